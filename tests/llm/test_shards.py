import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lacuna.llm import shards


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def plain(rows, parts, tolerance):
    """(id, size, crc, shard, slot) by running sums over the sorted rows; ``rows`` are (id, text)."""
    rows = sorted(((number(t or ""), number("" if i is None else str(i)), i, (t or "").encode()) for i, t in rows),
                  key=lambda r: r[:2])
    ends, wholes, upto = [0], [0], 0
    for k, (group, _, _, text) in enumerate(rows):
        upto += len(text) + 1
        ends.append(upto)
        if k + 1 == len(rows) or rows[k + 1][0] != group:
            wholes.append(upto)
    cuts = []
    for j in range(1, parts):
        off = lambda b: abs(b * parts - j * upto)
        whole = min(wholes, key=lambda b: (off(b), b))
        cuts.append(whole if off(whole) <= tolerance * upto else min(ends, key=lambda b: (off(b), b)))
    out, slots = [], [0] * parts
    for at, (_, _, i, text) in zip(ends, rows, strict=False):
        shard = sum(c <= at for c in cuts)
        out.append((i, len(text) + 1, zlib.crc32(text), shard, slots[shard]))
        slots[shard] += 1
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r)[:5] for r in df.select("id", "size", "text_crc32", "shard", "slot").collect()), key=str)


@pytest.mark.parametrize("parts, tolerance", [(16, 0.01), (5, 0.0)])
def test_matches_running_sums(docs, texts, parts, tolerance):
    assert got(shards.assign(docs, parts, tolerance=tolerance)) == plain(list(texts.items()), parts, tolerance)


def test_one_text_and_one_row_that_fill_many_shards(spark):
    rows = [(i, "same text") for i in range(400)] + [(7, "equal row")] * 500 + [(i, f"text {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = got(shards.assign(df, 16))
    assert found == plain(rows, 16, shards.TOLERANCE)
    sizes = [sum(r[1] for r in found if r[3] == s) for s in range(16)]
    assert max(sizes) - min(sizes) <= 0.05 * sum(sizes) / 16 + 20


def test_copies_stay_together_where_the_balance_allows(docs):
    split = shards.assign(docs, 4, tolerance=0.05).groupBy("text_crc32").agg(F.countDistinct("shard").alias("n"))
    assert split.where("n > 1").count() == 0


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(shards.assign(odd, 3)) == plain(rows, 3, shards.TOLERANCE)
    assert got(shards.assign(odd, 16)) == plain(rows, 16, shards.TOLERANCE)
    assert shards.assign(none).collect() == []


def test_very_long_text(spark):
    df = spark.createDataFrame([(1, "é" * 1_500_000), (2, "a"), (3, None)], "doc_id long, text string")
    assert sorted(r.size for r in shards.assign(df, 2).collect()) == [1, 2, 3_000_001]


def test_whole_rows_are_written(odd, tmp_path):
    back = shards.write_shards(odd, str(tmp_path / "out"), 3)
    assert back.count() == odd.count()
    assert sorted(map(str, (tuple(r.row) for r in back.collect()))) == sorted(map(str, (tuple(r) for r in odd.collect())))
    assert back.groupBy("shard", "slot").count().where("count > 1").count() == 0


def test_no_python_in_the_plan(docs):
    plan = shards.assign(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
