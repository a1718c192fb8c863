import re

import pytest

from lacuna.llm import decontaminate


def brute(text, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = split(text), set(), set()
    for item, t in items:
        w = split(t)
        n = min(window, len(w))
        if n:
            wins = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def answers(df):
    return sorted((r.id is not None, r.id or 0, r.n_words, sum(b - a for a, b in r.spans), r["items"]) for r in df.collect())


@pytest.mark.parametrize("block", [150_000, 40])
def test_matches_brute_force(spark, docs, texts, block):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    extra = spark.createDataFrame([(900, "der die"), (901, None), (902, "!!"), (903, "est")], bench.schema)
    items += [(900, "der die"), (901, None), (902, "!!"), (903, "est")]
    got = answers(decontaminate.overlaps(docs, bench.union(extra), block_words=block))
    assert got == sorted((True, i, *brute(t, items)) for i, t in texts.items())
    assert any(n for *_, n, _ in got)


def test_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, "brown fox jumps over the lazy dog and runs away into"), (2, "ONE"), (3, None)],
                                  "item_id long, text string")
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = sorted((r.doc_id is not None, r.doc_id or 0, *brute(r.text, items)) for r in odd.collect())
    assert answers(decontaminate.overlaps(odd, bench)) == want
    assert decontaminate.overlaps(none, bench).collect() == []
    assert all(not r.spans for r in decontaminate.overlaps(odd, bench.where("false")).collect())


def test_cuts_spans_and_keeps_clean_rows(spark, odd):
    bench = spark.createDataFrame([(1, "brown fox jumps over the lazy dog and runs away into")], "item_id long, text string")
    out = decontaminate.decontaminate(odd, bench)
    assert out.columns == odd.columns and out.count() == odd.count()
    kept = {r.doc_id: r.text for r in out.collect()}
    assert kept[1] == "The quick  the forest again" and kept[4] is None and kept[7].startswith("Été à la mer")
    assert decontaminate.decontaminate(odd, bench, max_coverage=0.5).where("doc_id in (1, 2)").count() == 0


def test_short_items_that_stand_whole_are_cut(spark, odd):
    bench = spark.createDataFrame([(1, "Lazy dog"), (2, "quick fox"), (3, "again"), (4, None), (5, "")], "item_id long, text string")
    kept = {r.doc_id: r.text for r in decontaminate.decontaminate(odd, bench).collect()}
    assert kept[1] == "The quick brown fox jumps over the  and runs away into the forest "
    assert kept[4] is None and kept[7].startswith("Été à la mer")
    stay = {r.doc_id: r.text for r in decontaminate.decontaminate(odd, bench, max_span=1).collect()}
    assert stay[1] == "The quick brown fox jumps over the  and runs away into the forest again"
