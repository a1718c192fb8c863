import re
import sys

import duckdb
import pytest

from .conftest import FOLDER, root

sys.path.insert(0, str(root()))
import corpus_pipeline  # noqa: E402

from lacuna.llm import queries, simhash  # noqa: E402


def test_stages_keep_columns_and_clean_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).toPandas(), docs.schema)
        assert docs.columns == columns
        seen[name] = before, {r.doc_id: r.text for r in docs.collect()}
        assert all(r.n_chars == len(r.text) for r in docs.collect())
    before, after = seen["language"]
    assert set(before) == set(after)
    before, after = seen["near_duplicates"]
    found = simhash.near_duplicates(spark.createDataFrame(list(before.items()), "doc_id long, text string"), shingle=5)
    assert set(after) == {r.component for r in found.collect()}
    before, after = seen["benchmark_leaks"]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    wins = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = words(r.text)
        wins |= {tuple(w[i:i + 10]) for i in range(len(w) - 9)}
    leaky = lambda t: any(tuple(words(t)[i:i + 10]) in wins for i in range(len(words(t)) - 9))
    assert any(map(leaky, before.values())) and not any(map(leaky, after.values()))
    assert all(after[i] == t for i, t in before.items() if not leaky(t))
    before, after = seen["personal_data"]
    assert not any(re.search(r"[a-z0-9]@[a-z0-9]+\.", t) for t in after.values()) and set(before) == set(after)


def test_run_gives_tokens(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "ids", "n_tokens"} <= set(rows.columns)
    assert all(len(r.ids) == r.n_tokens for r in rows.collect())


def test_odd_rows(spark, odd, none):
    docs = odd.withColumn("source", odd.lang).select("doc_id", "text", "lang", "source", "n_chars")
    for given in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, given, FOLDER).collect()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_beside_its_sql(spark, name):
    found = queries.QUERIES[name](spark, FOLDER)
    rows = found.collect()
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    size = {"op1": "SELECT count(*) FROM pages", "op12": "SELECT 10 * count(*) FROM benchmark",
            "op13": "SELECT count(DISTINCT conv_id) FROM conversations"}
    assert len(rows) == con.execute(size.get(name.split("_")[0], "SELECT count(*) FROM documents")).fetchone()[0]
    if name in queries.SQL:
        want = con.execute(queries.SQL[name])
        names = [c[0] for c in want.description]
        assert sorted(names) == sorted(found.columns)
        assert sorted(str([r[c] for c in names]) for r in rows) == sorted(str(list(r)) for r in want.fetchall())
