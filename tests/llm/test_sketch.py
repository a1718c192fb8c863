import hashlib

import pytest
from pyspark.sql import functions as F

from lacuna.llm import sketch


def units(text):
    return {line[i:i + sketch.PIECE] for line in text.split("\n") for i in range(0, len(line), sketch.PIECE)}


def like(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def sketch_of(keys):
    return sketch._sketch(keys, str(sketch.CELLS))


def test_matches_brute_force(docs, texts):
    ids = sorted(texts)
    found = sketch.versions(docs).withColumns({f"{k}_cells": sketch.cells(k) for k in ("own", "changed", "following")})
    found = found.withColumns({"x": sketch.difference("own", "changed", "own_cells", "changed_cells"),
                               "y": sketch.difference("own", "following", "own_cells", "following_cells")})
    rows = found.select("id", "n", F.sha2("edited", 256).alias("sha"), sketch.fingerprint("own_cells").alias("fp"),
                        sketch.likeness("own", "changed", "x").alias("near"), sketch.likeness("own", "following", "y").alias("next")).collect()
    got = {r.id: r for r in rows}
    assert sorted(got) == ids
    prints = {}
    for i, d in enumerate(ids):
        t, following = texts[d], texts[ids[(i + 1) % len(ids)]]
        k = len(t) // 4
        edited = t[:len(t) - k] + following[:k]
        r = got[d]
        assert r.n == len(t) and r.sha == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near == pytest.approx(like(units(t), units(edited))) and r.next == pytest.approx(like(units(t), units(following)))
        assert prints.setdefault(t, r.fp) == r.fp


def test_peeling_recovers_the_difference(spark):
    cases = [(0, [], []), (1, list(range(300)), list(range(290, 310))), (2, [5], []), (3, list(range(2000)), []),
             (4, list(range(50_000)), list(range(3, 50_010))), (5, list(range(4000)), list(range(4000, 9000)))]
    df = spark.createDataFrame(cases, "k int, a array<bigint>, b array<bigint>")
    for r in df.select("k", "a", "b", sketch.difference("a", "b", sketch_of("a"), sketch_of("b")).alias("d")).collect():
        assert set(r.d.left) == set(r.a) - set(r.b) and set(r.d.right) == set(r.b) - set(r.a)
        assert len(r.d.left) + len(r.d.right) == len(set(r.a) ^ set(r.b))


def test_odd_rows(odd, none):
    rows = sketch.versions(odd).collect()
    assert len(rows) == odd.count()
    assert {r.edited for r in rows if r.id == 3} == {""}
    one = sketch.versions(odd.where("doc_id = 7")).first()
    assert one.edited[:20] == "Été à la mer\n\nñandú "[:20] and one.following == one.own
    assert sketch.versions(none).collect() == []


def test_no_python_in_the_plan(docs):
    plan = sketch.versions(docs).withColumn("x", sketch.difference("own", "changed", sketch_of("own"), sketch_of("changed")))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
