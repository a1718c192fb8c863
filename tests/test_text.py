import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lacuna.functions import bits, text
from lacuna.operators import masks as mk
from lacuna.operators import monitoring as mo
from lacuna.sources import params as pr

relaxed = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@relaxed
@given(st.lists(st.sets(st.integers(0, 60), min_size=1, max_size=30), min_size=1, max_size=8))
def test_ranges_round_trip(spark, sets):
    df = spark.createDataFrame([(sorted(s),) for s in sets], "n array<bigint>")
    out = df.select("n", text.expand_ranges(text.compact_ranges(F.col("n"))).alias("m")).collect()
    assert all(r["n"] == r["m"] for r in out)


def test_only_stride_one_is_joined(spark):
    row = spark.createDataFrame([([1, 2, 5, 6, 9],)], "n array<bigint>").select(text.compact_ranges(F.col("n"))).first()
    assert row[0] == "1_to_2_5_to_6_9"


@relaxed
@given(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 6), st.text("01 x\n", max_size=40)), min_size=1, max_size=8))
def test_mask_repair(spark, cases):
    df = spark.createDataFrame(cases, "ny int, nz int, t string")
    for r in df.select("*", mk.repair(F.col("t"), F.col("ny"), F.col("nz")).alias("m")).collect():
        want = "".join("1" if c == "1" else "0" for c in r["t"]).ljust(r["ny"] * r["nz"], "0")[: r["ny"] * r["nz"]]
        assert r["m"] == want


@relaxed
@given(st.lists(st.integers(0, 65535), min_size=1, max_size=30))
def test_flags_pack_back(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "w int")
    flags = df.select("w", *bits.flag_columns(F.col("w")))
    out = flags.select("w", bits.pack_flags([F.col(n) for n in bits.FILE_STATUS]).alias("p")).collect()
    assert all(r["w"] == r["p"] for r in out)


@relaxed
@given(st.lists(st.floats(width=32, allow_nan=False, allow_infinity=False), min_size=1, max_size=20))
def test_single_precision_fields(spark, values):
    df = spark.createDataFrame([(bytearray(np.array([v], ">f4").tobytes()), float(np.float32(v))) for v in values], "b binary, v double")
    assert all(r[0] == r[1] for r in df.select("v", bits.float32(F.col("b"), 0)).collect())


def test_options_last_token_wins(spark):
    df = spark.createDataFrame([(["a=1", "flag", "a=2", "b=x=y", ""],)], "t array<string>")
    assert df.select(text.options(F.col("t"))).first()[0] == {"a": "2", "flag": "true", "b": "x=y"}


def test_duration_beyond_a_day(spark):
    df = spark.createDataFrame([(90061.2345,), (0.0,), (400000.0,)], "s double")
    assert [r[0] for r in df.select(text.duration(F.col("s"))).collect()] == ["25:01:01.235", "00:00:00.000", "111:06:40.000"]


def test_log_lines(spark):
    lines = ["Slice 12: Time to load sparse data:  5.40 seconds.", "slice 7 : Time to set up recon:  6 seconds.",
             "Slice 12: Time to reconstruct data (With 1 iteration blocks):  120.13 seconds. ",
             'Slice 3: Reconstruction flag ("400") read', "ERROR: Slice 3: Time to load sparse data:  5.40 seconds.", ""]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [tuple(r) for r in mo.scan_log(df, []).collect()]
    assert got == [(12, "time_load", 5.4), (7, "time_setup", 6.0), (12, "time_recon", 120.13), (3, "iterations", 400.0)]


def test_parameter_files(spark):
    body = 'te 7 1\n3 1.5 2 -3e-1\n0\nname 2\n2 "a b"\n"c"\npetable 4\n1 "epi132alt8k2r"\nbad\n5 1 2\ncut\n2 "only"\n'
    rows = {r["key"]: r for r in pr.parse_params(spark.createDataFrame([("r", body)], "run string, text string")).collect()}
    assert rows["te"]["nums"] == [1.5, 2.0, -0.3] and rows["te"]["complete"]
    assert rows["name"]["strs"] == ["a b", "c"]
    assert not rows["bad"]["complete"] and not rows["cut"]["complete"]
    out = pr.derive(pr.parse_params(spark.createDataFrame([("r", body)], "run string, text string"))).first()
    assert (out["numshots"], out["accfactor"], out["navechoes"]) == (8.0, 2.0, 4.0)


def test_numbers_over_the_width_keep_their_digits(spark):
    df = spark.createDataFrame([(7,), (999,), (1000,), (123456,)], "n long")
    got = [r[0] for r in df.select(text.volume_id(F.lit("S1"), F.col("n"))).collect()]
    assert got == ["S1_m007", "S1_m999", "S1_m1000", "S1_m123456"]


def test_parameter_records_stay_in_the_jvm_and_may_be_many(spark):
    body = "".join(f"key{i}\n{i % 4} {' '.join(str(i + j) for j in range(i % 4))}\n" if i % 2 else f'key{i}\n2 "a{i}"\n"it\'s"\n0\n' for i in range(4000))
    df = spark.createDataFrame([("r", body), ("none", None), ("empty", "")], "run string, text string")
    out = pr.parse_params(df)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    rows = {r["key"]: r for r in out.collect()}
    assert len(rows) == 4000 and all(r["complete"] for r in rows.values())
    assert rows["key3"]["nums"] == [3.0, 4.0, 5.0] and rows["key2"]["strs"] == ["a2", 'it"s'] and rows["key1"]["declared"] == 1


def test_parameter_files_of_one_split_are_parsed_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(pr, "FILES_A_TASK", 10)
    rows = [(i, f"te\n2 {i} 1\nname\n1 \"n{i}\"\n") for i in range(200)] + [(None, None), (7, "te\n2 7 1\n"), (7, "te\n2 7 1\n")]
    out = pr.parse_params(spark.createDataFrame(rows, "run long, text string").coalesce(1))
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) > 10 and max(per_task) < 100 and sum(per_task) == 402
    found = sorted((r.run, r.key, r.nums, r.strs) for r in out.collect())
    assert found == sorted([(str(i), "te", [float(i), 1.0], []) for i in [*range(200), 7, 7]] + [(str(i), "name", [], [f"n{i}"]) for i in range(200)])


def test_grouping_of_parameters_sorts_first_values_only(spark):
    body = "".join(f"key{i}\n9 {' '.join(str(i * j) for j in range(9))}\nsaid{i}\n2 \"a{i}\"\n\"b\"\n" for i in range(50))
    rows = [("a", body + 'petable\n1 "epi132alt8k2r"\nnavecho\n2 3 9\n'), ("b", body), ("c", "nseg\n1 6\n"), ("c", 'petable\n1 "epi132alt4k"\nnumshots\n0\n'),
            ("d", "nseg\n1 x\naccfactor\n1 0\n"), ("none", None), ("empty", "")]
    out = pr.derive(pr.parse_params(spark.createDataFrame(rows, "run string, text string")))
    found = sorted(tuple(r) for r in out.collect())
    assert found == [("a", "epi132alt8k2r", 8.0, 2.0, 1.0, 3.0, 12.0), ("b", None, 1.0, 1.0, 1.0, 0.0, 0.0),
                     ("c", "epi132alt4k", 6.0, 1.0, 1.0, 1.0, 6.0), ("d", None, 1.0, 0.0, 1.0, 0.0, None)]
    todo, sorted_types = [out._jdf.queryExecution().sparkPlan()], []
    while todo:
        node = todo.pop()
        children = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "SortAggregate":
            sorted_types += [children[0].output().apply(i).dataType().simpleString() for i in range(children[0].output().size())]
        todo += children
    assert sorted_types and not [t for t in sorted_types if t.startswith("array")]
