import pytest

from lacuna.functions import options, tables


def parse(spark, *tokens):
    df = spark.createDataFrame([(list(tokens),)], "tokens array<string>")
    return options.parse_options(df, "tokens").first()


def test_defaults(spark):
    r = parse(spark)
    assert (r.Itnlim, r.blocks, r.per_block, r.chunk_size, r.hamming_window) == (100, 1, 100.0, 30, 32)
    assert r.TVWeight == [0.0012] and r.xfmWeight == [0.006] and r.wavelet_dims == [12.0, 12.0] and r.wavelet_type == "Daubechies"
    assert r.fermi_filter and not r.keep_work and (r.fermi_w1, r.fermi_w2) == (0.15, 0.75)
    assert r.CS_table is None and r.CS_preview_data is None and r.problems == []
    assert {o.name for o in options.OPTIONS} <= set(r.asDict())


@pytest.mark.parametrize("tokens, limit, mask, problems", [
    (["50", "CS256_8x_pa18_pb54"], 50, "CS256_8x_pa18_pb54", []),
    (["CS256_8x_pa18_pb54", "50"], 50, "CS256_8x_pa18_pb54", []),
    (["roll_data", "50"], 50, None, []),
    (["roll_data", "x=1", "50"], 100, None, ["unknown 50", "unknown x"]),
    (["chunk_size=3", "50"], 100, None, ["unknown 50"]),  # loose forms end at the first key
    (["50", "Itnlim=20"], 20, None, ["Itnlim given twice"]),
    (["CS1_1x_", "CS_table=CS2_2x_"], 100, "CS2_2x_", ["CS_table given twice"]),
])
def test_loose_tokens(spark, tokens, limit, mask, problems):
    r = parse(spark, *tokens)
    assert (r.Itnlim, r.CS_table, r.problems) == (limit, mask, problems)


def test_plans_and_weights(spark):
    r = parse(spark, "iteration_strategy=10x5", "TVWeight=0.002", "xfmWeight=[1,2,3,4,5]")
    assert (r.Itnlim, r.blocks, r.re_init_count, r.per_block) == (50, 5, 4, 10.0)
    assert r.TVWeight == [0.002] * 5 and r.xfmWeight == [1.0, 2.0, 3.0, 4.0, 5.0] and r.problems == []
    assert parse(spark, "Itnlim=30", "re_init_count=2").per_block == 10.0
    assert parse(spark, "Itnlim=10", "re_init_count=2").problems == ["Itnlim not divisible"]
    assert parse(spark, "iteration_strategy=10x2", "TVWeight=1,2,3").problems == ["weights do not match the blocks"]
    assert parse(spark, "iteration_strategy=10", "keep_work").problems == ["bad iteration_strategy", "keep_work with iteration_strategy"]


def test_kinds_that_do_not_fit_keep_the_default(spark):
    r = parse(spark, "chunk_size=few", "fermi_w1=x", "TVWeight=a", "wavelet_type=Best", "keep_work=0", "CS_preview_data", "fermi_w2=")
    assert (r.chunk_size, r.fermi_w1, r.fermi_w2, r.TVWeight, r.wavelet_type, r.keep_work) == (30, 0.15, 0.75, [0.0012], "Daubechies", False)
    assert r.CS_preview_data == "slice"
    assert r.problems == ["bad chunk_size", "bad TVWeight", "bad fermi_w1", "bad fermi_w2", "bad wavelet_type"]


def test_table_functions_in_sql(spark):
    tables.register(spark)
    rows = spark.sql("SELECT t.s, r.value FROM VALUES ('3_to_5_9_4'), ('7') t(s), LATERAL expand_ranges(t.s) r").collect()
    assert sorted((r.s, r.value) for r in rows) == [("3_to_5_9_4", v) for v in (3, 4, 5, 9)] + [("7", 7)]
    assert [tuple(r) for r in spark.sql("SELECT * FROM key_values('a=1;b=2')").collect()] == [("a", "1"), ("b", "2")]
    plan = spark.sql("SELECT r.value FROM VALUES ('1_2') t(s), LATERAL expand_ranges(t.s) r")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
