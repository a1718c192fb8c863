"""Ordered and ranked work with a third of all rows in one key."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lacuna.functions import skew
from lacuna.operators import monitoring as mo

rng = np.random.default_rng(11)


def hot_rows(n=3000):
    key = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 30, n))
    return pd.DataFrame({"key": key, "line": rng.permutation(n * 5)[:n], "value": rng.lognormal(0, 4, n)})


@pytest.mark.parametrize("chunk", [40, 700, 1 << 20])
def test_position_is_the_row_number(spark, chunk):
    pdf = hot_rows()
    out = skew.with_position(spark.createDataFrame(pdf), ["key"], "line", "k", first_of="value", chunk=chunk).toPandas()
    pdf = pdf.sort_values(["key", "line"])
    pdf["k"] = pdf.groupby("key").cumcount()
    pdf["first_value"] = pdf.groupby("key")["value"].transform("first")
    out = out.sort_values(["key", "line"])[["key", "line", "value", "k", "first_value"]]
    assert out.to_numpy().tolist() == pdf[["key", "line", "value", "k", "first_value"]].to_numpy().tolist()


def test_halo_window_equals_the_whole_window(spark):
    df = spark.createDataFrame(hot_rows(1500))
    run = lambda chunk: mo.convergence(df, ["key"], "line", "value", 10, chunk).orderBy("key", "line").toPandas()
    small, whole = run(25), run(1 << 20)
    for c in ("k", "mean_window", "delta", "metric"):
        assert np.allclose(small[c], whole[c], equal_nan=True)


def test_first_value_of_zero_divides_as_floating_point_does(spark):
    df = spark.createDataFrame([(1, k, v) for k, v in enumerate([0.0, *[2.0] * 11, None])], "key long, line long, value double")
    rows = mo.convergence(df, ["key"], "line", "value").orderBy("line").collect()
    assert [str(r.mean_window) for r in rows] == ["None"] * 9 + ["nan", "inf", "inf", "inf"]
    assert [str(r.delta) for r in rows] == ["None"] * 10 + ["nan"] * 3
    assert [str(r.metric) for r in rows] == ["None"] * 11 + ["nan"] * 2


@pytest.mark.parametrize("share", [0.0001, 0.37, 0.9995, 1.0])
def test_order_statistic_on_heavy_tails_ties_and_zeros(spark, share):
    pdf = hot_rows()
    pdf.loc[rng.random(len(pdf)) < 0.35, "value"] = 7.25
    pdf.loc[rng.random(len(pdf)) < 0.05, "value"] = 0.0
    rank = lambda n: F.greatest(F.floor(n * share + 0.5), F.lit(1))
    got = {r["key"]: r["order_value"] for r in skew.order_statistic(
        spark.createDataFrame(pdf), ["key"], "value", rank, bins=8).collect()}
    for key, group in pdf.groupby("key"):
        v = np.sort(group["value"].to_numpy())
        assert got[key] == v[max(int(np.floor(len(v) * share + 0.5)), 1) - 1]
    assert len(got) == pdf["key"].nunique()


def brute_attempts(metrics):
    seen, attempt, out = set(), 1, []
    for m in metrics:
        if m in seen:
            seen, attempt = set(), attempt + 1
        seen.add(m)
        out.append(attempt)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 3), min_size=1, max_size=120), st.integers(1, 40))
def test_attempts_match_the_walk_for_any_chunk(spark, codes, chunk):
    names = [mo.METRICS[c] for c in codes]
    rows = [(1, i * 3, m, float(i)) for i, m in enumerate(names)] + [(2, 5, mo.METRICS[0], 1.0)]
    df = spark.createDataFrame(rows, "slice long, line_no long, metric string, value double")
    out = mo.number_attempts(df, ["slice"], "line_no", chunk=chunk).where("slice = 1").orderBy("line_no").collect()
    assert [r["attempt"] for r in out] == brute_attempts(names)
    assert [r["metric"] for r in out] == names


def sparse_hot_rows(n=40_000):
    key = np.where(rng.random(n) < 0.9, 0, rng.integers(1, 30, n))
    return pd.DataFrame({"key": key, "line": rng.integers(-2**62, 2**62, n), "value": rng.random(n)})


def test_ranges_are_of_equal_size_for_a_hot_key_with_a_sparse_order(spark):
    df = spark.createDataFrame(sparse_hot_rows()).repartition(8)
    sizes = sorted(r["count"] for r in skew.in_ranges(df, ["key"], "line").groupBy(F.shiftright("_at", 33)).count().collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert skew.in_ranges(df, ["key"], "line", 500).groupBy("key", "_chunk").count().agg(F.max("count")).first()[0] <= 500


@pytest.mark.parametrize("order", ["line", "name", "pair"])
def test_positions_by_any_order_column(spark, order):
    pdf = sparse_hot_rows(3000)
    df = spark.createDataFrame(pdf).withColumns({"name": F.col("line").cast("string"), "pair": F.struct("value", "line")})
    pdf["name"] = pdf["line"].astype(str)
    pdf = pdf.sort_values(["key", "value" if order == "pair" else order])
    want = list(zip(pdf["key"], pdf["line"], pdf.groupby("key").cumcount(), strict=True))
    got = [(r.key, r.line, r.k) for r in skew.with_position(df, ["key"], order, chunk=100).collect()]
    assert sorted(got) == sorted(want)
    alone = skew.with_position(df.where("key > 20"), [], order).orderBy("k").collect()
    assert [r.k for r in alone] == list(range(len(alone)))
    assert [r[order] for r in alone] == sorted(r[order] for r in alone)


def test_attempts_of_a_sparse_order(spark):
    codes = rng.integers(0, 4, 2000).tolist()
    lines = np.sort(rng.choice(2**60, 2000, replace=False)).tolist()
    df = spark.createDataFrame([(1, n, mo.METRICS[c], 0.0) for n, c in zip(lines, codes, strict=True)],
                               "slice long, line_no long, metric string, value double").repartition(5)
    out = mo.number_attempts(df, ["slice"], "line_no", chunk=50).orderBy("line_no").collect()
    assert [r["attempt"] for r in out] == brute_attempts([mo.METRICS[c] for c in codes])
