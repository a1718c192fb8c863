"""Queries on multi-echo data: four consecutive slices are the echoes of one volume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.operators import echoes as ec
from lacuna.plans import adapters as ad
from lacuna.plans.registry import query, table
from lacuna.plans.transforms import voxels

ECHO_SQL = f"(SELECT slice // 4 AS volume, slice % 4 AS echo, pos, y, z, re, im, 0.005::DOUBLE * (slice % 4 + 1) AS te FROM {ad.VOXEL_SQL})"
COEF_SQL = "CASE echo WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.5::DOUBLE WHEN 2 THEN 0.25::DOUBLE ELSE 0.125::DOUBLE END"


def echo_rows(spark: SparkSession, folder: str) -> DataFrame:
    v = voxels(spark, folder)
    return v.select(F.floor(F.col("slice") / 4).alias("volume"), (F.col("slice") % 4).alias("echo"), "pos", "y", "z", "re", "im",
                    (0.005 * (F.col("slice") % 4 + 1)).alias("te"))


@query(f"SELECT volume, pos, round(sqrt(sum(re * re)), 9) AS rss FROM {ECHO_SQL} GROUP BY 1, 2")
def echo_rss(spark: SparkSession, folder: str) -> DataFrame:
    return ec.root_sum_of_squares(echo_rows(spark, folder), ["volume", "pos"], "re").withColumn("rss", F.round("rss", 9))


@query(f"""SELECT volume, echo, pos, round(atan2(im, re), 9) + 0.0 AS phase, round(atan2(im, re) * {COEF_SQL}, 9) + 0.0 AS frequency,
  round(atan2(im, re) / (2 * pi() * 0.0125), 6) + 0.0 AS hertz FROM {ECHO_SQL}""")
def echo_frequency(spark: SparkSession, folder: str) -> DataFrame:
    coefficients = spark.range(4).select(F.col("id").alias("echo"), F.pow(F.lit(0.5), F.col("id")).alias("coefficient"))
    rows = ec.echo_frequency(ec.echo_phase(echo_rows(spark, folder)), coefficients)
    return rows.select("volume", "echo", "pos", (F.round("phase", 9) + 0.0).alias("phase"), (F.round("frequency", 9) + 0.0).alias("frequency"),
                       (F.round(ec.rescale_frequency(F.col("phase"), 0.0125), 6) + 0.0).alias("hertz"))


@query(f"""SELECT volume, pos, round(sum(v * te * exp(-te / 0.02)) / sum(CASE WHEN v IS NOT NULL THEN te * exp(-te / 0.02) END), 9) + 0.0 AS combined
  FROM (SELECT *, CASE WHEN (pos + echo) % 5 <> 0 THEN re END AS v FROM {ECHO_SQL}) WHERE echo < 3 GROUP BY 1, 2""")
def echo_combine(spark: SparkSession, folder: str) -> DataFrame:
    rows = echo_rows(spark, folder)
    holes = F.when((F.col("pos") + F.col("echo")) % 5 == 0, F.lit(float("nan"))).otherwise(F.col("re"))
    weighted = rows.withColumns({"v": holes, "w": ec.decay_weight(F.col("te"), 0.02)})
    out = ec.combine(weighted, ["volume", "pos"], "v", "w", 3)
    return out.withColumn("combined", F.round("combined", 9) + 0.0)


@query(f"""SELECT volume, pos, echoes, round(exp(i), 6) AS amplitude, round(-s, 6) + 0.0 AS r2, CASE WHEN s < 0 THEN round(-1 / s, 6) END AS t2 FROM (
  SELECT volume, pos, regr_slope(ln(v), te) AS s, regr_intercept(ln(v), te) AS i, count(*) AS echoes FROM (SELECT volume, pos, te, sqrt(re * re + im * im) + 0.001 AS v FROM {ECHO_SQL}) GROUP BY 1, 2)""")
def decay_fit(spark: SparkSession, folder: str) -> DataFrame:
    rows = echo_rows(spark, folder).withColumn("v", F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im")) + 0.001)
    fit = ec.decay_fit(rows, ["volume", "pos"], "v", "te")
    return fit.select("volume", "pos", "echoes", F.round("amplitude", 6).alias("amplitude"),
                      (F.round("r2", 6) + 0.0).alias("r2"), F.round("t2", 6).alias("t2"))


@query(f"""SELECT v.slice, v.pos, CASE WHEN v.re > 0 AND w.re > -0.05 THEN v.re ELSE 0 END AS masked FROM {ad.VOXEL_SQL} v
  JOIN {ad.VOXEL_SQL} w ON v.slice = w.slice AND w.pos = 63 - v.pos""")
def mask_product(spark: SparkSession, folder: str) -> DataFrame:
    """Two masks as tables; the second one is looked up at the mirrored position."""
    v = voxels(spark, folder).select("slice", "pos", "re")
    first = v.select("slice", "pos", (F.col("re") > 0).alias("inside"))
    second = v.where("re > -0.05").select("slice", (63 - F.col("pos")).alias("pos"), F.lit(True).alias("inside"))
    out = ec.apply_masks(v, [first, second], ["slice", "pos"], "re")
    return out.select("slice", "pos", (F.col("masked") + 0.0).alias("masked"))


BALL = [(a, b) for a in range(-2, 3) for b in range(-2, 3) if a * a + b * b <= 4]
BALL_SQL = "(VALUES " + ", ".join(f"({a}, {b})" for a, b in BALL) + ") o(a, b)"


@query(f"""WITH m AS (SELECT slice, y, z FROM {ad.VOXEL_SQL} WHERE re > 0.12),
  g AS (SELECT DISTINCT slice, y + a AS y, z + b AS z FROM m, {BALL_SQL} WHERE y + a BETWEEN 0 AND 7 AND z + b BETWEEN 0 AND 7),
  c AS (SELECT slice, y, z, a, b FROM (SELECT DISTINCT slice FROM m), (SELECT unnest(range(8)) AS y), (SELECT unnest(range(8)) AS z), {BALL_SQL} WHERE y + a BETWEEN 0 AND 7 AND z + b BETWEEN 0 AND 7)
SELECT c.slice, CAST(c.y AS INTEGER) AS y, CAST(c.z AS INTEGER) AS z FROM c LEFT JOIN g ON g.slice = c.slice AND g.y = c.y + a AND g.z = c.z + b GROUP BY 1, 2, 3 HAVING count(g.slice) = count(*)""")
def mask_closing(spark: SparkSession, folder: str) -> DataFrame:
    inside = voxels(spark, folder).where("re > 0.12").select("slice", "y", "z")
    return ec.close_mask(inside, ["slice"], {"y": 8, "z": 8}, 2)
