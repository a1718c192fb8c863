"""Queries on transforms and recovery."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions import kernels, linops
from lacuna.operators import recovery as rc
from lacuna.operators import transforms as tf
from lacuna.plans import adapters as ad
from lacuna.plans.registry import query, table
from lacuna.session import work_dir
from lacuna.sources import state as st

V = ad.VOXEL_SQL
DIGITS = 8


def dft2_sql(src: str, sign: int, key: str = "slice", n: int = 8) -> str:
    """Centred orthonormal 2-D DFT of (key, y, z, re, im); sign -1 forward, +1 inverse."""
    s = "+" if sign < 0 else "-"
    r = "-" if sign < 0 else "+"
    h = n // 2

    def half(src: str, axis: str, out: str, rest: str) -> str:
        angle = f"2 * pi() * ({out} - {h}) * ({axis} - {h}) / {n}"
        return (f"(SELECT {key}, {out}, {rest}, sum(re * cos({angle}) {s} im * sin({angle})) AS re, "
                f"sum(im * cos({angle}) {r} re * sin({angle})) AS im FROM {src}, (SELECT CAST(unnest(range({n})) AS INTEGER) AS {out}) GROUP BY 1, 2, 3)")

    inner = half(src, "y", "ky", "z")
    return f"(SELECT {key}, ky, kz, re / {n} AS re, im / {n} AS im FROM {half(inner, 'z', 'kz', 'ky')})"


def long_rows(df: DataFrame, key: str = "slice", ny: int = 8, names=("ky", "kz"), digits: int = DIGITS) -> DataFrame:
    rows = df.select(key, F.posexplode(F.arrays_zip("re", "im")).alias("p", "v"))
    return rows.select(key, (F.col("p") % ny).alias(names[0]), F.floor(F.col("p") / ny).cast("int").alias(names[1]),
                       (F.round("v.re", digits) + 0.0).alias("re"), (F.round("v.im", digits) + 0.0).alias("im"))


def rounded(sql: str, cols: str, digits: int = DIGITS) -> str:
    return f"SELECT {cols}, round(re, {digits}) + 0.0 AS re, round(im, {digits}) + 0.0 AS im FROM {sql}"


# ---------------------------------------------------------------- Fourier

READOUT_SQL = f"""(SELECT volume, trace, k AS x,
    sum(re * cos(2 * pi() * (k - 16) * (x - 16) / 32) - im * sin(2 * pi() * (k - 16) * (x - 16) / 32)) / 32 AS re,
    sum(re * sin(2 * pi() * (k - 16) * (x - 16) / 32) + im * cos(2 * pi() * (k - 16) * (x - 16) / 32)) / 32 AS im
  FROM {ad.POINT_SQL}, (SELECT CAST(unnest(range(32)) AS INTEGER) AS k) GROUP BY 1, 2, 3)"""


@query(rounded(READOUT_SQL, "volume, trace, x"))
def readout_ifft(spark: SparkSession, folder: str) -> DataFrame:
    out = tf.readout_ifft(ad.traces(spark, folder))
    return out.select("volume", "trace", F.posexplode(F.arrays_zip("re", "im")).alias("x", "v")).select(
        "volume", "trace", "x", (F.round("v.re", DIGITS) + 0.0).alias("re"), (F.round("v.im", DIGITS) + 0.0).alias("im"))


@query(f"""SELECT volume, x, count(*) AS traces, sum(round(re * 1000000) * (trace + 1)) AS re_moment, sum(round(im * 1000000) * (trace + 1)) AS im_moment
  FROM {ad.POINT_SQL} GROUP BY 1, 2""")
def trace_to_slice(spark: SparkSession, folder: str) -> DataFrame:
    slices = tf.traces_to_slices(ad.traces(spark, folder), ad.TRACES_PER_VOLUME)
    moment = lambda c: F.aggregate(F.transform(c, lambda v, i: F.round(v * 1000000) * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    filled = F.size(F.filter(F.arrays_zip("re", "im"), lambda v: (v.re != 0) | (v.im != 0))).cast("bigint")
    return slices.select("volume", "x", filled.alias("traces"), moment("re").alias("re_moment"), moment("im").alias("im_moment"))


@query(rounded(dft2_sql(V, -1), "slice, ky, kz"))
def slice_fft2(spark: SparkSession, folder: str) -> DataFrame:
    return long_rows(tf.slice_fft(ad.complex_slices(spark, folder), 8, 8))


@query(rounded(dft2_sql(V, 1), "slice, ky, kz"))
def slice_ifft2(spark: SparkSession, folder: str) -> DataFrame:
    return long_rows(tf.slice_fft(ad.complex_slices(spark, folder), 8, 8, inverse=True))


@query(f"SELECT slice, round(max(sqrt(re * re + im * im)) / 8, {DIGITS}) AS slice_max FROM {dft2_sql(V, 1)} GROUP BY slice")
def slice_peak(spark: SparkSession, folder: str) -> DataFrame:
    peaks = tf.slice_peak(ad.complex_slices(spark, folder), 8, 8)
    return peaks.select("slice", F.round("slice_max", DIGITS).alias("slice_max"))


# eight slices make one volume
STACK_SQL = f"(SELECT CAST(slice // 8 AS INTEGER) AS volume, CAST(slice % 8 AS INTEGER) AS x, y, z, re, im FROM {V})"


def stacked(spark: SparkSession, folder: str) -> DataFrame:
    s = ad.complex_slices(spark, folder)
    return s.select(F.floor(F.col("slice") / 8).cast("int").alias("volume"), (F.col("slice") % 8).cast("int").alias("x"), "re", "im")


def dft3_sql(keep: str = "true") -> str:
    plane = dft2_sql(f"(SELECT volume * 8 + x AS slice, y, z, re, im FROM {STACK_SQL})", -1)
    angle = "2 * pi() * (kx - 4) * (slice % 8 - 4) / 8"
    return (f"(SELECT CAST(slice // 8 AS INTEGER) AS volume, kx, ky, kz, 8 * sum(re * cos({angle}) + im * sin({angle})) AS re, "
            f"8 * sum(im * cos({angle}) - re * sin({angle})) AS im FROM {plane}, (SELECT CAST(unnest(range(8)) AS INTEGER) AS kx) WHERE {keep} GROUP BY 1, 2, 3, 4)")


@query(rounded(dft3_sql(), "volume, kx AS x, ky + 8 * kz AS pos", 7))
def volume_fft3(spark: SparkSession, folder: str) -> DataFrame:
    k = tf.volume_fft(stacked(spark, folder), 8, 8, 8)
    return k.select("volume", "x", "pos", (F.round("re", 7) + 0.0).alias("re"), (F.round("im", 7) + 0.0).alias("im"))


def idft3_sql(src: str, n: int) -> str:
    h = n // 2

    def step(src: str, k: str, out: str, rest: str) -> str:
        a = f"2 * pi() * ({out} - {h}) * ({k} - {h}) / {n}"
        return (f"(SELECT volume, {out}, {rest}, sum(re * cos({a}) - im * sin({a})) / {n} AS re, sum(im * cos({a}) + re * sin({a})) / {n} AS im "
                f"FROM {src}, (SELECT CAST(unnest(range({n})) AS INTEGER) AS {out}) GROUP BY 1, 2, 3, 4)")

    return step(step(step(src, "kx", "x", "ky, kz"), "ky", "y", "x, kz"), "kz", "z", "x, y")


@query(rounded(idft3_sql(f"(SELECT volume, kx - 2 AS kx, ky - 2 AS ky, kz - 2 AS kz, re, im FROM {dft3_sql()} WHERE kx BETWEEN 2 AND 5 AND ky BETWEEN 2 AND 5 AND kz BETWEEN 2 AND 5)", 4),
               "volume, x, CAST(y + 4 * z AS INTEGER) AS pos", 7))
def kspace_downsample(spark: SparkSession, folder: str) -> DataFrame:
    small = tf.downsample(stacked(spark, folder), (8, 8, 8), (4, 4, 4))
    return small.select("volume", "x", "pos", (F.round("re", 7) + 0.0).alias("re"), (F.round("im", 7) + 0.0).alias("im"))


@query("""SELECT o_orderkey AS volume, factor, CAST(floor(192 / factor + 0.5) AS INTEGER) AS nx, CAST(floor(128 / factor + 0.5) AS INTEGER) AS ny, CAST(floor(100 / factor + 0.5) AS INTEGER) AS nz
  FROM orders, (VALUES (1.5::DOUBLE), (2.0::DOUBLE), (4.0::DOUBLE)) f(factor) WHERE NOT (o_orderstatus = 'F' AND factor = 2.0)""")
def reduction_plan(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumnRenamed("o_orderkey", "volume")
    done = orders.where("o_orderstatus = 'F'").select("volume", F.lit(2.0).alias("factor"))
    return tf.reduction_plan(orders, (1.5, 2.0, 4.0), done, (192, 128, 100))


@query(rounded(f"""(SELECT slice, pos, re * cos(a) - im * sin(a) AS re, re * sin(a) + im * cos(a) AS im FROM
  (SELECT *, 2 * pi() * ((y + 1) * (slice % 5) / 8.0 + (z + 1) * (slice % 3) / 8.0) AS a FROM {V}))""", "slice, pos"))
def phase_ramp(spark: SparkSession, folder: str) -> DataFrame:
    v = voxels(spark, folder)
    out = tf.phase_ramp(v, F.col("slice") % 5, F.col("slice") % 3, 8, 8)
    return out.select("slice", "pos", (F.round("re", DIGITS) + 0.0).alias("re"), (F.round("im", DIGITS) + 0.0).alias("im"))


def voxels(spark: SparkSession, folder: str) -> DataFrame:
    rows = ad.complex_slices(spark, folder).select(
        "volume", "slice", F.posexplode(F.arrays_zip("re", "im")).alias("pos", "v"))
    return rows.select("volume", "slice", "pos", (F.col("pos") % 8).alias("y"),
                       F.floor(F.col("pos") / 8).cast("int").alias("z"), "v.re", "v.im")


@query(f"""SELECT slice, pos, CAST(round(sqrt(re * re + im * im), {DIGITS}) AS DOUBLE) AS magnitude, round(atan2(im, re), {DIGITS}) + 0.0 AS phase,
  round(re * re + im * im, {DIGITS}) AS power, re / 2 AS half_re FROM {V}""")
def complex_columns(spark: SparkSession, folder: str) -> DataFrame:
    from lacuna.functions import cplx

    v, z = voxels(spark, folder), (F.col("re"), F.col("im"))
    power = cplx.multiply(z, cplx.conjugate(z))[0]
    return v.select("slice", "pos", F.round(cplx.magnitude(*z), DIGITS).alias("magnitude"),
                    (F.round(cplx.phase(*z), DIGITS) + 0.0).alias("phase"), F.round(power, DIGITS).alias("power"),
                    (F.col("re") / 2).alias("half_re"))


IMAGE2_SQL = f"(SELECT CAST(slice // 8 AS INTEGER) AS volume, CAST(slice % 8 AS INTEGER) AS x, ky AS y, kz AS z, re / 8 AS re, im / 8 AS im FROM {dft2_sql(V, 1)})"
PREVIEW_SQL = f"""(SELECT 'kspace' AS kind, * FROM {STACK_SQL} UNION ALL SELECT 'image', * FROM {IMAGE2_SQL}
  UNION ALL SELECT 'inverse', volume, x, y, z, re, im FROM {idft3_sql(f"(SELECT volume, x AS kx, y AS ky, z AS kz, re, im FROM {IMAGE2_SQL})", 8)})"""


@query(rounded(f"(SELECT * FROM {PREVIEW_SQL} WHERE x = 4 OR y = 4 OR z = 4)", "kind, volume, x, y + 8 * z AS pos", 7))
def preview_planes(spark: SparkSession, folder: str) -> DataFrame:
    out = tf.preview(stacked(spark, folder), 8, 8, 8)
    return out.select("kind", "volume", "x", "pos", (F.round("re", 7) + 0.0).alias("re"), (F.round("im", 7) + 0.0).alias("im"))


# ---------------------------------------------------------------- masked Fourier, gradient, wavelet, cosine

MASKED = "(ky * 3 + kz * 5 + slice) % 4 <> 0"


def masked_slices(spark: SparkSession, folder: str) -> DataFrame:
    rule = lambda p: F.when((p % 8 * 3 + F.floor(p / 8) * 5 + F.col("slice")) % 4 != 0, 1.0).otherwise(0.0)
    return ad.complex_slices(spark, folder).withColumn("mask", F.transform(F.sequence(F.lit(0), F.lit(63)), rule))


@query(rounded(f"(SELECT slice, ky, kz, CASE WHEN {MASKED} THEN re ELSE 0 END AS re, CASE WHEN {MASKED} THEN im ELSE 0 END AS im FROM {dft2_sql(V, -1)})", "slice, ky, kz"))
def masked_fourier(spark: SparkSession, folder: str) -> DataFrame:
    return long_rows(tf.masked_fourier(masked_slices(spark, folder), 8, 8))


@query(rounded(dft2_sql(f"(SELECT slice, y, z, CASE WHEN {MASKED.replace('ky', 'y').replace('kz', 'z')} THEN re ELSE 0 END AS re, CASE WHEN {MASKED.replace('ky', 'y').replace('kz', 'z')} THEN im ELSE 0 END AS im FROM {V})", 1), "slice, ky, kz"))
def masked_fourier_adjoint(spark: SparkSession, folder: str) -> DataFrame:
    return long_rows(tf.masked_fourier(masked_slices(spark, folder), 8, 8, adjoint=True))


GRAD_SQL = f"""(SELECT slice, y, z, re, coalesce(lead(re) OVER (PARTITION BY slice, z ORDER BY y) - re, 0) AS dy,
  coalesce(lead(re) OVER (PARTITION BY slice, y ORDER BY z) - re, 0) AS dz FROM {V})"""


@query(f"SELECT slice, y, z, dy, dz FROM {GRAD_SQL}")
def tv_forward(spark: SparkSession, folder: str) -> DataFrame:
    diffs = tf.gradient_planes(ad.slices(spark, folder), 8, 8, ("slice",))
    return diffs.select("slice", F.posexplode(F.arrays_zip("dy", "dz")).alias("p", "d")).select(
        "slice", (F.col("p") % 8).alias("y"), F.floor(F.col("p") / 8).cast("int").alias("z"), "d.dy", "d.dz")


@query(f"""SELECT slice, y, z, round(ay + az, {DIGITS}) + 0.0 AS adjoint FROM (SELECT slice, y, z,
  coalesce(lag(dy) OVER (PARTITION BY slice, z ORDER BY y), 0) - CASE WHEN y < 7 THEN dy ELSE 0 END AS ay,
  coalesce(lag(dz) OVER (PARTITION BY slice, y ORDER BY z), 0) - CASE WHEN z < 7 THEN dz ELSE 0 END AS az FROM {GRAD_SQL})""")
def tv_adjoint(spark: SparkSession, folder: str) -> DataFrame:
    diffs = tf.gradient_rows(voxels(spark, folder), ["slice"])
    out = tf.gradient_adjoint_rows(diffs, ["slice"], 8, 8)
    return out.select("slice", "y", "z", (F.round("adjoint", DIGITS) + 0.0).alias("adjoint"))


TAPS = [(math.sqrt(2) * c) for c in ((1 + math.sqrt(3)) / 8, (3 + math.sqrt(3)) / 8, (3 - math.sqrt(3)) / 8, (1 - math.sqrt(3)) / 8)]
TAP_SQL = "(VALUES " + ", ".join(
    f"({k}, 0, {f!r}::DOUBLE), ({1 - k}, 1, {(f if k % 2 == 0 else -f)!r}::DOUBLE)" for k, f in enumerate(TAPS)) + ") t(off, band, f)"


def wavelet_sql(src: str) -> str:
    """One analysis level along y, then z, as joins to the filter taps."""

    def step(src: str, axis: str, out: str, rest: str) -> str:
        return (f"(SELECT slice, CAST(i + 4 * band AS INTEGER) AS {out}, {rest}, sum(re * f) AS re, sum(im * f) AS im FROM (SELECT * FROM (SELECT unnest(range(4)) AS i), {TAP_SQL}) w "
                f"JOIN {src} v ON v.{axis} = (2 * i + off + 8) % 8 GROUP BY 1, 2, 3)")

    return step(step(src, "y", "ky", "z"), "z", "kz", "ky")


@query(rounded(wavelet_sql(V), "slice, ky, kz"))
def wavelet_level(spark: SparkSession, folder: str) -> DataFrame:
    return long_rows(tf.apply_operator(ad.complex_slices(spark, folder), linops.Wavelet("Daubechies", 4, 2), 8, 8))


@query(rounded(V, "slice, y AS ky, z AS kz", 7))
def wavelet_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    op = linops.Wavelet("Symmlet", 4, 1)
    there = tf.apply_operator(ad.complex_slices(spark, folder), op, 8, 8)
    return long_rows(tf.apply_operator(there, op, 8, 8, adjoint=True), digits=7)


@query(f"""SELECT slice, CAST(u AS INTEGER) AS u, CAST(v AS INTEGER) AS v, round(sum(re * cos(pi() * (2 * y + 1) * u / 16) * cos(pi() * (2 * z + 1) * v / 16))
   * CASE WHEN u = 0 THEN sqrt(0.125) ELSE 0.5 END * CASE WHEN v = 0 THEN sqrt(0.125) ELSE 0.5 END, {DIGITS}) + 0.0 AS coef
  FROM {V}, (SELECT unnest(range(8)) AS u), (SELECT unnest(range(8)) AS v) GROUP BY slice, u, v""")
def block_cosine(spark: SparkSession, folder: str) -> DataFrame:
    coef = tf.block_cosine(ad.slices(spark, folder), 8, 8)
    rows = coef.select("slice", F.posexplode("coef").alias("p", "c"))
    return rows.select("slice", (F.col("p") % 8).alias("u"), F.floor(F.col("p") / 8).cast("int").alias("v"),
                       (F.round("c", DIGITS) + 0.0).alias("coef"))


# ---------------------------------------------------------------- objective, differences, recovery


@query(f"""SELECT slice, round(sum(pow(re - im, 2)), {DIGITS}) AS data_term, round(sum(sqrt(re * re + im * im + 1e-15)), {DIGITS}) AS l1_term,
  round(sum(sqrt(dy * dy + 1e-15) + sqrt(dz * dz + 1e-15)), {DIGITS}) AS tv_term, round(sqrt(sum(pow(re - im, 2)) / count(*) FILTER (WHERE y % 2 = 0)), {DIGITS}) AS rms
  FROM (SELECT g.*, v.im FROM {GRAD_SQL} g JOIN {V} v ON g.slice = v.slice AND g.y = v.y AND g.z = v.z) GROUP BY slice""")
def objective_terms(spark: SparkSession, folder: str) -> DataFrame:
    rows = tf.gradient_rows(voxels(spark, folder), ["slice"]).select(
        "slice", (F.col("re") - F.col("im")).alias("rre"), F.lit(0.0).alias("rim"), F.col("re").alias("wre"), F.col("im").alias("wim"),
        F.col("dy").alias("dy_re"), F.lit(0.0).alias("dy_im"), F.col("dz").alias("dz_re"), F.lit(0.0).alias("dz_im"),
        (F.col("y") % 2 == 0).alias("sampled"))
    terms = tf.objective_terms(rows, ["slice"])
    return terms.select("slice", *[F.round(c, DIGITS).alias(c) for c in ("data_term", "l1_term", "tv_term", "rms")])


@query(f"""SELECT a.volume, round(sum(sqrt(a.re * a.re + a.im * a.im) - abs(b.re) * sqrt(2)), 6) + 0.0 AS sum_diff,
  round(sum(sqrt(pow(a.re - b.re, 2) + pow(a.im - b.re, 2))), 6) AS sum_abs_diff, round(sum(sqrt(a.re * a.re + a.im * a.im)), 6) AS sum_left,
  round(sum(abs(b.re) * sqrt(2)), 6) AS sum_right FROM {V} a JOIN {V} b ON a.slice = b.slice AND a.pos = b.pos GROUP BY 1""")
def run_diff(spark: SparkSession, folder: str) -> DataFrame:
    s = ad.complex_slices(spark, folder)
    report = tf.run_difference(s, s.select("slice", "re", F.col("re").alias("im")), ["slice"], ["volume"])
    return report.select("volume", *[(F.round(c, 6) + 0.0).alias(c) for c in ("sum_diff", "sum_abs_diff", "sum_left", "sum_right")])


def undersampled(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """K-space of each slice at the mask's positions, and the three masks in use."""
    k = tf.slice_fft(ad.slices(spark, folder).withColumn("im", F.transform("re", lambda v: v * 0)), 8, 8)
    kind = (F.col("slice") % 3).cast("int")
    acquired = lambda kind: lambda p: ((p % 8 * 3 + F.floor(p / 8) * 5 + kind) % 3 != 0) | (
        (F.abs(p % 8 - 4) <= 1) & (F.abs(F.floor(p / 8) - 4) <= 1))
    positions = lambda kind: F.filter(F.sequence(F.lit(0), F.lit(63)), acquired(kind))
    at = lambda c: F.transform("positions", lambda p: F.get(F.col(c), p))
    samples = k.withColumns({"mask_id": kind, "positions": positions(kind)}).select(
        "volume", "slice", "mask_id", at("re").alias("re"), at("im").alias("im"))
    masks = spark.range(3).select(F.col("id").cast("int").alias("mask_id"), positions(F.col("id")).alias("positions"),
                                  F.array_repeat(F.lit(0.7), 64).alias("density"))
    return samples, masks


OPTIONS = rc.RecoveryOptions(8, 8, passes=((6, 0.002, 0.004), (6, 0.0016, 0.0032)), window=8,
                             transform=linops.Wavelet("Daubechies", 4, 1))


@query()
def recover_slices(spark: SparkSession, folder: str) -> DataFrame:
    samples, masks = undersampled(spark, folder)
    out = rc.recover(samples, masks, OPTIONS)
    return out.select("volume", "slice", "iterations", F.round(F.element_at("objective", -1), 6).alias("objective"),
                      F.size(F.filter("re", lambda v: F.abs(v) > 1e-3)).alias("coefficients"))


@query()
def recover_volume(spark: SparkSession, folder: str) -> DataFrame:
    """64 slices of 128 x 128, each with its own mask: line items as k-space samples."""
    cell = (F.col("l_partkey") % 128 + 128 * (F.col("l_suppkey") * 31 % 128)).cast("int")
    samples = table(spark, folder, "lineitem").groupBy(
        (F.col("l_orderkey") % 64).alias("slice"), cell.alias("pos")).agg(F.sum(F.col("l_extendedprice") / 1e5).alias("v"))
    cells = F.array_sort(F.collect_list(F.struct("pos", "v")))
    rows = samples.groupBy("slice").agg(cells.alias("c"))  # at most 128 * 128 distinct cells a slice
    slices = rows.select(F.lit(0).alias("volume"), "slice", F.col("slice").alias("mask_id"), F.col("c.v").alias("re"),
                         F.transform("c.v", lambda v: v * 0).alias("im"))
    masks = rows.select(F.col("slice").alias("mask_id"), F.col("c.pos").alias("positions"),
                        F.array_repeat(F.size("c") / 16384.0, 16384).alias("density"))
    options = rc.RecoveryOptions(128, 128, passes=((10, 0.0012, 0.006),), transform=linops.Wavelet("Daubechies", 4, 4))
    out = rc.recover(slices, masks, options, chunk=4, slices=64)
    return out.select("volume", "slice", "iterations", F.round(F.element_at("objective", 1), 4).alias("objective_first"),
                      F.round(F.element_at("objective", -1), 4).alias("objective_last"))


@query()
def resume_slices(spark: SparkSession, folder: str) -> DataFrame:
    """Half the plan, its state kept as Parquet, then the rest from that state."""
    path = work_dir(spark, "state")
    samples, masks = undersampled(spark, folder)
    half = rc.RecoveryOptions(8, 8, passes=OPTIONS.passes[:1], window=8, transform=OPTIONS.transform)
    st.append_attempt(rc.recover(samples, masks, half), path, 1)
    out = rc.recover(samples, masks, OPTIONS, st.read_state(spark, path))
    return out.select("volume", "slice", "iterations", F.round(F.element_at("objective", -1), 6).alias("objective"))


CROP_SQL = f"(SELECT slice, ky - 1 AS y, kz - 1 AS z, re, im FROM {dft2_sql(V, -1)} WHERE ky BETWEEN 1 AND 6 AND kz BETWEEN 1 AND 6)"


@query(f"SELECT slice, CAST(ky + 6 * kz AS INTEGER) AS pos, round(sqrt(re * re + im * im) * (slice % 7 + 1) / 6 * 2, {DIGITS}) AS magnitude FROM {dft2_sql(CROP_SQL, 1, n=6)}")
def finish_slices(spark: SparkSession, folder: str) -> DataFrame:
    """Padded slices scaled back and cropped in k-space from 8 x 8 to 6 x 6."""
    iterate = ad.complex_slices(spark, folder).withColumn("volume_scale", (F.col("slice") % 7 + 1).cast("double"))
    images = rc.finish(iterate, rc.RecoveryOptions(6, 6), "volume_scale", scale=2.0)
    return images.select("slice", F.posexplode("magnitude").alias("pos", "magnitude")).withColumn("magnitude", F.round("magnitude", DIGITS))


HAMMING = "(0.54 - 0.46 * cos(2 * pi() * {} / 7))"
DATA_SQL = f"(SELECT slice, y, z, (y * 3 + z * 5 + slice % 3) % 4 <> 0 AS m, CASE WHEN (y * 3 + z * 5 + slice % 3) % 4 <> 0 THEN im ELSE 0 END AS re, CASE WHEN (y * 3 + z * 5 + slice % 3) % 4 <> 0 THEN re ELSE 0 END AS im FROM {V})"
LOW_SQL = f"(SELECT slice, y, z, re * w AS re, im * w AS im FROM (SELECT *, {HAMMING.format('y')} * {HAMMING.format('z')} AS w FROM {DATA_SQL}))"
TURNED_SQL = f"""(SELECT v.slice, v.y, v.z, v.re * cos(a) - v.im * sin(a) AS re, v.re * sin(a) + v.im * cos(a) AS im FROM {V} v
  JOIN (SELECT slice, ky, kz, atan2(im, re) AS a FROM {dft2_sql(LOW_SQL, 1)}) p ON p.slice = v.slice AND p.ky = v.y AND p.kz = v.z)"""


@query(f"""WITH r AS (SELECT d.slice, sum(pow(f.re - d.re, 2) + pow(f.im - d.im, 2)) AS residual FROM {dft2_sql(TURNED_SQL, -1)} f JOIN {DATA_SQL} d ON d.slice = f.slice AND d.y = f.ky AND d.z = f.kz WHERE m GROUP BY 1),
  g AS (SELECT slice, sqrt(re * re + im * im) AS x, coalesce(sqrt(pow(lead(re) OVER wy - re, 2) + pow(lead(im) OVER wy - im, 2)), 0) AS gy, coalesce(sqrt(pow(lead(re) OVER wz - re, 2) + pow(lead(im) OVER wz - im, 2)), 0) AS gz
    FROM {V} WINDOW wy AS (PARTITION BY slice, z ORDER BY y), wz AS (PARTITION BY slice, y ORDER BY z)),
  l AS (SELECT slice, sum(x + gy + gz) AS l1 FROM g GROUP BY 1)
SELECT r.slice, round(residual, 7) AS residual, round(l1, 7) AS l1 FROM r JOIN l ON r.slice = l.slice""")
def recovery_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Residual and L1 of an iterate against sampled data, phase from the low frequencies."""
    rule = lambda kind: lambda p: (p % 8 * 3 + F.floor(p / 8) * 5 + kind) % 4 != 0
    masks = spark.range(3).select(F.col("id").alias("mask_id"), F.filter(F.sequence(F.lit(0), F.lit(63)), rule(F.col("id"))).alias("positions"),
                                  F.array_repeat(F.lit(0.75), 64).alias("density"))
    iterate = ad.complex_slices(spark, folder).withColumn("iterations", F.lit(0))
    kind = F.col("slice") % 3
    kept = lambda c: F.filter(c, lambda _, p: rule(kind)(p))
    samples = iterate.select("volume", "slice", kind.alias("mask_id"), kept("im").alias("re"), kept("re").alias("im"))
    out = rc.quality(iterate, samples, masks, rc.RecoveryOptions(8, 8))
    return out.select("slice", F.round("residual", 7).alias("residual"), F.round("l1", 7).alias("l1"))


@query("""SELECT e.label AS volume, CAST(count(*) AS BIGINT) AS pending FROM embeddings e
  WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l_partkey = e.vec_id AND l_quantity >= 49) GROUP BY 1""")
def pending_slices(spark: SparkSession, folder: str) -> DataFrame:
    plan = table(spark, folder, "embeddings").select(F.col("label").alias("volume"), F.col("vec_id").alias("slice"))
    state = table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("slice")).agg(F.max("l_quantity").alias("iterations"))
    left = rc.pending(plan, plan.join(state, "slice"), 49)
    return left.groupBy("volume").agg(F.count(F.lit(1)).alias("pending"))
