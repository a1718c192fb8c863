"""Global scale, histograms, quantiles, profiles and object bounds.

Magnitudes may be any non-negative number; pass integers where sums must be
exact.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.arrays import map_arrays
from lacuna.functions.joins import measured_join, settle
from lacuna.functions.skew import order_statistic

# 16-bit output range, share of voxels kept in range, histogram
# bins, and how far above the profile minimum still counts as background.
OUTPUT_MAX, KEEP_SHARE, BINS, BACKGROUND = 65535, 0.9995, 255, 1.2


def slice_max(samples: DataFrame, keys: Sequence[str] = ("volume", "slice"), value: str = "magnitude") -> DataFrame:
    return samples.groupBy(*keys).agg(F.max(value).alias("slice_max"))


def midpoint_quantile(df: DataFrame, keys: Sequence[str], value: str, p: float, out: str = "quantile") -> DataFrame:
    """Quantile that is linear between the (k - 0.5)/n points and clamped outside.

    Meant for per-slice values: a key holds one row per slice of a volume.
    """
    ordered = Window.partitionBy(*keys).orderBy(value)
    every = Window.partitionBy(*keys)
    position = F.least(F.greatest(F.lit(p) * F.col("_n") + 0.5, F.lit(1.0)), F.col("_n").cast("double"))
    ranked = (df.select(*keys, F.col(value).cast("double").alias("_v"))
              .withColumn("_r", F.row_number().over(ordered.orderBy("_v")))
              .withColumn("_n", F.count(F.lit(1)).over(every)).withColumn("_q", position))
    at = lambda edge: F.max(F.when(F.col("_r") == edge(F.col("_q")), F.col("_v")))
    return (ranked.groupBy(*keys).agg(at(F.floor).alias("_lo"), at(F.ceil).alias("_hi"), F.first("_q").alias("_q"))
            .select(*keys, (F.col("_lo") + (F.col("_q") - F.floor("_q")) * (F.col("_hi") - F.col("_lo"))).alias(out)))


def scale_from_quantile(quantile: Column) -> Column:
    return F.try_divide(F.lit(float(OUTPUT_MAX)), quantile)


def volume_scale(peak: Column, ny: int, nz: int, first: Column | None = None, scaling: Column | None = None,
                 padded: bool = False) -> Column:
    """sqrt(ny nz) times the peak, or the study scale turned back for the first unpadded volume."""
    side = float(ny * nz) ** 0.5
    own = F.lit(side) * peak
    if first is None or scaling is None or padded:
        return own
    return F.when(first, F.try_divide(F.lit(side) * OUTPUT_MAX, scaling)).otherwise(own)


def axis_profiles(samples: DataFrame, value: str = "magnitude", keys: Sequence[str] = ("volume",),
                  axes: Sequence[str] = ("slice", "y", "z")) -> DataFrame:
    """Mean per position of each axis in one pass; a task sends one row per position, not its samples."""
    sets = samples.groupingSets([[*[F.col(k) for k in keys], F.col(a)] for a in axes], *keys, *axes).agg(
        F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_n"))
    name = F.coalesce(*[F.when(F.col(a).isNotNull(), F.lit(a)) for a in axes])
    return sets.select(*keys, name.alias("axis"), F.coalesce(*axes).alias("i"),
                       (F.col("_s") / F.col("_n")).alias("mean_value"))


def profile_argmin(profiles: DataFrame, keys: Sequence[str] = ("volume", "axis")) -> DataFrame:
    """Index of the smallest mean, the first one on ties."""
    low = F.min(F.struct("mean_value", "i"))
    return profiles.groupBy(*keys).agg(low.alias("_m")).select(
        *keys, F.col("_m.i").alias("arg_min"), F.col("_m.mean_value").alias("min_value"))


def _round_half_up(x: Column) -> Column:
    return F.floor(x + 0.5)


def object_bounds(profiles: DataFrame, lengths: dict[str, int], keys: Sequence[str] = ("volume",),
                  half_rolled: Sequence[str] = ("y", "z")) -> DataFrame:
    """Object centre, roll and first corner per axis, all 1-based.

    The profile is turned so its minimum sits at the edge; the object ends where
    the outer thirds fall under 1.2 times the minimum.
    """
    c = F.col
    n = F.create_map(*[F.lit(v) for pair in lengths.items() for v in pair])[c("axis")]
    half = _round_half_up(c("n") / 2)
    moved = F.when(c("axis").isin(list(half_rolled)), F.pmod(c("i") + half, c("n"))).otherwise(c("i")) + 1
    group = [*keys, "axis"]
    base = profiles.withColumn("n", n).withColumn("p", moved)
    lowest = F.min(F.struct("mean_value", "p")).over(Window.partitionBy(*group))
    turned = base.withColumn("_f", lowest).withColumn("h", half)
    start = c("_f.p") + c("h") - 1
    turned = turned.withColumn("s0", c("h") - F.when(start > c("n"), start - c("n")).otherwise(start))
    turned = turned.withColumn("j", F.pmod(c("p") - 1 + c("s0"), c("n")) + 1)
    dark = c("mean_value") < BACKGROUND * c("_f.mean_value")
    ends = turned.groupBy(*group).agg(
        F.first("n").alias("n"), F.first("h").alias("h"), F.first("s0").alias("s0"),
        F.max(F.when(dark & (c("j") <= _round_half_up(c("n") / 3)), c("j"))).alias("lo"),
        F.min(F.when(dark & (c("j") >= _round_half_up(2 * c("n") / 3) + 1), c("j"))).alias("hi"))
    ends = ends.withColumns({"lo": F.coalesce("lo", F.lit(1)), "hi": F.coalesce("hi", "n")})
    centre = _round_half_up((c("hi") - c("lo")) / 2 + c("lo")) - c("s0")
    ends = ends.withColumn("centre", F.when(centre > c("n"), centre - c("n")).otherwise(centre))
    corner = c("centre") + 1 - c("h")
    return ends.select(*group, "lo", "hi", "centre", (c("h") - c("centre")).alias("roll"),
                       F.when(corner < 0, corner + c("n")).otherwise(corner).alias("corner"))


def histogram(df: DataFrame, keys: Sequence[str], value: str, top: str, bins: int = BINS) -> DataFrame:
    """Fixed-width counts over [0, top]; the last bin is closed, values outside are left out.

    A volume whose top is 0 has everything in bin 0 and no scale.
    """
    width = F.col(top) / bins
    inside = df.where((F.col(value) >= 0) & (F.col(value) <= F.col(top)))
    return inside.groupBy(*keys, top, F.coalesce(
        F.least(F.floor(F.try_divide(F.col(value).cast("double"), width)), F.lit(bins - 1)), F.lit(0)).alias("bin")).agg(
        F.count(F.lit(1)).alias("voxels"))


def histogram_cutoff(hist: DataFrame, keys: Sequence[str], top: str, bins: int = BINS,
                     share: float = KEEP_SHARE) -> DataFrame:
    """First bin whose running count passes the share; its middle sets the scale."""
    running = Window.partitionBy(*keys).orderBy("bin")
    total = F.sum("voxels").over(Window.partitionBy(*keys))
    passed = (hist.withColumn("_cum", F.sum("voxels").over(running)).withColumn("_all", total)
              .where(F.col("_cum") > F.lit(share) * F.col("_all")))
    first = passed.groupBy(*keys, top).agg(F.min("bin").alias("cut_bin"))
    middle = (F.col("cut_bin") + 0.5) * (F.col(top) / bins)
    return first.select(*keys, "cut_bin", middle.alias("cut_value"), F.try_divide(F.lit(float(OUTPUT_MAX)), middle).alias("scale"))


def rank_cutoff(df: DataFrame, keys: Sequence[str], value: str, share: float = KEEP_SHARE) -> DataFrame:
    """Sorted value at round(n * share), found without a global sort."""
    rank = lambda n: F.greatest(F.floor(n * share + 0.5), F.lit(1))
    return order_statistic(df, keys, value, rank, "cut_value").withColumn(
        "scale", F.try_divide(F.lit(float(OUTPUT_MAX)), F.col("cut_value")))


def scaled(value: Column, factor: Column, clip: bool = True) -> Column:
    """Output integer; values over the range are clipped unless told otherwise."""
    out = F.floor(value * factor + 0.5)
    return (F.least(out, F.lit(OUTPUT_MAX)) if clip else out).cast("int")


def histogram_mode(df: DataFrame, keys: Sequence[str], value: str, first: float, width: float, edges: int) -> DataFrame:
    """Lower edge of the fullest bin between ``edges`` equal steps from ``first``.

    A bin holds its lower edge; the last edge is a bin of its own.  Zero, NaN and
    infinite values and those outside the edges are not counted; ties go to the lower bin.
    """
    v = F.col(value).cast("double")
    last = first + width * (edges - 1)
    usable = df.where(~F.isnan(v) & (F.abs(v) != float("inf")) & (v != 0) & (v >= first) & (v <= last))
    counted = usable.groupBy(*keys, F.least(F.floor((v - first) / width), F.lit(edges - 1)).alias("bin")).agg(
        F.count(F.lit(1)).alias("voxels"))
    best = F.max(F.struct(F.col("voxels"), (-F.col("bin")).alias("b")))
    return counted.groupBy(*keys).agg(best.alias("_m")).select(
        *keys, (-F.col("_m.b")).alias("mode_bin"), F.col("_m.voxels").alias("voxels"),
        (-F.col("_m.b") * width + first).alias("mode_value"))


def keep_largest(df: DataFrame, keys: Sequence[str], value: str, fraction: float) -> DataFrame:
    """Values under the one at rank floor(n * fraction) from the top become 0; ties stay."""
    size = F.abs(F.col(value))
    rank = lambda n: n - F.greatest(F.floor(n * fraction), F.lit(1)) + 1
    limits = settle(order_statistic(df.withColumn("_size", size), keys, "_size", rank, "_limit"))
    return (measured_join(df, limits, keys)
            .withColumn(value, F.when(size < F.col("_limit"), 0.0).otherwise(F.col(value))).drop("_limit"))


def keep_largest_in(slices: DataFrame, values: str, fraction: float, keep: Sequence[str]) -> DataFrame:
    """The same inside each array of a column; no shuffle."""

    def cut(block):
        v = block[values]
        rank = max(int(np.floor(v.shape[1] * fraction)), 1)
        limit = -np.partition(-np.abs(v), rank - 1, axis=1)[:, rank - 1:rank]
        return {values: np.where(np.abs(v) < limit, 0.0, v)}

    return map_arrays(slices, cut, (values,), f"{values} array<double>", keep)
