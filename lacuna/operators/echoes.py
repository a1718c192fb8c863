"""Multi-echo analytics on long voxel rows (volume, echo, voxel, value)."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions import cplx
from lacuna.functions.arrays import map_arrays
from lacuna.functions.joins import measured_join


def root_sum_of_squares(rows: DataFrame, keys: Sequence[str], value: str, out: str = "rss") -> DataFrame:
    v = F.col(value)
    return rows.groupBy(*keys).agg(F.sqrt(F.sum(v * v)).alias(out))


def echo_phase(rows: DataFrame) -> DataFrame:
    return rows.withColumn("phase", cplx.phase(F.col("re"), F.col("im")))


def echo_frequency(rows: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Phase times its echo's coefficient; the coefficient table is the caller's."""
    return measured_join(rows, coefficients.select("echo", "coefficient"), ["echo"]).withColumn(
        "frequency", F.col("phase") * F.col("coefficient"))


def decay_weight(te, t2):
    """TE exp(-TE / T2), published practice; the studied body is not public."""
    return te * F.exp(-te / t2)


def combine(rows: DataFrame, keys: Sequence[str], value: str, weight: str, first: int, out: str = "combined") -> DataFrame:
    """Weighted mean of the first echoes; NaN and NULL values take no part."""
    v, w = F.col(value), F.col(weight)
    good = v.isNotNull() & ~F.isnan(v)
    used = rows.where(F.col("echo") < first)
    top, bottom = F.sum(F.when(good, v * w)), F.sum(F.when(good, w))
    return used.groupBy(*keys).agg(F.try_divide(top, bottom).alias(out))


def decay_fit(rows: DataFrame, keys: Sequence[str], value: str, te: str) -> DataFrame:
    """Mono-exponential fit by a log-linear regression: amplitude, T2 and R2."""
    positive = rows.where(F.col(value) > 0)
    slope, intercept = (f(F.log(value), F.col(te)) for f in (F.regr_slope, F.regr_intercept))
    fit = positive.groupBy(*keys).agg(slope.alias("_s"), intercept.alias("_i"), F.count(F.lit(1)).alias("echoes"))
    return fit.select(*keys, "echoes", F.exp("_i").alias("amplitude"), (-F.col("_s")).alias("r2"),
                      F.when(F.col("_s") < 0, -1 / F.col("_s")).alias("t2"))


def rescale_frequency(frequency, mean_te):
    """Phase over the mean echo time to cycles per second."""
    return frequency / (2 * math.pi * mean_te)


def apply_masks(rows: DataFrame, masks: Sequence[DataFrame], on: Sequence[str], value: str) -> DataFrame:
    """Product of several masks applied to a value; a voxel missing from a mask counts as 0."""
    product = F.lit(1.0)
    for i, m in enumerate(masks):
        rows = rows.join(m.select(*on, F.col("inside").cast("double").alias(f"_m{i}")), list(on), "left")
        product = product * F.coalesce(f"_m{i}", F.lit(0.0))
    return rows.withColumn("masked", F.col(value) * product).drop(*[f"_m{i}" for i in range(len(masks))])


def close_mask(voxels: DataFrame, keys: Sequence[str], axes: dict[str, int], radius: int = 2, tile: int = 64) -> DataFrame:
    """Binary closing with a ball: grow, then shrink; outside the grid nothing blocks.

    ``voxels`` holds the inside voxels only, with 0-based integer axes.  Space is
    cut into tiles; a voxel goes to its tile and to the tiles whose border it is
    near, so each tile is closed on its own as a small dense array.
    """
    names, reach = list(axes), 2 * radius
    spread = voxels.select(*keys, *names).distinct()
    for n in names:
        near = F.sequence(F.floor((F.col(n) - reach) / tile).cast("int"), F.floor((F.col(n) + reach) / tile).cast("int"))
        last = (axes[n] - 1) // tile
        inside = F.filter(near, lambda t: t.between(0, last))
        spread = spread.withColumn(f"_{n}", F.explode(inside))
    tiles = [f"_{n}" for n in names]
    # distinct voxels of a tile: never more than its cells
    grouped = spread.groupBy(*keys, *tiles).agg(F.collect_list(F.struct(*names)).alias("_v")).select(
        *keys, *tiles, *[F.col(f"_v.{n}").alias(n) for n in names])
    sizes = np.array([axes[n] for n in names])
    span = np.arange(-radius, radius + 1)
    ball = [o for o in np.stack(np.meshgrid(*[span] * len(names), indexing="ij"), -1).reshape(-1, len(names))
            if (o * o).sum() <= radius * radius]

    def neighbours(block: np.ndarray) -> Iterator[np.ndarray]:
        """The block seen from each offset of the ball, ``radius`` cells smaller on every side."""
        for o in ball:
            yield block[tuple(slice(radius + d, n - radius + d) for d, n in zip(o, block.shape))]

    def close_tile(index: np.ndarray, points: np.ndarray) -> np.ndarray:
        origin = index.astype(int) * tile - reach
        block = np.zeros(np.minimum(tile, sizes - origin - reach) + 2 * reach, dtype=bool)
        block[tuple((points.astype(int) - origin).T)] = True
        grown = np.logical_or.reduce(list(neighbours(block)))
        at = np.indices(grown.shape).reshape(len(names), -1).T + origin + radius
        outside = ((at < 0) | (at >= sizes)).any(axis=1).reshape(grown.shape)
        return np.argwhere(np.logical_and.reduce(list(neighbours(grown | outside)))) + origin + reach

    def close(block):
        where = np.stack([block[t] for t in tiles], axis=1)
        found = [close_tile(where[r], np.stack([block[n][r] for n in names], axis=1)) for r in range(len(where))]
        return {n: [f[:, a] for f in found] for a, n in enumerate(names)}

    closed = map_arrays(grouped, close, (*tiles, *names), ", ".join(f"{n} array<int>" for n in names), keys, ragged=True)
    rows = closed.select(*keys, F.explode(F.arrays_zip(*names)).alias("_p"))
    return rows.select(*keys, *[F.col(f"_p.{n}").cast(voxels.schema[n].dataType).alias(n) for n in names])
