"""Sampling masks, densities and windows on the (y, z) grid.

A mask or density has ``ny * nz`` cells at most, fixed by the acquisition shape;
windows partitioned by mask are bounded by that grid, not by the data volume.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions import kernels, text
from lacuna.functions.arrays import map_arrays, planes
from lacuna.functions.skew import with_position

BROADCAST_BYTES = 256 << 20


def grid_join(left: DataFrame, grid: DataFrame, on: Sequence[str], cells: int, row_bytes: int = 48,
              how: str = "inner", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join against a per-grid table of ``cells`` rows.

    The grid's size is known from its shape: it is broadcast only while it fits
    ``limit``; beyond it AQE chooses (and splits skewed partitions).
    """
    side = F.broadcast(grid) if cells * row_bytes <= limit else grid
    return left.join(side, list(on), how)


def repair(mask_text: Column, ny: Column, nz: Column) -> Column:
    """Only '1' counts; short text is padded with '0', long text is cut."""
    clean = F.regexp_replace(mask_text, "(?s)[^1]", "0")
    return F.rpad(clean, ny * nz, "0")


def mask_positions(repaired: Column) -> Column:
    """0-based column-major positions of the acquired cells, in order."""
    marked = F.transform(F.split(repaired, ""), lambda mark, p: F.when(mark == "1", p))
    return F.filter(marked, lambda p: p.isNotNull())


def acquired_cells(masks: DataFrame, keys: Sequence[str], repaired: str = "mask", ny: str = "ny") -> DataFrame:
    """One row per acquired cell with its rank in mask order; no shuffle."""
    ranked = masks.select(*keys, ny, F.posexplode(mask_positions(F.col(repaired))).alias("rank", "pos"))
    return ranked.select(*keys, "rank", "pos", (F.col("pos") % F.col(ny)).alias("y"),
                         F.floor(F.col("pos") / F.col(ny)).cast("int").alias("z"))


def decode_names(names: DataFrame, name: str = "name") -> DataFrame:
    """Grid, acceleration and profile exponents spelled in a mask name (NULL if none).

    The pattern runs once a row; the generator keeps later filters from being
    pushed below it and running it again.
    """
    spelled = F.regexp_replace(name, f"(?s)^.*?{text.MASK_NAME}.*$", "\u0001$1\u0001$2\u0001$3\u0001$4\u0001$5")
    split = names.withColumn("_parts", F.split(spelled, "\u0001"))
    return split.select("*", F.inline(F.array(F.struct(*_name_fields(F.col("_parts")))))).drop("_parts")


def _name_fields(parts: Column) -> list[Column]:
    number = lambda c: c.try_cast("double")
    part = lambda i: F.get(parts, i)
    ny = number(part(1))
    nz = F.coalesce(number(F.substring(part(2), 2, 9)), ny)
    return [ny.cast("int").alias("ny"), nz.cast("int").alias("nz"), number(part(3)).alias("acceleration"),
            (number(part(4)) / 10).alias("pa"), (number(part(5)) / 10).alias("pb")]


def candidate_masks(names: DataFrame, ntraces: Column, pa: float, pb: float, name: str = "name") -> DataFrame:
    """Masks whose name fits the trace count; the default exponents sort last."""
    decoded = decode_names(names, name)
    fits = F.try_divide(F.col("ny") * F.col("nz"), F.col("acceleration")) == ntraces
    found = decoded.where(F.col("ny").isNotNull() & fits).withColumn(
        "is_default", (F.col("pa") == pa) & (F.col("pb") == pb))
    placed = with_position(found.withColumn("_order", F.struct("is_default", name)), [], "_order", "place").drop("_order")
    return placed.withColumn("place", (F.col("place") + 1).cast("int"))


def mask_report(mask_text: Column) -> list[Column]:
    """Zero, one and total character counts with a warning on foreign characters."""
    zeros, ones = F.regexp_count(mask_text, F.lit("0")), F.regexp_count(mask_text, F.lit("1"))
    total = F.length(mask_text)
    return [zeros.alias("zeros"), ones.alias("ones"), (zeros + ones).alias("marks"), total.alias("total"),
            F.when(zeros + ones != total, "unexpected characters").otherwise("ok").alias("warning")]


def sampling_fraction(df: DataFrame, keys: Sequence[str], acquired: str = "acquired") -> DataFrame:
    marks = F.sum(F.col(acquired).cast("bigint"))
    share = marks.cast("double") / F.count(F.lit(1))
    return df.groupBy(*keys).agg(marks.alias("sampled"), share.alias("fraction"), F.try_divide(F.lit(1.0), share).alias("acceleration"))


# ---------------------------------------------------------------- scatter and gather


def scatter(samples: DataFrame, cells: DataFrame, keys: Sequence[str], grid_cells: int,
            rank: str = "rank", values: Sequence[str] = ("re", "im")) -> DataFrame:
    """Mask-ordered samples to their grid positions (long form, zeros implicit)."""
    placed = grid_join(samples, cells.select(F.col("rank").alias(rank), "pos", "y", "z"), [rank], grid_cells)
    return placed.select(*keys, "pos", "y", "z", *values)


def gather(grid: DataFrame, cells: DataFrame, on: Sequence[str] = ("y", "z"), grid_cells: int = 1 << 22) -> DataFrame:
    """Grid rows at acquired positions only."""
    return grid_join(grid, cells.select(*on).distinct(), on, grid_cells, how="left_semi")


def weight_by_density(samples: DataFrame, density: DataFrame, values: Sequence[str], grid_cells: int,
                      on: Sequence[str] = ("y", "z")) -> DataFrame:
    joined = grid_join(samples, density, on, grid_cells)
    return joined.withColumns({f"{v}_weighted": F.col(v) / F.col("p") for v in values})


# ---------------------------------------------------------------- density


def radial_profile(y: Column, z: Column, ny: Column, nz: Column, pa: Column, pb: Column) -> Column:
    """exp(-(pb r / n)^pa), averaged over both sides in the exponent; 1 at the cell nearest the middle."""
    decay = lambda r, n: F.pow(pb * r / n, pa)
    fall = lambda r: (decay(r, ny) + decay(r, nz)) / 2
    off = lambda n: F.pmod(n, F.lit(2)) / 2  # of an odd grid no cell is in the middle
    return F.exp(fall(F.hypot(off(ny), off(nz))) - fall(F.hypot(y - ny / 2, z - nz / 2)))


def polynomial_profile(r: Column, power: Column, full_radius: float = 0.0) -> Column:
    """(1 - r)^power with a fully sampled centre; r runs from 0 to 1."""
    return F.when(r < full_radius, 1.0).otherwise(F.pow(F.greatest(1 - r, F.lit(0.0)), power))


def calibrate(weights: DataFrame, keys: Sequence[str], weight: str, target: str, order: Sequence[str]) -> DataFrame:
    """Inclusion probabilities min(w + c, 1) whose sum is the target.

    With the k largest weights saturated, c = (target - k - sum of the others) /
    (n - k); the k is kept for which exactly those weights reach 1.  ``c`` is NULL
    where the weights alone already exceed the target.
    """
    w = Window.partitionBy(*keys)
    ordered = w.orderBy(F.col(weight).desc(), *order)
    prefix = F.sum(weight).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    ranked = weights.withColumns({
        "_k": F.row_number().over(ordered), "_n": F.count(F.lit(1)).over(w),
        "_tail": F.sum(weight).over(w) - prefix, "_next": F.lead(weight).over(ordered)})
    # a row stands for "the first _k weights are saturated"; k = 0 is added from the first row
    some = F.try_divide(F.col(target) - F.col("_k") - F.col("_tail"), F.col("_n") - F.col("_k"))
    none = (F.col(target) - F.col("_tail") - F.col(weight)) / F.col("_n")
    fits_some = (F.col("_k") < F.col("_n")) & (F.col(weight) + some >= 1) & (F.col("_next") + some < 1)
    fits_none = (F.col("_k") == 1) & (F.col(weight) + none < 1)
    ranked = ranked.withColumn("_c", F.when(fits_none, none).when(fits_some, some))
    c = F.max("_c").over(w)
    feasible = F.floor(F.sum(weight).over(w)) <= F.floor(F.col(target))
    solved = ranked.withColumn("c", F.when(feasible, c)).drop("_k", "_n", "_tail", "_next", "_c")
    return solved.withColumn("p", F.least(F.col(weight) + F.col("c"), F.lit(1.0)))


def grid(masks: DataFrame, ny: Column, nz: Column) -> DataFrame:
    """All (y, z) cells of each mask row, column-major."""
    cells = masks.withColumn("pos", F.explode(F.sequence(F.lit(0).cast("bigint"), (ny * nz - 1).cast("bigint"))))
    return cells.withColumns({"y": (F.col("pos") % ny).cast("int"), "z": F.floor(F.col("pos") / ny).cast("int")})


# ---------------------------------------------------------------- random masks


def scrambled(x: np.ndarray) -> np.ndarray:
    """A 32-bit finaliser: uniform numbers from counters."""
    for _ in range(2):
        x = ((x ^ (x >> np.uint64(16))) * np.uint64(0x45D9F3B)) & np.uint64(0xFFFFFFFF)
    return x ^ (x >> np.uint64(16))


def drawn(start: int, redraw: int, p: np.ndarray) -> np.ndarray:
    """Cells hit in one draw: the same on every retry and partitioning."""
    cell = np.arange(len(p), dtype=np.uint64) * np.uint64(2246822519) + np.uint64((start + redraw * 2654435769) & 0xFFFFFFFF)
    return scrambled(cell & np.uint64(0xFFFFFFFF)) / 4294967296.0 < p


def reachable(p: np.ndarray, tolerance: float) -> bool:
    """Whether some draw has a count within ``tolerance`` of the sum of ``p`` (rounded to 6 digits).

    Cells of density 1 or more are always hit and cells of 0 never, so every count from the
    number of the first to the number of all others has a chance.
    """
    want, low, high = round(float(np.sum(p)), 6), int(np.sum(p >= 1)), int(np.sum(p > 0))
    return max(low, math.ceil(want - tolerance)) <= min(high, math.floor(want + tolerance))


def draw_masks(density: DataFrame, keys: Sequence[str], ny: int, nz: int, tries: int, seed: int = 0,
               tolerance: float = 1.0) -> DataFrame:
    """Density-weighted draws per mask with their peak side lobe: one row per (key, try).

    Each try is redrawn until its count is within ``tolerance`` of the sum of the
    density, however often that takes, so every mask comes back; a sum that no count can
    reach fails the job before its first draw.  A count of independent cells is likeliest
    next to its mean, so n cells take some sqrt(n) draws.  The row has the mask text, the count, the redraw, and the largest off-centre value of
    the inverse FFT of mask/p.
    """
    cells = F.transform(F.array_sort(F.collect_list(F.struct("pos", "p"))), lambda c: c.p)
    rows = density.groupBy(*keys).agg(cells.alias("p")).withColumn("try", F.explode(F.sequence(F.lit(0), F.lit(tries - 1))))
    name = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in keys], F.col("try").cast("string")))
    rows = rows.withColumn("start", F.conv(F.substring(name, 1, 8), 16, 10).cast("bigint"))

    def draw(block):
        out = {"mask": [], "count": [], "redraw": [], "side_lobe": []}
        for start, p in zip(block["start"].tolist(), block["p"], strict=True):
            want = round(float(np.sum(p)), 6)
            if not reachable(p, tolerance):
                raise ValueError(f"no draw has a count within {tolerance} of {want}")
            redraw = 0
            while abs(int((hit := drawn(start, redraw, p)).sum()) - want) > tolerance:
                redraw += 1
            image = abs(np.fft.ifft2(planes((hit / p)[None], ny, nz))).ravel()
            out["mask"].append("".join("01"[int(h)] for h in hit))
            out["count"].append(int(hit.sum()))
            out["redraw"].append(redraw)
            out["side_lobe"].append(float(image[1:].max()))
        return {k: np.array(v) for k, v in out.items()}

    return map_arrays(rows, draw, ("p", "start"), "mask string, count bigint, redraw int, side_lobe double", (*keys, "try"))


def best_mask(draws: DataFrame, keys: Sequence[str], digits: int = 9) -> DataFrame:
    """The draw that has the least peak side lobe (first on ties)."""
    best = F.min(F.struct(F.round("side_lobe", digits).alias("side_lobe"), "try", "mask", "count"))
    return draws.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


# ---------------------------------------------------------------- windows


def hamming(i: Column, n: int) -> Column:
    return F.lit(0.54) - 0.46 * F.cos(2 * math.pi * i / (n - 1))


def low_frequency_window(y: Column, z: Column, ny: int, nz: int, width: int) -> Column:
    """Outer product of two Hamming windows, centred on the grid, largest value 1."""
    y0, z0 = ny // 2 - width // 2, nz // 2 - width // 2
    peak = max(0.54 - 0.46 * math.cos(2 * math.pi * i / (width - 1)) for i in range(width))
    inside = y.between(y0, y0 + width - 1) & z.between(z0, z0 + width - 1)
    return F.when(inside, hamming(y - y0, width) * hamming(z - z0, width) / peak ** 2).otherwise(0.0)


def fermi_window(y: Column, z: Column, ny: int, nz: int, w1: float = 0.15, w2: float = 0.75) -> Column:
    """Published Fermi window 1 / (1 + exp((r - w2) / w1)), r normalised to the half width.

    The exact variant used by the studied pipeline is not public; see the README.
    """
    r = F.hypot((y - ny // 2) / (ny / 2), (z - nz // 2) / (nz / 2))
    return 1 / (1 + F.exp((r - w2) / w1))


def unit_radius(y: Column, z: Column, ny: int, nz: int, norm: str = "l2") -> Column:
    """Distance from the grid middle, scaled so the farthest cell is 1."""
    a = F.abs(-1 + 2 * y / (ny - 1))
    b = F.abs(-1 + 2 * z / (nz - 1))
    return F.greatest(a, b) if norm == "max" else F.hypot(a, b) / math.sqrt(2)


def lowest_radius(cells: DataFrame, keys: Sequence[str], radius: str, fraction: float) -> DataFrame:
    """Mask of the given share of cells nearest the middle; ties go by position."""
    w = Window.partitionBy(*keys)
    order = w.orderBy(radius, "pos")
    return cells.withColumn("acquired", F.row_number().over(order) <= F.floor(F.lit(fraction) * F.count(F.lit(1)).over(w)))
