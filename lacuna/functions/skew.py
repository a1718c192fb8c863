"""Ordered work that stays balanced when one key holds a large share of the rows.

A plain ``Window.partitionBy(key)`` puts all rows of a key in one task.  Here rows are
sorted into ranges of nearly equal size; every range works by itself and only per-range
summaries meet at the key level.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.joins import measured_join, settle

CHUNK = 1 << 20


def in_ranges(df: DataFrame, keys: Sequence[str], order: str, chunk: int = CHUNK) -> DataFrame:
    """Rows sorted by key and ``order`` in partitions of nearly equal size, written down once.

    Adds ``_at``, which rises with the order, and ``_chunk``, the same for at most ``chunk``
    rows that follow each other.  The bounds come from a sample of the rows, so neither a
    hot key nor a sparse, skewed or non-numeric order column makes a large or a tiny range.
    """
    by = [*keys, order]
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))  # the upper bits number the partition
    return settle(rows).withColumn("_chunk", F.col("_at") - F.pmod(inside, F.lit(chunk)))


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    out: str = "k",
    first_of: str | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """0-based position of a row among the rows of its key, ordered by ``order``.

    ``order`` is of any type that can be sorted; equal values come in any order.  With
    ``first_of`` the value of that column on the key's first row is added as
    ``first_<name>``.  A range of rows counts from its first row, and only the sizes of
    the ranges meet at the key.
    """
    keys = list(keys)
    cut = in_ranges(df, keys, order, chunk)
    aggs = [F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_from")]
    if first_of:
        aggs.append(F.min_by(first_of, "_at").alias("_first"))
    by_chunk = Window.partitionBy(*keys).orderBy("_chunk")
    before = F.coalesce(F.sum("_n").over(by_chunk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = cut.groupBy(*keys, "_chunk").agg(*aggs).withColumn("_base", before - F.col("_from"))
    if first_of:
        bases = bases.withColumn(f"first_{first_of}", F.first("_first").over(by_chunk))
    return (measured_join(cut, settle(bases.drop("_n", "_from", "_first")), keys + ["_chunk"])
            .withColumn(out, F.col("_base") + F.col("_at"))
            .drop("_chunk", "_base", "_at"))


def over_recent(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    lookback: int,
    build: Callable[[Window], dict[str, Column]],
    chunk: int = CHUNK,
) -> DataFrame:
    """Window expressions that look back at most ``lookback`` positions.

    Rows at the end of a range are also sent to the next range as a halo, so the
    result equals the one window over the whole key.
    """
    if chunk <= lookback:
        raise ValueError("chunk must exceed the lookback")
    own = F.floor(F.col(position) / chunk)
    late = F.col(position) % chunk >= chunk - lookback
    halo = df.withColumn("_home", own).withColumn(
        "_part", F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))))
    window = Window.partitionBy(*keys, "_part").orderBy(position)
    for name, expr in build(window).items():
        halo = halo.withColumn(name, expr)
    return halo.where(F.col("_home") == F.col("_part")).drop("_home", "_part")


def order_statistic(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    rank: Callable[[Column], Column],
    out: str = "order_value",
    bins: int = 4096,
) -> DataFrame:
    """Exact value at a rank per key, without sorting or shuffling the rows.

    ``rank`` maps the row count to a 1-based rank.  Three narrow scans: counts
    per magnitude bin (16 bins an octave), counts in ``bins`` equal parts of the
    bin that holds the rank, and counts per distinct value of the one part left.
    All are aggregations with map-side combine, so ties and hot keys collapse
    before the shuffle.  Only one small row per key goes from scan to scan.
    Values are expected to be >= 0; NULL and NaN are left out.
    """
    keys = list(keys)
    group = keys or ["_all"]
    v = F.col(value).cast("double")
    usable = df.where(v.isNotNull() & ~F.isnan(v)).select(
        *keys, *([] if keys else [F.lit(0).alias("_all")]), F.col(value).alias("_v"))
    coarse = F.when(F.col("_v") > 0, F.floor(F.log2(F.col("_v").cast("double")) * 16)).otherwise(F.lit(-10 ** 6))
    rows = usable.withColumn("_bin", coarse)
    count = F.count(F.lit(1)).alias("_m")

    def pick(binned: DataFrame, column: str, carried: list[str]) -> DataFrame:
        """The bin that holds the rank, with the rank counted from its start."""
        w = Window.partitionBy(*group).orderBy(column)
        before = F.col("_cum") - F.col("_m")
        return (binned.withColumn("_cum", F.sum("_m").over(w))
                .where((F.col("_cum") >= F.col("_rank")) & (before < F.col("_rank")))
                .select(*group, column, (F.col("_rank") - before).alias("_rank"), *carried))

    first = rows.groupBy(*group, "_bin").agg(count, F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    first = first.withColumn("_rank", rank(F.sum("_m").over(Window.partitionBy(*group))))
    target = settle(pick(first, "_bin", ["_lo", "_hi"]))

    width = (F.col("_hi") - F.col("_lo")).cast("double")
    part = F.when(width > 0, F.least(F.floor((F.col("_v") - F.col("_lo")) / width * bins), F.lit(bins - 1))).otherwise(F.lit(0))
    carried = ["_bin", "_lo", "_hi"]
    second = measured_join(rows, target, group + ["_bin"]).withColumn("_part", part).groupBy(*group, "_part").agg(
        count, *[F.first(c).alias(c) for c in ("_rank", *carried)])
    chosen = settle(pick(second, "_part", carried))

    last = measured_join(rows, chosen.withColumnRenamed("_part", "_wanted"), group + ["_bin"])
    values = last.where(part == F.col("_wanted")).groupBy(*group, "_v").agg(count, F.first("_rank").alias("_rank"))
    return pick(values, "_v", []).select(*keys, F.col("_v").alias(out))
