"""Shards of nearly equal bytes by histogram sort.

All in DataFrame functions.  Rows are ordered by a hash of their text, then a hash of
their id.  Exact bytes below evenly spaced candidate keys are counted over all
partitions; every splitter keeps the interval that its target falls in, and the next
round probes inside it, until the key next to the target is found.  A splitter between
two texts is taken where one lies within the tolerance, so copies stay together;
otherwise the group is entered and the nearest row is found the same way.  Then the rows
are exchanged once, in order, and numbered where they arrive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import parts_for
from lacuna.session import work_dir

#: Candidate keys between the ends of a splitter's interval, each round.
PROBES = 2048
#: A splitter between two texts may be off its target by this part of a shard.
TOLERANCE = 0.01
#: Bytes of rows in one range of the exchange.
RANGE_BYTES = 128 << 20
#: The key of a row, coarse to fine; each is a number from 0 up to the bound.
LEVELS = (("_group", 1 << 60), ("_member", 1 << 60), ("_copy", (1 << 63) - 1))


@dataclass(frozen=True)
class Interval:
    """Rows whose key starts with ``prefix`` and goes on in [low, high)."""

    prefix: tuple[int, ...] = ()
    low: int = 0
    high: int = LEVELS[0][1]

    @property
    def step(self) -> int:
        return -(-(self.high - self.low) // PROBES)

    def holds(self) -> Column:
        name = LEVELS[len(self.prefix)][0]
        inside = F.col(name).between(self.low, self.high - 1)
        for (level, _), value in zip(LEVELS, self.prefix, strict=False):
            inside = inside & (F.col(level) == F.lit(value))
        return inside

    def bin(self) -> Column:
        name = LEVELS[len(self.prefix)][0]
        return F.expr(f"({name} - {self.low}L) div {self.step}L")


def _histogram(rows: DataFrame, intervals: list[Interval]) -> dict[Interval, list[tuple[int, int, int]]]:
    """(bin, bytes, rows) of every used bin, in order: at most ``PROBES`` a splitter, whatever the input."""
    cell = F.lit(None).cast("struct<which:int,bin:bigint>")
    for i, interval in enumerate(intervals):
        cell = F.when(interval.holds(), F.struct(F.lit(i).alias("which"), interval.bin().alias("bin"))).otherwise(cell)
    got = rows.select(cell.alias("cell"), "size").where("cell is not null").groupBy("cell").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    out: dict[Interval, list[tuple[int, int, int]]] = {interval: [] for interval in intervals}
    for r in got:
        out[intervals[r.cell.which]].append((r.cell.bin, r.bytes, r.n))
    return {interval: sorted(bins) for interval, bins in out.items()}


def splitters(rows: DataFrame, shards: int, total: int, tolerance: float) -> list[tuple[int, ...]]:
    """The first key of each shard but shard 0, in order; a key may stop at a coarse level.

    ``rows`` has the columns of ``LEVELS`` and ``size``.  Every round is one narrow scan
    for all splitters together, and intervals shrink by ``PROBES`` each round, so there
    are six rounds a level.  Of two places equally near the target the lower is taken.
    """
    # splitter: its interval, and the bytes below the interval
    open_: dict[int, tuple[Interval, int]] = {j: (Interval(), 0) for j in range(1, shards)}
    found: dict[int, tuple[int, ...]] = {}
    while open_:
        bins = _histogram(rows, list(dict.fromkeys(interval for interval, _ in open_.values())))
        for j, (interval, below) in list(open_.items()):
            for at, size, n in bins[interval]:
                if (below + size) * shards > j * total:
                    break
                below += size
            low = interval.low + at * interval.step
            if interval.step > 1:
                open_[j] = Interval(interval.prefix, low, min(low + interval.step, interval.high)), below
                continue
            before, after = j * total - below * shards, (below + size) * shards - j * total
            level = len(interval.prefix)
            if n == 1 or (level == 0 and min(before, after) <= tolerance * total):
                found[j] = (*interval.prefix, low + (before > after))
                del open_[j]
            else:
                open_[j] = Interval((*interval.prefix, low), 0, LEVELS[level + 1][1]), below
    return [found[j] for j in sorted(found)]


def _reached(splitter: tuple[int, ...]) -> Column:
    """Whether a row's key is at or after the splitter."""
    name, value = LEVELS[len(splitter) - 1][0], splitter[-1]
    reached = F.col(name) >= F.lit(value)
    for (level, _), v in reversed(list(zip(LEVELS, splitter[:-1], strict=False))):
        reached = (F.col(level) > F.lit(v)) | ((F.col(level) == F.lit(v)) & reached)
    return reached


def _number(text: Column) -> Column:
    """Sixty bits of a digest of a text as a number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def assign(docs: DataFrame, shards: int = 16, *, id_col: str = "doc_id", text_col: str = "text",
           tolerance: float = TOLERANCE, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, size, text_crc32, shard, slot, row): every row's shard, and its place within.

    Size is the bytes of the text plus one.  Shards are ranges of the key order, so a
    splitter is off its target by at most the tolerance or half of the row it meets.
    ``carry`` names columns that travel with the rows; they come back in ``row``, so no
    name can clash.  A null text is an empty one and a null id sorts like an empty one;
    equal rows are told apart by a number given once and written down, so even one
    row repeated without end is cut between shards.  An empty table gives no rows, a
    long text moves whole, and only its length, checksum and digest are looked at.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), _number(text).alias("_group"),
        _number(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("_member"),
        F.monotonically_increasing_id().alias("_copy"),
        *([F.struct(*(F.col(c) for c in carry)).alias("row")] if carry else []))
    path = work_dir(spark, "shard-keys")
    keyed.write.parquet(path)
    rows = spark.read.parquet(path)
    total = rows.agg(F.sum("size")).first()[0] or 0
    shard = F.lit(0)
    for cut in splitters(rows, shards, total, tolerance) if total else []:
        shard = shard + _reached(cut).cast("int")
    order = ["shard", *(name for name, _ in LEVELS)]
    parts = [parts_for(total, RANGE_BYTES) + shards] if carry else []
    ranged = rows.withColumn("shard", shard).repartitionByRange(*parts, *order).sortWithinPartitions(*order)
    path = work_dir(spark, "shards")
    ranged.withColumn("_at", F.monotonically_increasing_id()).drop(*order[1:]).write.parquet(path)
    placed = spark.read.parquet(path).withColumn("_range", F.shiftright("_at", 33))
    # One row a range and shard; a range numbers its rows from its first row of the shard.
    runs = placed.groupBy("shard", "_range").agg(F.min("_at").alias("first"), F.count("*").alias("n"))
    runs = runs.select("shard", "_range", F.expr(
        "sum(n) over (partition by shard order by _range) - n - first").alias("_shift"))
    return (placed.join(F.broadcast(runs), ["shard", "_range"])
            .withColumn("slot", F.col("_at") + F.col("_shift"))
            .select("id", "size", "text_crc32", "shard", "slot", *(["row"] if carry else [])))


def write_shards(docs: DataFrame, path: str, shards: int = 16, **options) -> DataFrame:
    """The whole rows of ``docs`` as Parquet, one folder a shard, files in key order; gives what was written."""
    rows = assign(docs, shards, carry=tuple(docs.columns), **options)
    rows.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)
