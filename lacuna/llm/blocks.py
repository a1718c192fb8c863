"""Blocks of documents that ask buckets of hashes, and read the answers.

A block is some megabytes of documents, named by a hash; a bucket is a range of 64-bit
hashes.  A block sends each bucket its sorted distinct hashes as one binary row; the
bucket compares what all blocks sent and answers every row with values in the same
order.  A hash costs a few bytes in the shuffle and nothing is ever sent twice by a
block, so a passage that stands in a third of all documents is one hash a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lacuna.llm.common import settle
from lacuna.session import ship

#: Bytes of text of a block; a task holds about forty times as much while it works.
BLOCK_BYTES = 8 << 20

NOTES = "block int, key bigint, h bigint, ord bigint, flag boolean, bucket int, data binary, more binary"
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, key, h): two independent hashes name a row; a null text is empty."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.withColumns({"key": F.xxhash64("id", "text"), "h": F.xxhash64("text", F.lit("h"), "id")})


def ordered(rows: DataFrame, *carry: str) -> DataFrame:
    """(id, key, h, ord, + carry): the place of every distinct row in order of id, then key.

    Ids are dealt into ranges by a sample; each range numbers its rows, and only the
    sizes of the ranges meet in one place.
    """
    keys = settle(rows.select("id", "key", "h", *carry).distinct().repartitionByRange("id", "key")
                  .withColumn("part", F.spark_partition_id()))
    sizes = keys.groupBy("part").count()  # one row a partition
    before = sizes.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("id", "key"))
    return (keys.withColumn("place", place).join(F.broadcast(before), "part")
            .withColumn("ord", F.col("before") + F.col("place") - 1).drop("part", "place", "before"))


def notes(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` with all columns of ``NOTES``, nulls where it has none."""
    kinds = dict(x.split(" ") for x in NOTES.split(", "))
    return df.select(*((F.col(c) if c in df.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()))


def visit(rows: DataFrame, given: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``fn`` on every block's rows and notes."""
    ship(rows.sparkSession)
    return rows.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(fn, schema)


def answered(sent: DataFrame, fn: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """``fn`` on everything that one bucket was sent; gives notes for the blocks."""
    return sent.groupBy("bucket").applyInArrow(fn, NOTES)


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a settled step go when the step ends, not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, old)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def bucket_edges(hashes: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, start, end) of sorted hashes; buckets are equal ranges of the hash."""
    which = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.concatenate(([True], which[1:] != which[:-1]))) if len(which) else np.zeros(0, int)
    ends = [*cuts[1:].tolist(), len(which)]
    return list(zip(which[cuts].tolist(), cuts.tolist(), ends, strict=True)) if len(which) else []


def pack_planes(x: np.ndarray) -> bytes:
    """Whole numbers, byte by byte of their places: high bytes that are mostly zero shrink to little."""
    return zstandard.compress(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack_planes(data: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(flat.reshape(8, -1).T).view(np.uint64).reshape(-1)


def pack_sorted(x: np.ndarray) -> bytes:
    """Rising 64-bit numbers as packed differences, some two bytes shorter each."""
    return pack_planes(np.diff(x, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_planes(data), dtype=np.uint64)


def pack_places(order: np.ndarray, at: np.ndarray) -> bytes:
    """Document places, as numbers within the block beside the block's own list of places."""
    table = pack_sorted(order.astype(np.uint64))
    return len(table).to_bytes(4, "little") + table + pack_planes(at)


def unpack_places(data: bytes) -> np.ndarray:
    cut = 4 + int.from_bytes(data[:4], "little")
    return unpack_sorted(data[4:cut])[unpack_planes(data[cut:]).astype(np.int64)]


def note_table(rows: list[dict]) -> pa.Table:
    fields = {"block": pa.int32(), "key": pa.int64(), "h": pa.int64(), "ord": pa.int64(), "flag": pa.bool_(),
              "bucket": pa.int32(), "data": pa.binary(), "more": pa.binary()}
    return pa.Table.from_pylist(rows, schema=pa.schema(list(fields.items())))


class Block:
    """The distinct rows of a block in document order, their bytes end to end."""

    def __init__(self, rows: pa.Table, given: pa.Table) -> None:
        self.number = rows.column("block")[0].as_py() if rows.num_rows else -1
        place = {}
        self.replies: dict[object, list[tuple[int, bytes, bytes | None]]] = {}
        for g in given.to_pylist():
            if g["ord"] is not None:
                place[g["key"], g["h"]] = g["ord"], g["flag"]
            else:
                self.replies.setdefault(g["flag"], []).append((g["bucket"], g["data"], g["more"]))
        keys = list(zip(rows.column("key").to_pylist(), rows.column("h").to_pylist(), strict=True))
        texts = rows.column("text")
        where = sorted({k: i for i, k in enumerate(keys)}.items(), key=lambda x: place[x[0]][0])
        self.row_doc = {k: n for n, (k, _) in enumerate(where)}
        self.keys = keys
        self.order = np.array([place[k][0] for k, _ in where], dtype=np.int64)
        self.flags = np.array([bool(place[k][1]) for k, _ in where])
        parts = [texts[i].as_py().encode("utf-8") for _, i in where]
        self.sizes = np.array([len(p) for p in parts], dtype=np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.data = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def reply(self, kind: object) -> bytes:
        """The answers of all buckets, in order of hash."""
        return b"".join(data for _, data, _ in sorted(self.replies.get(kind, []), key=lambda r: r[0]))

    def reply_bits(self, kind: object, size: int, edges: list[tuple[int, int, int]]) -> np.ndarray:
        out = np.zeros(size, dtype=bool)
        got = {bucket: data for bucket, data, _ in self.replies.get(kind, [])}
        for bucket, a, b in edges:
            out[a:b] = np.unpackbits(np.frombuffer(got[bucket], dtype=np.uint8), count=b - a).view(bool)
        return out
