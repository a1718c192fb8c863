"""Commits that exactly one writer wins, on any file system Spark can reach.

A file is created once: whoever comes second reads what the first wrote.  On top of that
a ``Log`` names the folders of rows that count, as numbered snapshots; a new snapshot is
its predecessor with one change, and a writer that loses the race for a number tries
again on what the winner left.  Rows are Parquet that Spark writes and reads; the log
holds folder names only.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import astuple, dataclass, replace
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def _at(spark: SparkSession, path: str):
    """(file system, path) as Hadoop sees them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole small file, or None where there is none."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return None
    handle = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(handle, "UTF-8")
    finally:
        handle.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, hidden ones left out; none if it does not exist."""
    fs, where = _at(spark, folder)
    if not fs.exists(where):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(where)) if not n.startswith("."))


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` whole, or leave it as another writer made it; whether it was ours.

    The text is written beside and takes its name in one step that fails if the name is taken.
    """
    fs, where = _at(spark, path)
    fs.mkdirs(where.getParent())
    side = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.{uuid.uuid4().hex}")
    out = fs.create(side, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            os.link(side.toUri().getPath(), where.toUri().getPath())
        else:
            hadoop = spark._jvm.org.apache.hadoop.fs
            none = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
            none[0] = hadoop.Options.Rename.NONE
            hadoop.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration()).rename(side, where, none)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(side, False)


@dataclass(frozen=True)
class Part:
    """A folder of rows: the newest attempt in it, how many rows, and for folded ones the runs of attempts."""

    folder: str
    attempt: int
    rows: int
    folded: tuple[tuple[int, int], ...] = ()

    def spans(self) -> tuple[tuple[int, int], ...]:
        return self.folded or ((self.attempt, self.attempt),)


def _joined(spans: list[tuple[int, int]]) -> tuple[tuple[int, int], ...]:
    """Runs of whole numbers, those that touch made one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(high, out[-1][1])
        else:
            out.append((low, high))
    return tuple(out)


@dataclass(frozen=True)
class Snapshot:
    number: int
    parts: tuple[Part, ...]


class Log:
    """Rows under ``path``, appended by attempts; a read touches the live folders only.

    Every row gets the number of its attempt in the column ``attempt``.  An attempt that is
    written again replaces itself.  ``compact`` folds the newest folders into one, so that
    the number of live folders stays under ``most`` while old, large ones are rarely read.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: tuple[str, ...], most: int = 16,
                 first_wins: bool = False) -> None:
        self.spark, self.path, self.keys, self.most, self.first_wins = spark, path, keys, most, first_wins
        self.schema = StructType.fromDDL(schema)

    def snapshot(self) -> Snapshot:
        """The newest one.  Snapshots are never removed, so numbers are never used twice."""
        numbers = [int(n.removesuffix(".json")) for n in names(self.spark, f"{self.path}/_log")]
        if not numbers:
            return Snapshot(0, ())
        text = read_text(self.spark, f"{self.path}/_log/{max(numbers):010d}.json")
        return Snapshot(max(numbers), tuple(Part(*p[:3], tuple(map(tuple, p[3]))) for p in json.loads(text)))

    def commit(self, change: Callable[[tuple[Part, ...]], tuple[Part, ...] | None]) -> Snapshot:
        """Put ``change`` on top of the newest snapshot, whatever others do meanwhile; None changes nothing."""
        while True:
            now = self.snapshot()
            parts = change(now.parts)
            if parts is None:
                return now
            new = Snapshot(now.number + 1, tuple(parts))
            if create_once(self.spark, f"{self.path}/_log/{new.number:010d}.json", json.dumps([astuple(p) for p in parts])):
                return new

    def _write(self, rows: DataFrame, attempt: int, folded: tuple[tuple[int, int], ...] = ()) -> Part:
        folder = f"part-{uuid.uuid4().hex}"
        rows.write.option("compression", "lz4").parquet(f"{self.path}/{folder}")
        return Part(folder, attempt, self.spark.read.parquet(f"{self.path}/{folder}").count(), folded)

    def append(self, rows: DataFrame, attempt: int | None = None, on: Snapshot | None = None) -> Snapshot | None:
        """The rows of one attempt, seen whole or not at all; gives the snapshot that has them.

        An attempt may come late and may replace itself until it has been folded.  Without
        a number it gets the next one in the moment it counts.  Rows that rest on what a
        snapshot holds name it as ``on``: if it is not the newest any more, nothing is
        appended and None comes back.
        """
        part = self._write(rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema)), attempt or 0)

        def change(parts: tuple[Part, ...]) -> tuple[Part, ...] | None:
            if on is not None and parts != on.parts:
                return None
            if attempt is None:
                return *parts, replace(part, attempt=1 + max((p.attempt for p in parts), default=0))
            if any(low <= attempt <= high for p in parts for low, high in p.folded):
                raise ValueError(f"attempt {attempt} is finished and folded; give the rows a new number")
            return *(p for p in parts if p.folded or p.attempt != attempt), part

        new = self.commit(change)
        return new if any(p.folder == part.folder for p in new.parts) else None

    def read(self, parts: tuple[Part, ...] | None = None) -> DataFrame:
        """All live rows of a snapshot's parts with their attempts; old versions of a key are still among them."""
        parts = self.snapshot().parts if parts is None else parts
        schema = StructType([*self.schema.fields, StructField("attempt", IntegerType())])
        if not parts:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*(f"{self.path}/{p.folder}" for p in parts))
        given = [x for p in parts if not p.folded for x in (F.lit(p.folder), F.lit(p.attempt))]
        if not given:
            return rows
        folder = F.regexp_extract("_metadata.file_path", r"/(part-[0-9a-f]+)/[^/]*$", 1)
        return rows.withColumn("attempt", F.coalesce("attempt", F.create_map(*given)[folder]))

    def current(self, parts: tuple[Part, ...] | None = None) -> DataFrame:
        """One row a key, of its newest attempt, or of its earliest where the first one wins.

        The narrow columns are grouped; wide rows are read again only where they count.
        """
        rows = self.read(parts)
        best = rows.groupBy(*self.keys).agg((F.min if self.first_wins else F.max)("attempt").alias("attempt"))
        named = best.select(*(F.col(c).alias(f"_{c}") for c in best.columns))  # a null is a key like any other
        same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in best.columns))
        return rows.join(named, same, "left_semi")

    def compact(self) -> Snapshot:
        """Fold the newest folders into one when there are too many.

        From the newest back, a folder is folded in while it holds at most twice the rows
        of those after it; so a row is written again about once each time the state doubles.
        """
        now = self.snapshot()
        if len(now.parts) <= self.most:
            return now
        ordered = sorted(now.parts, key=lambda p: p.attempt)
        rows, cut = 0, len(ordered)
        while cut and (cut > self.most or ordered[cut - 1].rows <= 2 * rows or len(ordered) - cut < 2):
            cut -= 1
            rows += ordered[cut].rows
        old = tuple(ordered[cut:])
        order = list(self.keys)
        spans = _joined([span for p in old for span in p.spans()])
        merged = self._write(self.current(old).repartitionByRange(*order).sortWithinPartitions(*order), spans[-1][1], spans)
        # folders replaced by others meanwhile: what was folded is out of date, so nothing changes
        return self.commit(lambda parts: (*(p for p in parts if p not in old), merged) if set(old) <= set(parts) else None)

    def purge(self) -> int:
        """Delete folders no snapshot names as live; for when no reader or writer is at work."""
        live = {p.folder for p in self.snapshot().parts}
        gone = [n for n in names(self.spark, self.path) if n.startswith("part-") and n not in live]
        for n in gone:
            fs, where = _at(self.spark, f"{self.path}/{n}")
            fs.delete(where, True)
        return len(gone)


def publish_once(rows: DataFrame, path: str) -> DataFrame:
    """A few rows published under ``path`` for good: the first writer's, for all writers and readers."""
    spark = rows.sparkSession
    if read_text(spark, f"{path}/_winner") is None:
        folder = f"attempt-{uuid.uuid4().hex}"
        rows.write.parquet(f"{path}/{folder}")
        create_once(spark, f"{path}/_winner", folder)
    return published(spark, path)


def published(spark: SparkSession, path: str) -> DataFrame:
    folder = read_text(spark, f"{path}/_winner")
    if folder is None:
        raise FileNotFoundError(f"nothing is published under {path}")
    return spark.read.parquet(f"{path}/{folder}")
