"""Volumes written again at several resolutions, one output after the other; a run that stops goes on.

Every output is a log of rows, one part a job, and another log has a marker for each volume
that is whole, with the part that holds it.  A marker is committed after the rows are
there, so a run that dies between the two writes those volumes again, and what it left is
never read; marked volumes are never touched.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions.joins import settle
from lacuna.operators import transforms as tf
from lacuna.sources.commits import Log


@dataclass(frozen=True)
class Reduction:
    """An output by the name of its run; ``factor`` need not be whole."""

    name: str
    factor: float

    def dims(self, shape: Sequence[int]) -> tuple[int, int, int]:
        """Sizes divided and rounded, halves up."""
        if self.factor < 1:
            raise ValueError("a reduction has a factor of 1 or more")
        return tuple(math.floor(s / self.factor + 0.5) for s in shape)


def markers(spark: SparkSession, out: str) -> Log:
    return Log(spark, f"{out}/_done", "name string, volume bigint, volume_id string, factor double, nx int, ny int, nz int, "
                                      "part int, samples bigint", ("name", "volume"))


def output(spark: SparkSession, out: str, name: str) -> Log:
    return Log(spark, f"{out}/{name}", "volume int, x int, pos int, magnitude double", ("volume", "x", "pos"))


def pending(volumes: DataFrame, out: str, reduction: Reduction) -> DataFrame:
    """Volumes without a marker for this output."""
    done = markers(volumes.sparkSession, out).read().where(F.col("name") == reduction.name).select("volume")
    return volumes.select("volume").distinct().join(done, "volume", "left_anti")


def write_reduction(slices: DataFrame, shape: tuple[int, int, int], out: str, reduction: Reduction) -> int:
    """Magnitudes of the volumes in ``slices`` as a part of the output, sorted by volume; gives the part's number."""
    small = tf.downsample(slices, shape, reduction.dims(shape))
    rows = small.select("volume", "x", "pos", F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im")).alias("magnitude"))
    rows = rows.repartitionByRange("volume", "x").sortWithinPartitions("volume", "x", "pos")
    return output(slices.sparkSession, out, reduction.name).append(rows).parts[-1].attempt


def mark(spark: SparkSession, shape: tuple[int, int, int], out: str, reduction: Reduction, part: int, digits: int = 2) -> None:
    """Markers for the volumes whose rows are all in a part, with what a header needs; others stay pending."""
    nx, ny, nz = reduction.dims(shape)
    rows = output(spark, out, reduction.name)
    there = rows.read(tuple(p for p in rows.snapshot().parts if p.attempt == part))
    whole = there.groupBy("volume").agg(F.count("*").alias("samples")).where(F.col("samples") == nx * ny * nz)
    number = F.col("volume").cast("string")
    rows = whole.select(
        F.lit(reduction.name).alias("name"), "volume",
        F.concat(F.lit(f"{reduction.name}_m"), F.lpad(number, F.greatest(F.lit(digits), F.length(number)), F.lit("0"))).alias("volume_id"),
        F.lit(float(reduction.factor)).alias("factor"), F.lit(nx).alias("nx"), F.lit(ny).alias("ny"), F.lit(nz).alias("nz"), F.lit(part).alias("part"),
        "samples")
    log = markers(spark, out)
    log.append(rows)
    log.compact()


def export_reductions(slices: DataFrame, shape: tuple[int, int, int], reductions: Sequence[Reduction], out: str,
                      limit: int | None = None) -> DataFrame:
    """Write what is not marked yet of every output and give the markers of all.

    ``slices`` are (volume, x, re, im).  An output is one job for all its pending volumes,
    committed before the next begins; ``limit`` takes the lowest so many volumes only.
    """
    spark = slices.sparkSession
    volumes = slices.select("volume").distinct()
    if limit is not None:
        volumes = volumes.orderBy("volume").limit(limit)
    for reduction in reductions:
        todo = settle(pending(volumes, out, reduction))
        if todo.isEmpty():
            continue
        mark(spark, shape, out, reduction, write_reduction(slices.join(todo, "volume", "left_semi"), shape, out, reduction))
    return markers(spark, out).current().drop("attempt")


def read_reduction(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The marked volumes of one output, each from the part its marker names."""
    done = markers(spark, out).current().where(F.col("name") == name).select("volume", F.col("part").alias("attempt"))
    return output(spark, out, name).read().join(done, ["volume", "attempt"], "left_semi").drop("attempt")
