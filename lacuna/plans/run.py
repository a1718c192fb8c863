"""A whole run: block files in, 16-bit volumes out, every stage one Spark job.

Stages meet in Parquet under one folder, so a run that stops anywhere goes on
from what is there: finished slices are skipped, volumes are replaced whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions.arrays import map_arrays
from lacuna.functions.joins import measured_join, settle
from lacuna.functions.skew import with_position
from lacuna.operators import recovery as rc
from lacuna.operators import scaling as sc
from lacuna.operators import transforms as tf
from lacuna.operators.acquisition import check_sizes, echo_count, expected_bytes, split_echoes
from lacuna.session import ship
from lacuna.sources import sinks
from lacuna.sources import state as st
from lacuna.sources.blocks import register
from lacuna.sources.commits import Log


@dataclass(frozen=True)
class RunFolders:
    root: str

    def __getattr__(self, name: str) -> str:
        if name in ("workspace", "scales", "state", "complex", "study_scale", "images", "volumes", "quarantine"):
            return f"{self.root}/{name}"
        raise AttributeError(name)


def workspace(traces: DataFrame, acquired: int) -> DataFrame:
    """Readout transform, then slices of mask-ordered samples: (volume, slice, re, im)."""
    slices = tf.traces_to_slices(tf.readout_ifft(traces), acquired)
    return slices.withColumnRenamed("x", "slice")


def volume_scales(slices: DataFrame, masks: DataFrame, options: rc.RecoveryOptions) -> DataFrame:
    """Peak of the density-weighted zero-filled image of each volume, times sqrt(ny nz)."""
    o, n = options, options.padded
    rows = rc.with_mask(slices, masks, o)

    def peak(block):
        data = rc.place(block["positions"], block["re"] + 1j * block["im"], o.ny, o.nz, n)
        density = rc.place(block["positions"], np.take_along_axis(block["density"], block["positions"].astype(int), 1), o.ny, o.nz, n, 1.0)
        return {"slice_max": np.abs(np.fft.ifft2(data / density)).max(axis=(1, 2))}

    peaks = map_arrays(rows, peak, ("re", "im", "positions", "density"), "slice_max double", ("volume", "slice"))
    return peaks.groupBy("volume").agg(sc.volume_scale(F.max("slice_max"), n, n).alias("volume_scale"))


def recover_run(spark: SparkSession, path: str, masks: DataFrame, options: rc.RecoveryOptions, out: str,
                acquired: int, slices: int | None = None, echoes: int | None = None) -> DataFrame:
    """Recover every ready volume of ``path`` with the run's one mask; returns the images.

    ``path`` may name many files: a volume is one echo of one block of one file, and
    ``<out>/volumes`` lists its number (volume, path, block, echo); numbers stay when a
    resumed run finds more files.  Blocks that are short or have no data yet are listed
    in ``<out>/quarantine`` with the reason.  ``acquired`` is the number of sampled
    lines of an echo.  Without ``echoes`` each file's header tells how many echoes a block
    has: a single block holds its traces divided by ``acquired``, one of several blocks
    holds one.  ``slices`` is the total slice count if known (it sets the number of
    tasks of the solver).
    """
    ship(spark)
    register(spark)
    folders = RunFolders(out)
    raw = spark.read.format("lacuna_blocks").option("path", path).load()
    quarantine(spark, path).write.mode("overwrite").parquet(folders.quarantine)
    counts = echo_counts(spark, path, acquired, echoes)
    volumes = number_volumes(spark, path, counts, folders.volumes)
    split = split_echoes(measured_join(raw, counts, ["path"]), F.col("echoes")).drop("trace").withColumnRenamed("echo_trace", "trace")
    traces = measured_join(split, volumes, ["path", "block", "echo"]).select("volume", "trace", "re", "im")
    work = workspace(traces, acquired).withColumn("mask_id", F.lit(0))
    work.write.mode("overwrite").parquet(folders.workspace)
    work = spark.read.parquet(folders.workspace)

    volume_scales(work, masks, options).write.mode("overwrite").parquet(folders.scales)
    scales = spark.read.parquet(folders.scales)
    # a volume without any signal has scale 0 and stays as it is
    share = lambda c: F.transform(c, lambda v: v / F.when(F.col("volume_scale") > 0, F.col("volume_scale")).otherwise(1.0))
    scaled = measured_join(work, scales, ["volume"]).select("volume", "slice", "mask_id", share("re").alias("re"), share("im").alias("im"))
    earlier, attempt = _earlier(spark, folders.state)
    st.append_attempt(rc.recover(scaled, masks, options, earlier, slices=slices), folders.state, attempt)

    done = measured_join(st.read_state(spark, folders.state), scales, ["volume"])
    sinks.write_complex(rc.finish(done, options, "volume_scale").select("volume", "slice", "re", "im"), folders.complex)
    images = sinks.read_complex(spark, folders.complex).select(
        "volume", "slice", F.zip_with("re", "im", lambda a, b: F.sqrt(a * a + b * b)).alias("magnitude"))
    sinks.publish_once(study_scale(images), folders.study_scale)
    factor = sinks.read_published(spark, folders.study_scale)
    value = F.transform("magnitude", lambda m: sc.scaled(m, F.col("factor")))
    sinks.write_images(images.withColumn("factor", factor).select("volume", "slice", value.alias("value")), folders.images)
    return spark.read.parquet(folders.images)


def _headers(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.format("lacuna_blocks").option("path", path).option("table", table).load()


def echo_counts(spark: SparkSession, path: str, acquired: int, echoes: int | None = None) -> DataFrame:
    """(path, echoes) of every file: the given number, or what its header says."""
    files = _headers(spark, path, "file_header")
    told = echo_count(F.col("nblocks"), F.col("ntraces"), F.lit(acquired)) if echoes is None else F.lit(echoes)
    return files.select("path", told.alias("echoes"))


def number_volumes(spark: SparkSession, path: str, echoes: int | DataFrame, folder: str) -> DataFrame:
    """(path, block, echo, volume): earlier numbers as they are, new volumes after them, in order of file and block.

    ``echoes`` is the number for every block, or (path, echoes).  Only headers are read.  New numbers are one attempt of a log, given on the newest
    snapshot: runs that find the same files at a time do not number them twice.
    """
    ready = _headers(spark, path, "block_header").where("has_data").select("path", "block").distinct()
    counts = echoes if isinstance(echoes, DataFrame) else echo_counts(spark, path, 0, echoes)
    keys = ready.join(counts, "path").select("path", "block", F.explode(F.sequence(F.lit(0), F.col("echoes") - 1)).alias("echo"))
    log = Log(spark, folder, "path string, block int, echo int, volume int", ("path", "block", "echo"), first_wins=True)
    while True:
        seen = log.snapshot()
        known = log.current(seen.parts)
        top = known.agg(F.max("volume")).first()[0] or 0
        fresh = keys.join(known.select("path", "block", "echo"), ["path", "block", "echo"], "left_anti")
        placed = with_position(fresh.withColumn("_order", F.struct("path", "block", "echo")), [], "_order")
        rows = settle(placed.select("path", "block", "echo", (F.col("k") + top + 1).cast("int").alias("volume")))
        if rows.isEmpty() or log.append(rows, on=seen) is not None:
            log.compact()
            return log.current().drop("attempt")


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """(path, block, reason) of every block the file headers promise and the run leaves out."""
    files = check_sizes(_headers(spark, path, "file_header"))
    promised = files.select("path", "file_bytes", "bytes_per_block", F.explode(F.sequence(F.lit(1), F.col("nblocks"))).alias("block"))
    there = _headers(spark, path, "block_header").select("path", "block", "has_data")
    whole = expected_bytes(F.col("block").cast("bigint"), F.col("bytes_per_block")) <= F.col("file_bytes")
    reason = F.when(~whole, "short").when(~F.coalesce("has_data", F.lit(False)), "no data")
    return promised.join(there, ["path", "block"], "left").withColumn("reason", reason).where("reason is not null").select(
        "path", "block", "reason")


def study_scale(images: DataFrame) -> DataFrame:
    """Histogram cut-off of the first volume: one row."""
    first = images.where(F.col("volume") == images.agg(F.min("volume")).scalar())
    voxels = first.select(F.explode("magnitude").alias("magnitude"))
    top = settle(voxels.agg(F.max("magnitude").alias("top"))).scalar()
    return sc.histogram_cutoff(sc.histogram(voxels.withColumn("top", top), [], "magnitude", "top"), [], "top").select("scale")


def _earlier(spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
    """Stored state and the next attempt number."""
    last = st.last_attempt(spark, path)
    return (None, 1) if last is None else (st.read_state(spark, path), last + 1)
