"""Tags of runs: the first 100 bytes of the first volume, kept for good, that later volumes must match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions.joins import settle
from lacuna.operators.acquisition import TAG_BYTES
from lacuna.sources.commits import Log

#: 1-based bytes of the file status, which changes when an acquisition ends.
STATUS_FROM, STATUS_TO = 27, 28


def lasting(tag: Column) -> Column:
    """The bytes of a tag that never change."""
    return F.concat(F.substring(tag, 1, STATUS_FROM - 1), F.substring(tag, STATUS_TO + 1, TAG_BYTES - STATUS_TO))


def tag_log(spark: SparkSession, path: str, most: int = 16) -> Log:
    return Log(spark, path, "run string, tag_volume bigint, tag binary", ("run",), most, first_wins=True)


def check_tags(volumes: DataFrame, path: str) -> DataFrame:
    """Adds (tag_volume, tag_status) to (run, volume, ready, tag) and keeps the tags of new runs under ``path``.

    A run without a kept tag gets that of its lowest volume if that is ready.  Who comes
    second, also at the same time, is compared with what the first kept: ``written``,
    ``match``, ``mismatch``, ``not_ready``, or ``no_tag`` where the run has none yet.
    """
    log = tag_log(volumes.sparkSession, path)
    lowest = volumes.groupBy("run").agg(F.min_by(F.struct("volume", "ready", "tag"), "volume").alias("_v"))
    fresh = settle(lowest.where("_v.ready").join(log.current().select("run"), "run", "left_anti").select(
        "run", F.col("_v.volume").alias("tag_volume"), F.substring(F.col("_v.tag"), 1, TAG_BYTES).alias("tag")))
    if not fresh.isEmpty():
        log.append(fresh)
        log.compact()
    kept = log.current().select("run", "tag_volume", F.col("tag").alias("_kept"))
    asked = volumes.join(kept, "run", "left").join(fresh.select("run", F.lit(True).alias("_new")), "run", "left")
    status = (F.when(~F.col("ready"), "not_ready").when(F.col("_kept").isNull(), "no_tag")
              .when(F.col("_new") & (F.col("volume") == F.col("tag_volume")) & (F.col("_kept") == F.substring("tag", 1, TAG_BYTES)), "written")
              .when(lasting(F.col("tag")) == lasting(F.col("_kept")), "match").otherwise("mismatch"))
    return asked.withColumn("tag_status", status).drop("_kept", "_new")
