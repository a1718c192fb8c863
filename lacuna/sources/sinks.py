"""Parquet, TSV and text outputs, all safe to run again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.sources.commits import publish_once, published

__all__ = ["append_log", "publish_once", "read_complex", "read_published", "write_complex", "write_images", "write_manifest",
           "write_timing"]


def write_images(images: DataFrame, path: str) -> None:
    """16-bit magnitude slices by volume; volumes written again are replaced whole."""
    (images.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("volume").parquet(path))


def write_complex(slices: DataFrame, path: str) -> None:
    """Complex volumes in single precision, as exported."""
    single = slices.withColumns({c: F.col(c).cast("array<float>") for c in ("re", "im")})
    (single.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("volume").parquet(path))


def read_complex(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.withColumns({c: F.col(c).cast("array<double>") for c in ("re", "im")})


def read_published(spark: SparkSession, path: str, column: str = "scale") -> Column:
    """The published value as a scalar subquery."""
    return published(spark, path).agg(F.first(column)).scalar()


def write_timing(timing: DataFrame, path: str) -> None:
    """Tab separated report, missing values empty."""
    timing.write.mode("overwrite").option("sep", "\t").option("header", "true").option("nullValue", "").csv(path)


def write_manifest(lines: DataFrame, path: str, group: str) -> None:
    """One folder per group with its lines in order."""
    (lines.repartition(group).sortWithinPartitions(group, "line_no").select(group, "line")
     .write.mode("overwrite").partitionBy(group).text(path))


def append_log(messages: DataFrame, path: str, targets: Sequence[str] = ("target",)) -> None:
    messages.write.mode("append").partitionBy(*targets).json(path)
