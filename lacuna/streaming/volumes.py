"""Volumes of growing block files, processed as they become ready."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.sources.blocks import register
from lacuna.streaming.sinks import once_per_key


def logged_offset(spark: SparkSession, checkpoint: str) -> str:
    """Last offset a query wrote to its checkpoint, or the empty start."""
    try:
        logs = spark.read.text(f"{checkpoint}/offsets").where(F.startswith("value", F.lit('{"ready"')))
        batch = F.regexp_extract(F.input_file_name(), "/offsets/([0-9]+)$", 1).cast("long")
        found = logs.agg(F.max_by("value", batch)).first()[0]
    except AnalysisException:
        found = None
    return found or '{"ready": {}}'


def growing_blocks(spark: SparkSession, path: str, max_blocks: int | None = None, checkpoint: str | None = None) -> DataFrame:
    """Stream of the traces of ready blocks; an admission limit needs the checkpoint to resume from."""
    register(spark)
    reader = spark.readStream.format("lacuna_blocks").option("path", path)
    if max_blocks:
        if not checkpoint:
            raise ValueError("max_blocks needs the query's checkpoint")
        reader = reader.option("max_blocks", str(max_blocks)).option("issued", logged_offset(spark, checkpoint))
    return reader.load()


def process_volumes(stream: DataFrame, job: Callable[[DataFrame], DataFrame], out: str, checkpoint: str,
                    keys: tuple[str, ...] = ("path", "block"), interval: str | None = None):
    """Every ready volume goes through ``job`` once, several volumes per trigger as one job."""
    writer = stream.writeStream.foreachBatch(once_per_key(out, keys, job)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
