"""foreachBatch sinks that can be replayed."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lacuna.sources.commits import Log


def _other_batches(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What other batches wrote; a replay must not see its own first try."""
    try:
        return spark.read.option("basePath", path).parquet(path).where(F.col("batch_id") != batch_id)
    except AnalysisException:
        return None


def once_per_key(path: str, keys: Sequence[str], job: Callable[[DataFrame], DataFrame] | None = None):
    """Run ``job`` on the keys no other batch has finished and replace this batch's folder.

    For keys whose rows arrive together, such as the traces of a whole block.  Rows of a
    key that an earlier batch finished are not dropped: they go to ``<path>.late``.  Each
    trigger reads the narrow list of finished keys (``<path>.keys``), never the results.
    For keys that grow over several batches use an aggregation (``grown``) instead.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            done = _other_batches(batch.sparkSession, f"{path}.keys", batch_id)
            fresh = rows
            if done is not None:
                known = done.select(*keys).distinct()
                fresh = rows.join(known, list(keys), "left_anti")
                late = rows.join(known, list(keys), "left_semi")
                late.write.mode("overwrite").parquet(f"{path}.late/batch_id={batch_id}")
            (job(fresh) if job else fresh).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            fresh.select(*keys).distinct().write.mode("overwrite").parquet(f"{path}.keys/batch_id={batch_id}")
        finally:
            rows.unpersist()

    return write


def grown(path: str):
    """Write what an update-mode aggregation gives; ``newest_batch`` reads the current row of every key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def changed_only(path: str, keys: Sequence[str], content: Sequence[str]):
    """Publish a row only where its content differs from what was published last."""

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = _other_batches(batch.sparkSession, path, batch_id)
        fresh = batch.withColumn("digest", F.xxhash64(*content))
        if seen is not None:
            last = seen.groupBy(*keys).agg(F.max_by("digest", "batch_id").alias("_d"))
            fresh = fresh.join(last, list(keys), "left").where(~F.col("digest").eqNullSafe(F.col("_d"))).drop("_d")
        fresh.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


class LatestValues:
    """The newest published row of every key, as a sink and as a table.

    What a trigger publishes is one attempt of a log that folds itself, so a trigger reads
    the current rows of the keys, never all that was ever published, and a batch that runs
    again replaces its own first try.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], most: int = 8) -> None:
        self.keys = tuple(keys)
        self.log = Log(spark, path, schema, self.keys, most)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Publish the rows that differ from the current row of their key, or have a new key."""
        attempt, parts = batch_id + 1, self.log.snapshot().parts
        if all(p.attempt < attempt for p in parts):
            parts = self.log.compact().parts  # the newest batch may still run again, those before it not
        others = [c for c in self.log.schema.names if c not in self.keys]
        last = self.log.current(tuple(p for p in parts if p.attempt != attempt)).select(
            *(F.col(k).alias(f"_{k}") for k in self.keys), F.struct(*others).alias("_last"))
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys))
        joined = batch.join(last, same, "left").where(F.col("_last").isNull() | ~F.struct(
            *(F.col(c).cast(self.log.schema[c].dataType) for c in others)).eqNullSafe(F.col("_last")))
        self.log.append(joined.select(*self.log.schema.names), attempt)

    def read(self) -> DataFrame:
        """The current row of every key."""
        return self.log.current().drop("attempt")


def run_available(stream: DataFrame, checkpoint: str, write, mode: str = "append") -> StreamingQuery:
    """Process everything that is there now and stop."""
    query = (stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def newest_batch(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Latest published row per key."""
    rows = spark.read.option("basePath", path).parquet(path)
    others = [c for c in rows.columns if c not in keys and c != "batch_id"]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("_r")).select(*keys, "_r.*")
