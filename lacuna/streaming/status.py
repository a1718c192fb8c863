"""Readiness, timeouts, status and stalls of a run as streaming queries.

State is kept by built-in stateful operators (joins, aggregations, session
windows); none of them needs Python state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _within(left: DataFrame, right: DataFrame, on: Sequence[str], limit: str, delay: str, time: str) -> DataFrame:
    """Left rows beside the right rows within ``limit`` after them; each left row at least once."""
    named = right.select(*[F.col(k).alias(f"_{k}") for k in on], F.col("ts").alias(time),
                         *[c for c in right.columns if c not in (*on, "ts")]).withWatermark(time, delay)
    match = F.lit(True)
    for k in on:
        match = match & (F.col(k) == F.col(f"_{k}"))
    span = (F.col(time) >= F.col("ts")) & (F.col(time) <= F.col("ts") + F.expr(f"INTERVAL {limit}"))
    return left.withWatermark("ts", delay).join(named, match & span, "left_outer").drop(*[f"_{k}" for k in on])


def wait_for(requests: DataFrame, ready: DataFrame, on: Sequence[str], limit: str, delay: str = "10 minutes") -> DataFrame:
    """Every request once: answered by the earliest ready event within the limit, else ``timeout``.

    Both inputs carry ``ts``.  A left outer stream-stream join and a minimum over each
    request; the answer comes out once the watermark passes the end of the wait, so it
    does not depend on how the input is cut into batches.  Equal requests count once.
    """
    joined = _within(requests, ready.select(*on, "ts"), on, limit, delay, "ready_ts")
    answered = joined.groupBy(*requests.columns).agg(F.min("ready_ts").alias("ready_ts"))
    return answered.withColumn("outcome", F.when(F.col("ready_ts").isNull(), "timeout").otherwise("ready"))


def late_parameters(images: DataFrame, files: DataFrame, on: Sequence[str], limit: str, delay: str = "10 minutes") -> DataFrame:
    """Every image once with its earliest parameter file if one comes in time; NULL parameters otherwise."""
    joined = _within(images, files.select(*on, "ts", "params"), on, limit, delay, "file_ts")
    first = F.min(F.when(F.col("file_ts").isNotNull(), F.struct("file_ts", "params"))).alias("_f")
    return joined.groupBy(*images.columns).agg(first).select(
        *images.columns, F.col("_f.file_ts").alias("file_ts"), F.col("_f.params").alias("params")).withColumn(
        "header_complete", F.col("params").isNotNull())


def release_superseded(waiters: DataFrame, acquisitions: DataFrame, source: str = "source", run: str = "run") -> DataFrame:
    """Waiters of a run are released as soon as its source has a newer run."""
    newest = acquisitions.groupBy(source).agg(F.max(run).alias("newest_run"))
    return waiters.join(newest, source, "left").withColumn(
        "outcome", F.when(F.col("newest_run") > F.col(run), "released").otherwise("waiting"))


def latest_stage(facts: DataFrame, key: Sequence[str], stage: str = "stage", order: Sequence[str] = ("ts",)) -> DataFrame:
    """Newest stage per volume; use with update output mode."""
    newest = F.max(F.struct(*order, stage))
    return facts.groupBy(*key).agg(newest.alias("_n")).select(
        *key, F.col(f"_n.{stage}").alias(stage), *[F.col(f"_n.{c}").alias(c) for c in order])


def stalls(progress: DataFrame, run: str, idle: str, delay: str = "10 minutes") -> DataFrame:
    """A session of progress that ended: nothing new within ``idle`` of the last step."""
    sessions = progress.withWatermark("ts", delay).groupBy(run, F.session_window("ts", idle)).agg(
        F.count(F.lit(1)).alias("steps"), F.max("ts").alias("last_progress"), F.max_by("remaining", "ts").alias("remaining"))
    return sessions.where("remaining > 0").select(run, "steps", "last_progress", "remaining",
                                                  F.col("session_window.end").alias("stalled_at"))
