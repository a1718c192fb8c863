"""Resumable work state: attempts in a log of live folders, the newest one of a slice counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.sources.commits import Log

STATE_DDL = "volume int, slice bigint, iterations int, re array<double>, im array<double>"


def state_log(spark: SparkSession, path: str, most: int = 16) -> Log:
    return Log(spark, path, STATE_DDL, ("volume", "slice"), most)


def allocate(plan: DataFrame) -> DataFrame:
    """Header rows with zero iterations and no iterate yet."""
    empty = F.array().cast("array<double>")
    return plan.select("volume", "slice").distinct().select(
        "volume", "slice", F.lit(0).alias("iterations"), empty.alias("re"), empty.alias("im"))


def append_attempt(rows: DataFrame, path: str, attempt: int, most: int = 16) -> None:
    """One attempt; the commit is atomic and a re-run of the attempt replaces it.

    Beyond ``most`` live folders the newest are folded into one, so reads stay cheap
    however many attempts there were.
    """
    log = state_log(rows.sparkSession, path, most)
    log.append(rows, attempt)
    log.compact()


def last_attempt(spark: SparkSession, path: str) -> int | None:
    """Number of the newest attempt, from the log alone."""
    return max((p.attempt for p in state_log(spark, path).snapshot().parts), default=None)


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the live folders with their ``attempt``."""
    return state_log(spark, path).read()


def header(spark: SparkSession, path: str) -> DataFrame:
    """Newest attempt per slice; only the narrow columns are read."""
    return read_attempts(spark, path).groupBy("volume", "slice").agg(
        F.max("attempt").alias("attempt"), F.max_by("iterations", "attempt").alias("iterations"))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return state_log(spark, path).current().select("volume", "slice", "iterations", "re", "im")


def remaining(header_rows: DataFrame, limit: int) -> DataFrame:
    """Slices left, finished and in total per volume."""
    left = F.count_if(F.col("iterations") < limit)
    return header_rows.groupBy("volume").agg(
        left.alias("remaining"), F.count_if(F.col("iterations") >= limit).alias("completed"),
        (left / F.count(F.lit(1))).alias("fraction_left"))
