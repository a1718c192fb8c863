"""Admission control: of every run at most so many volumes are in flight, the next ones start as others finish.

What was admitted and what finished is one log.  A step reads a snapshot, takes finished
volumes out, fills the free places in order of volume, and commits both on that snapshot
only; a step that another admitter overtook is worked out again.  So the limit holds for
any number of admitters, and a trigger that runs again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lacuna.functions.joins import settle
from lacuna.sources.commits import Log
from lacuna.streaming.sinks import run_available

ADMITTED, FINISHED = "admitted", "finished"


def admissions(spark: SparkSession, path: str) -> Log:
    return Log(spark, path, "run bigint, volume bigint, event string", ("run", "volume", "event"))


def in_flight(events: DataFrame) -> DataFrame:
    """(run, volume, attempt) of what is admitted and not finished."""
    done = events.where(F.col("event") == FINISHED).select("run", "volume")
    return events.where(F.col("event") == ADMITTED).join(done, ["run", "volume"], "left_anti").select("run", "volume", "attempt")


def admit(requests: DataFrame, finished: DataFrame | None, log: Log, limit: int, attempt: int) -> DataFrame:
    """One step; gives the volumes (run, volume) that may start now.

    ``finished`` has (run, volume); volumes that are not in flight are passed over.  The
    lowest ``limit`` waiting volumes of a run are found before anything is shuffled, so a
    run with most requests costs no more than others.
    """
    while True:
        seen = log.snapshot()
        events = settle(log.read(tuple(p for p in seen.parts if p.attempt != attempt)))
        flight = in_flight(events)
        done = flight.select("run", "volume").where("false")
        if finished is not None:
            done = flight.join(finished.select("run", "volume").distinct(), ["run", "volume"], "left_semi").select("run", "volume")
        held = flight.join(done, ["run", "volume"], "left_anti").groupBy("run").agg(F.count("*").alias("held"))
        begun = events.where(F.col("event") == ADMITTED).select("run", "volume")
        place = F.row_number().over(Window.partitionBy("run").orderBy("volume"))
        waiting = requests.select("run", "volume").distinct().join(begun, ["run", "volume"], "left_anti")
        waiting = waiting.withColumn("place", place).where(F.col("place") <= limit)
        fresh = waiting.join(held, "run", "left").where(F.col("place") <= limit - F.coalesce("held", F.lit(0)))
        rows = settle(done.withColumn("event", F.lit(FINISHED)).union(
            fresh.select("run", "volume", F.lit(ADMITTED).alias("event"))))
        if log.append(rows, attempt, on=seen) is not None:
            return rows.where(F.col("event") == ADMITTED).select("run", "volume")


def admit_stream(requests: DataFrame, finished: DataFrame, log: Log, limit: int, checkpoint: str) -> StreamingQuery:
    """Fill all places once, then go on with every batch of the ``finished`` stream until it has no more.

    ``finished`` has (run, volume), or (run, n): so many volumes of the run, the oldest in
    flight first.  The stream's own read limit sets how much one trigger takes in.
    """
    if log.snapshot().number == 0:
        admit(requests, None, log, limit, 1)

    def step(batch: DataFrame, batch_id: int) -> None:
        attempt = batch_id + 2
        named = batch
        if "n" in batch.columns:
            flight = in_flight(log.read(tuple(p for p in log.snapshot().parts if p.attempt != attempt)))
            place = F.row_number().over(Window.partitionBy("run").orderBy("attempt", "volume"))
            many = batch.groupBy("run").agg(F.sum("n").alias("n"))
            named = flight.withColumn("place", place).join(many, "run").where(F.col("place") <= F.col("n"))
        if all(p.attempt < attempt for p in log.snapshot().parts):
            log.compact()  # the newest attempt may still be run again, those before it not
        admit(requests, settle(named.select("run", "volume")), log, limit, attempt)

    return run_available(finished, checkpoint, step)


def load(events: DataFrame) -> DataFrame:
    """(run, trigger, admitted, finished, in_flight) after every trigger in which a run changed."""
    steps = events.groupBy("run", F.col("attempt").alias("trigger")).agg(
        F.count_if(F.col("event") == ADMITTED).alias("admitted"), F.count_if(F.col("event") == FINISHED).alias("finished"))
    upto = Window.partitionBy("run").orderBy("trigger")
    return steps.withColumn("in_flight", F.sum(F.col("admitted") - F.col("finished")).over(upto))
