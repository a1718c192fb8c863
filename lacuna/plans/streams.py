"""Streaming queries run to the end of the given tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.plans.registry import query, table
from lacuna.session import work_dir
from lacuna.streaming import admission, gate, sinks, status


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a stream; event time must be a zoned timestamp for watermarks."""
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/events*.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _local_times(df: DataFrame) -> DataFrame:
    """Timestamps back to the zone-free type of the tables."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema
                           if f.dataType.typeName() == "timestamp"})


def drain(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Run an append-mode stream to the end into Parquet and read it back."""
    path = work_dir(spark, "stream")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    sinks.run_available(stream, work_dir(spark, "checkpoint"), write)
    return _local_times(spark.read.option("basePath", path).parquet(path).drop("batch_id"))


STAGE = "CASE event_type WHEN 'signup' THEN 0 WHEN 'click' THEN 1 WHEN 'view' THEN 3 WHEN 'error' THEN 4 ELSE 6 END"


@query(f"SELECT user_id AS volume, arg_max({STAGE}, ts) AS stage, max(ts) AS ts FROM events GROUP BY 1")
def stream_latest_stage(spark: SparkSession, folder: str) -> DataFrame:
    """Newest stage per volume and its time, published only when they change."""
    facts = event_stream(spark, folder).select(F.col("user_id").alias("volume"), F.expr(STAGE).alias("stage"), "ts")
    path = work_dir(spark, "stages")
    sinks.run_available(status.latest_stage(facts, ["volume"]), work_dir(spark, "checkpoint"),
                        sinks.changed_only(path, ["volume"], ["stage", "ts"]), "update")
    return _local_times(sinks.newest_batch(spark, path, ["volume"]).select("volume", "stage", "ts"))


IDLE = "20 minutes"


@query("""WITH e AS (SELECT user_id % 40 AS run, ts, value FROM events),
  g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 20 MINUTE THEN 0 ELSE 1 END AS brk FROM e WINDOW w AS (PARTITION BY run ORDER BY ts)),
  s AS (SELECT *, sum(brk) OVER (PARTITION BY run ORDER BY ts) AS session FROM g),
  a AS (SELECT run, session, count(*) AS steps, max(ts) AS last_progress, arg_max(value, ts) AS remaining FROM s GROUP BY 1, 2)
SELECT run, steps, last_progress, remaining, last_progress + INTERVAL 20 MINUTE AS stalled_at FROM a
WHERE remaining > 0 AND last_progress + INTERVAL 20 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def stream_stalls(spark: SparkSession, folder: str) -> DataFrame:
    progress = event_stream(spark, folder).select((F.col("user_id") % 40).alias("run"), "ts", F.col("value").alias("remaining"))
    return drain(spark, status.stalls(progress, "run", IDLE))


@query("""WITH q AS (SELECT user_id AS volume, event_id, ts FROM events WHERE event_type = 'signup'), r AS (SELECT user_id AS volume, ts AS ready_ts FROM events WHERE event_type = 'purchase')
SELECT q.volume, event_id, ts, min(ready_ts) AS ready_ts, CASE WHEN min(ready_ts) IS NULL THEN 'timeout' ELSE 'ready' END AS outcome FROM q LEFT JOIN r ON q.volume = r.volume AND ready_ts BETWEEN ts AND ts + INTERVAL 2 HOUR
WHERE ts + INTERVAL 2 HOUR < least((SELECT max(ts) FROM q), (SELECT max(ready_ts) FROM r)) - INTERVAL 10 MINUTE GROUP BY 1, 2, 3""")
def stream_wait(spark: SparkSession, folder: str) -> DataFrame:
    events = event_stream(spark, folder)
    requests = events.where("event_type = 'signup'").select(F.col("user_id").alias("volume"), "event_id", "ts")
    ready = event_stream(spark, folder).where("event_type = 'purchase'").select(F.col("user_id").alias("volume"), "ts")
    return drain(spark, status.wait_for(requests, ready, ["volume"], "2 HOURS"))


@query("""WITH q AS (SELECT user_id AS volume, event_id, ts FROM events WHERE event_type = 'view'), r AS (SELECT user_id AS volume, ts AS file_ts, props AS params FROM events WHERE event_type = 'click')
SELECT q.volume, event_id, ts, min(file_ts) AS file_ts, arg_min(params, file_ts) AS params, min(file_ts) IS NOT NULL AS header_complete FROM q LEFT JOIN r ON q.volume = r.volume AND file_ts BETWEEN ts AND ts + INTERVAL 1 HOUR
WHERE ts + INTERVAL 1 HOUR < least((SELECT max(ts) FROM q), (SELECT max(file_ts) FROM r)) - INTERVAL 10 MINUTE GROUP BY 1, 2, 3""")
def stream_late_parameters(spark: SparkSession, folder: str) -> DataFrame:
    images = event_stream(spark, folder).where("event_type = 'view'").select(F.col("user_id").alias("volume"), "event_id", "ts")
    files = event_stream(spark, folder).where("event_type = 'click'").select(F.col("user_id").alias("volume"), "ts", F.col("props").alias("params"))
    return drain(spark, status.late_parameters(images, files, ["volume"], "1 HOUR"))


@query("""SELECT user_id % 50 AS volume, event_type, count(*) AS steps, max(event_id) AS last_event FROM events GROUP BY 1, 2""")
def stream_volumes(spark: SparkSession, folder: str) -> DataFrame:
    """Steps and newest event of every volume as its events arrive."""
    path = work_dir(spark, "volumes")
    stream = event_stream(spark, folder).select((F.col("user_id") % 50).alias("volume"), "event_type", "event_id")
    steps = stream.groupBy("volume", "event_type").agg(F.count(F.lit(1)).alias("steps"), F.max("event_id").alias("last_event"))
    sinks.run_available(steps, work_dir(spark, "checkpoint"), sinks.grown(path), "update")
    return sinks.newest_batch(spark, path, ["volume", "event_type"])


@query("""WITH w AS (SELECT o_custkey % 25 AS source, o_custkey AS run, o_orderkey AS volume FROM orders WHERE o_orderstatus = 'P'), a AS (SELECT o_custkey % 25 AS source, max(o_custkey) AS newest_run FROM orders WHERE o_totalprice > 200000 GROUP BY 1)
SELECT w.source, run, volume, newest_run, CASE WHEN newest_run > run THEN 'released' ELSE 'waiting' END AS outcome FROM w LEFT JOIN a ON w.source = a.source""")
def superseded(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        (F.col("o_custkey") % 25).alias("source"), F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("volume"), "o_orderstatus", "o_totalprice")
    waiters = orders.where("o_orderstatus = 'P'").select("source", "run", "volume")
    return status.release_superseded(waiters, orders.where("o_totalprice > 200000"))


@query("""WITH e AS (SELECT user_id % 25 AS source, user_id AS run, CAST(floor(value) AS BIGINT) % 3 AS volume, ts, event_type FROM events
    WHERE event_type IN ('signup', 'purchase', 'error')),
  w AS (SELECT DISTINCT source, run, volume, ts FROM e WHERE event_type = 'signup'),
  r AS (SELECT w.*, min(e.ts) AS ready_ts FROM w JOIN e ON e.event_type = 'purchase' AND (e.source, e.run, e.volume) = (w.source, w.run, w.volume)
    AND e.ts BETWEEN w.ts AND w.ts + INTERVAL 6 HOUR GROUP BY ALL),
  a AS (SELECT w.*, min(e.ts) AS new_ts, arg_min(e.run, (e.ts, -e.run)) AS new_run FROM w JOIN e ON e.event_type = 'error' AND e.source = w.source AND e.run > w.run
    AND e.ts BETWEEN w.ts AND w.ts + INTERVAL 6 HOUR GROUP BY ALL),
  d AS (SELECT w.*, ready_ts, new_ts, new_run, least(ready_ts, new_ts, w.ts + INTERVAL 6 HOUR) AS decided_ts
    FROM w LEFT JOIN r USING (source, run, volume, ts) LEFT JOIN a USING (source, run, volume, ts))
SELECT source, run, volume, ts, decided_ts, CASE decided_ts WHEN ready_ts THEN 'ready' WHEN new_ts THEN 'released' ELSE 'timeout' END AS outcome,
  CASE WHEN decided_ts = new_ts AND decided_ts IS DISTINCT FROM ready_ts THEN new_run END AS newer_run
FROM d WHERE decided_ts <= (SELECT date_trunc('millisecond', max(ts)) FROM e) - INTERVAL 10 MINUTE""")
def stream_supersede(spark: SparkSession, folder: str) -> DataFrame:
    """Waiters released by a newer run of their source, unless their data comes first."""
    volume = F.floor("value") % 3
    source, run, ts = F.col("user_id") % 25, F.col("user_id"), F.col("ts")
    kinds = {"signup": gate.WAIT, "purchase": gate.READY, "error": gate.ACQUIRED}
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("event_type")]
    events = event_stream(spark, folder).where(F.col("event_type").isin(*kinds)).select(
        *gate.event(kind, source, run, ts, F.when(F.col("event_type") != "error", volume)))
    return drain(spark, gate.gate(events, "6 HOURS", shares=4))


PLACES, WEEKS = 6, 5


@query(f"""WITH RECURSIVE r AS (SELECT o_custkey % 30 AS run, count(*) AS total FROM orders GROUP BY 1),
  e AS (SELECT user_id % 30 AS run, least((day(ts) - 1) // 7, {WEEKS - 1}) + 2 AS trigger, count(*) AS n FROM events WHERE event_type = 'purchase' AND value > 30 GROUP BY ALL),
  q AS (SELECT run, 1::BIGINT AS trigger, total, least(total, {PLACES}) AS a, 0::BIGINT AS f FROM r
    UNION ALL SELECT run, trigger, total, least(total, f + {PLACES}), f FROM (
      SELECT q.run, q.trigger + 1 AS trigger, total, q.f + least(q.a - q.f, coalesce(n, 0)) AS f
      FROM q LEFT JOIN e ON e.run = q.run AND e.trigger = q.trigger + 1 WHERE q.trigger <= {WEEKS})),
  d AS (SELECT run, trigger, a - lag(a, 1, 0) OVER w AS admitted, f - lag(f, 1, 0) OVER w AS finished, a - f AS in_flight FROM q WINDOW w AS (PARTITION BY run ORDER BY trigger))
SELECT run, trigger::INTEGER AS trigger, admitted::BIGINT AS admitted, finished::BIGINT AS finished, in_flight::BIGINT AS in_flight FROM d WHERE admitted > 0 OR finished > 0""")
def stream_admission(spark: SparkSession, folder: str) -> DataFrame:
    """Volumes of a run start as others finish, week by week; never more than six are in flight."""
    path = work_dir(spark, "finished")
    events = table(spark, folder, "events").where("event_type = 'purchase' AND value > 30")
    week = F.least(F.floor((F.dayofmonth("ts") - 1) / 7), F.lit(WEEKS - 1))
    for i in range(WEEKS):
        events.where(week == i).select((F.col("user_id") % 30).alias("run")).coalesce(1).write.parquet(f"{path}/week{i}")
    finished = spark.readStream.schema("run bigint").option("maxFilesPerTrigger", 1).parquet(f"{path}/week*")
    requests = table(spark, folder, "orders").select((F.col("o_custkey") % 30).alias("run"), F.col("o_orderkey").alias("volume"))
    log = admission.admissions(spark, work_dir(spark, "admitted"))
    admission.admit_stream(requests, finished.withColumn("n", F.lit(1)), log, PLACES, work_dir(spark, "checkpoint"))
    return admission.load(log.read())


@query(f"SELECT user_id AS volume, arg_max({STAGE}, ts)::INTEGER AS stage, max(ts) AS ts FROM events GROUP BY 1")
def stream_stage_table(spark: SparkSession, folder: str) -> DataFrame:
    """The newest stage of every volume in a table that is as large as its keys, however long the stream."""
    facts = event_stream(spark, folder).select(F.col("user_id").alias("volume"), F.expr(STAGE).alias("stage"), "ts")
    table_ = sinks.LatestValues(spark, work_dir(spark, "stages"), "volume bigint, stage int, ts timestamp", ["volume"])
    sinks.run_available(status.latest_stage(facts, ["volume"]), work_dir(spark, "checkpoint"), table_.write, "update")
    return _local_times(table_.read())
