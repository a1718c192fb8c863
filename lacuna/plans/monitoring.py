"""Queries on logs, timings, progress, admission and the queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions import text
from lacuna.operators import monitoring as mo
from lacuna.plans.registry import query, table

# ---------------------------------------------------------------- logs

METRIC_SQL = """(SELECT event_id AS line_no, user_id AS slice, CASE event_type WHEN 'view' THEN 'time_load' WHEN 'click' THEN 'time_setup'
  WHEN 'purchase' THEN 'time_recon' ELSE 'iterations' END AS metric, value FROM events WHERE event_type <> 'error')"""


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as the text lines of a recovery log."""
    n, v = F.col("user_id").cast("string"), F.col("value").cast("string")
    line = (F.when(F.col("event_type") == "view", F.concat(F.lit("Slice "), n, F.lit(": Time to load sparse data:  "), v, F.lit(" seconds.")))
            .when(F.col("event_type") == "click", F.concat(F.lit("Slice "), n, F.lit(" : Time to set up recon:  "), v, F.lit(" seconds.")))
            .when(F.col("event_type") == "purchase", F.concat(
                F.lit("slice "), n, F.lit(": Time to reconstruct data (With 1 iteration blocks):  "), v, F.lit(" seconds. ")))
            .when(F.col("event_type") == "signup", F.concat(F.lit("Slice "), n, F.lit(': Reconstruction flag ("'), v, F.lit('") written.')))
            .otherwise(F.concat(F.lit("ERROR: Slice "), n, F.lit(" could not be read"))))
    return table(spark, folder, "events").select(F.lit(0).alias("volume"), F.col("event_id").alias("line_no"), line.alias("line"))


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    return mo.scan_log(log_lines(spark, folder), ("line_no",))


@query(f"SELECT * FROM {METRIC_SQL}")
def log_scan(spark: SparkSession, folder: str) -> DataFrame:
    return metrics(spark, folder)


ATTEMPT_SQL = f"""(WITH RECURSIVE m AS (SELECT *, CASE metric WHEN 'time_recon' THEN 1 WHEN 'time_load' THEN 2 WHEN 'time_setup' THEN 4 ELSE 8 END AS bit,
    row_number() OVER (PARTITION BY slice ORDER BY line_no) AS rn FROM {METRIC_SQL}),
  walk AS (SELECT slice, rn, bit AS seen, 1 AS attempt FROM m WHERE rn = 1
    UNION ALL SELECT m.slice, m.rn, CASE WHEN (w.seen & m.bit) > 0 THEN m.bit ELSE w.seen | m.bit END, w.attempt + CASE WHEN (w.seen & m.bit) > 0 THEN 1 ELSE 0 END
    FROM walk w JOIN m ON m.slice = w.slice AND m.rn = w.rn + 1)
  SELECT m.line_no, m.slice, m.metric, m.value, CAST(w.attempt AS INTEGER) AS attempt FROM m JOIN walk w ON m.slice = w.slice AND m.rn = w.rn)"""


def numbered(spark: SparkSession, folder: str) -> DataFrame:
    return mo.number_attempts(metrics(spark, folder), ["slice"], "line_no")


@query(f"SELECT * FROM {ATTEMPT_SQL}")
def attempt_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return numbered(spark, folder).drop("attempts")


TIMING_SQL = f"""(WITH a AS (SELECT * FROM {ATTEMPT_SQL}), l AS (SELECT slice, max(attempt) AS attempts FROM a GROUP BY slice)
  SELECT l.slice, attempts, max(value) FILTER (WHERE metric = 'time_recon') AS time_recon, max(value) FILTER (WHERE metric = 'time_load') AS time_load,
  max(value) FILTER (WHERE metric = 'time_setup') AS time_setup, max(value) FILTER (WHERE metric = 'iterations') AS iterations
  FROM l JOIN a ON a.slice = l.slice AND a.attempt = l.attempts GROUP BY 1, 2)"""


@query(f"SELECT * FROM {TIMING_SQL}")
def slice_timing(spark: SparkSession, folder: str) -> DataFrame:
    return mo.last_attempts(numbered(spark, folder), ["slice"])


@query(f"""WITH a AS (SELECT * FROM {ATTEMPT_SQL}), l AS (SELECT slice, max(attempt) AS n FROM a GROUP BY slice)
SELECT a.* FROM a JOIN l ON a.slice = l.slice WHERE attempt < n""")
def failed_attempts(spark: SparkSession, folder: str) -> DataFrame:
    return mo.failed_attempts(numbered(spark, folder))


SUMMARY_SQL = f"""(SELECT slice % 10 AS run, count(time_recon) AS slices, avg(time_recon) AS mean_time, sum(time_recon) AS total_time,
  min(nullif(time_recon, 0)) AS shortest, max(time_recon) AS longest, CAST(sum(attempts - 1) AS BIGINT) AS restarts FROM {TIMING_SQL} GROUP BY 1)"""


def timing_by_run(spark: SparkSession, folder: str) -> DataFrame:
    timing = mo.last_attempts(numbered(spark, folder), ["slice"]).withColumn("run", F.col("slice") % 10)
    return mo.timing_summary(timing, ["run"])


@query(f"SELECT run, slices, round(mean_time, 6) AS mean_time, round(total_time, 6) AS total_time, shortest, longest, restarts FROM {SUMMARY_SQL}")
def timing_summary(spark: SparkSession, folder: str) -> DataFrame:
    return timing_by_run(spark, folder).withColumns({c: F.round(c, 6) for c in ("mean_time", "total_time")})


CORE_SQL = """(SELECT DISTINCT c AS cores FROM (SELECT unnest(range(16, 97, 16)) AS c UNION ALL SELECT unnest(range(20, 81, 20)) AS c
  UNION ALL SELECT a + b FROM (SELECT unnest(range(16, 97, 16)) AS a), (SELECT unnest(range(20, 81, 20)) AS b)))"""
HMS = """CASE WHEN ms IS NOT NULL THEN concat(lpad(CAST(ms // 3600000 AS VARCHAR), 2, '0'), ':', lpad(CAST(ms // 60000 % 60 AS VARCHAR), 2, '0'), ':', lpad(CAST(ms // 1000 % 60 AS VARCHAR), 2, '0'),
  '.', lpad(CAST(ms % 1000 AS VARCHAR), 3, '0')) END"""


@query(f"""SELECT run, CAST(cores AS INTEGER) AS cores, {HMS.replace('ms', 'lo')} AS min_time, {HMS.replace('ms', 'hi')} AS max_time FROM (
  SELECT run, cores, CAST(floor(1480 * shortest / cores * 1000 + 0.5) AS BIGINT) AS lo, CAST(floor(1480 * longest / cores * 1000 + 0.5) AS BIGINT) AS hi FROM {SUMMARY_SQL}, {CORE_SQL})""")
def estimate_grid(spark: SparkSession, folder: str) -> DataFrame:
    summary = timing_by_run(spark, folder).withColumn("slice_count", F.lit(1480))
    return mo.work_estimate(summary, ["run"], "slice_count")


@query("""WITH f AS (SELECT user_id AS slice, event_id AS line_no, row_number() OVER w - 1 AS k, value, value / first_value(value) OVER w AS f
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
  m AS (SELECT slice, line_no, k, value, CASE WHEN k >= 9 THEN avg(f) OVER (PARTITION BY slice ORDER BY k ROWS 9 PRECEDING) END AS m FROM f),
  d AS (SELECT *, lag(m) OVER w AS m1, lag(m, 2) OVER w AS m2 FROM m WINDOW w AS (PARTITION BY slice ORDER BY k))
SELECT slice, line_no, k, value, round(m, 6) AS mean_window, round(m - m1, 6) + 0.0 AS delta, round(m - 2 * m1 + m2, 6) + 0.0 AS metric FROM d""")
def convergence_metric(spark: SparkSession, folder: str) -> DataFrame:
    objective = table(spark, folder, "events").select(
        F.col("user_id").alias("slice"), F.col("event_id").alias("line_no"), "value")
    out = mo.convergence(objective, ["slice"], "line_no", "value")
    return out.select("slice", "line_no", "k", "value", F.round("mean_window", 6).alias("mean_window"),
                      *[(F.round(c, 6) + 0.0).alias(c) for c in ("delta", "metric")])


@query("""SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean_iterations, min(value) AS min_iterations, max(value) AS max_iterations,
  round(stddev_samp(value), 6) AS std_iterations FROM events GROUP BY event_type""")
def iteration_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = mo.iteration_stats(table(spark, folder, "events"), ["event_type"], "value")
    return stats.withColumns({c: F.round(c, 6) for c in ("mean_iterations", "std_iterations")})


@query(f"""SELECT kind, slice, line_no, value FROM (SELECT CASE metric WHEN 'time_recon' THEN 'time' ELSE 'iterations' END AS kind, slice, line_no, value
  FROM {METRIC_SQL} WHERE metric IN ('time_recon', 'iterations'))""")
def harvest(spark: SparkSession, folder: str) -> DataFrame:
    rows = metrics(spark, folder).where(F.col("metric").isin("time_recon", "iterations"))
    return rows.select(F.when(F.col("metric") == "time_recon", "time").otherwise("iterations").alias("kind"),
                       "slice", "line_no", "value")


# ---------------------------------------------------------------- stages and progress

FACT_SQL = """(SELECT o_custkey AS run, o_orderkey AS volume, k % 5 = 0 AS tag_sent, k % 3 = 0 AS images_sent, k % 4 = 0 AS header_sent, (k % 11) * 4096 AS header_bytes,
  k % 6 AS image_count, k % 7 <> 0 AS has_header, k % 8 <> 0 AS state_exists, 100 AS slices, (k % 13) * 7 AS slices_left, k % 9 <> 0 AS workspace_ok,
  (k % 10) * 12 AS file_bytes, CASE WHEN k % 17 <> 0 THEN 1 + k % 3 END AS source_class, k % 2 = 0 AS source_ready FROM (SELECT *, o_orderkey * 7 // 3 AS k FROM orders))"""
STAGE_SQL = f"""(SELECT *, CASE WHEN done THEN 6 WHEN imaged THEN 5 WHEN frac = 0 THEN 4 WHEN state_exists AND workspace_ok THEN 3 WHEN file_bytes > 60 THEN 2 WHEN NOT waiting THEN 1 ELSE 0 END AS stage,
  CASE WHEN done THEN 100 ELSE 99.9 - CASE WHEN images_sent THEN 0 ELSE 1.8 END - CASE WHEN header_sent THEN 0 ELSE 0.1 END
    - CASE WHEN imaged THEN 0 ELSE 3 + 90 * frac + CASE WHEN frac > 0 AND NOT (state_exists AND workspace_ok) AND file_bytes <= 60 THEN 4 + CASE WHEN waiting THEN 1 ELSE 0 END ELSE 0 END END END AS progress
  FROM (SELECT *, tag_sent AND header_bytes > 20480 AS done, image_count > 0 AND has_header AS imaged, CASE WHEN state_exists THEN slices_left / slices ELSE 1 END AS frac,
    coalesce(source_class = 2 AND NOT source_ready, true) AS waiting FROM {FACT_SQL}))"""


def facts(spark: SparkSession, folder: str) -> DataFrame:
    k = F.floor(F.col("o_orderkey") * 7 / 3)
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("volume"), (k % 5 == 0).alias("tag_sent"),
        (k % 3 == 0).alias("images_sent"), (k % 4 == 0).alias("header_sent"), (k % 11 * 4096).alias("header_bytes"),
        (k % 6).alias("image_count"), (k % 7 != 0).alias("has_header"), (k % 8 != 0).alias("state_exists"), F.lit(100).alias("slices"),
        (k % 13 * 7).alias("slices_left"), (k % 9 != 0).alias("workspace_ok"), (k % 10 * 12).alias("file_bytes"),
        F.when(k % 17 != 0, 1 + k % 3).alias("source_class"), (k % 2 == 0).alias("source_ready"))


@query(f"SELECT run, volume, CAST(stage AS INTEGER) AS stage, CAST(round(progress, 3) AS DOUBLE) AS progress FROM {STAGE_SQL}")
def volume_stage(spark: SparkSession, folder: str) -> DataFrame:
    return mo.volume_stage(facts(spark, folder)).select("run", "volume", "stage", F.round("progress", 3).alias("progress"))


@query(f"""SELECT run, count(*) AS volumes, count(*) FILTER (WHERE stage = 6) AS done,
  CAST(floor(sum(CAST(round(progress * 1000) AS BIGINT)) / (count(*) * 1000)) AS BIGINT) AS total_progress FROM {STAGE_SQL} GROUP BY run""")
def progress_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return mo.run_progress(mo.volume_stage(facts(spark, folder)), "run")


@query(f"""SELECT run AS volume, count(*) FILTER (WHERE slices_left < 50) AS remaining, count(*) FILTER (WHERE slices_left >= 50) AS completed,
  CAST(count(*) FILTER (WHERE slices_left < 50) AS DOUBLE) / count(*) AS fraction_left FROM {FACT_SQL} GROUP BY run""")
def remaining_counts(spark: SparkSession, folder: str) -> DataFrame:
    from lacuna.sources.state import remaining

    rows = facts(spark, folder).select(F.col("run").alias("volume"), F.col("slices_left").alias("iterations"))
    return remaining(rows, 50)


# ---------------------------------------------------------------- admission


def volumes_of(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("volume"), "o_orderstatus", "o_totalprice", "o_orderpriority")


@query("SELECT DISTINCT o_custkey AS run, o_orderkey AS volume FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_custkey, o_orderkey FROM orders WHERE o_totalprice > 300000")
def started_set(spark: SparkSession, folder: str) -> DataFrame:
    v = volumes_of(spark, folder)
    return mo.started(v.where("o_orderstatus = 'F'"), v.where("o_totalprice > 300000"), ["run", "volume"])


@query("SELECT o_custkey AS run, o_orderkey AS volume FROM orders EXCEPT SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 100000")
def pending_volumes(spark: SparkSession, folder: str) -> DataFrame:
    v = volumes_of(spark, folder)
    done = v.where("o_orderstatus = 'F' AND o_totalprice >= 100000")
    return mo.unfinished(v.select("run", "volume"), done, ["run", "volume"])


@query("""WITH v AS (SELECT o_custkey AS run, o_orderkey AS volume, o_orderstatus = 'F' OR o_totalprice > 300000 AS s, o_orderpriority = '1-URGENT' AS q, o_orderstatus = 'F' AND o_totalprice > 150000 AS f FROM orders),
  c AS (SELECT run, count(*) FILTER (WHERE s) - count(*) FILTER (WHERE s AND f) + count(*) FILTER (WHERE NOT s AND q) AS in_progress, min(volume) FILTER (WHERE NOT s AND NOT q AND volume >= 10) AS nxt FROM v GROUP BY run)
SELECT run, in_progress, CASE WHEN in_progress < 4 THEN nxt END AS next_volume FROM c""")
def next_admitted(spark: SparkSession, folder: str) -> DataFrame:
    v = volumes_of(spark, folder)
    begun = mo.started(v.where("o_orderstatus = 'F'"), v.where("o_totalprice > 300000"), ["run", "volume"])
    queued, finished = v.where("o_orderpriority = '1-URGENT'"), v.where("o_orderstatus = 'F' AND o_totalprice > 150000")
    return mo.next_admitted(v, begun, queued, finished, "run", "volume", limit=4, skipped=10)


@query("""WITH a AS (SELECT DISTINCT o_custkey AS run FROM orders WHERE o_orderstatus = 'P'), w AS (SELECT c_custkey AS run FROM customer WHERE c_acctbal > 3000)
SELECT coalesce(a.run, w.run) AS run, CASE WHEN w.run IS NULL THEN 'add' WHEN a.run IS NULL THEN 'remove' ELSE 'keep' END AS action FROM a FULL JOIN w ON a.run = w.run""")
def watch_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    active = volumes_of(spark, folder).where("o_orderstatus = 'P'")
    watched = table(spark, folder, "customer").where("c_acctbal > 3000").select(F.col("c_custkey").alias("run"))
    return mo.reconcile(active, watched, "run")


@query("""SELECT o_custkey AS run, o_orderdate, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""")
def newest_per_run(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumnRenamed("o_custkey", "run")
    return mo.newest(orders, ["run"], ["o_orderdate", "o_orderkey"], [])


@query("SELECT DISTINCT o_orderkey AS volume FROM orders WHERE o_custkey % 2 = 0 OR o_orderstatus <> 'O' ORDER BY 1")
def volume_list(spark: SparkSession, folder: str) -> DataFrame:
    return volumes_of(spark, folder).where("run % 2 = 0 OR o_orderstatus <> 'O'").select("volume").distinct().orderBy("volume")


CHUNK_SQL = "(SELECT o_custkey AS run, o_orderkey AS volume, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4 AS chunk FROM orders)"


@query(f"SELECT * FROM {CHUNK_SQL}")
def chunk_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return mo.chunks(volumes_of(spark, folder).select("run", "volume"), ["run"], "volume", 4)


@query("""WITH l AS (SELECT l_orderkey AS run, CAST(l_linenumber AS BIGINT) AS slice FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)),
  c AS (SELECT run, slice, (row_number() OVER (PARTITION BY run ORDER BY slice) - 1) // 5 AS chunk FROM l),
  g AS (SELECT *, slice - row_number() OVER (PARTITION BY run, chunk ORDER BY slice) AS island FROM c),
  s AS (SELECT run, chunk, island, min(slice) AS lo, max(slice) AS hi, count(*) AS n FROM g GROUP BY 1, 2, 3)
SELECT run, chunk, CAST(sum(n) AS BIGINT) AS n, max(hi) - min(lo) + 1 = sum(n) AS contiguous,
  string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE concat(lo, '_to_', hi) END, '_' ORDER BY lo) AS range_text FROM s GROUP BY 1, 2""")
def chunk_range_text(spark: SparkSession, folder: str) -> DataFrame:
    slices = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("run"), F.col("l_linenumber").cast("bigint").alias("slice")).distinct()
    return mo.chunk_text(mo.chunks(slices, ["run"], "slice", 5), ["run"], "slice")


@query("SELECT o_orderkey AS volume FROM orders WHERE o_orderkey = 1 OR o_orderkey BETWEEN 100 AND (SELECT max(c_custkey) FROM customer)")
def volume_range(spark: SparkSession, folder: str) -> DataFrame:
    """Volume 1 is always kept beside the asked range."""
    last = table(spark, folder, "customer").agg(F.max("c_custkey")).scalar()
    v = F.col("volume")
    return volumes_of(spark, folder).select("volume").where((v == 1) | ((v >= 100) & (v <= last)))


# ---------------------------------------------------------------- housekeeping


@query("""SELECT volume, CASE WHEN header_bytes > 20480 AND NOT keep AND state_exists THEN 'purge' WHEN header_bytes > 20480 AND NOT keep THEN 'already_gone' ELSE 'keep' END AS action
  FROM (SELECT *, volume % 4 = 1 AS keep FROM """ + FACT_SQL + ")")
def purge_plan(spark: SparkSession, folder: str) -> DataFrame:
    rows = facts(spark, folder).withColumns({"keep_work": F.col("volume") % 4 == 1, "has_work": F.col("state_exists")})
    return mo.purge_plan(rows).select("volume", "action")


@query("""SELECT o_orderkey AS volume, image_count, expected, CASE WHEN image_count >= expected AND o_totalprice >= expected * 40000 THEN 'send' WHEN image_count >= expected THEN 'no_space' ELSE 'incomplete' END AS gate
  FROM (SELECT o_orderkey, o_totalprice, 1 + o_orderkey % 6 AS expected, coalesce(n, 0) AS image_count FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)""")
def export_gate(spark: SparkSession, folder: str) -> DataFrame:
    images = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("volume")).agg(F.count(F.lit(1)).alias("n"))
    orders = volumes_of(spark, folder).join(images, "volume", "left").select(
        "volume", F.coalesce("n", F.lit(0)).alias("image_count"), (1 + F.col("volume") % 6).alias("expected"),
        F.col("o_totalprice").alias("free_bytes"), ((1 + F.col("volume") % 6) * 40000).alias("needed_bytes"))
    return mo.export_gate(orders).select("volume", "image_count", "expected", "gate")


@query("""WITH v AS (SELECT o_custkey, concat('S', lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(6, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0'), '_m', lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(8, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0')) AS name FROM orders),
  e AS (SELECT o_custkey AS run, min(name) AS a, max(name) AS b, count(*) AS members FROM v GROUP BY 1),
  p AS (SELECT run, members, a, coalesce(min(i) FILTER (WHERE substr(a, i, 1) <> substr(b, i, 1)) - 1, length(any_value(a))) AS n FROM (SELECT *, unnest(range(1, greatest(length(a), length(b)) + 1)) AS i FROM e) GROUP BY 1, 2, 3)
SELECT run, members, substr(a, 1, n) AS prefix FROM p""")
def name_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    name = text.volume_id(F.concat(F.lit("S"), text.padded(F.col("run"), 6)), F.col("volume"), 8)
    return mo.common_prefix(volumes_of(spark, folder).withColumn("name", name), ["run"], "name")


@query("""WITH v AS (SELECT o_custkey AS base, o_orderkey, o_custkey // 3 AS person FROM orders)
SELECT base, row_number() OVER (PARTITION BY base ORDER BY o_orderkey) - 1 AS line_no, concat_ws(',', concat('S', base, '_m', o_orderkey), 'space', '192', '20.5', 'raw') AS line FROM v
UNION ALL SELECT base, count(*), concat('# recon_person=', max(person)) FROM v GROUP BY base
UNION ALL SELECT base, count(*) + 1, '# tag_file_creator=lacuna' FROM v GROUP BY base""")
def manifest_lines(spark: SparkSession, folder: str) -> DataFrame:
    v = volumes_of(spark, folder).select(
        F.col("run").alias("base"), "volume", F.floor(F.col("run") / 3).alias("person"),
        F.concat(F.lit("S"), F.col("run"), F.lit("_m"), F.col("volume")).alias("run"))
    return mo.manifest(v, "base", "volume", F.lit("space"), F.lit(192), F.lit("20.5"), F.lit("raw"), F.col("person").cast("string"), "lacuna")


@query("""SELECT event_id, target, CASE WHEN event_type = 'error' THEN concat('ERROR: ', event_type, ' ', value) ELSE concat(event_type, ' ', value) END AS logged
  FROM (SELECT *, unnest(CASE WHEN user_id % 2 = 0 THEN ['console', 'volume'] ELSE ['volume'] END) AS target FROM events)""")
def log_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    messages = table(spark, folder, "events").select(
        "event_id", F.concat_ws(" ", "event_type", "value").alias("message"), (F.col("event_type") == "error").alias("is_error"),
        F.when(F.col("user_id") % 2 == 0, "console,volume").otherwise("volume").alias("targets"))
    return mo.fan_out(messages, "targets", "message", "is_error").select("event_id", "target", "logged")


# ---------------------------------------------------------------- queue

JOB_SQL = """(SELECT event_id AS job_id, CASE WHEN user_id % 3 = 0 THEN 'high' ELSE 'slow' END AS partition, concat('S', lpad(CAST(user_id AS VARCHAR), CAST(greatest(5, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0'), '_m', event_id % 8) AS name,
  concat('user', user_id % 7) AS user, CASE event_type WHEN 'view' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' ELSE 'PENDING' END AS state, concat('S', lpad(CAST(user_id AS VARCHAR), CAST(greatest(5, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0')) AS run FROM events)"""


def queue_lines(spark: SparkSession, folder: str) -> DataFrame:
    u = F.col("user_id")
    state = F.when(F.col("event_type") == "view", "RUNNING").when(F.col("event_type") == "error", "FAILED").otherwise("PENDING")
    return table(spark, folder, "events").select(F.concat_ws(
        "  ", F.concat(F.lit(" "), F.col("event_id")), F.when(u % 3 == 0, "high").otherwise("slow"),
        F.concat(F.lit("S"), text.padded(u, 5), F.lit("_m"), F.col("event_id") % 8),
        F.concat(F.lit("user"), u % 7), state).alias("line"))


def jobs(spark: SparkSession, folder: str) -> DataFrame:
    return mo.queue_jobs(queue_lines(spark, folder)).withColumn("run", F.substring_index("name", "_", 1))


@query(f"SELECT job_id, partition, name, user, state FROM {JOB_SQL}")
def queue_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return jobs(spark, folder).select("job_id", "partition", "name", "user", "state")


@query(f"SELECT DISTINCT run FROM {JOB_SQL}")
def active_runs(spark: SparkSession, folder: str) -> DataFrame:
    return mo.active_runs(queue_lines(spark, folder))


@query(f"""WITH j AS (SELECT * FROM {JOB_SQL} WHERE lower(name) LIKE 's0001%')
SELECT 'all' AS list, job_id FROM j UNION ALL SELECT 'pending', job_id FROM j WHERE state = 'PENDING'
UNION ALL SELECT 'running', job_id FROM j WHERE state = 'RUNNING' UNION ALL SELECT 'cancel', job_id FROM j WHERE state <> 'RUNNING'""")
def jobs_of_run(spark: SparkSession, folder: str) -> DataFrame:
    """Jobs of the runs that match a pattern: all, pending, running and to be cancelled."""
    j = mo.jobs_of(jobs(spark, folder), "^S0001")
    return j.select(F.explode(mo.job_lists("state")).alias("list"), "job_id")


@query(f"""SELECT j.job_id, name, concat('/logs/', o_orderkey, '.log') AS log FROM {JOB_SQL} j JOIN orders ON o_orderkey = j.job_id WHERE regexp_matches(user, 'user[1-3]') AND partition = 'high' AND regexp_matches(name, '_m[0-5]')""")
def job_logs(spark: SparkSession, folder: str) -> DataFrame:
    logs = table(spark, folder, "orders").select(F.col("o_orderkey").alias("job_id"), F.concat(F.lit("/logs/"), F.col("o_orderkey"), F.lit(".log")).alias("log"))
    return mo.job_logs(jobs(spark, folder), logs, "user[1-3]", "^high$", "_m[0-5]").select("job_id", "name", "log")


@query("""WITH j AS (SELECT *, concat(run, '_', job_id // 100) AS part FROM """ + JOB_SQL + """)
SELECT part AS run, count(*) FILTER (WHERE state = 'PENDING') AS queued, count(*) FILTER (WHERE state = 'RUNNING') AS running FROM j GROUP BY 1
HAVING count(*) FILTER (WHERE state = 'PENDING') > 0 AND count(*) FILTER (WHERE state = 'RUNNING') = 0""")
def stuck_runs(spark: SparkSession, folder: str) -> DataFrame:
    parts = jobs(spark, folder).withColumn("run", F.concat_ws("_", "run", F.floor(F.col("job_id") / 100)))
    return mo.unhealthy(parts, "run", "state")


@query("SELECT c_custkey AS mount, CAST(floor(c_acctbal * 1000000 / 1073741824) AS BIGINT) AS free_gib, floor(c_acctbal * 1000000 / 1073741824) < 2 AS alert FROM customer")
def low_capacity(spark: SparkSession, folder: str) -> DataFrame:
    gib, low = mo.low_capacity(F.col("c_acctbal") * 1000000)
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("mount"), gib.alias("free_gib"), low.alias("alert"))
