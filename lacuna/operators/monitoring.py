"""Logs, timings, progress and admission as relational jobs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions import skew, text
from lacuna.functions.arrays import map_arrays

METRICS = tuple(text.LOG_PATTERNS)  # bit i of a seen-set is METRICS[i]

# Header size that counts as complete, and progress points.
COMPLETE_HEADER_BYTES = 20 * 1024
POINTS = {"tag": 0.1, "images": 1.8, "header": 0.1, "cleanup": 3.0, "slices": 90.0, "extract": 4.0, "acquire": 1.0}
# Core counts of the two node kinds.
CORES_A, CORES_B = tuple(range(16, 97, 16)), tuple(range(20, 81, 20))


# ---------------------------------------------------------------- logs


def scan_log(lines: DataFrame, keep: Sequence[str] = ("volume", "line_no"), line: str = "line") -> DataFrame:
    """Typed metric rows of a recovery log; other lines are left out."""
    c = F.col(line)
    return lines.where(text.is_metric(c)).select(
        *keep, text.metric_slice(c).alias("slice"), text.metric_name(c).alias("metric"), text.metric_value(c).alias("value"))


class _Range:
    """Attempt starts within consecutive lines, for any set of metrics seen before."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        following = np.full(n, n)  # next line of the same metric
        self.codes, self.first = codes, {}
        for code in range(len(METRICS)):
            at = np.flatnonzero(codes == code)
            if len(at):
                following[at[:-1]] = at[1:]
                self.first[code] = int(at[0])
        # earliest repeat of anything logged at or after a line
        self.repeat = np.minimum.accumulate(following[::-1])[::-1].tolist() + [n]
        self.present = sum(1 << code for code in self.first)
        self.known: dict[int, list[int]] = {}

    def starts(self, state: int) -> list[int]:
        at = min([self.repeat[0]] + [p for code, p in self.first.items() if state >> code & 1])
        if at not in self.known:
            chain, p = [], at
            while p < len(self.codes):
                chain.append(p)
                p = self.repeat[p]
            self.known[at] = chain
        return self.known[at]

    def seen_after(self, state: int) -> int:
        starts = self.starts(state)
        if not starts:
            return state | self.present
        return sum(1 << int(code) for code in set(self.codes[starts[-1]:].tolist()))


def number_attempts(metrics: DataFrame, keys: Sequence[str], order: str, metric: str = "metric",
                    chunk: int = 1 << 18) -> DataFrame:
    """Adds ``attempt`` and the key's total ``attempts``: a metric already seen starts the next attempt.

    Lines are cut into ranges of nearly equal size, whatever the values of ``order``.  Each
    range is summarised by what it does to every possible seen-set; the summaries, some
    hundred bytes a range, are chained per key, and then each range numbers its own lines.
    No task holds all lines of a key.
    """
    keys, sets = list(keys), 1 << len(METRICS)
    group = keys + ["_chunk"]
    others = [c for c in metrics.columns if c not in (*keys, order, metric)]
    names = F.array(*[F.lit(m) for m in METRICS])
    code = (F.array_position(names, F.col(metric)) - 1).cast("int")
    cut = skew.in_ranges(metrics.withColumn("_code", code), keys, order, chunk)
    lines = F.array_sort(F.collect_list(F.struct(order, "_code", *others)))
    ranges = cut.groupBy(*group).agg(lines.alias("_lines")).withColumn("_codes", F.col("_lines._code"))

    def summarise(block):
        ranges = [_Range(codes) for codes in block["_codes"]]
        return {"_after": [[r.seen_after(s) for s in range(sets)] for r in ranges],
                "_resets": [[len(r.starts(s)) for s in range(sets)] for r in ranges]}

    effects = map_arrays(ranges, summarise, ("_codes",), "_after array<int>, _resets array<int>", group, ragged=True)
    chained = effects.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_chunk", "_after", "_resets"))).alias("_e"))
    chained = chained.select(*keys, F.col("_e._chunk").alias("_chunks"), F.flatten("_e._after").alias("_after"),
                             F.flatten("_e._resets").alias("_resets"))

    def chain(block):
        states, bases, totals = [], [], []
        for chunks, after, resets in zip(block["_chunks"], block["_after"], block["_resets"]):
            state, attempt = 0, 1
            row_states, row_bases = np.empty(len(chunks), dtype=int), np.empty(len(chunks), dtype=int)
            for i in range(len(chunks)):
                row_states[i], row_bases[i] = state, attempt
                attempt += resets[i * sets + state]
                state = after[i * sets + state]
            states.append(row_states)
            bases.append(row_bases)
            totals.append(attempt)
        return {"_states": states, "_bases": bases, "_total": totals}

    carried = map_arrays(chained, chain, ("_chunks", "_after", "_resets"), "_states array<int>, _bases array<int>, _total int",
                         (*keys, "_chunks"), ragged=True)
    carried = carried.select(*keys, "_total", F.explode(F.arrays_zip("_chunks", "_states", "_bases")).alias("_c")).select(
        *keys, "_total", F.col("_c._chunks").alias("_chunk"), F.col("_c._states").alias("_state"), F.col("_c._bases").alias("_base"))

    def assign(block):
        out = []
        for codes, state, base in zip(block["_codes"], block["_state"], block["_base"]):
            step = np.zeros(len(codes), dtype=int)
            step[_Range(codes).starts(int(state))] = 1
            out.append(base + np.cumsum(step))
        return {"attempt": out}

    # a left join keeps both uses of the ranges alike, so that their shuffle is reused
    placed = map_arrays(ranges.join(carried, group, "left"), assign, ("_codes", "_state", "_base"), "attempt array<int>",
                        (*keys, "_lines", "_total"), ragged=True)
    rows = placed.select(*keys, "_total", F.explode(F.arrays_zip("_lines", "attempt")).alias("_r"))
    named = {c: F.col(c) for c in keys} | {metric: F.element_at(names, F.col("_r._lines._code") + 1)}
    return rows.select(*[(named[c] if c in named else F.col(f"_r._lines.{c}")).alias(c) for c in metrics.columns],
                       F.col("_r.attempt").alias("attempt"), F.col("_total").alias("attempts"))


def last_attempts(numbered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with the metrics of its last attempt, missing ones NULL."""
    return numbered.where(F.col("attempt") == F.col("attempts")).groupBy(*keys).agg(
        F.max("attempts").alias("attempts"), *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in METRICS])


def failed_attempts(numbered: DataFrame) -> DataFrame:
    """Metrics of every attempt that a later attempt replaced."""
    return numbered.where(F.col("attempt") < F.col("attempts")).drop("attempts")


def timing_summary(timing: DataFrame, keys: Sequence[str], time: str = "time_recon") -> DataFrame:
    t = F.col(time)
    return timing.groupBy(*keys).agg(
        F.count(t).alias("slices"), F.avg(t).alias("mean_time"), F.sum(t).alias("total_time"),
        F.min(F.nullif(t, F.lit(0.0))).alias("shortest"), F.max(t).alias("longest"),
        F.sum(F.col("attempts") - 1).alias("restarts"))


def core_counts() -> Column:
    """Both lists and all their pair sums, distinct and sorted."""
    pairs = F.flatten(F.transform(F.array(*[F.lit(c) for c in CORES_A]), lambda a: F.transform(
        F.array(*[F.lit(c) for c in CORES_B]), lambda b: a + b)))
    singles = F.array(*[F.lit(c) for c in CORES_A + CORES_B])
    return F.array_sort(F.array_distinct(F.concat(singles, pairs)))


def work_estimate(summary: DataFrame, keys: Sequence[str], slice_count: str) -> DataFrame:
    """Shortest and longest volume time for each core count, as ``HH:MM:SS.FFF``."""
    grid = summary.withColumn("cores", F.explode(core_counts()))
    at = lambda t: text.duration(F.col(slice_count) * F.col(t) / F.col("cores"))
    return grid.select(*keys, "cores", at("shortest").alias("min_time"), at("longest").alias("max_time"))


def convergence(objective: DataFrame, keys: Sequence[str], order: str, value: str, width: int = 10,
                chunk: int = skew.CHUNK) -> DataFrame:
    """Moving mean of the objective over its first value, with first and second difference.

    A first value of 0 gives infinity or NaN, as floating point does, and no NULL.
    """
    placed = skew.with_position(objective, keys, order, "k", first_of=value, chunk=chunk)
    first = F.col(f"first_{value}")
    placed = placed.withColumn("_f", F.when(first == 0, F.col(value) * float("inf")).otherwise(F.try_divide(F.col(value), first)))

    def build(w):
        mean = F.avg("_f").over(w.rowsBetween(1 - width, 0))
        known = F.col("k") >= width - 1
        return {
            "mean_window": F.when(known, mean),
            "delta": F.when(F.col("k") >= width, F.col("mean_window") - F.lag("mean_window").over(w)),
            "metric": F.when(F.col("k") >= width + 1, F.col("mean_window") - 2 * F.lag("mean_window").over(w)
                             + F.lag("mean_window", 2).over(w)),
        }

    return skew.over_recent(placed, keys, "k", width + 2, build, chunk).drop("_f", f"first_{value}")


def iteration_stats(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    v = F.col(value)
    return rows.groupBy(*keys).agg(F.count(v).alias("n"), F.avg(v).alias("mean_iterations"), F.min(v).alias("min_iterations"),
                                   F.max(v).alias("max_iterations"), F.stddev_samp(v).alias("std_iterations"))


# ---------------------------------------------------------------- stages and progress


def volume_stage(facts: DataFrame) -> DataFrame:
    """Stage 0..6 and progress points of each volume from its facts."""
    c, p = F.col, POINTS
    done = c("tag_sent") & (c("header_bytes") > COMPLETE_HEADER_BYTES)
    imaged = (c("image_count") > 0) & c("has_header")
    fraction = F.when(c("state_exists"), F.coalesce(F.try_divide(c("slices_left"), c("slices")), F.lit(0.0))).otherwise(1.0)
    slicing = fraction > 0
    setup = ~c("workspace_ok") | ~c("state_exists")
    extract = c("file_bytes") <= 60
    waiting = F.coalesce((c("source_class") == 2) & ~c("source_ready"), F.lit(True))
    stage = (F.when(done, 6).when(imaged, 5).when(~slicing, 4).when(~setup, 3).when(~extract, 2)
             .when(~waiting, 1).otherwise(0))
    lost = lambda test, points: F.when(test, points).otherwise(0.0)
    sending = p["tag"] + lost(~c("images_sent"), p["images"]) + lost(~c("header_sent"), p["header"])
    making = p["cleanup"] + p["slices"] * fraction
    early = lost(slicing & setup & extract, p["extract"]) + lost(slicing & setup & extract & waiting, p["acquire"])
    left = F.when(done, 0.0).when(imaged, sending).otherwise(sending + making + early)
    return facts.withColumns({"stage": stage, "progress": 100.0 - left})


def run_progress(staged: DataFrame, run: str) -> DataFrame:
    """Floored mean of the asked volumes; points are summed as whole thousandths."""
    total = F.sum(F.round(F.col("progress") * 1000).cast("bigint"))
    return staged.groupBy(run).agg(
        F.count(F.lit(1)).alias("volumes"), F.count_if(F.col("stage") == 6).alias("done"),
        F.floor(total / (F.count(F.lit(1)) * 1000)).alias("total_progress"))


def started(state: DataFrame, cleaned: DataFrame, on: Sequence[str]) -> DataFrame:
    return state.select(*on).union(cleaned.select(*on)).distinct()


def unfinished(volumes: DataFrame, finished: DataFrame, on: Sequence[str]) -> DataFrame:
    return volumes.join(finished.select(*on), list(on), "left_anti")


def next_admitted(candidates: DataFrame, begun: DataFrame, queued: DataFrame, finished: DataFrame, run: str, volume: str,
                  limit: int, skipped: int = 0) -> DataFrame:
    """In-flight count per run and the next volume to start while it is under the limit."""
    facts = {"_c": candidates, "_s": begun, "_q": queued, "_f": finished}
    tagged = [df.select(run, volume, *[F.lit(n == name).alias(n) for n in facts]) for name, df in facts.items()]
    marked = reduce(DataFrame.union, tagged).groupBy(run, volume).agg(*[F.bool_or(n).alias(n) for n in facts]).where("_c")
    s, q, f = F.col("_s"), F.col("_q"), F.col("_f")
    flight = F.count_if(s) - F.count_if(s & f) + F.count_if(~s & q)
    free = F.min(F.when(~s & ~q & (F.col(volume) >= skipped), F.col(volume)))
    counted = marked.groupBy(run).agg(flight.alias("in_progress"), free.alias("_next"))
    return counted.select(run, "in_progress", F.when(F.col("in_progress") < limit, F.col("_next")).alias("next_volume"))


def reconcile(active: DataFrame, watched: DataFrame, run: str) -> DataFrame:
    """Watch list against active runs: add, keep or remove."""
    a = active.select(run).distinct().withColumn("_a", F.lit(True))
    w = watched.select(run).distinct().withColumn("_w", F.lit(True))
    return a.join(w, run, "full_outer").select(
        run, F.when(F.col("_w").isNull(), "add").when(F.col("_a").isNull(), "remove").otherwise("keep").alias("action"))


def newest(rows: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The newest row per key as an aggregate, so a hot key is combined map-side."""
    return rows.groupBy(*keys).agg(F.max(F.struct(*order, *values)).alias("_n")).select(
        *keys, *[F.col(f"_n.{c}").alias(c) for c in (*order, *values)])


def unhealthy(jobs: DataFrame, run: str, state: str) -> DataFrame:
    """Runs with queued jobs and none running."""
    counts = jobs.groupBy(run).agg(F.count_if(F.col(state) == "PENDING").alias("queued"),
                                   F.count_if(F.col(state) == "RUNNING").alias("running"))
    return counts.where((F.col("queued") > 0) & (F.col("running") == 0))


def low_capacity(free_bytes: Column, floor_gib: int = 2) -> tuple[Column, Column]:
    gib = F.floor(free_bytes / 1024 ** 3)
    return gib, gib < floor_gib


def chunks(rows: DataFrame, keys: Sequence[str], order: str, size: int) -> DataFrame:
    """Fixed-size chunk number within a key, ordered by an integer."""
    placed = skew.with_position(rows, keys, order, "_k")
    return placed.withColumn("chunk", F.floor(F.col("_k") / size)).drop("_k")


def chunk_text(chunked: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Range text of each chunk; a chunk has a fixed size, so the list is short."""
    numbers = F.array_sort(F.collect_list(order))
    return chunked.groupBy(*keys, "chunk").agg(
        F.count(F.lit(1)).alias("n"), ((F.max(order) - F.min(order) + 1) == F.count(F.lit(1))).alias("contiguous"),
        text.compact_ranges(numbers).alias("range_text"))


# ---------------------------------------------------------------- housekeeping


def purge_plan(volumes: DataFrame) -> DataFrame:
    """Work may go once the header is complete and nobody asked to keep it."""
    ready = (F.col("header_bytes") > COMPLETE_HEADER_BYTES) & ~F.col("keep_work")
    return volumes.withColumn("action", F.when(ready & F.col("has_work"), "purge").when(ready, "already_gone").otherwise("keep"))


def export_gate(counts: DataFrame) -> DataFrame:
    full = F.col("image_count") >= F.col("expected")
    space = F.col("free_bytes") >= F.col("needed_bytes")
    return counts.withColumn("gate", F.when(full & space, "send").when(full, "no_space").otherwise("incomplete"))


def common_prefix(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Longest prefix shared by all names of a key: that of the first and last in order."""
    low, high = F.col("_lo"), F.col("_hi")
    ends = rows.groupBy(*keys).agg(F.min(name).alias("_lo"), F.max(name).alias("_hi"), F.count(F.lit(1)).alias("members"))
    at = F.filter(F.sequence(F.lit(1), F.least(F.length(low), F.length(high))),
                  lambda i: F.substr(low, i, F.lit(1)) != F.substr(high, i, F.lit(1)))
    size = F.coalesce(F.get(at, 0) - 1, F.least(F.length(low), F.length(high)))
    return ends.select(*keys, "members", F.substr(low, F.lit(1), size).alias("prefix"))


def manifest(volumes: DataFrame, group: str, order: str, space: Column, slices: Column, project: Column, image_format: Column,
             person: Column, creator: str) -> DataFrame:
    """Numbered manifest lines per group: one per volume, then two comment lines."""
    line = F.concat_ws(",", F.col("run"), space, slices.cast("string"), project, image_format)
    body = skew.with_position(volumes.withColumn("line", line), [group], order, "line_no").select(group, "line_no", "line")
    tail = volumes.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.max(person).alias("_p")).select(
        group, F.posexplode(F.array(F.concat(F.lit("# recon_person="), F.col("_p")),
                                    F.lit(f"# tag_file_creator={creator}"))).alias("_i", "line"), "_n")
    return body.unionByName(tail.select(group, (F.col("_n") + F.col("_i")).alias("line_no"), "line"))


def fan_out(messages: DataFrame, targets: str, message: str, is_error: str) -> DataFrame:
    """One row per message and target, errors carrying their prefix."""
    return messages.select(
        "*", F.explode(F.split(targets, ",")).alias("target"),
        text.with_severity(F.col(message), F.col(is_error)).alias("logged")).drop(targets)


# ---------------------------------------------------------------- queue


def queue_jobs(lines: DataFrame, line: str = "line") -> DataFrame:
    """Whitespace table of the queue: id, partition, name, user, state."""
    parts = F.split(F.trim(line), r"\s+")
    return lines.select("*", F.get(parts, 0).cast("bigint").alias("job_id"), *[
        F.get(parts, i).alias(n) for i, n in enumerate(("partition", "name", "user", "state"), 1)])


def jobs_of(jobs: DataFrame, pattern: str, state: str | None = None) -> DataFrame:
    """Jobs whose name matches a pattern, any case; optionally in one state."""
    hit = jobs.where(F.lower("name").rlike(pattern.lower()))
    return hit.where(F.col("state") == state) if state else hit


def to_cancel(jobs: DataFrame, pattern: str) -> DataFrame:
    return jobs_of(jobs, pattern).where(F.col("state") != "RUNNING")


def job_lists(state: str = "state") -> Column:
    """Names of the lists a job is on: one scan answers all of them."""
    c = F.col(state)
    names = F.array(F.lit("all"), F.when(c == "PENDING", "pending"), F.when(c == "RUNNING", "running"), F.when(c != "RUNNING", "cancel"))
    return F.filter(names, lambda n: n.isNotNull())


def active_runs(lines: DataFrame, line: str = "line", pattern: str = r"([A-Z][0-9]{5,6})") -> DataFrame:
    """Distinct run ids, the first one on each queue line."""
    run = F.regexp_extract(line, pattern, 1)
    return lines.select(run.alias("run")).where(F.col("run") != "").distinct()


def job_logs(jobs: DataFrame, logs: DataFrame, user: str | None = None, partition: str | None = None,
             pattern: str | None = None) -> DataFrame:
    """Log files of the jobs that pass all given filters."""
    for column, rule in (("user", user), ("partition", partition), ("name", pattern)):
        jobs = jobs.where(F.col(column).rlike(rule)) if rule else jobs
    return jobs.join(logs, "job_id")
