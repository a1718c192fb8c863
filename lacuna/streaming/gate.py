"""Waiters held at a gate until their data is ready, a newer run of the source supersedes them, or time is up.

Keyed state with event-time timers.  Events wait in the state of their source until the
watermark has passed them, then they are looked at in order of time, so no answer depends
on how the input is cut into batches or in which order rows of a batch come.  A newer run
releases every waiter of its source in one pass over the waiters; nothing is joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

WAIT, READY, ACQUIRED = "wait", "ready", "acquired"

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

ANSWER = "source bigint, run bigint, volume bigint, ts_us bigint, decided_us bigint, outcome string, newer_run bigint"


def event(kind: str | Column, source: Column, run: Column, ts: Column, volume: Column | None = None) -> list[Column]:
    """The columns of a gate event; an acquisition has no volume."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return [kind.alias("kind"), source.cast("bigint").alias("source"), run.cast("bigint").alias("run"),
            (F.lit(None) if volume is None else volume).cast("bigint").alias("volume"), ts.alias("ts")]


def decide(waits: list[tuple], signals: list[tuple], limit: int, now: int) -> list[tuple]:
    """(waiter, decided, outcome, newer run) of what is settled by ``now``.

    ``waits`` are (time, run, volume) and ``signals`` (time, kind, run, volume).  Signals
    go by in order of time, once; a heap by run gives those that a newer run releases.
    """
    waits = sorted(waits)
    by_run: list[tuple] = []
    by_name: dict[tuple, list[tuple]] = {}
    answers: dict[tuple, tuple] = {}
    entered = 0
    # at one time data comes before a newer run, and the newest run first
    for us, kind, run, volume in sorted(signals, key=lambda s: (s[0], s[1] != READY, -s[2])):
        while entered < len(waits) and waits[entered][0] <= us:
            w = waits[entered]
            heappush(by_run, (w[1], w))
            by_name.setdefault(w[1:], []).append(w)
            entered += 1
        if kind == READY:
            met = by_name.pop((run, volume), [])
        else:
            met = []
            while by_run and by_run[0][0] < run:
                met.append(heappop(by_run)[1])
        for w in met:  # whoever is past the limit here is so for all later signals
            if w not in answers and us <= w[0] + limit:
                answers[w] = (us, "ready", None) if kind == READY else (us, "released", run)
    for w in waits:
        if w not in answers and w[0] + limit <= now:
            answers[w] = w[0] + limit, "timeout", None
    return [(w, *answer) for w, answer in answers.items()]


class Gate(StatefulProcessor):
    """Pending waiters and signals of one source, or of one of its shares."""

    def __init__(self, limit_us: int) -> None:
        self.limit = limit_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waits = handle.getListState("waits", "us bigint, run bigint, volume bigint")
        self.signals = handle.getListState("signals", "us bigint, kind string, run bigint, volume bigint")
        self.timer = handle.getValueState("timer", "ms bigint")

    def _wake(self, us: int | None) -> None:
        """One timer a key: the earliest time at which something is decided."""
        held = self.timer.get()[0] if self.timer.exists() else None
        ms = None if us is None else -(-us // 1000)
        if held is not None and (ms is None or ms < held):
            self.handle.deleteTimer(held)
        if ms is None:
            self.timer.clear()
        elif held is None or ms < held:
            self.handle.registerTimer(ms)
            self.timer.update((ms,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        waits, signals = set(), []
        for frame in rows:
            for kind, run, volume, us in zip(frame["kind"], frame["run"], frame["volume"], frame["us"], strict=True):
                volume = -1 if pd.isna(volume) else int(volume)
                if kind == WAIT:
                    waits.add((int(us), int(run), volume))
                else:
                    signals.append((int(us), kind, int(run), volume))
        if waits:
            self.waits.appendList(sorted(waits))
        if signals:
            self.signals.appendList(signals)
        due = [s[0] for s in signals] + [w[0] + self.limit for w in waits]
        if due:
            self._wake(min(due))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        """Decide everything up to the watermark, in order of time."""
        now = timerValues.getCurrentWatermarkInMs() * 1000
        self.timer.clear()
        waits = sorted({tuple(w) for w in self.waits.get()}) if self.waits.exists() else []
        signals = [tuple(s) for s in self.signals.get()] if self.signals.exists() else []
        later = [s for s in signals if s[0] > now]
        answers = decide(waits, [s for s in signals if s[0] <= now], self.limit, now)
        done = {w for w, *_ in answers}
        waits = [w for w in waits if w not in done]
        for state, rows in ((self.waits, waits), (self.signals, later)):
            if rows:
                state.put(rows)
            else:
                state.clear()
        self._wake(min([s[0] for s in later] + [w[0] + self.limit for w in waits], default=None))
        if answers:
            frame = pd.DataFrame([(key[0], w[1], w[2], w[0], us, outcome, newer) for w, us, outcome, newer in answers],
                                 columns=["source", "run", "volume", "ts_us", "decided_us", "outcome", "newer_run"])
            frame["newer_run"] = frame["newer_run"].astype("Int64")
            yield frame

    def close(self) -> None:
        pass


def gate(events: DataFrame, limit: str, *, delay: str = "10 minutes", shares: int = 1) -> DataFrame:
    """Every waiter once: (source, run, volume, ts, decided_ts, outcome, newer_run).

    ``events`` has the columns of ``event``.  A waiter is ``ready`` at the first ready event
    of its run and volume, ``released`` at the first acquisition of a higher run of its
    source, and a ``timeout`` after ``limit``, whichever is first from its own time on.
    Equal waiters count once; the answer comes once the watermark passes the decision.
    ``shares`` deals the waiters of one source to so many tasks; acquisitions, which are
    few, go to all of them.  The state of a share is its open waiters.
    """
    # keyed state with timers exists in this store only
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    span = events.sparkSession.range(1).select(
        F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {limit}"))).first()[0]
    mine = F.array(F.pmod(F.xxhash64("run", "volume"), F.lit(shares)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(shares - 1))
    keyed = (events.withWatermark("ts", delay).withColumn("us", F.unix_micros("ts"))
             .withColumn("share", F.explode(F.when(F.col("kind") == ACQUIRED, every).otherwise(mine))))
    found = keyed.groupBy("source", "share").transformWithStateInPandas(
        statefulProcessor=Gate(span), outputStructType=ANSWER, outputMode="append", timeMode="EventTime")
    return found.select("source", "run", "volume", F.timestamp_micros("ts_us").alias("ts"),
                        F.timestamp_micros("decided_us").alias("decided_ts"), "outcome", "newer_run")
