import random

import pytest
from pyspark.sql import functions as F

from lacuna.streaming import gate, sinks

SCHEMA = "kind string, source long, run long, volume long, ts timestamp"
LIMIT = 3600


def events(seed, n=400):
    """(kind, source, run, volume, seconds) at distinct whole seconds; one waiter twice."""
    rng = random.Random(seed)
    rows = [(rng.choice([gate.WAIT, gate.WAIT, gate.READY, gate.ACQUIRED]), rng.randrange(3), rng.randrange(6), rng.randrange(2), t)
            for t in rng.sample(range(40_000), n)]
    waiter = next(r for r in rows if r[0] == gate.WAIT)
    return [*rows, waiter]


def plain(rows, now):
    out = set()
    for _, source, run, volume, t in (r for r in rows if r[0] == gate.WAIT):
        near = [r for r in rows if r[1] == source and t <= r[4] <= t + LIMIT]
        found = [(t + LIMIT, 2, "timeout", None)]
        found += [(r[4], 0, "ready", None) for r in near if r[0] == gate.READY and r[2:4] == (run, volume)]
        found += [(r[4], 1, "released", r[2]) for r in near if r[0] == gate.ACQUIRED and r[2] > run]
        when, _, outcome, newer = min(found, key=lambda f: f[:2])
        if when <= now:
            out.add((source, run, volume, t, when, outcome, newer))
    return out


def feed(spark, rows, path):
    rows = [(k, s, r, v if k != gate.ACQUIRED else None, t) for k, s, r, v, t in rows]
    df = spark.createDataFrame(rows, SCHEMA.replace("ts timestamp", "t long"))
    df.withColumn("ts", F.timestamp_seconds("t")).drop("t").coalesce(1).write.parquet(path)


def run(spark, folder, out, checkpoint, shares=1):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part*")
    sinks.run_available(gate.gate(stream, "1 HOUR", shares=shares), checkpoint, sinks.grown(out))
    rows = spark.read.option("basePath", out).parquet(out).select(
        "source", "run", "volume", F.unix_seconds("ts"), F.unix_seconds("decided_ts"), "outcome", "newer_run").collect()
    assert len(rows) == len(set(rows))
    return set(map(tuple, rows))


@pytest.mark.parametrize("files, shares", [(1, 1), (5, 1), (5, 3)])
def test_same_answers_however_the_input_is_cut(spark, tmp_path, files, shares):
    rows = sorted(events(1), key=lambda r: r[4])
    for i in range(files):
        part = rows[i * len(rows) // files:(i + 1) * len(rows) // files]
        random.Random(i).shuffle(part)
        feed(spark, part, str(tmp_path / "in" / f"part{i}"))
    want = plain(rows, max(r[4] for r in rows) - 600)
    assert {o for *_, o, _ in want} == {"ready", "released", "timeout"}
    assert run(spark, tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp"), shares) == want


def test_a_restart_goes_on_with_the_open_waiters(spark, tmp_path):
    rows = sorted(events(2), key=lambda r: r[4])
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for i in range(3):
        feed(spark, rows[i * len(rows) // 3:(i + 1) * len(rows) // 3], str(tmp_path / "in" / f"part{i}"))
        found = run(spark, tmp_path / "in", out, checkpoint)
    assert found == plain(rows, max(r[4] for r in rows) - 600)


@pytest.mark.parametrize("seed", range(20))
def test_decisions_match_a_plain_search(seed):
    rows = events(seed, 150)
    now = random.Random(seed).randrange(20_000, 45_000)
    got = set()
    for source in range(3):
        mine = [r for r in rows if r[1] == source]
        waits = {(t, run, volume) for k, _, run, volume, t in mine if k == gate.WAIT}
        signals = [(t, k, run, volume) for k, _, run, volume, t in mine if k != gate.WAIT and t <= now]
        got |= {(source, w[1], w[2], w[0], us, outcome, newer) for w, us, outcome, newer in gate.decide(list(waits), signals, LIMIT, now)}
    assert got == plain(rows, now)


def test_nothing_and_only_signals(spark, tmp_path):
    feed(spark, [(gate.READY, 1, 1, 0, 50), (gate.ACQUIRED, 1, 2, 0, 60)], str(tmp_path / "in" / "part0"))
    assert run(spark, tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")) == set()
