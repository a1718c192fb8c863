import pytest
from pyspark.sql import functions as F

from lacuna.sources import sinks as out
from lacuna.streaming import sinks, status


def write_files(spark, folder, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/part{i}")


def stream(spark, folder, schema, per_trigger=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(f"{folder}/part*")


def test_each_volume_is_written_once(spark, tmp_path):
    schema = "volume int, v int"
    write_files(spark, tmp_path / "in", [[(1, 1), (2, 2)], [(2, 9), (3, 3)]], schema)
    path, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    sinks.run_available(stream(spark, tmp_path / "in", schema), cp, sinks.once_per_key(path, ["volume"]))
    got = sorted((r["volume"], r["v"]) for r in spark.read.parquet(path).collect())
    assert len(got) == 3 and [v for v, _ in got] == [1, 2, 3]
    # a new file after a restart only adds what is new
    write_files(spark, tmp_path / "in2", [[(3, 7), (4, 4)]], schema)
    spark.read.parquet(str(tmp_path / "in2" / "part0")).write.parquet(str(tmp_path / "in" / "part9"))
    sinks.run_available(stream(spark, tmp_path / "in", schema), cp, sinks.once_per_key(path, ["volume"]))
    assert sorted(r["volume"] for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4]


def test_replayed_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "out")
    write = sinks.once_per_key(path, ["volume"])
    batch = spark.createDataFrame([(1,), (2,)], "volume int")
    write(batch, 0)
    write(batch, 0)
    write(spark.createDataFrame([(2,), (3,)], "volume int"), 1)
    assert sorted((r["batch_id"], r["volume"]) for r in spark.read.parquet(path).collect()) == [(0, 1), (0, 2), (1, 3)]


def test_only_changes_are_published(spark, tmp_path):
    path = str(tmp_path / "out")
    write = sinks.changed_only(path, ["run"], ["total"])
    frame = lambda rows: spark.createDataFrame(rows, "run string, total int")
    write(frame([("a", 10), ("b", 5)]), 0)
    write(frame([("a", 10), ("b", 6)]), 1)
    write(frame([("a", 11), ("b", 6), ("c", None)]), 2)
    rows = sorted((r["batch_id"], r["run"]) for r in spark.read.parquet(path).collect())
    assert rows == [(0, "a"), (0, "b"), (1, "b"), (2, "a"), (2, "c")]
    last = {r["run"]: r["total"] for r in sinks.newest_batch(spark, path, ["run"]).collect()}
    assert last == {"a": 11, "b": 6, "c": None}


def test_latest_stage_over_several_triggers(spark, tmp_path):
    schema = "volume int, stage int, ts timestamp"
    ts = lambda m: f"2024-01-01 00:{m:02d}:00"
    rows = [[(1, 0, ts(1)), (2, 0, ts(1))], [(1, 3, ts(5)), (2, 0, ts(6))], [(1, 2, ts(4))]]
    frames = [[(v, s, t) for v, s, t in b] for b in rows]
    for i, b in enumerate(frames):
        spark.createDataFrame(b, "volume int, stage int, t string").select("volume", "stage", F.col("t").cast("timestamp").alias("ts")) \
            .coalesce(1).write.parquet(str(tmp_path / "in" / f"part{i}"))
    path = str(tmp_path / "out")
    sinks.run_available(status.latest_stage(stream(spark, tmp_path / "in", schema), ["volume"]), str(tmp_path / "cp"),
                        sinks.changed_only(path, ["volume"], ["stage"]), "update")
    assert {r["volume"]: r["stage"] for r in sinks.newest_batch(spark, path, ["volume"]).collect()} == {1: 3, 2: 0}
    assert spark.read.parquet(path).count() == 3  # two first stages and one change


def test_publish_once_and_images(spark, tmp_path):
    scale = lambda v: spark.createDataFrame([(v,)], "scale double")
    out.publish_once(scale(2.0), str(tmp_path / "scale"))
    out.publish_once(scale(9.0), str(tmp_path / "scale"))
    value = spark.range(1).select(out.read_published(spark, str(tmp_path / "scale")).alias("s")).first()["s"]
    assert value == 2.0
    images = spark.createDataFrame([(1, 0, [1, 2]), (2, 0, [3])], "volume int, slice int, value array<int>")
    out.write_images(images, str(tmp_path / "img"))
    out.write_images(images.where("volume = 2").withColumn("slice", F.lit(5)), str(tmp_path / "img"))
    assert sorted((r["volume"], r["slice"]) for r in spark.read.parquet(str(tmp_path / "img")).collect()) == [(1, 0), (2, 5)]


def test_complex_round_trip_and_text_outputs(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, [0.5, 1.0], [0.25, -2.0])], "volume int, slice int, re array<double>, im array<double>")
    out.write_complex(df, str(tmp_path / "c"))
    row = out.read_complex(spark, str(tmp_path / "c")).first()
    assert (row["re"], row["im"], row["volume"]) == ([0.5, 1.0], [0.25, -2.0], 1)
    timing = spark.createDataFrame([(1, 5.4, None)], "slice int, time_load double, time_recon double")
    out.write_timing(timing, str(tmp_path / "t"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "t")).collect()]
    assert "slice\ttime_load\ttime_recon" in lines and "1\t5.4\t" in lines
    manifest = spark.createDataFrame([("a", 1, "second"), ("a", 0, "first"), ("b", 0, "x")], "g string, line_no int, line string")
    out.write_manifest(manifest, str(tmp_path / "m"), "g")
    assert [r[0] for r in spark.read.text(str(tmp_path / "m" / "g=a")).collect()] == ["first", "second"]
    logs = spark.createDataFrame([("x", "t1"), ("y", "t2")], "logged string, target string")
    out.append_log(logs, str(tmp_path / "l"))
    out.append_log(logs, str(tmp_path / "l"))
    assert spark.read.json(str(tmp_path / "l")).count() == 4


@pytest.mark.parametrize("name", ["stream_volumes", "stream_latest_stage", "stream_wait", "stream_late_parameters", "stream_stalls"])
def test_any_cut_into_files_gives_the_same_rows(spark, tmp_path, monkeypatch, name):
    """The same events in 1, 2 and 7 files, one a trigger."""
    from lacuna.plans import catalog, streams

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").orderBy("ts").toPandas()
    schema = spark.read.parquet("/root/testdata/sf0.001/events.parquet").schema

    def stream_of(folder):
        def made(session, _):
            rows = session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/events*.parquet")
            return rows.withColumn("ts", F.col("ts").cast("timestamp"))
        return made

    answers = []
    for parts in (1, 2, 7):
        folder = tmp_path / f"cut{parts}"
        size = -(-len(events) // parts)
        for i in range(parts):
            rows = events.iloc[i * size:(i + 1) * size]
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/events{i}.parquet")
        monkeypatch.setattr(streams, "event_stream", stream_of(folder))
        df = catalog.QUERIES[name](spark, str(folder))
        answers.append(sorted(map(str, df.select(sorted(df.columns)).collect())))
    assert answers[0] == answers[1] == answers[2] and answers[0]


def test_latest_values_stay_as_large_as_their_keys(spark, tmp_path):
    table = sinks.LatestValues(spark, str(tmp_path / "t"), "run string, part int, total int, note string", ["run", "part"], most=2)
    frame = lambda rows: spark.createDataFrame(rows, "run string, part int, total int, note string")
    table.write(frame([("a", 1, 10, None), ("a", 2, 5, "x"), (None, None, 1, "n")]), 0)
    want = {("a", 1): (10, None), ("a", 2): (5, "x"), (None, None): (1, "n")}
    for i in range(1, 9):
        rows = [("a", 1, 10, None), ("a", 2, i, "x"), ("b", i % 2, i, None)]
        table.write(frame(rows), i)
        table.write(frame(rows), i)  # the batch runs again
        want |= {("a", 2): (i, "x"), ("b", i % 2): (i, None)}
        parts = table.log.snapshot().parts
        assert len(parts) <= 3 and parts[-1].rows == 2  # what did not change is not published again
    assert {(r.run, r.part): (r.total, r.note) for r in table.read().collect()} == want
