from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from lacuna.streaming import admission


def frame(spark, rows):
    return spark.createDataFrame(rows, "run long, volume long")


def flight(log):
    return sorted((r.run, r.volume) for r in admission.in_flight(log.read()).collect())


def pairs(df):
    return sorted((r.run, r.volume) for r in df.collect())


def test_places_are_filled_in_order_as_volumes_finish(spark, tmp_path):
    log = admission.admissions(spark, str(tmp_path / "log"))
    requests = frame(spark, [(r, v) for r in (1, 2) for v in (7, 3, 5, 9, 3)] + [(3, 1)])
    assert pairs(admission.admit(requests, None, log, 2, 1)) == [(1, 3), (1, 5), (2, 3), (2, 5), (3, 1)]
    assert pairs(admission.admit(requests, None, log, 2, 2)) == []
    # 9 was never admitted, so its finish frees nothing
    assert pairs(admission.admit(requests, frame(spark, [(1, 5), (1, 9), (3, 1)]), log, 2, 3)) == [(1, 7)]
    assert flight(log) == [(1, 3), (1, 7), (2, 3), (2, 5)]
    # the same step once more, as after a lost driver
    assert pairs(admission.admit(requests, frame(spark, [(1, 5), (1, 9), (3, 1)]), log, 2, 3)) == [(1, 7)]
    assert flight(log) == [(1, 3), (1, 7), (2, 3), (2, 5)]


def test_racing_admitters_keep_the_limit(spark, tmp_path):
    path = str(tmp_path / "log")
    requests = frame(spark, [(1, v) for v in range(50)])
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: pairs(admission.admit(requests, None, admission.admissions(spark, path), 5, i)), range(1, 5)))
    assert sorted(sum(got, [])) == [(1, v) for v in range(5)]
    assert flight(admission.admissions(spark, path)) == [(1, v) for v in range(5)]


def test_a_stream_of_finishes_over_restarts(spark, tmp_path):
    log = admission.admissions(spark, str(tmp_path / "log"))
    requests = frame(spark, [(r, v) for r in (1, 2) for v in range(r * 6)])
    stream = spark.readStream.schema("run long, volume long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "part*"))
    for i, rows in enumerate([[(1, 0), (2, 1)], [(2, 0), (2, 2)], [(1, 1), (1, 2), (2, 9)]]):
        frame(spark, rows).coalesce(1).write.parquet(str(tmp_path / "in" / f"part{i}"))
        if i != 1:  # two files wait when the stream comes back
            admission.admit_stream(requests, stream, log, 3, str(tmp_path / "cp"))
    rows = admission.load(log.read()).collect()
    assert max(r.in_flight for r in rows) == 3
    assert sorted((r.trigger, r.run, r.admitted, r.finished) for r in rows) == [
        (1, 1, 3, 0), (1, 2, 3, 0), (2, 1, 1, 1), (2, 2, 1, 1), (3, 2, 2, 2), (4, 1, 2, 2)]
    assert flight(log) == [(1, 3), (1, 4), (1, 5), (2, 3), (2, 4), (2, 5)]


def test_counts_finish_the_oldest(spark, tmp_path):
    log = admission.admissions(spark, str(tmp_path / "log"))
    requests = frame(spark, [(1, v) for v in (9, 4, 2, 8)])
    frame(spark, [(1, 0)]).coalesce(1).select("run").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("run long").parquet(str(tmp_path / "in"))
    admission.admit_stream(requests, stream.withColumn("n", F.lit(2)), log, 3, str(tmp_path / "cp"))
    assert flight(log) == [(1, 8), (1, 9)]
