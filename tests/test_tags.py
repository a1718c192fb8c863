from concurrent.futures import ThreadPoolExecutor

import numpy as np
from blockfile import block_file
from pyspark.sql import functions as F

from lacuna.sources import blocks, tags


def volumes(spark, folder):
    blocks.register(spark)
    rows = spark.read.format("lacuna_blocks").option("table", "tag").load(str(folder))
    return rows.select(F.regexp_extract("path", r"([^/]+)\.fid$", 1).alias("run"), F.col("block").alias("volume"),
                       F.col("has_data").alias("ready"), "tag")


def statuses(df):
    return {(r.run, r.volume): r.tag_status for r in df.collect()}


def test_tags_are_the_bytes_of_the_file(spark, tmp_path):
    rng = np.random.default_rng(6)
    folder = tmp_path / "files"
    folder.mkdir()
    samples = lambda: rng.normal(size=(2, 4, 8)) + 1j * rng.normal(size=(2, 4, 8))
    for name, ready in (("a", [True, True]), ("b", [False, True])):
        block_file(folder / f"{name}.fid", samples(), ready=ready)
    found = volumes(spark, folder)
    data = (folder / "a.fid").read_bytes()
    size = int.from_bytes(data[20:24], "big")
    got = {(r.run, r.volume): bytes(r.tag) for r in found.collect()}
    assert got["a", 1] == data[:100] and got["a", 2] == data[:32] + data[32 + size:32 + size + 68]

    store = str(tmp_path / "tags")
    assert statuses(tags.check_tags(found, store)) == {
        ("a", 1): "written", ("a", 2): "mismatch", ("b", 1): "not_ready", ("b", 2): "no_tag"}
    raw = bytearray(data)
    raw[27] ^= 0x40  # the file status changes when an acquisition ends
    (folder / "a.fid").write_bytes(bytes(raw))
    assert statuses(tags.check_tags(volumes(spark, folder), store))["a", 1] == "match"
    block_file(folder / "a.fid", samples())  # another acquisition under the same name
    assert statuses(tags.check_tags(volumes(spark, folder), store))["a", 1] == "mismatch"


def test_two_writers_at_a_time_keep_one_tag(spark, tmp_path):
    store = str(tmp_path / "tags")

    def check(i):
        rows = spark.createDataFrame([("r", 1, True, bytearray([i] * 100))], "run string, volume long, ready boolean, tag binary")
        return tags.check_tags(rows, store).first().tag_status

    with ThreadPoolExecutor(2) as pool:
        got = list(pool.map(check, (1, 2)))
    kept = tags.tag_log(spark, store).current().collect()
    assert len(kept) == 1 and "written" in got
    winner = kept[0].tag[0]
    assert check(winner) == "match" and check(3 - winner) == "mismatch"
