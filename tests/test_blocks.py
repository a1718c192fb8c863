import numpy as np
import pytest
from blockfile import block_file, set_ready
from pyspark.sql import functions as F

from lacuna.sources.blocks import BlockSource, Layout
from lacuna.streaming.volumes import growing_blocks, process_volumes

rng = np.random.default_rng(5)


@pytest.fixture(autouse=True)
def source(spark):
    spark.dataSource.register(BlockSource)


def data(blocks=4, traces=5, points=6):
    return np.round(rng.normal(size=(blocks, traces, points)) * 100) + 1j * np.round(rng.normal(size=(blocks, traces, points)) * 100)


def load(spark, path, **options):
    reader = spark.read.format("lacuna_blocks")
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load(str(path))


def as_dict(rows):
    return {(r["block"], r["trace"]): np.array(r["re"]) + 1j * np.array(r["im"]) for r in rows}


@pytest.mark.parametrize("kind", ["int16", "int32", "float32"])
@pytest.mark.parametrize("split", [37, 200, 1 << 20])
def test_every_trace_once_for_any_split(spark, tmp_path, kind, split):
    x = data()
    block_file(tmp_path / "a.fid", x, kind, ready=[True, True, True, False])
    rows = load(spark, tmp_path / "a.fid", partition_bytes=split, batch_bytes=64).collect()
    got = as_dict(rows)
    assert len(rows) == len(got) == 15
    assert all(np.array_equal(got[b, t], x[b - 1, t]) for b, t in got)


def test_headers(spark, tmp_path):
    block_file(tmp_path / "a.fid", data(), "int32", ready=[True, False, True, True])
    head = load(spark, tmp_path / "a.fid", table="file_header").first()
    assert (head["nblocks"], head["ntraces"], head["npoints"], head["version"], head["status"]) == (4, 5, 12, 7, 5)
    assert head["file_bytes"] == 32 + 4 * head["bytes_per_block"]
    blocks = load(spark, tmp_path / "a.fid", table="block_header", partition_bytes=100).orderBy("block").collect()
    assert [b["has_data"] for b in blocks] == [True, False, True, True]
    assert (blocks[0]["lpval"], blocks[0]["rpval"], blocks[0]["ctcount"]) == (0.5, -1.0, 3)


def test_block_filter_reads_only_those_bytes(spark, tmp_path):
    x = data(6)
    for name in ("a.fid", "b.fid"):
        block_file(tmp_path / name, x)
    df = load(spark, tmp_path, partition_bytes=1 << 20).where(F.col("block").isin(2, 5))
    assert df.rdd.getNumPartitions() == 4
    assert {(r["block"]) for r in df.collect()} == {2, 5} and df.count() == 20
    assert load(spark, str(tmp_path / "*.fid")).where("block = 9").count() == 0


def test_cut_file_gives_whole_blocks_only(spark, tmp_path):
    path = tmp_path / "a.fid"
    block_file(path, data())
    with open(path, "r+b") as f:
        f.truncate(path.stat().st_size - 10)
    assert load(spark, path).select("block").distinct().count() == 3


def test_layout_counts_traces_by_start():
    lay = Layout(3, 4, 8, 2, 16, 28 + 64, 1)
    starts = [lay.trace_start(b, t) for b in (1, 2, 3) for t in range(4)]
    for offset in range(0, 400):
        assert lay.first_at(offset) == sum(s < offset for s in starts)


def test_growing_file_equals_batch_over_restarts(spark, tmp_path):
    """Blocks appear between runs; each run resumes from its checkpoint."""
    x, path, out = data(5), tmp_path / "g.fid", str(tmp_path / "out")
    block_file(path, x, ready=[True, False, True, False, False])
    job = lambda rows: rows.groupBy("path", "block").agg(F.count("*").alias("traces"), F.sum(F.get("re", 0)).alias("s"))

    def run():
        process_volumes(growing_blocks(spark, str(path)), job, out, str(tmp_path / "cp")).awaitTermination()
        return {r["block"] for r in spark.read.parquet(out).collect()}

    assert run() == {1}
    set_ready(path, 2)
    assert run() == {1, 2, 3}
    set_ready(path, 5)
    assert run() == {1, 2, 3}
    set_ready(path, 4)
    assert run() == {1, 2, 3, 4, 5}
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 5 and all(r["traces"] == 5 and r["s"] == x[r["block"] - 1, :, 0].real.sum() for r in rows)


def test_admission_limit_holds_over_a_restart(spark, tmp_path):
    path, seen, cp = tmp_path / "g.fid", [], str(tmp_path / "cp")
    block_file(path, data(5))

    def run(blocks):
        block_file(path, data(9), ready=[True] * blocks + [False] * (9 - blocks))
        query = (growing_blocks(spark, str(path), max_blocks=2, checkpoint=cp).writeStream
                 .foreachBatch(lambda df, i: seen.append(sorted(r[0] for r in df.select("block").distinct().collect())))
                 .option("checkpointLocation", cp).start())
        query.processAllAvailable()
        query.stop()

    run(5)
    assert [s for s in seen if s] == [[1, 2], [3, 4], [5]]
    run(8)
    assert [s for s in seen if s][3:] == [[6, 7], [8]]
