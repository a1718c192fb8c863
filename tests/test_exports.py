import numpy as np
import pytest

from lacuna.operators import transforms as tf
from lacuna.sources import exports as ex

SHAPE = (4, 6, 8)


def slices(spark, volumes):
    rng = np.random.default_rng(4)
    rows = [(v, x, rng.normal(size=48).tolist(), rng.normal(size=48).tolist()) for v in volumes for x in range(4)]
    return spark.createDataFrame(rows, "volume int, x int, re array<double>, im array<double>")


def test_a_stopped_run_goes_on(spark, tmp_path):
    out, data = str(tmp_path / "out"), slices(spark, [1, 2, 3, 10])
    both = (ex.Reduction("two", 2.0), ex.Reduction("some", 1.3))
    assert {(r.name, r.volume) for r in ex.export_reductions(data, SHAPE, both, out, limit=2).collect()} == {
        (n, v) for n in ("two", "some") for v in (1, 2)}
    assert ex.write_reduction(data.where("volume = 3"), SHAPE, out, both[0]) == 2  # dies before the marker
    assert {r.volume for r in ex.read_reduction(spark, out, "two").collect()} == {1, 2}
    done = {(r.name, r.volume): r for r in ex.export_reductions(data, SHAPE, both, out).collect()}
    assert len(done) == 8 and done["some", 10].volume_id == "some_m10" and done["two", 3].volume_id == "two_m03"
    assert (done["some", 1].nx, done["some", 1].ny, done["some", 1].nz) == (3, 5, 6)
    assert {v: done["two", v].part for v in (1, 2, 3, 10)} == {1: 1, 2: 1, 3: 3, 10: 3}
    got = sorted((r.volume, r.x, r.pos, round(r.magnitude, 9)) for r in ex.read_reduction(spark, out, "two").collect())
    want = sorted((r.volume, r.x, r.pos, round(float(np.hypot(r.re, r.im)), 9)) for r in tf.downsample(data, SHAPE, (2, 3, 4)).collect())
    assert got == want


def test_nothing_left_to_do_writes_nothing(spark, tmp_path):
    out, data = str(tmp_path / "out"), slices(spark, [5])
    one = (ex.Reduction("two", 2.0),)
    ex.export_reductions(data, SHAPE, one, out)
    before = ex.markers(spark, out).snapshot()
    ex.export_reductions(data, SHAPE, one, out)
    assert ex.markers(spark, out).snapshot() == before


def test_a_volume_with_missing_rows_stays_pending(spark, tmp_path):
    out, two = str(tmp_path / "out"), ex.Reduction("two", 2.0)
    rows = spark.createDataFrame([(v, x, p, 1.0) for v in (1, 2) for x in range(2) for p in range(12) if (v, x, p) != (2, 1, 11)],
                                 "volume int, x int, pos int, magnitude double")
    part = ex.output(spark, out, "two").append(rows).parts[-1].attempt
    ex.mark(spark, SHAPE, out, two, part)
    assert [r.volume for r in ex.pending(rows, out, two).collect()] == [2]


def test_factors_below_one_are_refused():
    with pytest.raises(ValueError, match="factor"):
        ex.Reduction("up", 0.5).dims(SHAPE)
