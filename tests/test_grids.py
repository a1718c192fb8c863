"""Masks, densities, bounds and echoes against plain NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lacuna.functions import arrays
from lacuna.operators import acquisition as acq
from lacuna.operators import echoes as ec
from lacuna.operators import masks as mk
from lacuna.operators import scaling as sc
from lacuna.operators import transforms as tf

rng = np.random.default_rng(21)


def bisect(f, target):
    lo, hi = 0.0, 1.0
    for _ in range(200):
        c = (lo + hi) / 2
        if np.minimum(f + c, 1).sum() > target:
            hi = c
        else:
            lo = c
    return c


def test_calibration_matches_bisection(spark):
    rows, want = [], {}
    for m in range(12):
        n = int(rng.integers(3, 60))
        f = np.round(np.exp(-rng.random(n) * 4), 3)
        target = float(np.clip(f.sum() + rng.random() * (n - f.sum()) * 0.98, 0.1, n - 0.01))
        rows += [(m, i, float(v), target) for i, v in enumerate(f)]
        want[m] = bisect(f, target)
    df = spark.createDataFrame(rows, "m int, pos int, f double, target double")
    out = mk.calibrate(df, ["m"], "f", "target", ["pos"]).groupBy("m").agg(F.first("c").alias("c"), F.sum("p").alias("s"), F.first("target").alias("t"))
    for r in out.collect():
        assert r["c"] == pytest.approx(want[r["m"]], abs=1e-9) and r["s"] == pytest.approx(r["t"], abs=1e-9)


def test_calibration_refuses_impossible_targets(spark):
    df = spark.createDataFrame([(0, i, 0.9, 2.0) for i in range(4)], "m int, pos int, f double, target double")
    assert mk.calibrate(df, ["m"], "f", "target", ["pos"]).where("c IS NOT NULL").count() == 0


def walk_bounds(m, half_rolled):
    """The published 1-based procedure, step by step."""
    n = len(m)
    r = lambda v: int(np.floor(v + 0.5))
    h = r(n / 2)
    m = np.roll(m, h) if half_rolled else m
    c0 = int(np.argmin(m)) + 1 + h - 1
    c0 -= n if c0 > n else 0
    s0 = h - c0
    m = np.roll(m, s0)
    low = 1.2 * m.min()
    lo = [i for i in range(1, r(n / 3) + 1) if m[i - 1] < low]
    hi = [i for i in range(r(2 * n / 3) + 1, n + 1) if m[i - 1] < low]
    lo, hi = (lo[-1] if lo else 1), (hi[0] if hi else n)
    c = r((hi - lo) / 2 + lo) - s0
    c -= n if c > n else 0
    corner = c + 1 - h
    return lo, hi, c, h - c, corner + n if corner < 0 else corner


def test_object_bounds(spark):
    rows, want = [], {}
    for v in range(8):
        for axis, n in (("slice", 24), ("y", 17), ("z", 20)):
            m = 1 + rng.random(n) * 0.4 + 5 * np.exp(-((np.arange(n) - rng.integers(0, n)) / 4.0) ** 2)
            rows += [(v, axis, i, float(x)) for i, x in enumerate(m)]
            want[v, axis] = walk_bounds(m, axis != "slice")
    df = spark.createDataFrame(rows, "volume int, axis string, i int, mean_value double")
    for r in sc.object_bounds(df, {"slice": 24, "y": 17, "z": 20}).collect():
        assert (r["lo"], r["hi"], r["centre"], r["roll"], r["corner"]) == want[r["volume"], r["axis"]]


def test_midpoint_quantile_definition(spark):
    df = spark.createDataFrame([(0, float(v)) for v in range(1, 11)], "k int, v double")
    at = lambda p: sc.midpoint_quantile(df, ["k"], "v", p).first()["quantile"]
    assert at(0.9) == pytest.approx(9.5) and at(0.0) == 1 and at(1.0) == 10 and at(0.5) == pytest.approx(5.5)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v, 10) for v in (0.0, 1.0, 9.99, 10.0, 10.01)], "v double, top int")
    got = {r["bin"]: r["voxels"] for r in sc.histogram(df, [], "v", "top", 10).collect()}
    assert got == {0: 1, 1: 1, 9: 2}


def test_an_empty_volume_has_no_scale(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0)] * 5 + [(2, 3.0, 9.0), (2, 8.0, 9.0)], "volume int, v double, top double")
    cut = {r["volume"]: r for r in sc.histogram_cutoff(sc.histogram(df, ["volume"], "v", "top"), ["volume"], "top").collect()}
    assert cut[1]["scale"] is None and cut[2]["scale"] == pytest.approx(65535 / cut[2]["cut_value"])
    assert {r["volume"]: r["scale"] for r in sc.rank_cutoff(df, ["volume"], "v").collect()} == {1: None, 2: 65535 / 8}
    none = df.withColumn("acquired", F.lit(False))
    assert mk.sampling_fraction(none, ["volume"]).where("acceleration IS NULL AND fraction = 0").count() == 2


def test_shifts_pads_and_crops(spark):
    for n in (7, 8):
        row = spark.range(1).select(F.sequence(F.lit(0), F.lit(n - 1)).alias("a")).select(
            arrays.centre_shift(F.col("a")), arrays.centre_shift(F.col("a"), True), arrays.roll(F.col("a"), -3)).first()
        a = np.arange(n)
        assert list(row[0]) == list(np.fft.fftshift(a)) and list(row[1]) == list(np.fft.ifftshift(a))
        assert list(row[2]) == list(np.roll(a, -3))


def test_merge_samples_adds_repeats_and_fills(spark):
    rows = [(0, 2, 1.0), (0, 2, 2.0), (0, 4, 5.0), (1, 0, 1.0)]
    df = spark.createDataFrame(rows, "k int, pos int, v double")
    got = {r["k"]: r["v"] for r in acq.merge_samples(df, ["k"], "pos", ("v",), 6).collect()}
    assert got == {0: [0, 0, 3, 0, 5, 0], 1: [1, 0, 0, 0, 0, 0]}


def test_slices_from_turned_blocks_and_from_single_samples(spark):
    rows = [(v, t, [float(10 * t + x + v) for x in range(5)], [float(-x) for x in range(5)]) for v in range(3) for t in range(7)]
    rows += [(0, 2, [1.0] * 5, [0.5] * 5)] * 40  # a trace that comes many times
    df = spark.createDataFrame(rows, "volume int, trace int, re array<double>, im array<double>").repartition(6)
    run = lambda repeats: tf.traces_to_slices(df, 8, repeats=repeats).orderBy("volume", "x").collect()
    a, b = run(False), run(True)
    assert len(a) == 15 and [r.asDict() for r in a] == [r.asDict() for r in b]
    first = a[0]
    assert first["re"] == [0, 10, 20 + 40, 30, 40, 50, 60, 0]


def test_downsample_matches_whole_volume_transform(spark):
    shape, target = (6, 8, 10), (4, 5, 6)
    x = rng.normal(size=(2, *shape)) + 1j * rng.normal(size=(2, *shape))
    rows = [(v, i, list(map(float, p.T.ravel().real)), list(map(float, p.T.ravel().imag))) for v in range(2) for i, p in enumerate(x[v])]
    df = spark.createDataFrame(rows, "volume int, x int, re array<double>, im array<double>")
    got = np.zeros((2, *target), complex)
    for r in tf.downsample(df, shape, target).collect():
        got[r["volume"], r["x"], r["pos"] % 5, r["pos"] // 5] = r["re"] + 1j * r["im"]
    ax = (1, 2, 3)
    k = np.fft.fftshift(np.fft.fftn(np.fft.fftshift(x, ax), axes=ax), ax)
    k = k[:, 1:5, 2:7, 2:8]  # round(0.5 * (n - t)) .. round(0.5 * (n + t)), halves up
    assert np.allclose(got, np.fft.fftshift(np.fft.ifftn(np.fft.fftshift(k, ax), axes=ax), ax))
    with pytest.raises(ValueError):
        tf.downsample(df, shape, (7, 8, 10))


def test_masked_fourier_job_is_adjoint(spark):
    def plane():
        return [float(v) for v in rng.normal(size=24)]

    mask = [float(v) for v in rng.random(24) < 0.5]
    df = spark.createDataFrame([(0, 0, plane(), plane(), plane(), plane(), mask, plane())],
                               "volume int, slice int, re array<double>, im array<double>, yr array<double>, yi array<double>, mask array<double>, ph array<double>")
    go = lambda a, b, adj: tf.masked_fourier(df.select("volume", "slice", F.col(a).alias("re"), F.col(b).alias("im"), "mask", "ph"), 4, 6, adj, "ph").first()
    c = lambda r: np.array(r["re"]) + 1j * np.array(r["im"])
    row = df.first()
    x, y = np.array(row["re"]) + 1j * np.array(row["im"]), np.array(row["yr"]) + 1j * np.array(row["yi"])
    assert np.isclose(np.vdot(c(go("re", "im", False)), y), np.vdot(x, c(go("yr", "yi", True))))


def test_drawn_masks_are_repeatable_and_choose_the_least_side_lobe(spark):
    p = np.clip(rng.random((6, 8)) + 0.2, 0, 1)
    df = spark.createDataFrame([(0, int(i), float(v)) for i, v in enumerate(p.T.ravel())], "m int, pos int, p double")
    draws = mk.draw_masks(df, ["m"], 6, 8, 5, seed=3, tolerance=50).cache()
    again = mk.draw_masks(df.repartition(3), ["m"], 6, 8, 5, seed=3, tolerance=50)
    key = lambda d: sorted((r["try"], r["mask"]) for r in d.collect())
    assert key(draws) == key(again)
    for r in draws.collect():
        w = np.array([int(ch) for ch in r["mask"]]).reshape(8, 6).T / p
        assert r["side_lobe"] == pytest.approx(np.abs(np.fft.ifft2(w)).ravel()[1:].max())
    best = mk.best_mask(draws, ["m"]).first()
    assert best["side_lobe"] == pytest.approx(min(r["side_lobe"] for r in draws.collect()))


def test_every_mask_comes_back_within_tolerance(spark):
    n = 128
    y, z = np.mgrid[-n // 2:n // 2, -n // 2:n // 2] / n
    p = np.clip(np.exp(-(5 * np.hypot(y, z)) ** 2) + 0.1, 0, 1).T.ravel()
    cells = spark.range(n * n).select(F.col("id").cast("int").alias("pos"), F.element_at(F.lit(p.tolist()), F.col("id").cast("int") + 1).alias("p"))
    density = cells.crossJoin(spark.range(20).select(F.col("id").alias("m")))
    rows = mk.draw_masks(density, ["m"], n, n, 2, seed=1).collect()
    assert len(rows) == 40 and all(abs(r["count"] - p.sum()) <= 1.001 for r in rows)


def test_profile_of_an_odd_grid_reaches_one(spark):
    for ny, nz in ((7, 9), (8, 9), (8, 10)):
        cells = mk.grid(spark.range(1), F.lit(ny), F.lit(nz))
        f = mk.radial_profile(F.col("y"), F.col("z"), F.lit(ny), F.lit(nz), F.lit(1.8), F.lit(5.4))
        assert cells.agg(F.max(f)).first()[0] == pytest.approx(1.0)


def test_closing_in_three_dimensions(spark):
    size, r = (9, 8, 7), 2
    inside = rng.random(size) < 0.25
    ball = [(a, b, c) for a in range(-r, r + 1) for b in range(-r, r + 1) for c in range(-r, r + 1) if a * a + b * b + c * c <= r * r]

    def step(m, fill, grow):
        big = np.pad(m, r, constant_values=fill)
        views = [big[r + a:r + a + size[0], r + b:r + b + size[1], r + c:r + c + size[2]] for a, b, c in ball]
        return np.any(views, axis=0) if grow else np.all(views, axis=0)

    want = step(step(inside, False, True), True, False)
    df = spark.createDataFrame([(0, *map(int, p)) for p in np.argwhere(inside)], "v int, x int, y int, z int")
    for tile in (3, 5, 64):
        rows = [(q["x"], q["y"], q["z"]) for q in ec.close_mask(df, ["v"], {"x": 9, "y": 8, "z": 7}, r, tile).collect()]
        assert len(rows) == len(set(rows)) and set(rows) == {tuple(map(int, p)) for p in np.argwhere(want)}


def test_decay_fit_recovers_the_constant(spark):
    te = [0.004, 0.008, 0.02, 0.04]
    rows = [(v, t, float(a * np.exp(-t / t2))) for v, (a, t2) in enumerate([(100, 0.02), (30, 0.05)]) for t in te]
    out = ec.decay_fit(spark.createDataFrame(rows, "v int, te double, s double"), ["v"], "s", "te").orderBy("v").collect()
    assert [r["t2"] for r in out] == pytest.approx([0.02, 0.05]) and [r["amplitude"] for r in out] == pytest.approx([100, 30])


def test_a_sum_that_no_count_reaches_is_told_from_a_rare_one():
    assert mk.reachable(np.array([0.5, 0.5]), 0) and not mk.reachable(np.array([0.5, 0.25]), 0.2)
    assert not mk.reachable(np.array([1.0, 0.3]), 0.2) and mk.reachable(np.array([1.0, 0.3]), 0.3)
    assert mk.reachable(np.array([2.0, 0.0]), 1) and not mk.reachable(np.array([2.0, 0.0]), 0.5)


def test_preview_makes_rows_of_the_planes_only(spark):
    from lacuna.operators import transforms as tf

    nx, ny, nz = 4, 6, 8
    a = rng.normal(size=(nx, ny * nz)) + 1j * rng.normal(size=(nx, ny * nz))
    df = spark.createDataFrame([(1, x, [float(v) for v in a[x].real], [float(v) for v in a[x].imag]) for x in range(nx)],
                               "volume int, x int, re array<double>, im array<double>")
    key = lambda d: {(r.kind, r.x, r.pos): (r.re, r.im) for r in d.collect()}
    every, some = tf.preview(df, nx, ny, nz, whole=True), tf.preview(df, nx, ny, nz)
    everything, planes = key(every), key(some)
    assert len(everything) == every.count() == 3 * nx * ny * nz
    want = {k for k in everything if k[1] == nx // 2 or k[2] % ny == ny // 2 or k[2] // ny == nz // 2}
    assert set(planes) == want and some.count() == len(want)
    for k in want:
        assert planes[k] == pytest.approx(everything[k])
    before = some._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in [line.strip(" :+-").split(" ")[0] for line in before.split("\n")]  # nothing is thrown away after it became a row
