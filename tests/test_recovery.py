import numpy as np
import pytest
from pyspark.sql import functions as F

from lacuna.functions import kernels, linops
from lacuna.operators import recovery as rc
from lacuna.sources import state as st

rng = np.random.default_rng(8)


def problem(n=16, count=4, share=0.5):
    """Sparse images seen through half of their k-space."""
    images = np.zeros((count, n, n))
    for i in range(count):
        for _ in range(5):
            y, z = rng.integers(2, n - 4, 2)
            images[i, y:y + 3, z:z + 3] += rng.uniform(0.4, 1)
    k = kernels.fft2_centred(images)
    r = np.hypot(*np.mgrid[-n // 2:n // 2, -n // 2:n // 2]) / n
    p = np.clip(np.exp(-(4 * r) ** 2) + share * 0.7, 0, 1)
    mask = rng.random((n, n)) < p
    positions = np.flatnonzero(mask.T.ravel())
    flat = np.swapaxes(k, 1, 2).reshape(count, -1)[:, positions]
    return images, flat, positions, p.T.ravel()


def tables(spark, flat, positions, density):
    rows = [(0, i, 1, list(map(float, f.real)), list(map(float, f.imag))) for i, f in enumerate(flat)]
    samples = spark.createDataFrame(rows, "volume int, slice bigint, mask_id int, re array<double>, im array<double>")
    masks = spark.createDataFrame([(1, [int(p) for p in positions], [float(d) for d in density])],
                                  "mask_id int, positions array<int>, density array<double>")
    return samples, masks


def options(passes, **kw):
    return rc.RecoveryOptions(16, 16, passes=passes, window=8, transform=linops.Wavelet("Haar", 0, 2), **kw)


@pytest.fixture(scope="module")
def case(spark):
    images, *rest = problem()
    return images, tables(spark, *rest)


def test_objective_falls_and_image_improves(spark, case):
    images, (samples, masks) = case
    opts = options(((60, 0.002, 0.002),))
    rows = rc.recover(samples, masks, opts, slices=4, chunk=2).orderBy("slice").collect()
    assert [r["iterations"] for r in rows] == [60] * 4
    for r in rows:
        assert all(b <= a * (1 + 1e-9) for a, b in zip(r["objective"], r["objective"][1:]))
    final = rc.finish(rc.recover(samples, masks, opts), opts).orderBy("slice").collect()
    start = rc.finish(rc.recover(samples, masks, options(((1, 0.002, 0.002),))), opts).orderBy("slice").collect()
    err = lambda r, i: np.linalg.norm(np.array(r["magnitude"]).reshape(16, 16).T - images[i]) / np.linalg.norm(images[i])
    for i in range(4):
        assert err(final[i], i) < 0.6 * err(start[i], i)


def test_blocks_equal_resumes(spark, case, tmp_path):
    """Three blocks in one job against three jobs that pick up the stored state."""
    samples, masks = case[1]
    block = (8, 0.002, 0.004)
    once = rc.recover(samples, masks, options((block,) * 3)).orderBy("slice").collect()
    path = str(tmp_path / "state")
    for n in (1, 2, 3):
        state = st.read_state(spark, path) if n > 1 else None
        st.append_attempt(rc.recover(samples, masks, options((block,) * n), state), path, n)
    resumed = st.read_state(spark, path).orderBy("slice").collect()
    assert [r["iterations"] for r in resumed] == [24] * 4
    for a, b in zip(once, resumed):
        assert np.allclose(a["re"], b["re"], atol=1e-9) and np.allclose(a["im"], b["im"], atol=1e-9)
    assert rc.recover(samples, masks, options((block,) * 3), st.read_state(spark, path)).count() == 0
    assert st.remaining(st.header(spark, path), 24).first()["completed"] == 4


def test_rows_do_not_depend_on_their_batch(case):
    """A stack of slices gives what each slice gives alone."""
    samples, masks = case[1]
    rows = samples.join(masks, "mask_id").orderBy("slice").toPandas()
    block = {c: np.stack(rows[c]) for c in ("re", "im", "positions", "density")}
    block |= {"completed": np.zeros(4), "start_re": np.zeros((4, 0)), "start_im": np.zeros((4, 0))}
    opts = options(((12, 0.002, 0.004),))
    stack = rc.recover_block(block, opts)
    for i in range(4):
        alone = rc.recover_block({k: v[i:i + 1] for k, v in block.items()}, opts)
        assert np.allclose(stack["re"][i], alone["re"][0], atol=1e-10)


@pytest.mark.parametrize("stop,tolerance", [("metric", 1e-3), ("grad_norm", 0.5), ("norm_change", 0.05)])
def test_early_stops(case, stop, tolerance):
    samples, masks = case[1]
    out = rc.recover(samples, masks, options(((80, 0.002, 0.004),), stop=stop, tolerance=tolerance)).collect()
    assert all(0 < r["iterations"] < 80 for r in out)


def test_non_square_slices_are_padded_and_cropped(spark):
    n_y, n_z = 10, 6
    flat = rng.normal(size=(2, n_y * n_z)) + 1j * rng.normal(size=(2, n_y * n_z))
    samples, masks = tables(spark, flat, np.arange(n_y * n_z), np.ones(n_y * n_z))
    opts = rc.RecoveryOptions(n_y, n_z, passes=((2, 0.001, 0.001),), window=6)
    assert opts.padded == 16
    rec = rc.recover(samples, masks, opts)
    assert {len(r["re"]) for r in rec.collect()} == {256}
    assert {len(r["magnitude"]) for r in rc.finish(rec, opts).collect()} == {60}


def test_gradient_is_the_slope_of_the_objective():
    mask, phase = (rng.random((8, 8)) < 0.6).astype(float), np.exp(1j * rng.random((1, 8, 8)))
    c = lambda: rng.normal(size=(1, 8, 8)) + 1j * rng.normal(size=(1, 8, 8))
    opts = rc.RecoveryOptions(8, 8, transform=linops.Wavelet("Daubechies", 4, 1), smooth=1e-3)
    solver = rc.SliceSolver(c() * mask, linops.MaskedFourier(mask, phase), opts)
    x, d, row = c(), c(), np.array([0])
    f = solver.line(x, d, 0.3, 0.2)
    at = lambda t: f(row, np.array([t]))[0]
    slope = np.real(np.vdot(solver.gradient(x, 0.3, 0.2), d))
    assert np.isclose((at(1e-6) - at(-1e-6)) / 2e-6, slope, rtol=1e-6)


@pytest.mark.parametrize("variation,real_only", [(linops.Identity(), False), (linops.BlockCosine(8, 4), False), (linops.Gradient(), True)])
def test_other_operators(case, variation, real_only):
    samples, masks = case[1]
    out = rc.recover(samples, masks, options(((8, 0.002, 0.004),), variation=variation, real_only=real_only)).collect()
    assert all(b <= a * (1 + 1e-9) for r in out for a, b in zip(r["objective"], r["objective"][1:]))


def test_weights():
    assert rc.spread_weights(10, 3, [0.1], [0.2, 0.3, 0.4]) == ((10, 0.1, 0.2), (10, 0.1, 0.3), (10, 0.1, 0.4))
    with pytest.raises(ValueError):
        rc.spread_weights(10, 3, [0.1, 0.2], [0.3])


def test_pending(spark):
    plan = spark.createDataFrame([(0, i) for i in range(4)], "volume int, slice bigint")
    state = spark.createDataFrame([(0, 1, 50), (0, 2, 100)], "volume int, slice bigint, iterations int")
    left = lambda keep: sorted(r["slice"] for r in rc.pending(plan, state, 100, keep).collect())
    assert left(True) == [0, 1, 3] and left(False) == [0, 3]
    assert st.allocate(plan).agg(F.sum("iterations")).first()[0] == 0
