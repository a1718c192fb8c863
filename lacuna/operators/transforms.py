"""Fourier, wavelet, cosine and gradient transforms as Spark jobs.

Array tables hold one trace or slice per row: those transforms need no shuffle.
Only going from traces to slices, and the third axis of a volume, move data, and
then by (volume, position), so no task ever holds a volume.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions import cplx, kernels, linops
from lacuna.functions.arrays import dense_rows, map_arrays, planes, transposed, vectors
from lacuna.operators.acquisition import merge_samples

COMPLEX = "re array<double>, im array<double>"


def _split(a: np.ndarray) -> dict[str, np.ndarray]:
    return {"re": np.ascontiguousarray(a.real), "im": np.ascontiguousarray(a.imag)}


def per_row(df: DataFrame, fn, keep: Sequence[str]) -> DataFrame:
    """``fn`` on the complex rows of (re, im)."""
    return map_arrays(df, lambda b: _split(fn(b["re"] + 1j * b["im"])), ("re", "im"), COMPLEX, keep)


def per_slice(df: DataFrame, fn, ny: int, nz: int, keep: Sequence[str]) -> DataFrame:
    """``fn`` on complex (ny, nz) planes; it may change the plane size."""
    return per_row(df, lambda a: vectors(fn(planes(a, ny, nz)) + 0j), keep)


# ---------------------------------------------------------------- Fourier


def readout_ifft(traces: DataFrame, keep: Sequence[str] = ("volume", "trace")) -> DataFrame:
    return per_row(traces, kernels.readout_ifft, keep)


def traces_to_slices(traces: DataFrame, length: int, keys: Sequence[str] = ("volume",), trace: str = "trace",
                     axis: str = "x", repeats: bool = False) -> DataFrame:
    """One row per readout position with the values of all traces, in trace order.

    The one big shuffle.  A trace is read once, so a group holds ``length``
    values; it travels in blocks turned where they were read.  Where a trace
    number may come many times, ``repeats`` adds single samples before the
    shuffle instead.
    """
    if repeats:
        points = traces.select(*keys, trace, F.posexplode(F.arrays_zip("re", "im")).alias(axis, "_p")).select(
            *keys, axis, trace, "_p.re", "_p.im")
        return merge_samples(points, [*keys, axis], trace, ("re", "im"), length)
    blocks = transposed(traces, keys, trace, axis)
    pieces = blocks.groupBy(*keys, axis).agg(F.collect_list(F.struct(trace, "re", "im")).alias("_b"))
    flat = pieces.select(*keys, axis, *[F.flatten(F.col(f"_b.{c}")).alias(c) for c in (trace, "re", "im")])
    return dense_rows(flat, trace, ("re", "im"), length, [*keys, axis])


def slice_fft(slices: DataFrame, ny: int, nz: int, inverse: bool = False,
              keep: Sequence[str] = ("volume", "slice")) -> DataFrame:
    return per_slice(slices, kernels.ifft2_centred if inverse else kernels.fft2_centred, ny, nz, keep)


def slice_peak(slices: DataFrame, ny: int, nz: int, keep: Sequence[str] = ("volume", "slice")) -> DataFrame:
    """Largest magnitude of the zero-filled inverse; the shift is skipped, it cannot change a maximum."""

    def peak(block):
        image = np.abs(np.fft.ifft2(planes(block["re"] + 1j * block["im"], ny, nz)))
        return {"slice_max": image.max(axis=(1, 2))}

    return map_arrays(slices, peak, ("re", "im"), "slice_max double", keep)


def volume_fft(slices: DataFrame, nx: int, ny: int, nz: int, inverse: bool = False, axis: str = "x") -> DataFrame:
    """Separable 3-D transform: planes first, then columns along x after one shuffle.

    Returns long rows (volume, x, pos, re, im).  Same shift on both sides, no
    normalisation forward, 1/N back.
    """
    lines = _volume_lines(slices, nx, ny, nz, inverse, axis)
    return lines.select("volume", "pos", F.posexplode(F.arrays_zip("re", "im")).alias(axis, "_p")).select(
        "volume", axis, "pos", "_p.re", "_p.im")


def _volume_lines(slices: DataFrame, nx: int, ny: int, nz: int, inverse: bool, axis: str) -> DataFrame:
    """The transform of ``volume_fft`` as one row of arrays along ``axis`` for each position."""
    ax = (-2, -1)
    plane = ((lambda a: kernels.shift(np.fft.ifft2(kernels.shift(a, ax)), ax)) if inverse
             else (lambda a: kernels.shift(np.fft.fft2(kernels.shift(a, ax)), ax)))
    flat = per_slice(slices, plane, ny, nz, ("volume", axis))
    columns = traces_to_slices(flat, nx, ("volume",), axis, "pos")
    return per_row(columns, kernels.readout_ifft if inverse else kernels.readout_fft, ("volume", "pos"))


def phase_ramp(samples: DataFrame, dy: Column, dz: Column, ny: int, nz: int) -> DataFrame:
    """Linear phase over (y, z) that rolls the image by (dy, dz)."""
    angle = -2 * np.pi * ((F.col("y") + 1) * dy / ny + (F.col("z") + 1) * dz / nz)
    re, im = cplx.multiply((F.col("re"), F.col("im")), cplx.conjugate(cplx.unit(angle)))
    return samples.withColumns({"re": re, "im": im})


def downsample(slices: DataFrame, shape: tuple[int, int, int], target: tuple[int, int, int], axis: str = "x",
               window=None) -> DataFrame:
    """Keep the centre of k-space: FFT, crop to ``target``, optional window, inverse FFT.

    Each axis is handled on its own: planes are cropped before anything is
    shuffled, so the shuffle carries only what stays.
    """
    (nx, ny, nz), (tx, ty, tz) = shape, target
    if tx > nx or ty > ny or tz > nz:
        raise ValueError("up-sampling is not supported")
    (x0, x1), (y0, y1), (z0, z1) = (kernels.window_bounds(n, t) for n, t in zip(shape, target))
    ax = (-2, -1)

    def plane(a):
        k = kernels.shift(np.fft.fft2(kernels.shift(a, ax)), ax)[..., y0:y1, z0:z1]
        k = k if window is None else k * window
        return kernels.shift(np.fft.ifft2(kernels.shift(k, ax)), ax)

    small = per_slice(slices, plane, ny, nz, ("volume", axis))
    columns = traces_to_slices(small, nx, ("volume",), axis, "pos")
    lines = per_row(columns, lambda a: kernels.readout_ifft(kernels.readout_fft(a)[..., x0:x1]), ("volume", "pos"))
    return lines.select("volume", "pos", F.posexplode(F.arrays_zip("re", "im")).alias(axis, "_p")).select(
        "volume", axis, "pos", "_p.re", "_p.im")


def reduction_plan(volumes: DataFrame, factors: Sequence[float], done: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """Volumes times requested reductions, without the outputs already finished."""
    wanted = volumes.select("volume", F.explode(F.array(*[F.lit(float(f)) for f in factors])).alias("factor"))
    dims = {n: F.floor(F.lit(float(s)) / F.col("factor") + 0.5).cast("int") for n, s in zip(("nx", "ny", "nz"), shape)}
    return wanted.join(done.select("volume", "factor"), ["volume", "factor"], "left_anti").withColumns(dims)


# ---------------------------------------------------------------- operators on slices


def apply_operator(slices: DataFrame, op: linops.LinearOp, ny: int, nz: int, adjoint: bool = False,
                   keep: Sequence[str] = ("volume", "slice")) -> DataFrame:
    """Forward or adjoint of a plane-to-plane operator."""
    return per_slice(slices, op.adjoint if adjoint else op.forward, ny, nz, keep)


def masked_fourier(slices: DataFrame, ny: int, nz: int, adjoint: bool = False, phase: str | None = None,
                   mask: str = "mask", keep: Sequence[str] = ("volume", "slice")) -> DataFrame:
    """Sampled Fourier operator whose mask (and phase angle) are columns of the row."""
    columns = ["re", "im", mask] + ([phase] if phase else [])

    def run(block):
        angle = np.exp(1j * planes(block[phase], ny, nz)) if phase else 1.0
        op = linops.MaskedFourier(planes(block[mask], ny, nz), angle)
        x = planes(block["re"] + 1j * block["im"], ny, nz)
        return _split(vectors(op.adjoint(x) if adjoint else op.forward(x)))

    return map_arrays(slices, run, columns, COMPLEX, keep)


def gradient_rows(voxels: DataFrame, keys: Sequence[str], value: str = "re") -> DataFrame:
    """Next minus current along y and z on long rows; 0 at the far edge.

    Both windows run inside a slice, so one shuffle by slice serves them and the
    adjoint after them.
    """
    v = F.col(value)
    voxels = voxels.repartition(*keys)

    def step(axis: str, other: str) -> Column:
        return F.coalesce(F.lead(v).over(Window.partitionBy(*keys, other).orderBy(axis)) - v, F.lit(0.0))

    return voxels.withColumns({"dy": step("y", "z"), "dz": step("z", "y")})


def gradient_planes(slices: DataFrame, ny: int, nz: int, keep: Sequence[str] = ("volume", "slice")) -> DataFrame:
    """The same on slice arrays, without any shuffle: real differences ``dy`` and ``dz``."""

    def run(block):
        gy, gz = kernels.gradient(planes(block["re"], ny, nz))
        return {"dy": vectors(gy), "dz": vectors(gz)}

    return map_arrays(slices, run, ("re",), "dy array<double>, dz array<double>", keep)


def gradient_adjoint_rows(diffs: DataFrame, keys: Sequence[str], ny: int, nz: int) -> DataFrame:
    """Adjoint of ``gradient_rows``: previous minus current with both edges handled."""

    def step(axis: str, other: str, value: str, n: int) -> Column:
        d = F.when(F.col(axis) < n - 1, F.col(value)).otherwise(0.0)
        before = F.lag(F.col(value), 1, 0.0).over(Window.partitionBy(*keys, other).orderBy(axis))
        return before - d

    return diffs.withColumn("adjoint", step("y", "z", "dy", ny) + step("z", "y", "dz", nz))


def block_cosine(slices: DataFrame, ny: int, nz: int, block: int = 8, overlap: int = 8,
                 keep: Sequence[str] = ("volume", "slice")) -> DataFrame:
    """Block cosine planes, one row per cyclic shift."""
    n = block // overlap

    def run(b):
        stack = kernels.block_dct(planes(b["re"], ny, nz), block, overlap)
        return {"planes": np.concatenate([vectors(p) for p in stack], axis=1)}

    wide = map_arrays(slices, run, ("re",), "planes array<double>", keep)
    cells = ny * nz
    return wide.select(*keep, F.explode(F.sequence(F.lit(0), F.lit(n * n - 1))).alias("shift"), "planes").select(
        *keep, "shift", F.slice("planes", F.col("shift") * cells + 1, cells).alias("coef"))


def _entries(df: DataFrame, keys: Sequence[str], index: str, wanted: Column) -> DataFrame:
    """Long rows of only the ``wanted`` entries of (re, im)."""
    entry = lambda i: F.struct(i.alias(index), F.get("re", i).alias("re"), F.get("im", i).alias("im"))
    return df.select(*keys, F.inline(F.transform(wanted, entry)))


def preview(kspace: DataFrame, nx: int, ny: int, nz: int, whole: bool = False) -> DataFrame:
    """K-space, image and fully populated k-space of a volume: centre planes or everything.

    Off the planes nothing becomes a row: a slice beside the middle one gives its two centre
    lines, a column of the inverse that lies in neither plane its middle voxel.
    """
    ax = (-2, -1)
    image = per_slice(kspace, lambda a: kernels.shift(np.fft.ifft2(kernels.shift(a, ax)), ax), ny, nz, ("volume", "x"))
    lines = _volume_lines(image, nx, ny, nz, True, "x")
    on_lines = lambda pos: (pos % ny == ny // 2) | (F.floor(pos / ny) == nz // 2)
    cells, xs = F.sequence(F.lit(0), F.lit(ny * nz - 1)), F.sequence(F.lit(0), F.lit(nx - 1))
    in_slice, in_line = cells, xs
    if not whole:
        in_slice = F.when(F.col("x") == nx // 2, cells).otherwise(F.filter(cells, on_lines))
        in_line = F.when(on_lines(F.col("pos")), xs).otherwise(F.array(F.lit(nx // 2)))
    parts = {"kspace": _entries(kspace, ("volume", "x"), "pos", in_slice), "image": _entries(image, ("volume", "x"), "pos", in_slice),
             "inverse": _entries(lines, ("volume", "pos"), "x", in_line)}
    tagged = [df.select(F.lit(kind).alias("kind"), "volume", "x", "pos", "re", "im") for kind, df in parts.items()]
    return tagged[0].union(tagged[1]).union(tagged[2])


# ---------------------------------------------------------------- reports


def objective_terms(residual: DataFrame, keys: Sequence[str], eps: float = 1e-15, p: float = 1.0) -> DataFrame:
    """Data term, smoothed L1, smoothed gradient norm and RMS per sample.

    Long rows with (rre, rim) residual, (wre, wim) coefficients, (dy_re, dy_im,
    dz_re, dz_im) differences and ``sampled``.
    """
    c = F.col
    norm = lambda a, b: F.pow(c(a) * c(a) + c(b) * c(b) + eps, F.lit(p / 2))
    data = F.sum(c("rre") * c("rre") + c("rim") * c("rim"))
    return residual.groupBy(*keys).agg(
        data.alias("data_term"), F.sum(norm("wre", "wim")).alias("l1_term"),
        F.sum(norm("dy_re", "dy_im") + norm("dz_re", "dz_im")).alias("tv_term"),
        F.sqrt(data / F.count_if("sampled")).alias("rms"))


def run_difference(left: DataFrame, right: DataFrame, on: Sequence[str], report: Sequence[str]) -> DataFrame:
    """Two runs slice by slice: summed difference, summed |difference|, summed magnitudes."""
    other = right.select(*on, F.col("re").alias("re2"), F.col("im").alias("im2"))

    def compare(block):
        x, y = block["re"] + 1j * block["im"], block["re2"] + 1j * block["im2"]
        a, b = np.abs(x), np.abs(y)
        return {"sum_diff": (a - b).sum(1), "sum_abs_diff": np.abs(x - y).sum(1), "sum_left": a.sum(1), "sum_right": b.sum(1)}

    sums = ("sum_diff", "sum_abs_diff", "sum_left", "sum_right")
    per_slice = map_arrays(left.join(other, list(on)), compare, ("re", "im", "re2", "im2"),
                           ", ".join(f"{s} double" for s in sums), list(dict.fromkeys([*on, *report])))
    return per_slice.groupBy(*report).agg(*[F.sum(s).alias(s) for s in sums])
