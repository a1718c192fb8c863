"""L1/TV recovery of undersampled slices, with resumable state.

Every slice of every volume is one row of one job.  A kernel call solves all
slices of an Arrow block side by side, each with its own step size and stop.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions import kernels, linops
from lacuna.functions.arrays import map_arrays, planes, vectors
from lacuna.functions.joins import measured_join


@dataclass(frozen=True)
class RecoveryOptions:
    """``passes`` are (iterations, tv weight, l1 weight) blocks run one after the other."""

    ny: int
    nz: int
    passes: tuple[tuple[int, float, float], ...] = ((100, 0.0012, 0.006),)
    # Line search and smoothing defaults of the published solver.
    alpha: float = 0.01
    beta: float = 0.6
    first_step: float = 1.0
    max_trials: int = 150
    smooth: float = 1e-15
    p_norm: float = 1.0
    window: int = 32
    transform: linops.LinearOp = field(default_factory=linops.Wavelet)  # sparsifying
    variation: linops.LinearOp = field(default_factory=linops.Gradient)
    real_only: bool = False
    stop: str = "iterations"  # or "metric", "grad_norm", "norm_change"
    tolerance: float = 1e-4
    metric_window: int = 10

    @property
    def iterations(self) -> int:
        return sum(n for n, _, _ in self.passes)

    @property
    def padded(self) -> int:
        return max(2, 1 << (max(self.ny, self.nz) - 1).bit_length())


def spread_weights(iterations: int, blocks: int, tv: Sequence[float], l1: Sequence[float]):
    """Passes from an ``NxM`` plan; one weight serves all blocks, else one per block."""
    tv, l1 = ([w[0]] * blocks if len(w) == 1 else list(w) for w in (tv, l1))
    if len(tv) != blocks or len(l1) != blocks:
        raise ValueError("one weight per block is needed")
    return tuple((iterations, a, b) for a, b in zip(tv, l1))


def _sum(a: np.ndarray) -> np.ndarray:
    return a.reshape(len(a), -1).sum(axis=1)


def _energy(a: np.ndarray) -> np.ndarray:
    return _sum(a.real ** 2 + a.imag ** 2)


def _parts(a: np.ndarray) -> np.ndarray:
    """Planes of an operator that gives several per slice, else the one plane."""
    return a if a.ndim == 4 else a[None]


def _wide(v: np.ndarray) -> np.ndarray:
    return v[:, None, None]


class SliceSolver:
    """Non-linear conjugate gradient on a stack of independent slices."""

    def __init__(self, data: np.ndarray, fourier: linops.LinearOp, options: RecoveryOptions):
        self.data, self.ft, self.o = data, fourier, options
        self.tv = options.variation

    def smoothed(self, w: np.ndarray) -> np.ndarray:
        return (w.real ** 2 + w.imag ** 2 + self.o.smooth) ** (self.o.p_norm / 2)

    def slope(self, w: np.ndarray) -> np.ndarray:
        o = self.o
        return o.p_norm * w * (w.real ** 2 + w.imag ** 2 + o.smooth) ** (o.p_norm / 2 - 1)

    def gradient(self, x, tv_weight, l1_weight):
        o, image = self.o, self.o.transform.adjoint(x)
        g = 2 * o.transform.forward(self.ft.adjoint(self.ft.forward(image) - self.data))
        if l1_weight:
            g = g + l1_weight * self.slope(x)
        if tv_weight:
            g = g + tv_weight * o.transform.forward(self.tv.adjoint(self.slope(self.tv.forward(image))))
        return g

    def line(self, x, dx, tv_weight, l1_weight):
        """Objective along x + t dx for chosen rows; the transforms are taken once."""
        back = self.o.transform.adjoint
        image, step = back(x), back(dx)
        base, move = self.ft.forward(image) - self.data, self.ft.forward(step)
        grad = list(zip(_parts(self.tv.forward(image)), _parts(self.tv.forward(step)))) if tv_weight else []

        def value(rows, t):
            t = _wide(t)
            total = _energy(base[rows] + t * move[rows])
            for g, h in grad:
                total = total + tv_weight * _sum(self.smoothed(g[rows] + t * h[rows]))
            if l1_weight:
                total = total + l1_weight * _sum(self.smoothed(x[rows] + t * dx[rows]))
            return total

        return value

    def run_pass(self, x, budget, tv_weight, l1_weight, window):
        """At most ``budget`` iterations per row; returns (x, done, objective history)."""
        o, rows = self.o, len(x)
        eps = np.finfo(float).eps
        done = np.zeros(rows, dtype=int)
        active = budget > 0
        step0 = np.full(rows, o.first_step)
        g = self.gradient(x, tv_weight, l1_weight)
        dx = -g
        history: list[np.ndarray] = []
        while active.any():
            live = np.flatnonzero(active)
            f = self.line(x, dx, tv_weight, l1_weight)
            f0 = f(live, np.zeros(len(live)))
            t = step0[live].copy()
            f1 = f(live, t)
            slope = np.abs(_sum(np.conj(g[live]) * dx[live]))
            trials = np.zeros(len(live), dtype=int)
            while True:
                again = np.flatnonzero((f1 > f0 - o.alpha * t * slope) & (trials < o.max_trials))
                if not len(again):
                    break
                trials[again] += 1
                t[again] *= o.beta
                f1[again] = f(live[again], t[again])
            stuck = trials == o.max_trials
            active[live[stuck]] = False
            moved = live[~stuck]
            if not len(moved):
                break
            step0[live[trials > 2]] *= o.beta
            step0[live[trials < 1]] /= o.beta
            before = np.sqrt(_energy(dx[moved]))
            x[moved] = x[moved] + _wide(t[~stuck]) * dx[moved]
            g1 = self.gradient(x, tv_weight, l1_weight)
            bk = _energy(g1[moved]) / (_energy(g[moved]) + eps)
            dx[moved] = -g1[moved] + _wide(bk) * dx[moved]
            g[moved] = g1[moved]
            done[moved] += 1
            values = np.full(rows, np.nan)
            values[moved] = f1[~stuck]
            history.append(values)
            active &= done < budget
            if o.stop == "grad_norm":
                active[moved] &= np.sqrt(_energy(dx[moved])) >= o.tolerance
            elif o.stop == "norm_change":
                active[moved] &= np.abs(np.sqrt(_energy(dx[moved])) - before) >= o.tolerance
            elif o.stop == "metric" and len(history) >= max(window + 2, 3):
                recent = np.array(history[-window - 2:]) / history[0]
                means = [recent[i:i + window].mean(axis=0) for i in range(3)]
                curve = np.abs(means[2] - 2 * means[1] + means[0])
                active &= ~(curve < o.tolerance)
        table = np.array(history).T if history else np.zeros((rows, 0))
        return x, done, table


def low_frequency_plane(n: int, width: int) -> np.ndarray:
    width = min(width, n)
    taps = np.hamming(width)
    plane = kernels.pad_centre(np.outer(taps, taps), n, n)
    return plane / plane.max()


def place(positions: np.ndarray, values: np.ndarray, ny: int, nz: int, padded: int, fill=0.0) -> np.ndarray:
    """Mask-ordered rows of values on the padded grid."""
    flat = np.full((len(values), ny * nz), fill, dtype=values.dtype)
    np.put_along_axis(flat, positions.astype(np.int64), values, axis=1)
    return kernels.pad_centre(planes(flat, ny, nz), padded, padded, fill)


def start_estimate(data, density, mask, options):
    """Density-weighted inverse and the smooth phase of the slice."""
    image = kernels.ifft2_centred(data / density)
    window = low_frequency_plane(options.padded, options.window)
    phase = np.exp(1j * np.angle(kernels.ifft2_centred(data * window)))
    return options.transform.forward(image), linops.MaskedFourier(mask, phase, real_only=options.real_only)


def recover_block(block: dict[str, np.ndarray], options: RecoveryOptions) -> dict[str, object]:
    o, n = options, options.padded
    data = place(block["positions"], block["re"] + 1j * block["im"], o.ny, o.nz, n)
    density = kernels.pad_centre(planes(block["density"], o.ny, o.nz), n, n, 1.0)
    mask = place(block["positions"], np.ones(block["positions"].shape), o.ny, o.nz, n)
    x, fourier = start_estimate(data, density, mask, o)
    completed = block["completed"].astype(int)
    resumed = block["start_re"].shape[1] > 0
    if resumed:
        x = planes(block["start_re"] + 1j * block["start_im"], n, n).copy()
    solver = SliceSolver(data, fourier, o)
    x = np.ascontiguousarray(x, dtype=complex)
    history, total, end = [], np.zeros(len(x), dtype=int), 0
    for count, tv_weight, l1_weight in o.passes:
        end += count
        budget = np.clip(end - completed, 0, count)
        x, done, values = solver.run_pass(x, budget, tv_weight, l1_weight, 3 if resumed else o.metric_window)
        total += done
        history.append(values)
    objective = np.concatenate(history, axis=1)
    return {
        "iterations": completed + total,
        "re": vectors(x.real), "im": vectors(x.imag),
        "objective": [row[~np.isnan(row)] for row in objective],
    }


def with_mask(samples: DataFrame, masks: DataFrame, options: RecoveryOptions) -> DataFrame:
    """Each slice with its mask and density; a mask's size follows from the grid."""
    return measured_join(samples, masks.select("mask_id", "positions", "density"), ["mask_id"],
                         row_bytes=12 * options.ny * options.nz)


def recover(samples: DataFrame, masks: DataFrame, options: RecoveryOptions, state: DataFrame | None = None,
            chunk: int = 30, slices: int | None = None) -> DataFrame:
    """Recover every slice that has not reached the requested iterations.

    ``samples``: (volume, slice, mask_id, re, im) in mask order.  ``masks``:
    (mask_id, positions, density).  ``state``: earlier (volume, slice,
    iterations, re, im).  One row per slice comes back, in the wavelet domain.
    When the slice count is known the work is spread at ``chunk`` slices a task,
    because AQE sizes tasks by bytes and not by solver time.
    """
    rows = samples
    empty = F.array().cast("array<double>")
    if state is None:
        rows = rows.withColumns({"completed": F.lit(0), "start_re": empty, "start_im": empty})
    else:
        earlier = state.select("volume", "slice", F.col("iterations").alias("completed"),
                               F.col("re").alias("start_re"), F.col("im").alias("start_im"))
        finished = earlier.where(F.col("completed") >= options.iterations).select("volume", "slice")
        rows = rows.join(finished, ["volume", "slice"], "left_anti")  # narrow; finished slices go before any wide join
        rows = rows.join(earlier.where(F.col("completed") < options.iterations), ["volume", "slice"], "left")
        rows = rows.withColumn("completed", F.coalesce("completed", F.lit(0)))
        started = F.col("completed") > 0
        rows = rows.withColumns({c: F.when(started, F.col(c)).otherwise(empty) for c in ("start_re", "start_im")})
    if slices:
        rows = rows.repartition(max(1, -(-slices // chunk)), "volume", "slice")
    rows = with_mask(rows, masks, options)  # last: the mask of a slice is larger than its samples
    return map_arrays(
        rows, lambda b: recover_block(b, options),
        ("re", "im", "positions", "density", "completed", "start_re", "start_im"),
        "iterations int, re array<double>, im array<double>, objective array<double>", ("volume", "slice"))


def finish(recovered: DataFrame, options: RecoveryOptions, volume_scale: str | None = None, scale: float = 1.0,
           keep: Sequence[str] = ("volume", "slice")) -> DataFrame:
    """Recovered slices to image space: inverse transform, scale back, crop to the acquired size."""
    o, n = options, options.padded
    inputs = ("re", "im") + ((volume_scale,) if volume_scale else ())
    ax = (-2, -1)

    def run(block):
        image = o.transform.adjoint(planes(block["re"] + 1j * block["im"], n, n))
        if volume_scale:
            image = image * _wide(block[volume_scale]) / n
        if (o.ny, o.nz) != (n, n):
            k = kernels.crop_centre(kernels.shift(np.fft.fft2(kernels.shift(image, ax)), ax), o.ny, o.nz)
            image = kernels.shift(np.fft.ifft2(kernels.shift(k, ax)), ax)
        flat = vectors(image * scale)
        return {"re": np.ascontiguousarray(flat.real), "im": np.ascontiguousarray(flat.imag), "magnitude": np.abs(flat)}

    return map_arrays(recovered, run, inputs, "re array<double>, im array<double>, magnitude array<double>", keep)


def quality(recovered: DataFrame, samples: DataFrame, masks: DataFrame, options: RecoveryOptions) -> DataFrame:
    """Residual energy and gradient plus coefficient L1 of each recovered slice."""
    o, n = options, options.padded
    truth = with_mask(samples, masks, options).select(
        "volume", "slice", "positions", "density", F.col("re").alias("dre"), F.col("im").alias("dim"))
    rows = recovered.join(truth, ["volume", "slice"])

    def run(block):
        data = place(block["positions"], block["dre"] + 1j * block["dim"], o.ny, o.nz, n)
        density = kernels.pad_centre(planes(block["density"], o.ny, o.nz), n, n, 1.0)
        mask = place(block["positions"], np.ones(block["positions"].shape), o.ny, o.nz, n)
        _, fourier = start_estimate(data, density, mask, o)
        x = planes(block["re"] + 1j * block["im"], n, n)
        image = o.transform.adjoint(x)
        gy, gz = kernels.gradient(image)
        return {"residual": _energy(fourier.forward(image) - data),
                "l1": _sum(np.abs(gy)) + _sum(np.abs(gz)) + _sum(np.abs(x))}

    return map_arrays(rows, run, ("re", "im", "dre", "dim", "positions", "density"), "residual double, l1 double",
                      ("volume", "slice", "iterations"))


def pending(plan: DataFrame, state: DataFrame, limit: int, keep_work: bool = True) -> DataFrame:
    """Slices still to do: not started, or under the limit when earlier work is kept."""
    done = state.where(F.col("iterations") >= limit) if keep_work else state.where(F.col("iterations") > 0)
    return plan.join(done.select("volume", "slice"), ["volume", "slice"], "left_anti")
