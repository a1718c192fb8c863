"""NumPy kernels on stacks of arrays.

Every function works on the last one or two axes and treats the leading axes as
independent rows, so one Arrow batch of slices is transformed in one call.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

# ---------------------------------------------------------------- Fourier


def shift(a: np.ndarray, axes) -> np.ndarray:
    return np.fft.fftshift(a, axes=axes)


def readout_ifft(a: np.ndarray) -> np.ndarray:
    """Inverse FFT of the last axis; the same floor(n/2) shift goes on both sides."""
    return shift(np.fft.ifft(shift(a, -1), axis=-1), -1)


def readout_fft(a: np.ndarray) -> np.ndarray:
    return shift(np.fft.fft(shift(a, -1), axis=-1), -1)


def fft2_centred(a: np.ndarray) -> np.ndarray:
    """Orthonormal 2-D FFT with the origin at index floor(n/2)."""
    ax = (-2, -1)
    return np.fft.fftshift(np.fft.fft2(np.fft.ifftshift(a, axes=ax), norm="ortho"), axes=ax)


def ifft2_centred(a: np.ndarray) -> np.ndarray:
    ax = (-2, -1)
    return np.fft.ifftshift(np.fft.ifft2(np.fft.fftshift(a, axes=ax), norm="ortho"), axes=ax)


# ---------------------------------------------------------------- grids


def pad_centre(a: np.ndarray, ny: int, nz: int, fill=0.0) -> np.ndarray:
    """Put the last two axes in the middle of an ny x nz grid."""
    y, z = a.shape[-2:]
    out = np.full(a.shape[:-2] + (ny, nz), fill, dtype=a.dtype)
    y0, z0 = ny // 2 - y // 2, nz // 2 - z // 2
    out[..., y0:y0 + y, z0:z0 + z] = a
    return out


def crop_centre(a: np.ndarray, ny: int, nz: int) -> np.ndarray:
    y, z = a.shape[-2:]
    y0, z0 = y // 2 - ny // 2, z // 2 - nz // 2
    return a[..., y0:y0 + ny, z0:z0 + nz]


def window_bounds(size: int, target: int) -> tuple[int, int]:
    """0-based half-open centre window used when down-sampling k-space."""
    half_up = lambda v: math.floor(v + 0.5)
    return half_up(0.5 * size - 0.5 * target), half_up(0.5 * size + 0.5 * target)


# ---------------------------------------------------------------- gradients


def gradient(x: np.ndarray) -> np.ndarray:
    """Forward differences along y and z; the far edge is replicated (0)."""
    out = np.zeros((2,) + x.shape, dtype=x.dtype)
    out[0, ..., :-1, :] = x[..., 1:, :] - x[..., :-1, :]
    out[1, ..., :, :-1] = x[..., :, 1:] - x[..., :, :-1]
    return out


def gradient_adjoint(d: np.ndarray) -> np.ndarray:
    out = np.zeros(d.shape[1:], dtype=d.dtype)
    gy, gz = d[0], d[1]
    out[..., :-1, :] -= gy[..., :-1, :]
    out[..., 1:, :] += gy[..., :-1, :]
    out[..., :, :-1] -= gz[..., :, :-1]
    out[..., :, 1:] += gz[..., :, :-1]
    return out


# ---------------------------------------------------------------- wavelets

# Published orthonormal filter taps that have no short rule.
BEYLKIN = (
    0.099305765374, 0.424215360813, 0.699825214057, 0.449718251149, -0.110927598348, -0.264497231446,
    0.026900308804, 0.155538731877, -0.017520746267, -0.088543630623, 0.019679866044, 0.042916387274,
    -0.017460408696, -0.014365807969, 0.010040411845, 0.001484234782, -0.002736031626, 0.000640485329,
)
COIFLET = {
    1: (0.038580777748, -0.126969125396, -0.077161555496, 0.607491641386, 0.745687558934, 0.226584265197),
    2: (0.016387336463, -0.041464936782, -0.067372554722, 0.386110066823, 0.812723635450, 0.417005184424,
        -0.076488599078, -0.059434418646, 0.023680171947, 0.005611434819, -0.001823208871, -0.000720549445),
    3: (-0.003793512864, 0.007782596426, 0.023452696142, -0.065771911281, -0.061123390003, 0.405176902410,
        0.793777222626, 0.428483476378, -0.071799821619, -0.082301927106, 0.034555027573, 0.015880544864,
        -0.009007976137, -0.002574517688, 0.001117518771, 0.000466216960, -0.000070983303, -0.000034599773),
    4: (0.000892313668, -0.001629492013, -0.007346166328, 0.016068943964, 0.026682300156, -0.081266699680,
        -0.056077313316, 0.415308407030, 0.782238930920, 0.434386056491, -0.066627474263, -0.096220442034,
        0.039334427123, 0.025082261845, -0.015211731527, -0.005658286686, 0.003751436157, 0.001266561929,
        -0.000589020757, -0.000259974552, 0.000062339034, 0.000031229876, -0.000003259680, -0.000001784985),
    5: (-0.000212080863, 0.000358589677, 0.002178236305, -0.004159358782, -0.010131117538, 0.023408156762,
        0.028168029062, -0.091920010549, -0.052043163216, 0.421566206729, 0.774289603740, 0.437991626228,
        -0.062035963906, -0.105574208706, 0.041289208741, 0.032683574283, -0.019761779012, -0.009164231153,
        0.006764185419, 0.002433373209, -0.001662863769, -0.000638131296, 0.000302259520, 0.000140541149,
        -0.000041340484, -0.000021315014, 0.000003734597, 0.000002063806, -0.000000167408, -0.000000095158),
}
VAIDYANATHAN = (
    -0.000062906118, 0.000343631905, -0.000453956620, -0.000944897136, 0.002843834547, 0.000708137504,
    -0.008839103409, 0.003153847056, 0.019687215010, -0.014853448005, -0.035470398607, 0.038742619293,
    0.055892523691, -0.077709750902, -0.083928884366, 0.131971661417, 0.135084227129, -0.194450471766,
    -0.263494802488, 0.201612161775, 0.635601059872, 0.572797793211, 0.250184129505, 0.045799334111,
)
SYMMLET_10 = (
    0.001089170447, 0.000135245020, -0.012220642630, -0.002072363923, 0.064950924579, 0.016418869426,
    -0.225558972234, -0.100240215031, 0.667071338154, 1.088251530500, 0.542813011213, -0.050256540092,
    -0.045240772218, 0.070703567550, 0.008152816799, -0.028786231926, -0.001137535314, 0.006495728375,
    0.000080661204, -0.000649589896,
)
# Index of the largest tap, which settles the orientation of the
# least-asymmetric filters; one-sided length of the truncated spline filters.
SYMMLET_PEAK = {4: 3, 5: 4, 6: 5, 7: 8, 8: 8, 9: 9}
BATTLE_TERMS = {1: 12, 3: 21, 5: 30}

FILTER_FAMILIES = (
    [("Haar", 0), ("Beylkin", 0), ("Vaidyanathan", 0)]
    + [("Coiflet", p) for p in range(1, 6)]
    + [("Daubechies", p) for p in range(4, 21, 2)]
    + [("Symmlet", p) for p in range(4, 11)]
    + [("Battle", p) for p in (1, 3, 5)]
)


def _half_band_roots(moments: int) -> list[np.ndarray]:
    """Roots inside the unit circle of the half-band polynomial, in conjugate groups."""
    poly = [math.comb(moments - 1 + k, k) for k in range(moments - 1, -1, -1)]
    groups: list[np.ndarray] = []
    for y in np.roots(poly) if moments > 1 else []:
        if y.imag < -1e-12:
            continue
        z = np.roots([1.0, 4.0 * y - 2.0, 1.0])
        z = z[np.argmin(np.abs(z))]
        groups.append(np.array([z, z.conjugate()]) if y.imag > 1e-12 else np.array([z.real]))
    return groups


def _from_roots(moments: int, roots) -> np.ndarray:
    taps = np.poly(np.concatenate([-np.ones(moments), *roots])).real
    return taps / np.linalg.norm(taps)


def _phase_spread(taps: np.ndarray) -> float:
    """Departure of the unwrapped phase from a straight line."""
    w = np.linspace(0.0, np.pi, 257)[1:-1]
    phase = np.unwrap(np.angle(np.exp(-1j * np.outer(w, np.arange(len(taps)))) @ taps))
    slope = (w @ phase) / (w @ w)
    return float(np.sum((phase - slope * w) ** 2))


def _least_asymmetric(moments: int) -> np.ndarray:
    groups = _half_band_roots(moments)
    choices = []
    for bits in range(2 ** len(groups)):
        roots = [1.0 / g.conj() if bits >> i & 1 else g for i, g in enumerate(groups)]
        choices.append(_from_roots(moments, roots))
    taps = min(choices, key=_phase_spread)
    return taps if int(np.argmax(taps)) == SYMMLET_PEAK[moments] else taps[::-1]


def _spline_filter(degree: int) -> np.ndarray:
    """Battle-Lemarie filter sampled in frequency, then cut to its published length."""
    n, m, terms = 4096, degree + 1, BATTLE_TERMS[degree]
    w = 2.0 * np.pi * (np.arange(n) + 0.5) / n
    k = np.arange(-400, 401)

    def lattice(omega):
        return np.sum((omega[:, None] + 2.0 * np.pi * k) ** (-2.0 * m), axis=1)

    response = np.sqrt(2.0) * 2.0 ** -m * np.sqrt(lattice(w) / lattice(2.0 * w))
    t = np.arange(terms)
    half = np.real(np.exp(1j * np.outer(t, w)) @ response) / n
    return np.concatenate([half[:0:-1], half])


@lru_cache(maxsize=None)
def wavelet_filter(family: str, par: int = 0) -> np.ndarray:
    """Unit-norm low-pass taps of an orthonormal wavelet family."""
    if family == "Haar":
        taps = np.ones(2)
    elif family == "Beylkin":
        taps = np.array(BEYLKIN)
    elif family == "Coiflet":
        taps = np.array(COIFLET[par])
    elif family == "Vaidyanathan":
        taps = np.array(VAIDYANATHAN)
    elif family == "Daubechies":
        taps = _from_roots(par // 2, _half_band_roots(par // 2))
    elif family == "Symmlet":
        taps = np.array(SYMMLET_10) if par == 10 else _least_asymmetric(par)
    elif family == "Battle":
        taps = _spline_filter(par)
    else:
        raise ValueError(f"unknown wavelet family {family}")
    return taps / np.linalg.norm(taps)


def _level(x: np.ndarray, taps: np.ndarray, inverse: bool) -> np.ndarray:
    """One periodic analysis (or synthesis) step along the last axis."""
    n = x.shape[-1]
    t = 2 * np.arange(n // 2)
    out = np.zeros_like(x)
    low, high = slice(0, n // 2), slice(n // 2, n)
    for k, f in enumerate(taps):
        lo, hi, g = (t + k) % n, (t + 1 - k) % n, f if k % 2 == 0 else -f
        if inverse:
            out[..., lo] += f * x[..., low]
            out[..., hi] += g * x[..., high]
        else:
            out[..., low] += f * x[..., lo]
            out[..., high] += g * x[..., hi]
    return out


def _both_axes(block: np.ndarray, taps: np.ndarray, inverse: bool) -> np.ndarray:
    block = _level(block, taps, inverse)
    return np.swapaxes(_level(np.swapaxes(block, -1, -2), taps, inverse), -1, -2)


def dyadic_log2(x: np.ndarray) -> int:
    n = x.shape[-1]
    if x.shape[-2] != n or n & (n - 1):
        raise ValueError("the wavelet needs a square power-of-two grid")
    return n.bit_length() - 1


def wavelet2(x: np.ndarray, taps: np.ndarray, coarsest: int) -> np.ndarray:
    """Periodic orthogonal 2-D transform; ``coarsest`` >= log2(n) is the identity."""
    out = np.array(x)
    for j in range(dyadic_log2(x), coarsest, -1):
        n = 2 ** j
        out[..., :n, :n] = _both_axes(out[..., :n, :n], taps, False)
    return out


def wavelet2_inverse(x: np.ndarray, taps: np.ndarray, coarsest: int) -> np.ndarray:
    out = np.array(x)
    for j in range(coarsest + 1, dyadic_log2(x) + 1):
        n = 2 ** j
        out[..., :n, :n] = _both_axes(out[..., :n, :n], taps, True)
    return out


# ---------------------------------------------------------------- block DCT


@lru_cache(maxsize=None)
def cosine_basis(n: int) -> np.ndarray:
    k, i = np.mgrid[0:n, 0:n]
    basis = np.cos(np.pi * (2 * i + 1) * k / (2 * n)) * np.sqrt(2.0 / n)
    basis[0] /= np.sqrt(2.0)
    return basis


def _blockwise(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    b = basis.shape[0]
    y, z = x.shape[-2:]
    tiles = x.reshape(x.shape[:-2] + (y // b, b, z // b, b))
    tiles = np.einsum("ij,...ajck,lk->...aicl", basis, tiles, basis, optimize=True)
    return tiles.reshape(x.shape)


def block_dct(x: np.ndarray, block: int = 8, overlap: int = 8) -> np.ndarray:
    """Cosine transform of every block, for each of (block/overlap)^2 cyclic shifts."""
    shifts = block // overlap
    planes = [_blockwise(np.roll(x, (n, m), axis=(-2, -1)), cosine_basis(block))
              for n in range(shifts) for m in range(shifts)]
    return np.stack(planes) / shifts


def block_dct_inverse(planes: np.ndarray, block: int = 8, overlap: int = 8) -> np.ndarray:
    shifts = block // overlap
    moves = [(-n, -m) for n in range(shifts) for m in range(shifts)]
    back = [np.roll(_blockwise(p, cosine_basis(block).T), move, axis=(-2, -1))
            for p, move in zip(planes, moves)]
    return np.sum(back, axis=0) / shifts
