import numpy as np
import pytest

from lacuna.functions import kernels, linops

rng = np.random.default_rng(3)


def cplx(*shape):
    return rng.normal(size=shape) + 1j * rng.normal(size=shape)


@pytest.mark.parametrize("n", [7, 8])
def test_fourier_round_trip_and_energy(n):
    x = cplx(3, n, n + 1)
    k = kernels.fft2_centred(x)
    assert np.allclose(kernels.ifft2_centred(k) if n % 2 == 0 and (n + 1) % 2 == 0 else
                       np.fft.fftshift(np.fft.ifft2(np.fft.ifftshift(k, axes=(-2, -1)), norm="ortho"), axes=(-2, -1)), x)
    assert np.isclose((abs(k) ** 2).sum(), (abs(x) ** 2).sum())


def test_readout_matches_the_sum():
    x, n = cplx(2, 8), 8
    j = np.arange(n) - 4
    direct = x @ np.exp(2j * np.pi * np.outer(j, j) / n) / n
    assert np.allclose(kernels.readout_ifft(x), direct)
    assert np.allclose(kernels.readout_ifft(kernels.readout_fft(x)), x)


@pytest.mark.parametrize("family,par", kernels.FILTER_FAMILIES)
def test_filters_are_unit_norm_and_orthogonal_to_their_shifts(family, par):
    f = kernels.wavelet_filter(family, par)
    assert np.isclose(np.linalg.norm(f), 1)
    loose = {"Battle": 2e-2, "Coiflet": 1e-7}.get(family, 1e-9)
    for s in range(2, len(f), 2):
        assert abs(f[:-s] @ f[s:]) < loose
    assert np.isclose(f.sum(), np.sqrt(2), atol=loose)


@pytest.mark.parametrize("op,shape", [
    (linops.Wavelet("Daubechies", 4, 1), (16, 16)), (linops.Wavelet("Symmlet", 8, 2), (16, 16)),
    (linops.Wavelet("Haar", 0, 0), (8, 8)), (linops.Gradient(), (7, 9)), (linops.BlockCosine(8, 8), (16, 16)),
    (linops.BlockCosine(4, 2), (8, 8)), (linops.Identity(), (5, 5)),
    (linops.MaskedFourier((rng.random((6, 8)) < 0.5).astype(float), np.exp(1j * rng.random((8, 10))), (8, 10)), (8, 10)),
])
def test_adjoints(op, shape):
    x = cplx(2, *shape)
    y_shape = op.forward(x).shape
    y = cplx(*y_shape)
    assert np.isclose(np.vdot(op.forward(x), y), np.vdot(x, op.adjoint(y)))


def test_wavelet_beyond_the_grid_is_the_identity():
    x = cplx(1, 32, 32)
    assert np.array_equal(kernels.wavelet2(x, kernels.wavelet_filter("Daubechies", 12), 12), x)
    with pytest.raises(ValueError):
        kernels.wavelet2(cplx(1, 12, 12), kernels.wavelet_filter("Haar"), 1)


def test_block_cosine_inverse():
    x = rng.normal(size=(2, 16, 16))
    assert np.allclose(kernels.block_dct_inverse(kernels.block_dct(x, 8, 4), 8, 4), x)


def test_window_bounds_follow_half_up_rounding():
    assert kernels.window_bounds(192, 128) == (32, 160)
    assert kernels.window_bounds(8, 3) == (3, 6)
