"""Linear operators with a forward and an adjoint, used by the recovery job."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from lacuna.functions import kernels


class LinearOp:
    """forward(x) and adjoint(y) on stacks of slices."""

    def forward(self, x: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def adjoint(self, y: np.ndarray) -> np.ndarray:
        raise NotImplementedError


class Identity(LinearOp):
    def forward(self, x):
        return x

    adjoint = forward


@dataclass
class MaskedFourier(LinearOp):
    """Sampled Fourier operator: phase, FFT, crop to the sampled size, mask.

    ``real_only`` restricts the image to real values on both sides.
    """

    mask: np.ndarray
    phase: np.ndarray | float = 1.0
    image_shape: tuple[int, int] | None = None
    real_only: bool = False

    def forward(self, x):
        x = np.real(x) if self.real_only else x
        k = kernels.fft2_centred(x * self.phase)
        return kernels.crop_centre(k, *self.mask.shape[-2:]) * self.mask

    def adjoint(self, y):
        shape = self.image_shape or self.mask.shape[-2:]
        x = kernels.ifft2_centred(kernels.pad_centre(y * self.mask, *shape)) * np.conj(self.phase)
        return np.real(x) if self.real_only else x


@dataclass
class Wavelet(LinearOp):
    """Periodic orthogonal wavelet; real and imaginary parts go through together."""

    family: str = "Daubechies"
    par: int = 12
    coarsest: int = 12

    def forward(self, x):
        return kernels.wavelet2(x, kernels.wavelet_filter(self.family, self.par), self.coarsest)

    def adjoint(self, y):
        return kernels.wavelet2_inverse(y, kernels.wavelet_filter(self.family, self.par), self.coarsest)


class Gradient(LinearOp):
    def forward(self, x):
        return kernels.gradient(x)

    def adjoint(self, y):
        return kernels.gradient_adjoint(y)


@dataclass
class BlockCosine(LinearOp):
    block: int = 8
    overlap: int = 8

    def forward(self, x):
        return kernels.block_dct(x, self.block, self.overlap)

    def adjoint(self, y):
        return kernels.block_dct_inverse(y, self.block, self.overlap)
