"""Writes small block files for tests."""

import numpy as np

from lacuna.sources.blocks import BLOCK_HEADER, FILE_HEADER

STATUS = {"int16": 0b1, "int32": 0b101, "float32": 0b1001}
DTYPE = {"int16": ">i2", "int32": ">i4", "float32": ">f4"}


def block_file(path, samples, kind="float32", ready=None):
    """``samples``: (blocks, traces, points) complex; ``ready``: data bit per block."""
    blocks, traces, points = samples.shape
    pairs = np.stack([samples.real, samples.imag], axis=-1).reshape(blocks, traces, 2 * points).astype(DTYPE[kind])
    element = pairs.dtype.itemsize
    trace_bytes = 2 * points * element
    block_bytes = BLOCK_HEADER.size + traces * trace_bytes
    ready = [True] * blocks if ready is None else ready
    with open(path, "wb") as f:
        f.write(FILE_HEADER.pack(blocks, traces, 2 * points, element, trace_bytes, block_bytes, 7, STATUS[kind], 1))
        for b in range(blocks):
            f.write(BLOCK_HEADER.pack(1, int(ready[b]), b + 1, 0, 3, 0.5, -1.0, 0.25, 0.0))
            f.write(pairs[b].tobytes())


def set_ready(path, block):
    """Turn the data bit of a 1-based block on."""
    with open(path, "r+b") as f:
        header = FILE_HEADER.unpack(f.read(FILE_HEADER.size))
        f.seek(FILE_HEADER.size + (block - 1) * header[5] + 2)
        f.write(b"\x00\x01")
