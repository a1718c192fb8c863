"""Array columns: JVM-side index arithmetic, and Arrow batches into NumPy.

``map_arrays`` is the one bridge to Python.  Arrow list columns are viewed as
2-D NumPy blocks without a per-row loop, so a kernel sees a stack of slices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.functions import kernels

# A kernel works on at most this much input at a time, whatever the batch size.
BLOCK_BYTES = 64 << 20


def _rows_as_numpy(column: pa.Array) -> np.ndarray | list[np.ndarray]:
    """A 2-D block when all lists have one length, else a list of vectors."""
    if not pa.types.is_list(column.type) and not pa.types.is_large_list(column.type):
        return column.to_numpy(zero_copy_only=False)
    if column.null_count:
        raise ValueError("array column holds nulls")
    values = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths == lengths[0]).all():
        return values.reshape(len(lengths), lengths[0])
    return np.split(values, np.cumsum(lengths)[:-1])


def _to_arrow(block, dtype: pa.DataType) -> pa.Array:
    if pa.types.is_list(dtype) and isinstance(block, np.ndarray) and block.ndim == 2:
        offsets = np.arange(len(block) + 1, dtype=np.int32) * block.shape[1]
        flat = pa.array(np.ascontiguousarray(block).ravel()).cast(dtype.value_type)
        return pa.ListArray.from_arrays(pa.array(offsets), flat)
    if pa.types.is_list(dtype):
        return pa.array([np.asarray(row) for row in block], type=dtype)
    return pa.array(np.asarray(block)).cast(dtype)


def _length_runs(blocks: dict) -> Iterator[np.ndarray]:
    """Row indices grouped so every list column has one length in a group."""
    n = len(next(iter(blocks.values())))
    ragged = [b for b in blocks.values() if isinstance(b, list)]
    if not ragged:
        yield np.arange(n)
        return
    keys = np.array([[len(b[i]) for b in ragged] for i in range(n)])
    _, group = np.unique(keys, axis=0, return_inverse=True)
    for g in range(group.max() + 1):
        yield np.flatnonzero(group == g)


def map_arrays(
    df: DataFrame,
    kernel: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]],
    inputs: Sequence[str],
    outputs: str,
    keep: Sequence[str] = (),
    ragged: bool = False,
) -> DataFrame:
    """Apply ``kernel`` to blocks of rows.

    ``inputs`` name scalar or array columns; ``outputs`` is a DDL string of the
    columns the kernel returns; ``keep`` are carried through unchanged.  A kernel
    gets 2-D blocks of equal-length rows, or with ``ragged`` lists of vectors.
    """
    keep, inputs = list(keep), list(inputs)
    out_type = T.StructType.fromDDL(outputs)
    schema = T.StructType([df.schema[c] for c in keep] + out_type.fields)
    arrow_types = {f.name: _arrow_type(f.dataType) for f in out_type.fields}
    selected = df.select(*dict.fromkeys(keep + inputs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            step = max(1, int(BLOCK_BYTES * batch.num_rows // max(batch.nbytes, 1)))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                cols = {c: _rows_as_numpy(part.column(c)) for c in inputs}
                if ragged:
                    cols = {c: list(v) if isinstance(v, np.ndarray) and v.ndim == 2 else v for c, v in cols.items()}
                for rows in ([np.arange(part.num_rows)] if ragged else _length_runs(cols)):
                    whole = len(rows) == part.num_rows
                    block = cols if ragged else {c: v if whole and not isinstance(v, list) else
                             (np.stack([v[i] for i in rows]) if isinstance(v, list) else v[rows])
                             for c, v in cols.items()}
                    result = kernel(block)
                    kept = part if whole else part.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [kept.column(c) for c in keep]
                        + [_to_arrow(result[n], t) for n, t in arrow_types.items()],
                        names=keep + list(arrow_types),
                    )

    return selected.mapInArrow(run, schema)


def _arrow_type(dt: T.DataType) -> pa.DataType:
    if isinstance(dt, T.ArrayType):
        return pa.list_(_arrow_type(dt.elementType))
    return {
        T.DoubleType: pa.float64(), T.FloatType: pa.float32(), T.LongType: pa.int64(),
        T.IntegerType: pa.int32(), T.BooleanType: pa.bool_(), T.StringType: pa.string(),
    }[type(dt)]


def transposed(df: DataFrame, keys: Sequence[str], row: str, axis: str, values: Sequence[str] = ("re", "im")) -> DataFrame:
    """Rows of arrays turned within each Arrow batch: (keys, axis, [row], [values]).

    A batch holds many rows of a key, so what is shuffled afterwards are short
    vectors per axis position instead of single samples.  Rows of a key that
    repeat within a batch are added here already.
    """
    keys, values = list(keys), list(values)
    schema = T.StructType([df.schema[k] for k in keys] + T.StructType.fromDDL(
        f"{axis} int, {row} array<int>, " + ", ".join(f"{v} array<double>" for v in values)).fields)
    names = [f.name for f in schema.fields]
    types = [_arrow_type(f.dataType) for f in schema.fields]

    def turn(part: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        key_rows = np.stack([part[k] for k in keys], axis=1)
        found, group = np.unique(key_rows, axis=0, return_inverse=True)
        for g, key in enumerate(found):
            mine = np.flatnonzero(group.ravel() == g)
            at, slot = np.unique(part[row][mine], return_inverse=True)
            n = part[values[0]].shape[1]
            blocks = []
            for v in values:
                total = np.zeros((len(at), n))
                np.add.at(total, slot, part[v][mine])
                blocks.append(total.T)
            columns = [np.full(n, k) for k in key] + [np.arange(n), np.tile(at, (n, 1)), *blocks]
            yield pa.RecordBatch.from_arrays([_to_arrow(c, t) for c, t in zip(columns, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, int(BLOCK_BYTES * batch.num_rows // max(batch.nbytes, 1)))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                cols = {c: _rows_as_numpy(part.column(c)) for c in [*keys, row, *values]}
                for rows in _length_runs(cols):
                    yield from turn({c: np.stack([v[i] for i in rows]) if isinstance(v, list) else v[rows]
                                     for c, v in cols.items()})

    return df.select(*keys, row, *values).mapInArrow(run, schema)


def dense_rows(df: DataFrame, positions: str, values: Sequence[str], length: int, keep: Sequence[str]) -> DataFrame:
    """(positions, values) array pairs to full arrays of ``length``; repeats add up, gaps are 0."""

    def place(block):
        rows = np.arange(len(block[positions]))[:, None]
        out = {}
        for v in values:
            out[v] = np.zeros((len(rows), length))
            np.add.at(out[v], (rows, block[positions]), block[v])
        return out

    return map_arrays(df, place, (positions, *values), ", ".join(f"{v} array<double>" for v in values), keep)


# ---------------------------------------------------------------- JVM-side


def decode_interleaved(values: Column, part: str) -> Column:
    """``re`` (even) or ``im`` (odd) elements of an interleaved pair array."""
    parity = 0 if part == "re" else 1
    return F.transform(F.filter(values, lambda _, i: i % 2 == parity), lambda v: v.cast("double"))


def roll(values: Column, k) -> Column:
    """Circular shift by k (towards higher indices)."""
    n, k = F.size(values), F.lit(k) if isinstance(k, int) else k
    cut = n - F.pmod(k, n)
    return F.concat(F.slice(values, cut + 1, n), F.slice(values, F.lit(1), cut))


def centre_shift(values: Column, inverse: bool = False) -> Column:
    """Move the origin to floor(n/2), or back; the two differ for odd n."""
    n = F.size(values)
    return roll(values, ((n + 1) / 2 if inverse else n / 2).cast("int"))


def pad_planes(df: DataFrame, values: str, shape: tuple[int, int], target: tuple[int, int], keep: Sequence[str],
               fill: float = 0.0) -> DataFrame:
    """Centre column-major planes in a larger grid."""
    pad = lambda b: {values: vectors(kernels.pad_centre(planes(b[values], *shape), *target, fill))}
    return map_arrays(df, pad, (values,), f"{values} array<double>", keep)


def crop_plane(values: Column, ny: int, nz: int, my: int, mz: int) -> Column:
    """Centre my x mz part of an ny x nz column-major plane."""
    y0, z0 = ny // 2 - my // 2, nz // 2 - mz // 2
    return F.filter(values, lambda _, p: (p % ny >= y0) & (p % ny < y0 + my)
                    & (F.floor(p / ny) >= z0) & (F.floor(p / ny) < z0 + mz))


def dyadic(n: Column) -> Column:
    """Smallest power of two that is at least n (2 or more)."""
    bits = F.length(F.bin(F.greatest(n, F.lit(2)).cast("bigint") - 1))
    return F.pow(F.lit(2), bits).cast("int")


def planes(a: np.ndarray, ny: int, nz: int) -> np.ndarray:
    """Rows of column-major vectors as a stack of (ny, nz) planes."""
    return np.swapaxes(a.reshape(-1, nz, ny), 1, 2)


def vectors(a: np.ndarray) -> np.ndarray:
    """Inverse of ``planes``."""
    return np.swapaxes(a, -1, -2).reshape(len(a), -1)
