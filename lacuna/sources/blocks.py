"""Spark data source for block-structured sample files, batch and growing.

    register(spark)
    spark.read.format("lacuna_blocks").option("table", "trace").load(path)

``table`` is ``file_header``, ``block_header``, ``tag`` (the bytes that name an acquisition:
file header, block header and the first samples) or ``trace`` (default).  ``path``
is a file, a folder or a glob on any file system pyarrow can open.  A file is
split by byte range: a task reads the 32-byte header itself and emits the traces
that start in its range, so the driver only lists names and sizes, and one huge
file feeds many tasks.  An equality or IN filter on ``block`` prunes the ranges.
"""

from __future__ import annotations

import fnmatch
import json
import os
import posixpath
import struct
import sys
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, In, InputPartition,
)

# The process that plans a streaming source does not see shipped files, so the
# source travels as a whole instead of by module name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Record:
    """A fixed binary layout that can be pickled."""

    layout: str

    @property
    def size(self) -> int:
        return struct.calcsize(self.layout)

    def unpack(self, data: bytes) -> tuple:
        return struct.unpack(self.layout, data)

    def pack(self, *values) -> bytes:
        return struct.pack(self.layout, *values)


FILE_HEADER = Record(">5iIhhi")
BLOCK_HEADER = Record(">4hi4f")
#: Bytes of samples in a tag.
TAG_SAMPLES = 40

SCHEMAS = {
    "file_header": "path string, file_bytes bigint, nblocks int, ntraces int, npoints int, bytes_per_element int, "
                   "bytes_per_trace int, bytes_per_block bigint, version int, status int, nblock_headers int",
    "block_header": "path string, block int, scale int, status int, block_index int, mode int, ctcount int, "
                    "lpval float, rpval float, lvl float, tlt float, has_data boolean",
    "tag": "path string, block int, has_data boolean, tag binary",
    "trace": "path string, block int, trace int, re array<double>, im array<double>",
}


@dataclass(frozen=True)
class Layout:
    """Where blocks and traces of one file lie."""

    nblocks: int
    ntraces: int
    npoints: int
    element: int
    trace_bytes: int
    block_bytes: int
    status: int

    @classmethod
    def read(cls, handle) -> "Layout":
        f = FILE_HEADER.unpack(handle.read_at(FILE_HEADER.size, 0))
        return cls(f[0], f[1], f[2], f[3], f[4], f[5], f[7])

    @property
    def dtype(self) -> np.dtype:
        if self.status >> 3 & 1:
            return np.dtype(">f4")
        return np.dtype(">i4") if self.status >> 2 & 1 else np.dtype(">i2")

    def block_start(self, block: int) -> int:
        """Byte of a 1-based block's header."""
        return FILE_HEADER.size + (block - 1) * self.block_bytes

    def trace_start(self, block: int, trace: int) -> int:
        lead = self.block_bytes - self.ntraces * self.trace_bytes
        return self.block_start(block) + lead + trace * self.trace_bytes

    def first_at(self, offset: int) -> int:
        """Running number of the first trace that starts at or after a byte."""
        if offset <= self.trace_start(1, 0):
            return 0
        block = min((offset - FILE_HEADER.size) // self.block_bytes + 1, self.nblocks)
        inside = offset - self.trace_start(block, 0)
        return (block - 1) * self.ntraces + min(max(0, -(-inside // self.trace_bytes)), self.ntraces)


@dataclass
class Span(InputPartition):
    path: str
    start: int
    stop: int
    size: int


def filesystem(path: str):
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _open(path: str):
    system, inner = filesystem(path)
    return system.open_input_file(inner)


def _list(path: str) -> list[tuple[str, int]]:
    """(path, size) of every block file a path names."""
    from pyarrow import fs

    system, inner = filesystem(path)
    scheme = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    if any(ch in inner for ch in "*?["):
        folder = inner
        while any(ch in folder for ch in "*?["):
            folder = posixpath.dirname(folder)
        found = system.get_file_info(fs.FileSelector(folder, recursive=True))
        found = [i for i in found if fnmatch.fnmatch(i.path, inner)]
    else:
        info = system.get_file_info(inner)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True))
    keep = [i for i in found if i.type == fs.FileType.File and i.size >= FILE_HEADER.size
            and not os.path.basename(i.path).startswith((".", "_"))]
    return sorted((scheme + i.path, i.size) for i in keep)


def _flags(handle, layout: Layout, block: int) -> tuple:
    return BLOCK_HEADER.unpack(handle.read_at(BLOCK_HEADER.size, layout.block_start(block)))


def _traces(span: Span, blocks: set[int] | None, batch_bytes: int) -> Iterator[pa.RecordBatch]:
    """Traces that start in the span, block by block, in bounded batches."""
    with _open(span.path) as handle:
        layout = Layout.read(handle)
        whole = min(layout.nblocks, (span.size - FILE_HEADER.size) // layout.block_bytes)
        at = layout.first_at(span.start)
        end = min(layout.first_at(span.stop), whole * layout.ntraces)
        step = max(1, batch_bytes // max(layout.trace_bytes, 1))
        checked: tuple[int, bool] = (0, False)
        while at < end:
            block, trace = at // layout.ntraces + 1, at % layout.ntraces
            count = min(step, layout.ntraces - trace, end - at)
            if checked[0] != block:
                ready = (blocks is None or block in blocks) and _flags(handle, layout, block)[1] & 1
                checked = (block, bool(ready))
            if not checked[1]:
                at += layout.ntraces - trace
                continue
            raw = handle.read_at(count * layout.trace_bytes, layout.trace_start(block, trace))
            rows = np.frombuffer(raw, dtype=layout.dtype).reshape(count, -1)[:, :layout.npoints].astype(np.float64)
            yield _batch(span.path, block, trace, rows[:, 0::2], rows[:, 1::2])
            at += count


def _batch(path: str, block: int, trace: int, re: np.ndarray, im: np.ndarray) -> pa.RecordBatch:
    n = len(re)

    def lists(a):
        offsets = np.arange(n + 1, dtype=np.int32) * a.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(a).ravel()))

    return pa.RecordBatch.from_arrays(
        [pa.array([path] * n), pa.array(np.full(n, block, np.int32)),
         pa.array(np.arange(trace, trace + n, dtype=np.int32)), lists(re), lists(im)],
        names=["path", "block", "trace", "re", "im"])


class BlockReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.table = options.get("table", "trace")
        self.split = int(options.get("partition_bytes", 64 << 20))
        self.batch = int(options.get("batch_bytes", 4 << 20))
        self.blocks: set[int] | None = None

    def pushFilters(self, filters):
        for f in filters:
            wanted = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if wanted is not None and f.attribute == ("block",):
                self.blocks = wanted if self.blocks is None else self.blocks & wanted
            else:
                yield f

    def partitions(self):
        files = _list(self.path)
        if self.table == "file_header":
            return [Span(p, 0, FILE_HEADER.size, size) for p, size in files]
        if self.table == "trace" and self.blocks is not None:
            return self._block_ranges(files)
        spans = [Span(p, at, min(at + self.split, size), size)
                 for p, size in files for at in range(0, size, self.split)]
        return spans

    def _block_ranges(self, files):
        """Only the byte ranges of the wanted blocks; headers are read in parallel."""

        def ranges(entry):
            path, size = entry
            with _open(path) as handle:
                layout = Layout.read(handle)
            out = []
            for b in sorted(self.blocks):
                start, stop = layout.block_start(b), layout.block_start(b + 1)
                if 1 <= b <= layout.nblocks and stop <= size:
                    out += [Span(path, at, min(at + self.split, stop), size) for at in range(start, stop, self.split)]
            return out

        with ThreadPoolExecutor(32) as pool:
            return [s for part in pool.map(ranges, files) for s in part]

    def read(self, span: Span | None):
        if span is None:  # Spark asks once even when every range was pruned
            return
        if self.table == "trace":
            yield from _traces(span, self.blocks, self.batch)
        elif self.table == "file_header":
            with _open(span.path) as handle:
                f = FILE_HEADER.unpack(handle.read_at(FILE_HEADER.size, 0))
            yield (span.path, span.size, *f)
        elif self.table == "tag":
            yield from self._tags(span)
        else:
            yield from self._block_headers(span)

    def _tags(self, span: Span):
        with _open(span.path) as handle:
            layout, head = Layout.read(handle), handle.read_at(FILE_HEADER.size, 0)
            for row in self._block_headers(span):
                start = layout.block_start(row[1])
                yield (span.path, row[1], row[-1], head + handle.read_at(min(BLOCK_HEADER.size + TAG_SAMPLES, span.size - start), start))

    def _block_headers(self, span: Span):
        with _open(span.path) as handle:
            layout = Layout.read(handle)
            body, size = FILE_HEADER.size, max(layout.block_bytes, 1)
            first = max(1, -(-(span.start - body) // size) + 1)  # the blocks that start inside the span
            last = min(layout.nblocks, (span.stop - 1 - body) // size + 1)
            for block in range(first, last + 1):
                at = layout.block_start(block)
                if at + BLOCK_HEADER.size <= span.size and (self.blocks is None or block in self.blocks):
                    h = _flags(handle, layout, block)
                    yield (span.path, block, *h, bool(h[1] & 1))


def ready_blocks(path: str, known: int = 0) -> int:
    """Length of the leading run of blocks whose data bit is set, from a known count on."""
    with _open(path) as handle:
        size, layout = handle.size(), Layout.read(handle)
        n = known
        while n < layout.nblocks:
            if layout.block_start(n + 1) + layout.block_bytes > size or not _flags(handle, layout, n + 1)[1] & 1:
                break
            n += 1
        return n


class BlockStreamReader(DataSourceStreamReader):
    """Emits a block once it and all blocks before it are ready.

    The offset is the ready count per file.  ``max_blocks`` limits the new blocks
    of a trigger.  Spark does not tell a reader its start offset, so the limit
    also needs ``issued``, the last logged offset as JSON (see
    ``lacuna.streaming.volumes.growing_blocks``).
    """

    def __init__(self, options: dict):
        self.path = options["path"]
        self.batch = int(options.get("batch_bytes", 4 << 20))
        self.split = int(options.get("partition_bytes", 64 << 20))
        self.limit = int(options.get("max_blocks", 0))
        logged = options.get("issued")
        self.issued: dict[str, int] | None = json.loads(logged)["ready"] if logged else None

    def initialOffset(self) -> dict:
        return {"ready": {}}

    def latestOffset(self) -> dict:
        before = self.issued or {}
        room = self.limit if self.limit and self.issued is not None else None
        now = dict(before)
        for path, _ in _list(self.path):
            have = before.get(path, 0)
            count = ready_blocks(path, have)
            if room is not None:
                count = min(count, have + room)
                room -= count - have
            if count:
                now[path] = count
        self.issued = now
        return {"ready": now}

    def partitions(self, start: dict, end: dict):
        self.issued = dict(end["ready"])
        spans = []
        for path, last in sorted(end["ready"].items()):
            first = start["ready"].get(path, 0)
            if last <= first:
                continue
            with _open(path) as handle:
                size, layout = handle.size(), Layout.read(handle)
            lo, hi = layout.block_start(first + 1), layout.block_start(last + 1)
            spans += [Span(path, at, min(at + self.split, hi), size) for at in range(lo, hi, self.split)]
        return spans

    def read(self, span: Span):
        yield from _traces(span, None, self.batch)

    def commit(self, end: dict) -> None:
        self.issued = dict(end["ready"])


class BlockSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lacuna_blocks"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("table", "trace")]

    def reader(self, schema):
        return BlockReader(self.options)

    def streamReader(self, schema):
        return BlockStreamReader(self.options)


def register(spark) -> None:
    """Make ``lacuna_blocks`` known and allow its filter pushdown."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BlockSource)
