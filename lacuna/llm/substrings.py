"""Exact-substring removal by difference-cover, bucket-wise sorting of suffixes.

A byte goes if some string of ``SPAN`` bytes around it also starts earlier.  Suffixes are
never sorted as a whole.  First the cover sample: positions whose place in the text is
in a difference cover modulo 73.  Any two equal strings of 100 bytes have, at one common
offset below 73, sample positions on both sides; the 28 bytes there are equal.  The
sample is ranked by those bytes, and only suffixes near a sample position whose rank
occurs again can be repeated.  Then these suffixes are sorted, one bucket of prefix
hashes at a time, by their first 100 bytes; ties are in order of document and start.
Buckets are of bounded size and hold no text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm import blocks
from lacuna.llm.blocks import Block, bucket_edges, mix, note_table, pack_places, pack_sorted, unpack_places, unpack_sorted
from lacuna.llm.common import parts_for, settle

SPAN = 100
MODULUS = 73
#: A perfect difference set: every distance modulo 73 lies between two of these.
COVER = np.array([1, 2, 4, 8, 16, 32, 37, 55, 64])
SAMPLE = SPAN - MODULUS + 1
_BASE = 0x5851F42D4C957F2D
_CODES = np.random.default_rng(20240607).integers(0, 1 << 64, 256, dtype=np.uint64)


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from every position (the last size - 1 positions are missing).

    Lengths are doubled; the bits of ``size`` say which lengths are joined.
    """
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    power, width = _CODES[data], 1
    out, have = None, 0
    while True:
        if size & width:
            if out is None:
                out, have = power.copy(), width
            else:  # out covers the last ``have`` bytes of the window
                out = power[:len(data) - width - have + 1] * np.uint64(pow(_BASE, have, 1 << 64)) + out[width:]
                have += width
        if have == size:
            return mix(out[:n])
        power = power[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + power[width:]
        width *= 2


def cover_positions(block: Block) -> np.ndarray:
    """Sample positions with ``SAMPLE`` bytes left, in texts that are not later copies."""
    place = np.arange(len(block.data)) - np.repeat(block.starts, block.sizes)
    left = np.repeat(block.ends, block.sizes) - np.arange(len(block.data))
    sampled = np.zeros(MODULUS, dtype=bool)
    sampled[COVER] = True
    return np.flatnonzero(sampled[place % MODULUS] & (left >= SAMPLE) & ~np.repeat(block.flags, block.sizes))


def sample_ranks(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    at = cover_positions(block)
    hashes = window_hashes(block.data, SAMPLE)[at]
    ranks, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    return at, ranks, inverse, counts


def ask_samples(rows: pa.Table, given: pa.Table, buckets: int) -> pa.Table:
    block = Block(rows, given)
    _, ranks, _, counts = sample_ranks(block)
    low = ranks.astype(np.uint32)
    return note_table([{"block": block.number, "bucket": k, "data": low[a:b].tobytes(),
                        "more": np.packbits(counts[a:b] > 1).tobytes()} for k, a, b in bucket_edges(ranks, buckets)])


def answer_samples(sent: pa.Table) -> pa.Table:
    """A bit for each rank: it occurs again, in this block or another."""
    rows = sent.to_pylist()
    parts = [np.frombuffer(r["data"], dtype=np.uint32) for r in rows]
    _, inverse, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    again = np.split(counts[inverse] > 1, np.cumsum([len(p) for p in parts])[:-1])
    return note_table([{"block": r["block"], "bucket": r["bucket"], "flag": False, "data": np.packbits(
        x | np.unpackbits(np.frombuffer(r["more"], dtype=np.uint8), count=len(x)).view(bool)).tobytes()}
        for r, x in zip(rows, again, strict=True)])


def suffixes(block: Block, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(positions that may be repeated, their distinct prefixes, index of each one's, first of each)."""
    at, ranks, inverse, _ = sample_ranks(block)
    again = block.reply_bits(False, len(ranks), bucket_edges(ranks, buckets))[inverse]
    hit = at[again]
    size = len(block.data)
    doc = np.searchsorted(block.ends, hit, side="right")
    change = np.zeros(size + 1, dtype=np.int32)
    np.add.at(change, np.maximum(hit - (MODULUS - 1), block.starts[doc]), 1)
    np.add.at(change, hit + 1, -1)
    left = np.repeat(block.ends, block.sizes) - np.arange(size)
    spots = np.flatnonzero((np.cumsum(change[:-1]) > 0) & (left >= SPAN))
    hashes = window_hashes(block.data, SPAN)[spots]
    prefixes, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    return spots, prefixes, which, first


def ask_suffixes(rows: pa.Table, given: pa.Table, buckets: int) -> pa.Table:
    block = Block(rows, given)
    spots, prefixes, _, first = suffixes(block, buckets)
    doc = np.searchsorted(block.ends, spots[first], side="right")
    return note_table([{"block": block.number, "bucket": k, "data": pack_sorted(prefixes[a:b]),
                        "more": pack_places(block.order, doc[a:b])} for k, a, b in bucket_edges(prefixes, buckets)])


def answer_suffixes(sent: pa.Table) -> pa.Table:
    """Sort the bucket; a bit for each suffix: an equal one stands in an earlier document."""
    rows = sent.to_pylist()
    parts = [unpack_sorted(r["data"]) for r in rows]
    prefix = np.concatenate(parts)
    doc = np.concatenate([unpack_places(r["more"]) for r in rows])
    order = np.lexsort((doc, prefix))
    tied = np.concatenate(([False], prefix[order][1:] == prefix[order][:-1]))
    later = np.empty(len(prefix), dtype=bool)
    later[order] = tied
    out = np.split(later, np.cumsum([len(p) for p in parts])[:-1])
    return note_table([{"block": r["block"], "bucket": r["bucket"], "flag": True, "data": np.packbits(x).tobytes()}
                       for r, x in zip(rows, out, strict=True)])


def removed_spans(block: Block, buckets: int) -> list[np.ndarray]:
    """(start, end) of every maximal run of removed bytes, a table for each document."""
    spots, prefixes, which, first = suffixes(block, buckets)
    later = block.reply_bits(True, len(prefixes), bucket_edges(prefixes, buckets))[which]
    here = np.ones(len(spots), dtype=bool)
    here[first] = False
    begin = spots[later | here]
    change = np.zeros(len(block.data) + 1, dtype=np.int32)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + SPAN, -1)
    gone = np.cumsum(change[:-1]) > 0
    out = []
    for a, b, copy in zip(block.starts.tolist(), block.ends.tolist(), block.flags.tolist(), strict=True):
        if copy:
            out.append(np.array([[0, b - a]] if b - a >= SPAN else [], dtype=np.int64).reshape(-1, 2))
        else:
            edges = np.flatnonzero(np.diff(np.concatenate(([False], gone[a:b], [False])).view(np.int8)))
            out.append(edges.reshape(-1, 2))
    return out


def answer_documents(rows: pa.Table, given: pa.Table, buckets: int, with_text: bool) -> pa.Table:
    block = Block(rows, given)
    spans = removed_spans(block, buckets)
    texts = rows.column("text")
    out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "spans": [], "kept": []}
    for i, k in enumerate(block.keys):
        own, data = spans[block.row_doc[k]].tolist(), texts[i].as_py().encode("utf-8")
        pieces, end = [], 0
        for a, b in own:
            pieces.append(data[end:a])
            end = b
        kept = b"".join([*pieces, data[end:]])
        out["n_bytes"].append(len(data))
        out["n_removed"].append(len(data) - len(kept))
        out["n_spans"].append(len(own))
        out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        out["spans"].append(own)
        out["kept"].append(kept)
    cols = [rows.column("id"), *(pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")),
            pa.array(out["kept_sha256"], pa.string())]
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if with_text:
        cols += [pa.array(out["spans"], pa.list_(pa.list_(pa.int64()))), pa.array(out["kept"], pa.binary())]
        names += ["spans", "kept"]
    return pa.Table.from_arrays(cols, names=names)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
                   block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) for every row; ``with_text`` adds the spans and the bytes kept.

    Earlier means a smaller id (nulls first; equal ids in a fixed order), or an earlier
    start in the same text.  Null and empty texts have no bytes.  Texts below 100 bytes
    lose none.  Rows equal in id and text are one document and get equal answers.
    Kept bytes need not be whole characters.
    """
    spark = docs.sparkSession
    rows = blocks.keyed(docs, id_col, text_col)
    with blocks.short_lived_shuffles(spark):
        known = settle(blocks.ordered(rows.withColumns({"m": F.md5("text"), "n": F.octet_length("text")}), "m", "n"))
        parts = parts_for(known.agg(F.sum("n")).first()[0] or 0, block_bytes)
        number = F.pmod("key", F.lit(parts)).cast("int").alias("block")
        firsts = known.groupBy("m").agg(F.min("ord").alias("first"))
        places = settle(blocks.notes(spark, known.join(firsts, "m").select(
            number, "key", "h", "ord", (F.col("ord") > F.col("first")).alias("flag"))))
        rows = rows.withColumn("block", number)
        sent = blocks.visit(rows, places, lambda r, g: ask_samples(r, g, parts), blocks.NOTES)
        told = settle(places.union(blocks.answered(sent, answer_samples)))
        sent = blocks.visit(rows, told, lambda r, g: ask_suffixes(r, g, parts), blocks.NOTES)
        told = settle(told.union(blocks.answered(sent, answer_suffixes)))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    if with_text:
        schema += ", spans array<array<bigint>>, kept binary"
    return blocks.visit(rows, told, lambda r, g: answer_documents(r, g, parts, with_text), schema)
