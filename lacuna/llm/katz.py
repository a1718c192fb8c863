"""Katz backoff language model of order two, counted and evaluated in hash partitions.

A text is words and one end sign; the first word follows a start sign.  Seen word pairs
have Good-Turing discounted relative frequencies; what the discounts free goes to the
unseen words after the same history, in proportion to their own discounted frequencies,
with a weight that makes the sum over the vocabulary and the unknown word exactly one.
Words that occur in no training text share one unknown word.

Counts live in buckets of the hash: words by their own, pairs by the hash of both
words, so the pairs after a frequent word are dealt over all buckets.  One block is told
to own each pair; it adds the pair to what its history sums up to, and a history costs
one row of three numbers a block.  Scores are added up within the blocks; nothing is
broadcast but a few totals.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm import blocks
from lacuna.llm.blocks import Block, bucket_edges, mix, note_table
from lacuna.llm.common import LOWER, parts_for, settle

#: Counts above this are not discounted.
LIMIT = 5
_BASE = 0x2545F4914F6CDD1D
_CODES = np.random.default_rng(20250101).integers(0, 1 << 64, 256, dtype=np.uint64)
_LOWER = np.frombuffer(LOWER, dtype=np.uint8)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_END, _START = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes; numbers are stored byte by byte of their places, which packs them better."""
    flat = [(x.dtype.str, x.shape, np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes()) for x in arrays]
    return zstandard.compress(pickle.dumps(flat, protocol=5), 1)


def unpack(data: bytes) -> tuple[np.ndarray, ...]:
    return tuple(np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1).T)
                 .view(kind).reshape(shape) for kind, shape, raw in pickle.loads(zstandard.decompress(data)))


def rises(x: np.ndarray) -> np.ndarray:
    """Differences of rising hashes: some two bytes shorter each."""
    return np.diff(x, prepend=np.uint64(0))


def risen(x: np.ndarray) -> np.ndarray:
    return np.cumsum(x, dtype=np.uint64)


def small(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in the narrowest type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


class Tokens:
    """Token hashes of a block, texts end to end: ``token``, ``history`` and ``doc`` of each."""

    def __init__(self, block: Block) -> None:
        data, n = block.data, len(block.data)
        solid = ~_SPACE[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[block.starts[block.starts < n]] = True
        begin = np.flatnonzero(solid & (edge[:n] | ~np.concatenate(([False], solid[:-1]))))
        edge[:] = False
        edge[block.ends] = True
        finish = np.flatnonzero(solid & (edge[1:] | ~np.concatenate((solid[1:], [False])))) + 1
        power = np.full(n + 1, _BASE, dtype=np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        summed = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_CODES[_LOWER[data]] * power[:n], dtype=np.uint64)))
        shift = np.uint64(pow(_BASE, -n, 1 << 64))  # a word's hash must not depend on its place or on the block
        words = mix((summed[finish] - summed[begin]) * power[n - begin] * shift
                    + (finish - begin).astype(np.uint64) * _CODES[0])
        doc = np.searchsorted(block.ends, begin, side="right")
        count = len(block.sizes)
        per = np.bincount(doc, minlength=count)
        self.n_tokens = per + 1
        last = np.cumsum(self.n_tokens) - 1
        self.token = np.empty(len(words) + count, dtype=np.uint64)
        self.token[np.arange(len(words)) + doc] = words
        self.token[last] = _END
        self.history = np.concatenate(([_START], self.token[:-1])).astype(np.uint64)
        self.history[last - per] = _START
        self.doc = np.repeat(np.arange(count), self.n_tokens)
        self.train = ~block.flags[self.doc]
        self.copies = np.bincount([block.row_doc[k] for k in block.keys], minlength=count)[self.doc]


def pair_hash(history: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(history * np.uint64(0x9E3779B97F4A7C15) + (token ^ (token >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F))


def pairs_of(t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pair hashes in rising order, a place where each stands, and the pair of every token."""
    return np.unique(pair_hash(t.history, t.token), return_index=True, return_inverse=True)


def ask_counts(rows: pa.Table, given: pa.Table, buckets: int) -> pa.Table:
    """Distinct words of the block with their training counts, and distinct pairs with theirs."""
    block = Block(rows, given)
    t = Tokens(block)
    words, at = np.unique(t.token, return_inverse=True)
    copies = t.copies[t.train]
    counts = np.bincount(at[t.train], weights=copies, minlength=len(words)).astype(np.int64)
    pairs, _, pair = pairs_of(t)
    seen = np.bincount(pair[t.train], weights=copies, minlength=len(pairs)).astype(np.int64)
    out = []
    for flag, keys, n in ((False, words, counts), (True, pairs, seen)):
        out += [{"block": block.number, "bucket": k, "flag": flag, "data": pack(rises(keys[a:b]), small(n[a:b]))}
                for k, a, b in bucket_edges(keys, buckets)]
    return note_table(out)


def _ranked(counts: np.ndarray) -> np.ndarray:
    """How many have the counts 1 to LIMIT + 1."""
    return np.bincount(counts[counts <= LIMIT + 1], minlength=LIMIT + 2)[1:]


def answer_counts(sent: pa.Table) -> pa.Table:
    """Training counts of what each block asked for, whether it is the first to ask, and the bucket's totals (block -1)."""
    out, totals = [], []
    for flag in (False, True):
        rows = [r for r in sent.to_pylist() if r["flag"] == flag]
        parts = [unpack(r["data"]) for r in rows]
        if not parts:
            totals.append(np.zeros(LIMIT + 3, dtype=np.int64))
            continue
        keys = np.concatenate([risen(k) for k, _ in parts])
        distinct, first, at = np.unique(keys, return_index=True, return_inverse=True)
        own = np.zeros(len(keys), dtype=bool)
        own[first] = True
        counts = np.bincount(at, weights=np.concatenate([n for _, n in parts]), minlength=len(distinct)).astype(np.int64)
        totals.append(np.concatenate(([counts.sum(), np.count_nonzero(counts)], _ranked(counts))))
        cuts = np.cumsum([len(k) for k, _ in parts])[:-1]
        out += [{"block": r["block"], "bucket": r["bucket"], "flag": flag, "data": pack(small(x), np.packbits(o))}
                for r, x, o in zip(rows, np.split(counts[at], cuts), np.split(own, cuts), strict=True)]
    out.append({"block": -1, "bucket": -1, "data": pack(np.stack(totals))})
    return note_table(out)


def discounts(ranked: np.ndarray) -> np.ndarray:
    """Factor for each count from 0 to LIMIT + 1; the last stands for all larger.

    Good-Turing with Katz's correction; where the counts of counts give no factor
    between 0 and 1, half a count is taken off instead.
    """
    n = np.concatenate(([0], ranked)).astype(float)
    out = np.ones(LIMIT + 2)
    cut = (LIMIT + 1) * n[LIMIT + 1] / n[1] if n[1] else 1.0
    for r in range(1, LIMIT + 1):
        turing = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        factor = (turing - cut) / (1 - cut) if cut < 1 else 0.0
        out[r] = factor if 0 < factor < 1 else (r - 0.5) / r
    return out


@dataclass
class Totals:
    tokens: int
    words: int
    word_factors: np.ndarray
    pair_factors: np.ndarray
    unknown: float  # probability of the unknown word
    scale: float  # makes the words' probabilities and ``unknown`` add up to one

    @classmethod
    def of(cls, sums: np.ndarray) -> Totals:
        tokens, words, ranked = int(sums[0, 0]), int(sums[0, 1]), sums[0, 2:]
        factors = discounts(ranked)
        held = tokens - float(((1 - factors[1:LIMIT + 1]) * np.arange(1, LIMIT + 1) * ranked[:LIMIT]).sum())
        unknown = max(1 - held / tokens, 1 / (tokens + 1)) if tokens else 1.0
        return cls(tokens, words, factors, discounts(sums[1, 2:]), unknown, (1 - unknown) / held if held else 0.0)

    def word(self, counts: np.ndarray) -> np.ndarray:
        """Probability of words by their training count, without a history."""
        return np.where(counts > 0, self.word_factors[np.minimum(counts, LIMIT + 1)] * counts * self.scale, self.unknown)


class Counted:
    """A block's tokens with the training counts of its words and pairs, as the buckets told them."""

    def __init__(self, block: Block, replies: list[dict]) -> None:
        self.t = t = Tokens(block)
        told = {flag: [unpack(r["data"]) for r in sorted((r for r in replies if r["flag"] == flag), key=lambda r: r["bucket"])]
                for flag in (False, True)}
        none = np.zeros(0, dtype=np.int64)
        _, at = np.unique(t.token, return_inverse=True)
        self.known = np.concatenate([none, *(n for n, _ in told[False])]).astype(np.int64)[at]
        _, first, self.pair = pairs_of(t)
        self.count = np.concatenate([none, *(n for n, _ in told[True])]).astype(np.int64)
        self.own = np.concatenate([none, *(np.unpackbits(o, count=len(n)) for n, o in told[True])]).astype(bool)
        self.alone = self.known[first]  # of the pair's second word
        self.heads, self.head = np.unique(t.history[first], return_inverse=True)


def split_notes(given: pa.Table) -> tuple[pa.Table, list[dict], list[dict]]:
    """The places of the block's rows, what was told of words and pairs, and what was told of histories."""
    rows = given.to_pylist()
    told = [r for r in rows if r["ord"] is None]
    return (note_table([r for r in rows if r["ord"] is not None]), [r for r in told if r["flag"] is not None],
            [r for r in told if r["flag"] is None])


def ask_histories(rows: pa.Table, given: pa.Table, buckets: int, totals: Totals) -> pa.Table:
    """For each distinct history: training count, discounted count and words' probability over the pairs the block owns."""
    places, replies, _ = split_notes(given)
    block = Block(rows, places)
    c = Counted(block, replies)
    own = c.own & (c.count > 0)
    head, n, size = c.head[own], c.count[own], len(c.heads)
    total = np.bincount(head, weights=n, minlength=size).astype(np.int64)
    held = np.bincount(head, weights=totals.pair_factors[np.minimum(n, LIMIT + 1)] * n, minlength=size)
    alone = np.bincount(head, weights=totals.word(c.alone[own]), minlength=size)
    return note_table([{"block": block.number, "bucket": k, "data": pack(rises(c.heads[a:b]), small(total[a:b]), held[a:b], alone[a:b])}
                       for k, a, b in bucket_edges(c.heads, buckets)])


def answer_histories(sent: pa.Table) -> pa.Table:
    """Divisor of the discounted counts, and weight of the unseen words, for the histories each block asked for."""
    rows = sent.to_pylist()
    parts = [unpack(r["data"]) for r in rows]
    _, at = np.unique(np.concatenate([risen(p[0]) for p in parts]), return_inverse=True)
    total, held, alone = (np.bincount(at, weights=np.concatenate([p[k] for p in parts])) for k in (1, 2, 3))
    mass = held / np.maximum(total, 1)
    keep = np.where(1 - mass < 1e-12, total / (total + 1), 1.0)  # all counts large: one more, for the unseen
    weight = np.where(total > 0, (1 - mass * keep) / np.maximum(1 - alone, 1e-300), 1.0)
    scale = keep / np.maximum(total, 1)
    cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
    return note_table([{"block": r["block"], "bucket": r["bucket"], "data": pack(x, y)} for r, x, y in zip(
        rows, np.split(scale[at], cuts), np.split(weight[at], cuts), strict=True)])


def answer_documents(rows: pa.Table, given: pa.Table, totals: Totals) -> pa.Table:
    places, replies, histories = split_notes(given)
    block = Block(rows, places)
    c = Counted(block, replies)
    t, docs = c.t, len(block.sizes)
    told = [unpack(r["data"]) for r in sorted(histories, key=lambda r: r["bucket"])]
    scale, weight = (np.concatenate([x[k] for x in told])[c.head] for k in (0, 1))
    seen = totals.pair_factors[np.minimum(c.count, LIMIT + 1)] * c.count * scale
    log = np.log10(np.where(c.count > 0, seen, weight * totals.word(c.alone)))
    base = np.log10((c.known + 1) / (totals.tokens + totals.words + 1))
    at = np.array([block.row_doc[k] for k in block.keys], dtype=np.int64)
    sums = [np.bincount(t.doc, weights=x, minlength=docs)[at] for x in (c.known > 0, base, log[c.pair])]
    return pa.Table.from_arrays(
        [rows.column("id"), pa.array(block.flags[at]), pa.array(t.n_tokens[at]), pa.array(sums[0].astype(np.int64)),
         pa.array([totals.tokens] * len(at), pa.int64()), pa.array(sums[1]), pa.array(sums[2])],
        names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score(docs: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text",
          block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    The model is learned from the rows for which ``held_out``, over the columns of
    ``docs``, is false (null: true).  ``score`` is the model's log10 probability of the
    whole text, ``base_score`` that of add-one word counts; ``n_known`` counts the tokens
    that training texts hold.  A null or empty text is one end sign.  Every row is learned
    from, a repeated one as often as it stands there; rows equal in id and text are answered
    alike, and ``held_out`` must not tell them apart.  Without a training row every token has probability one.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(True)).alias("held"))
    rows = base.withColumns({"key": F.xxhash64("id", "text"), "h": F.xxhash64("text", F.lit("h"), "id")})
    with blocks.short_lived_shuffles(spark):
        known = settle(blocks.ordered(rows.withColumn("n", F.octet_length("text")), "held", "n"))
        parts = parts_for(known.agg(F.sum("n")).first()[0] or 0, block_bytes)
        number = F.pmod("key", F.lit(parts)).cast("int").alias("block")
        places = settle(blocks.notes(spark, known.select(number, "key", "h", "ord", F.col("held").alias("flag"))))
        rows = rows.drop("held").withColumn("block", number)
        sent = blocks.visit(rows, places, lambda r, g: ask_counts(r, g, parts), blocks.NOTES)
        told = settle(blocks.answered(sent, answer_counts))
    sums = np.zeros((2, LIMIT + 3), dtype=np.int64)
    for row in told.where("block = -1").select("data").toLocalIterator():
        sums += unpack(row[0])[0]
    totals = Totals.of(sums)
    given = places.union(told.where("block >= 0"))
    with blocks.short_lived_shuffles(spark):
        sent = blocks.visit(rows, given, lambda r, g: ask_histories(r, g, parts, totals), blocks.NOTES)
        weights = settle(blocks.answered(sent, answer_histories))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
              "score double")
    return blocks.visit(rows, given.union(weights), lambda r, g: answer_documents(r, g, totals), schema)
