"""Byte-level BPE encoding by merge replay, and decoding.

A task holds a slice of the corpus.  The distinct words of the slice are laid out in one
symbol array; an inverted index lists, for every adjacent token pair, the positions
where it stands.  Merges are applied in rank order over all words at once: each merge
touches only the listed positions and their neighbours, and files the new pairs it
makes.  Words never interact, so any division of the corpus gives the same ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Sequence

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.llm.common import map_batches, pick

#: Words remembered between batches of a task; beyond it the memory starts anew.
CACHE_WORDS = 200_000
#: Longer words are not remembered.
CACHE_LENGTH = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from lines of base64 and rank.  The file is read on the driver; its size is the bound."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def pair_merges(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """(left id, right id) -> id, for every split of a token into two tokens."""
    find = ranks.get
    out = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = find(token[:cut]), find(token[cut:])
            if a is not None and b is not None:
                out[a, b] = rank
    return out


NONE = np.int32(1 << 30)


class Merges:
    """The merges of a vocabulary: a dictionary for single pairs, sorted keys for many at once."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.one = pair_merges(ranks)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = sorted((a << 32 | b, rank) for (a, b), rank in self.one.items())
        self.keys = np.array([k for k, _ in pairs], dtype=np.int64)
        self.ranks = np.array([r for _, r in pairs], dtype=np.int32)

    def many(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank made by each pair, ``NONE`` if it makes no token; negative symbols never do."""
        key = left << 32 | right & 0xFFFFFFFF
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)


def replay(words: list[bytes], merges: Merges) -> list[list[int]]:
    """Token ids of each word: every merge in rank order over all words together.

    ``where`` is the inverted index from a merge to the positions whose pair makes it,
    ``queue`` the merges with positions.  A merge is applied to all its positions at
    once, then only the pairs beside them are looked up and filed again; positions whose
    pair has changed since are skipped.  Two kinds of words are finished one at a time
    instead, in the same order of merges: where positions of one merge overlap (a run of
    one token), and where a merge makes a pair of a lower rank than its own.
    """
    if not words or not len(merges.keys):
        return [merges.single[np.frombuffer(w, dtype=np.uint8)].tolist() for w in words]
    lengths = np.array([len(w) for w in words])
    begins = np.concatenate(([0], np.cumsum(lengths + 1)))
    data = np.frombuffer(b"\0".join(words) + b"\0", dtype=np.uint8)
    symbol = merges.single[data]
    symbol[begins[1:] - 1] = -1  # parts the words
    n = len(symbol)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    made = np.concatenate((merges.many(symbol[:-1], symbol[1:]), [NONE]))
    where: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def file(spots: np.ndarray) -> None:
        spots = spots[made[spots] < NONE]
        if not len(spots):
            return
        spots = spots[np.argsort(made[spots], kind="stable")]
        ranks = made[spots]
        edges = np.flatnonzero(np.concatenate(([True], ranks[1:] != ranks[:-1])))
        for f, a, b in zip(ranks[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(spots)], strict=True):
            if f in where:
                where[f].append(spots[a:b])
            else:
                where[f] = [spots[a:b]]
                heapq.heappush(queue, f)

    file(np.arange(n))
    apart: set[int] = set()
    while queue:
        rank = heapq.heappop(queue)
        at = np.concatenate(where.pop(rank))
        at = np.sort(at[made[at] == rank])
        if not len(at):
            continue
        at = at[np.concatenate(([True], at[1:] != at[:-1]))]
        right = after[at]
        if len(at) > 1 and (clash := right[:-1] == at[1:]).any():
            _leave(at[:-1][clash], apart, begins, made)
            at = at[made[at] == rank]
            right = after[at]
        beyond, left = after[right], before[at]
        symbol[at] = rank
        symbol[right] = -2
        made[right] = NONE
        after[at] = beyond
        before[beyond] = at
        spots = np.concatenate((at, left[left >= 0]))
        fresh = merges.many(symbol[spots], symbol[after[spots]])
        made[spots] = fresh
        if (low := fresh <= rank).any():
            _leave(spots[low], apart, begins, made)
        file(spots)
    keep = symbol >= 0
    ends = np.concatenate(([0], np.cumsum(keep)))[begins].tolist()
    flat = symbol[keep].tolist()
    out = [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]
    for w in apart:
        out[w] = replay_one(words[w], merges)
    return out


def _leave(spots: np.ndarray, apart: set[int], begins: np.ndarray, made: np.ndarray) -> None:
    """Take the words at ``spots`` out of the common replay."""
    for w in np.unique(np.searchsorted(begins, spots, side="right") - 1).tolist():
        apart.add(w)
        made[begins[w]:begins[w + 1]] = NONE


def replay_one(word: bytes, merges: Merges) -> list[int]:
    """One word, lowest rank and leftmost position first, in n log n steps."""
    symbol = merges.single[np.frombuffer(word, dtype=np.uint8)].tolist()
    n = len(symbol)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    find = merges.one.get
    queue = [(rank, i) for i, pair in enumerate(zip(symbol, symbol[1:], strict=False)) if (rank := find(pair)) is not None]
    heapq.heapify(queue)
    while queue:
        rank, i = heapq.heappop(queue)
        j = after[i]
        if symbol[i] < 0 or j >= n or find((symbol[i], symbol[j])) != rank:
            continue
        k, p = after[j], before[i]
        symbol[i], symbol[j], after[i] = rank, -2, k
        if k < n:
            before[k] = i
            if (fresh := find((rank, symbol[k]))) is not None:
                heapq.heappush(queue, (fresh, i))
        if p >= 0 and (fresh := find((symbol[p], rank))) is not None:
            heapq.heappush(queue, (fresh, p))
    return [x for x in symbol if x >= 0]


class Codec:
    """Encoder of one task: remembers the ids of frequent short words."""

    def __init__(self, ranks: dict[bytes, int], merges: Merges, pattern: str) -> None:
        self.ranks, self.merges = ranks, merges
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.known: dict[str, list[int]] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        parts = [self.split(t) for t in texts]
        fresh: dict[str, list[int]] = {w: [] for p in parts for w in p if w not in self.known}
        if fresh:
            coded = [(w, w.encode("utf-8")) for w in fresh]
            whole = self.ranks.get
            rest = []
            for w, b in coded:  # a word that is itself a token is that token
                if (rank := whole(b)) is not None:
                    fresh[w] = [rank]
                else:
                    rest.append((w, b))
            for (w, _), ids in zip(rest, replay([b for _, b in rest], self.merges), strict=True):
                fresh[w] = ids
        self.known.update(fresh)
        get = self.known.__getitem__
        out = []
        for p in parts:
            ids: list[int] = []
            for w in p:
                ids += get(w)
            out.append(ids)
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        else:
            for w in fresh:
                if len(w) > CACHE_LENGTH:
                    del self.known[w]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _each(docs: DataFrame, ranks_path: str, pattern: str, schema: T.StructType, answer) -> DataFrame:
    ranks = read_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, Merges(ranks)))
    return map_batches(docs, answer, schema, setup=lambda: Codec(*shared.value, pattern), rows=1000)


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): token ids of every row's whole text, without special tokens.

    Null and empty texts have no ids.  Repeated rows are encoded each for itself.
    """
    base = pick(docs, id_col, text_col)
    schema = T.StructType([base.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return _each(base, ranks_path, pattern, schema,
                 lambda batch, codec: {"id": batch["id"], "ids": codec.encode(batch["text"])})


def decode(coded: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, data): the bytes of every row's ids; null ids are an empty list.  An unknown id fails the job."""
    base = coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    schema = T.StructType([base.schema["id"], T.StructField("data", T.BinaryType())])
    return _each(base, ranks_path, pattern, schema,
                 lambda batch, codec: {"id": batch["id"], "data": [codec.decode(x or []) for x in batch["ids"]]})


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
               keep: Sequence[str] = (), with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encodes, decodes the ids, and gives the digests.

    Both steps run in one pass; the ids leave the task only ``with_ids``.  ``keep`` names
    columns to carry along as fields of ``row``.
    """
    row = [F.struct(*keep).alias("row")] if keep else []
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *row)
    schema = T.StructType([*base.drop("text").schema, *T.StructType.fromDDL(
        "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)])

    def answer(batch: dict[str, list], codec: Codec) -> dict[str, list]:
        coded = codec.encode(batch["text"])
        sha = hashlib.sha256
        return batch | {"n_tokens": [len(x) for x in coded], "ids": coded,
                        "ids_sha256": [sha(np.array(x, dtype="<u4").tobytes()).hexdigest() for x in coded],
                        "decoded_sha256": [sha(codec.decode(x)).hexdigest() for x in coded]}

    return _each(base, ranks_path, pattern, schema, answer)
