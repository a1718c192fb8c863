"""Ranked search: every test item against all documents, by branch and bound over document tries.

Documents are cut down to the terms that some item has (``vectors``), most frequent term
first, so that documents with the same common terms share a path of a trie.  A subtree is
a range of the sorted vectors.  For subtrees of a few sizes the trie keeps the largest
count of each term below them and the least length weight; together they bound the score
of every document in the subtree.  Each item walks the trie depth first, best bound first,
and leaves a subtree when its bound is under the tenth best score so far.
"""

from __future__ import annotations

import math
import re
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from lacuna.llm.common import LOWER, parts_for
from lacuna.session import ship, work_dir

#: Terms of items that are searched for in one pass over the documents; more items are more passes.
ITEM_TERMS = 1_000_000
#: Entries of the vectors that one trie holds; a task builds one trie after the other.
TRIE_ENTRIES = 2_000_000
#: Vectors of the subtrees that have bounds, coarse to fine.
SIZES = (4096, 512, 64, 8, 1)

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, h, terms) of every distinct row; two hashes name it."""
    rows = items.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).distinct()
    terms = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(TERM), F.lit(0))
    return rows.select("id", F.xxhash64("id", "text").alias("key"), F.xxhash64("text", F.lit("h"), "id").alias("h"),
                       terms.alias("terms")).where("size(terms) > 0")


def blocks_of(items: DataFrame, bound: int) -> list[DataFrame]:
    """Items dealt into blocks of at most ``bound`` terms, or of one item that has more by itself."""
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    count = parts_for(total, bound)
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("key", "h"), F.lit(count)))
        over = dealt.groupBy("block").agg(F.sum(F.size("terms")).alias("n"), F.count("*").alias("rows"))
        if over.where(f"n > {bound} and rows > 1").isEmpty():
            return [dealt.where(f"block = {b}") for b in range(count if total else 0)]
        count *= 2


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, counts) of ``docs`` (id, text): all terms counted in n, those of the vocabulary listed."""
    ship(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = StructType([docs.schema["id"], StructField("n", LongType()), StructField("terms", ArrayType(IntegerType())),
                         StructField("counts", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            n, ends, terms, counts, rows = [], [0], [], [], []
            for row, text in enumerate(batch.column("text")):
                words = _TERM.findall(text.as_py().encode("utf-8").translate(LOWER))
                if not words:
                    continue
                for word, count in Counter(words).items():
                    at = number.get(word)
                    if at is not None:
                        terms.append(at)
                        counts.append(count)
                rows.append(row)
                n.append(len(words))
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows, pa.int32())), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))], ["id", "n", "terms", "counts"])

    return docs.mapInArrow(run, schema)


def order_of(ident: object) -> tuple[bool, object]:
    """Ids in ascending order, null last."""
    return ident is None, ident


class Level:
    """The subtrees of one size: where they start, their least m, and the largest count of each of their terms."""

    def __init__(self, starts: np.ndarray, m: np.ndarray, term: np.ndarray, node: np.ndarray, count: np.ndarray) -> None:
        self.starts, self.m, self.count = starts, m, count
        self.nodes = len(starts)
        self.keys = term * self.nodes + node

    def bounds(self, low: int, high: int, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The highest score that a document below each of the nodes [low, high) can have."""
        out = np.zeros(high - low, dtype=np.int64)
        base = terms * self.nodes
        first, last = np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)
        sizes = last - first
        at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        node = self.keys[at] - np.repeat(base, sizes)
        tf = self.count[at]
        np.add.at(out, node - low, np.repeat(weights, sizes) * (1_000_000_000 * tf // (1000 * tf + 8 * self.m[node])))
        return out


class Trie:
    """Documents with equal vectors and lengths share a leaf, which keeps the ``k`` least ids."""

    def __init__(self, ids: list, n: np.ndarray, ends: np.ndarray, terms: np.ndarray, counts: np.ndarray, m: np.ndarray,
                 k: int) -> None:
        doc = np.repeat(np.arange(len(ids)), np.diff(ends))
        order = np.lexsort((terms, doc))
        path, tf = terms[order].astype(">u4"), counts[order].astype(">u4")
        cuts = ends.tolist()
        names = [(path[a:b].tobytes(), tf[a:b].tobytes(), x) for a, b, x in zip(cuts, cuts[1:], n.tolist(), strict=False)]
        leaves: dict[tuple, list[int]] = {}
        for i, name in enumerate(names):
            leaves.setdefault(name, []).append(i)
        sorted_names = sorted(leaves)
        heads = [leaves[name][0] for name in sorted_names]
        self.ids = [sorted((ids[i] for i in leaves[name]), key=order_of)[:k] for name in sorted_names]
        paths = [path[cuts[i]:cuts[i + 1]] for i in heads]
        shared = np.array([0, *map(_shared, paths, paths[1:])])
        leaf_m = m[heads]
        lengths = np.array([len(p) for p in paths], dtype=np.int64)
        term = np.concatenate(paths).astype(np.int64) if paths else np.zeros(0, np.int64)
        leaf = np.repeat(np.arange(len(paths)), lengths)
        count = np.concatenate([tf[cuts[i]:cuts[i + 1]] for i in heads]).astype(np.int64) if paths else term
        order = np.lexsort((leaf, term))
        term, leaf, count = term[order], leaf[order], count[order]
        ranges = [(0, len(paths))] if paths else []
        tops = []
        for size in SIZES:
            ranges = [part for whole in ranges for part in _subtrees(whole, shared, size)]
            tops.append(np.array([a for a, _ in ranges], dtype=np.int64))
        self.levels: list[Level] = []
        for starts in reversed(tops):
            node = np.searchsorted(starts, leaf, side="right") - 1
            new = np.flatnonzero(np.diff(term, prepend=-1) | np.diff(node, prepend=-1))
            term, leaf, node = term[new], leaf[new], node[new]
            count = np.maximum.reduceat(count, new) if len(new) else count
            self.levels.append(Level(starts, np.minimum.reduceat(leaf_m, starts), term, node, count))
        self.levels.reverse()
        self.leaves = len(paths)
        self.visited = 0

    def search(self, terms: np.ndarray, weights: np.ndarray, best: list[tuple[int, tuple]], k: int) -> None:
        """Put the item's best documents into ``best``: up to ``k`` of (minus score, id), in order."""
        if self.leaves:
            self._visit(0, 0, self.levels[0].nodes, terms, weights, best, k)

    def _visit(self, at: int, low: int, high: int, terms: np.ndarray, weights: np.ndarray, best: list, k: int) -> None:
        level = self.levels[at]
        bounds = level.bounds(low, high, terms, weights)
        self.visited += high - low
        for i in np.argsort(-bounds, kind="stable").tolist():
            bound = int(bounds[i])
            if bound <= 0 or (len(best) == k and bound < -best[-1][0]):
                return
            if at + 1 == len(SIZES):
                for ident in self.ids[low + i]:
                    insort(best, (-bound, order_of(ident)))
                del best[k:]
                continue
            start = int(level.starts[low + i])
            end = int(level.starts[low + i + 1]) if low + i + 1 < level.nodes else self.leaves
            below = next(d for d in range(at + 1, len(SIZES)) if SIZES[d] < end - start or d + 1 == len(SIZES))
            inner = self.levels[below].starts
            self._visit(below, *np.searchsorted(inner, (start, end)).tolist(), terms, weights, best, k)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many terms two vectors have in common from the root on."""
    size = min(len(a), len(b))
    apart = np.flatnonzero(a[:size] != b[:size])
    return int(apart[0]) if len(apart) else size


def _subtrees(whole: tuple[int, int], shared: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """The largest subtrees of at most ``size`` leaves in a range of leaves, in order."""
    todo = [whole]
    while todo:
        a, b = todo.pop()
        if b - a <= size:
            yield a, b
            continue
        inner = shared[a + 1:b]
        cuts = [a, *(np.flatnonzero(inner == inner.min()) + a + 1).tolist(), b]
        todo.extend(zip(cuts[-2::-1], cuts[:0:-1], strict=True))


def _search(found: DataFrame, items: list, rank: np.ndarray, weight: np.ndarray, docs: int, length: int, k: int) -> DataFrame:
    """(key, h, score, id): the best ``k`` documents of each item in every partition of ``found``."""
    spark = found.sparkSession
    questions = [(key, h, np.array(list(bag), dtype=np.int64), np.array(list(bag.values()), dtype=np.int64))
                 for key, h, bag in items]
    given = spark.sparkContext.broadcast((questions, rank, weight))
    schema = StructType([StructField("key", LongType()), StructField("h", LongType()), StructField("score", LongType()),
                         found.schema["id"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, place, worth = given.value
        best: list[list] = [[] for _ in asked]
        ident = None
        for batch in batches:
            ident = batch.schema.field("id").type
            for part in _slices(batch):
                n = part.column("n").to_numpy()
                lists = part.column("terms")
                ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
                terms = place[lists.flatten().to_numpy()]
                trie = Trie(part.column("id").to_pylist(), n, ends, terms, part.column("counts").flatten().to_numpy(),
                            25 + 75 * n * docs // length, k)
                for (_, _, words, times), top in zip(asked, best, strict=True):
                    trie.search(place[words], worth[words] * times, top, k)
        rows = [(key, h, -score, i[1]) for (key, h, _, _), top in zip(asked, best, strict=True) for score, i in top]
        if rows:
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], ident)], ["key", "h", "score", "id"])

    return found.mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows with at most ``TRIE_ENTRIES`` list entries together, or one row that has more."""
    ends = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros(0)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + TRIE_ENTRIES, side="right")))
        yield batch.slice(start, end - start)
        start = end


def search(docs: DataFrame, items: DataFrame, k: int = 10, *, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", bound: int = ITEM_TERMS) -> DataFrame:
    """(item_id, rank, id, score): the ``k`` best documents of each item with a score above 0.

    Equal scores go by id, null last.  Every row of ``docs`` is a document, repeated or not;
    equal rows of ``items`` are one item.  Null and empty texts have no terms, so they are
    never found and find nothing; an empty table on either side gives no rows.  Other
    columns are not read.  A long text is one vector; a long item may make a block of its own.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    asked = item_terms(items, item_col, item_text_col)
    found = []
    for block in blocks_of(asked, bound):
        bags = [(r.key, r.h, Counter(t.encode() for t in r.terms)) for r in block.select("key", "h", "terms").collect()]
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, _, bag in bags for t in bag}))}
        path = work_dir(spark, "ranked-vectors")
        vectors(rows, vocabulary).write.parquet(path)
        held = spark.read.parquet(path)
        docs_n, length = held.agg(F.count("*"), F.sum("n")).first()
        if not docs_n:
            continue
        frequency = np.zeros(len(vocabulary), dtype=np.int64)
        for r in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            frequency[r["term"]] = r["count"]
        order = np.lexsort((np.arange(len(frequency)), -frequency))
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        weight = np.array([math.floor(1000 * math.log((2 * docs_n + 2) / (2 * f + 1))) for f in frequency.tolist()],
                          dtype=np.int64)
        numbered = [(key, h, {vocabulary[t]: c for t, c in bag.items()}) for key, h, bag in bags]
        found.append(_search(held, numbered, rank, weight, docs_n, length, k))
    if not found:
        return spark.createDataFrame([], StructType([
            StructField("item_id", items.schema[item_col].dataType), StructField("rank", IntegerType()),
            StructField("id", docs.schema[id_col].dataType), StructField("score", LongType())]))
    place = F.row_number().over(Window.partitionBy("key", "h").orderBy(F.desc("score"), F.col("id").asc_nulls_last()))
    best = reduce(DataFrame.union, found).withColumn("rank", place).where(F.col("rank") <= k)
    named = asked.select(F.col("id").alias("item_id"), "key", "h")
    return best.join(named, ["key", "h"]).select("item_id", "rank", "id", "score")
