import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lacuna.llm import ranked

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOWN = {c: c + 32 for c in range(65, 91)}


def bag(text):
    return Counter(WORDS.findall((text or "").translate(DOWN)))


def plain(docs, items, k=10):
    """The contract, word for word; ``docs`` and ``items`` are (id, text)."""
    bags = [(i, b) for i, b in ((i, bag(t)) for i, t in docs) if b]
    n, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        asked, scored = bag(text), []
        for i, b in bags:
            m = 25 + 75 * sum(b.values()) * n // length
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m))
                        for t, times in asked.items() if t in b)
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_matches_brute_force(spark, docs, texts):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r.item_id, r.text) for r in items.collect()]
    want = plain(list(texts.items()), rows)
    assert got(ranked.search(docs, items)) == want
    few = ranked.search(docs, items, bound=200)  # many blocks of items, one pass each
    assert got(few) == want


def test_copies_ties_and_repeated_terms(spark):
    docs = [(i, "red fox red") for i in range(300)] + [(i, f"red fox {i} dog") for i in range(300, 400)] + [
        (5, "red fox red"), (None, "dog dog dog"), (401, "Dog dog_dog!")]
    items = [(1, "red red dog"), (2, "fox"), (3, "nothing here"), (2, "399 398"), (4, "dog")]
    found = ranked.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                          spark.createDataFrame(items * 2, "item_id long, text string"), 7)
    assert got(found) == plain(docs, items, 7)


def test_odd_rows(odd, none, spark):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "The dog, the CAT"), (2, None), (3, ""), (None, "漢字 one"), (5, "1" * 3000), (6, "une souris " * 20_000)]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("id", F.lit("clash"))
    assert got(ranked.search(odd, asked)) == plain(rows, items)
    assert ranked.search(none, asked).collect() == []
    assert ranked.search(odd, asked.where("false")).collect() == []
    assert ranked.search(odd, asked.where("item_id = 3")).columns == ["item_id", "rank", "id", "score"]


def test_very_long_text(spark):
    docs = [(1, "alpha beta " * 150_000), (2, "alpha"), (3, "beta gamma")]
    items = [(1, "alpha gamma"), (2, "beta " * 1000)]
    found = ranked.search(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string"))
    assert got(found) == plain(docs, items)


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_prune(seed):
    rng = np.random.default_rng(seed)
    vectors = [np.unique(np.minimum(rng.zipf(1.3, 12), 400)) - 1 for _ in range(3000)]
    ends = np.concatenate(([0], np.cumsum([len(v) for v in vectors]))).astype(np.int64)
    terms, counts = np.concatenate(vectors), rng.integers(1, 9, ends[-1])
    n, m = rng.integers(5, 90, 3000), rng.integers(25, 200, 3000)
    m = 25 + n
    trie = ranked.Trie(list(range(3000)), n, ends, terms, counts, m, 10)
    weights = 1 + np.arange(400) ** 2
    for item in ([0, 1, 250], [3, 30, 300, 399], list(range(20))):
        asked = np.array(item)
        best = []
        before = trie.visited
        trie.search(asked, weights[asked], best, 10)
        scores = []
        for i, v in enumerate(vectors):
            tf = dict(zip(v.tolist(), counts[ends[i]:ends[i + 1]].tolist(), strict=True))
            scores.append((-sum(int(weights[t]) * (10**9 * tf[t] // (1000 * tf[t] + 8 * int(m[i]))) for t in item if t in tf), (False, i)))
        assert best == sorted(s for s in scores if s[0])[:10]
        assert trie.visited - before < 2 * trie.leaves
        for level in trie.levels:  # a bound is no less than the score of any document below
            bounds = level.bounds(0, level.nodes, asked, weights[asked])
            last = trie.levels[-1].bounds(0, trie.leaves, asked, weights[asked])
            node = np.searchsorted(level.starts, np.arange(trie.leaves), side="right") - 1
            assert (bounds[node] >= last).all()


def test_subtrees_share_their_path():
    paths = [np.array(p) for p in sorted([[1], [1, 2], [1, 2, 3], [1, 2, 4], [1, 5], [2], [2, 9], [3, 4, 5], [3, 4, 6]])]
    shared = np.array([0, *map(ranked._shared, paths, paths[1:])])
    assert list(ranked._subtrees((0, 9), shared, 4)) == [(0, 1), (1, 4), (4, 5), (5, 7), (7, 9)]
    assert list(ranked._subtrees((0, 9), shared, 5)) == [(0, 5), (5, 7), (7, 9)]
