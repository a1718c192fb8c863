import random
import sys

import numpy as np
import pytest

from .conftest import FOLDER, root

sys.path.insert(0, str(root()))
import corpus_pipeline  # noqa: E402

from lacuna.llm import simhash  # noqa: E402


def brute_groups(texts):
    """Least index of each text's group at exact Jaccard 4/5 on five-word shingles."""
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({" ".join(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    top = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or 9 * both >= 4 * (len(sets[i]) + len(sets[j])) > 0:
                a, b = sorted((top[i], top[j]))
                top = [a if x == b else x for x in top]
    return top


def stage(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()


@pytest.fixture(scope="module")
def copies():
    """Originals of many lengths, each with copies of one to many changed words, chains, and copies of copies."""
    rng, out = random.Random(11), []
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    for size in (1, 3, 5, 12, 30, 60, 100, 100, 400, 800):
        base = [word() for _ in range(size)]
        out.append(" ".join(base))
        for edits in (1, 1, 2, 3, 8):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(size)] = word()
            out.append(" ".join(w))
        for _ in range(3):
            base = [*base[2:], word(), word()]
            out.append(" ".join(base))
    return [*out, "", None, *out[:20]]


def test_stage_equals_brute_force(spark, copies):
    top = brute_groups(copies)
    assert len(set(top)) < len(set(copies)) - 20
    got = stage(spark, [(i, t, "en", "s", 0) for i, t in enumerate(copies)])
    assert sorted(r.doc_id for r in got) == sorted(set(top))
    assert all(r.text == copies[r.doc_id] for r in got)


def test_given_table_equals_brute_force(spark, texts):
    ids = sorted(texts)
    top = brute_groups([texts[i] for i in ids])
    found = simhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), shingle=5)
    assert {r.id: r.component for r in found.collect()} == {i: ids[t] for i, t in zip(ids, top, strict=True)}


def test_large_group_of_near_copies(spark):
    rng = np.random.default_rng(2)
    base = [f"w{k}" for k in rng.integers(0, 1000, 100)]
    rows = []
    for i in range(400):
        w = list(base)
        w[rng.integers(100)] = f"x{i}"
        rows.append((i, " ".join(w), "en", "s", 0))
    assert [r.doc_id for r in stage(spark, rows)] == [0]


def test_rows_are_kept_by_text_not_by_id(spark):
    """Null and repeated ids."""
    text = {k: " ".join(f"{k}{i}" for i in range(50)) for k in "abcdef"}
    near = " ".join([*text["a"].split()[:-1], "z"])
    rows = [(None, text["b"], "en", "s", 0), (None, text["c"], "en", "s", 0), (None, near, "en", "s", 0), (1, text["a"], "en", "s", 0),
            (2, text["d"], "en", "s", 0), (2, text["e"], "en", "s", 0), (2, text["e"], "en", "s", 0), (None, text["b"], "en", "s", 0),
            (None, None, "en", "s", 0), (None, text["f"], None, "s", 0), (None, text["f"], "en", None, 0)]
    got = stage(spark, rows)
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted(
        [("None", text["b"]), ("None", text["c"]), ("1", text["a"]), ("2", text["d"]), ("2", text["e"]), ("None", "None"),
         ("None", text["f"])])


def test_pairs_grow_with_the_rows(spark, monkeypatch):
    """A large group of near copies, and a passage that stands in every row: far fewer pairs than all."""
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in rng.integers(0, 1000, 120)]
    passage = " ".join(f"p{k}" for k in range(30))
    texts = []
    for i in range(800):
        w = list(base)
        w[rng.integers(0, 120)] = f"x{i}"
        texts.append(f"{passage} {' '.join(w)}")
    texts += [f"{passage} {' '.join(f'u{k}' for k in rng.integers(0, 10**9, 60))}" for _ in range(800)]
    counted, compare = [], simhash._compared

    def counting(pairs, sets):
        pairs = simhash.settle(pairs)
        counted.append(pairs.count())
        return compare(pairs, sets)

    monkeypatch.setattr(simhash, "_compared", counting)
    kept = stage(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    assert sorted(r.doc_id for r in kept) == [0, *range(800, 1600)]
    assert sum(counted) <= 4 * len(texts)


def test_sets_that_meet_in_the_grid_are_compared_first(spark, copies, monkeypatch):
    """The stage takes its first pairs from the fingerprints: one for every set that has another within 2 bits."""
    asked, compare = [], simhash._compared

    def noting(pairs, sets):
        pairs = simhash.settle(pairs)
        asked.append(({(r.a, r.b) for r in pairs.collect()}, {r.node: r for r in sets.collect()}))
        return compare(pairs, sets)

    monkeypatch.setattr(simhash, "_compared", noting)
    kept = stage(spark, [(i, t, "en", "s", 0) for i, t in enumerate(copies)])
    assert sorted(r.doc_id for r in kept) == sorted(set(brute_groups(copies)))
    pairs, sets = asked[0]
    assert all(r.fp == simhash.fingerprint([x % 2**64 for x in r.hashes]) for r in sets.values())
    apart = lambda a, b: ((sets[a].fp ^ sets[b].fp) % 2**64).bit_count()
    assert pairs and all(a != b and apart(a, b) <= 2 for a, b in pairs)
    linked = {n for p in pairs for n in p}
    assert linked == {a for a in sets if any(a != b and apart(a, b) <= 2 for b in sets)}
    assert len({a for a, _ in pairs}) == len(pairs)
