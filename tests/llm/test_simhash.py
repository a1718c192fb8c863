import random

import numpy as np
import xxhash

from lacuna.llm import simhash
from lacuna.llm.graph import connected_components


def brute_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").split(" ") if w]
    parts = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(prints):
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and bin(prints[i] ^ prints[j]).count("1") <= 2:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return {i: top(i) for i in ids}


def test_matches_brute_force(docs, texts):
    got = simhash.near_duplicates(docs).collect()
    prints = {r.id: r.fp & (1 << 64) - 1 for r in got}
    assert all(prints[i] == brute_print(t) for i, t in texts.items())
    assert {r.id: r.component for r in got} == brute_components(prints)


def test_links_in_crowded_cells(spark, monkeypatch):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = set(base)
    for b in base:
        for _ in range(40):
            fps.add(b ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    fps = {f - (1 << 64) if f >> 63 else f for f in fps}
    nodes = spark.createDataFrame([(f, simhash.cell_of(f)) for f in fps], "fp long, cell long")
    want = brute_components({f: f & (1 << 64) - 1 for f in fps})

    def classes(limit):
        monkeypatch.setattr(simhash, "CROWDED", limit)
        return {r.node: r.root for r in connected_components(simhash.links(nodes), "a", "b").collect()}

    for limit in (64, 3, 0):
        got = classes(limit)
        for f, g in want.items():
            assert got.get(f, f) == g


def test_lower_bound():
    rng = np.random.default_rng(3)
    for a, b in rng.integers(0, 1 << 63, (200, 2)):
        x, y = simhash.cell_of(int(a)), simhash.cell_of(int(b))
        steps = sum(abs((x >> 4 * i & 15) - (y >> 4 * i & 15)) for i in range(16))
        assert steps <= bin(int(a) ^ int(b)).count("1")


def test_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in connected_components(links, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_odd_rows(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.id, []).append(r)
    assert len(by[1]) == 2 and {r.component for r in by[1] + by[2]} == {1}
    assert {by[k][0].component for k in (3, 4, 9)} == {3} and by[3][0].fp == 0
    assert simhash.near_duplicates(none).collect() == []
