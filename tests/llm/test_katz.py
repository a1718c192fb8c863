import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lacuna.llm import blocks, katz


class Brute:
    def __init__(self, rows):
        self.one, self.two, self.head = Counter(), Counter(), Counter()
        for t in rows:
            h = "<s>"
            for w in self.tokens(t):
                self.one[w] += 1
                self.two[h, w] += 1
                self.head[h] += 1
                h = w
        ranked = [np.array([sum(v == r for v in c.values()) for r in range(1, 7)]) for c in (self.one, self.two)]
        self.d1, self.d2 = map(katz.discounts, ranked)
        self.n = sum(self.one.values())
        self.p = {w: self.d1[min(c, 6)] * c / self.n for w, c in self.one.items()}
        self.unknown = 1 - sum(self.p.values())
        self.after = defaultdict(dict)
        for (h, w), c in self.two.items():
            self.after[h][w] = c
        self.cache = {}

    @staticmethod
    def tokens(text):
        return [*re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower()), None]

    def log(self, h, w):
        alone = self.p.get(w, self.unknown)
        if h not in self.after:
            return math.log10(alone)
        if h not in self.cache:
            mass = sum(self.d2[min(c, 6)] * c / self.head[h] for c in self.after[h].values())
            keep = self.head[h] / (self.head[h] + 1) if 1 - mass < 1e-12 else 1.0
            self.cache[h] = keep, (1 - mass * keep) / (1 - sum(self.p[x] for x in self.after[h]))
        keep, weight = self.cache[h]
        c = self.after[h].get(w, 0)
        return math.log10(keep * self.d2[min(c, 6)] * c / self.head[h] if c else weight * alone)


@pytest.mark.parametrize("size", [8 << 20, 60_000])
def test_matches_brute_force(docs, texts, size):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    model = Brute(t for i, t in texts.items() if not held[i])
    got = katz.score(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2, block_bytes=size).collect()
    assert len(got) == len(texts)
    for r in got:
        tokens = Brute.tokens(texts[r.id])
        assert r.held_out == held[r.id] and r.n_tokens == len(tokens) and r.train_tokens == model.n
        assert r.n_known == sum(w in model.one for w in tokens)
        assert r.base_score == pytest.approx(sum(math.log10((model.one[w] + 1) / (model.n + len(model.one) + 1)) for w in tokens))
        assert r.score == pytest.approx(sum(model.log(h, w) for h, w in zip(["<s>", *tokens], tokens, strict=False)))
    for h in ("<s>", b"the", b"of", b"~never~"):
        assert sum(10 ** model.log(h, w) for w in [*model.one, b"~unknown~"]) == pytest.approx(1)


def test_discounts_stay_inside():
    for ranked in ([0] * 6, [5, 0, 0, 0, 0, 0], [100, 40, 20, 10, 6, 4], [1, 9, 9, 9, 9, 9]):
        d = katz.discounts(np.array(ranked))
        assert d[6] == 1 and ((d[1:6] > 0) & (d[1:6] < 1)).all()


def test_odd_rows(odd, none):
    got = katz.score(odd, F.col("doc_id") == 2).collect()
    assert len(got) == odd.count()
    by = {r.id: r for r in got}
    assert by[3].n_tokens == by[4].n_tokens == by[9].n_tokens == 1 and by[3].score == by[4].score
    assert by[None].held_out and not by[3].held_out and all(r.score <= 0 for r in got)
    assert katz.score(none, F.lit(False)).collect() == []
    alone = katz.score(odd, F.lit(True)).collect()
    assert len(alone) == odd.count() and all(r.score == 0 and r.n_known == 0 for r in alone)


def test_a_frequent_history_is_dealt_over_the_buckets(spark):
    """No bucket is sent a large part of the pairs after one word, nor a number for each occurrence."""
    text = " ".join(f"the w{i}" for i in range(3000)) + " the same" * 3000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = blocks.keyed(df, "doc_id", "text").first()
    given = blocks.note_table([{"block": 0, "key": row.key, "h": row.h, "ord": 0, "flag": False}])
    rows = pa.table({"id": [1], "text": [text], "key": [row.key], "h": [row.h], "block": pa.array([0], pa.int32())})
    sent = katz.ask_counts(rows, given, 16).to_pylist()
    sizes = [len(katz.unpack(r["data"])[0]) for r in sent if r["flag"]]
    assert len(sizes) == 16 and max(sizes) < 2 * sum(sizes) / 16
    told = katz.answer_counts(blocks.note_table(sent)).to_pylist()
    totals = katz.Totals.of(katz.unpack(told[-1]["data"])[0])
    asked = katz.ask_histories(rows, blocks.note_table([*given.to_pylist(), *told[:-1]]), 1, totals).to_pylist()
    assert len(asked) == 1 and len(katz.unpack(asked[0]["data"])[0]) == 3003  # words as histories, "the", "same", start sign


def test_a_repeated_row_is_learned_each_time(spark):
    """Rows equal in id and text count as often as they stand there, over several blocks too."""
    rows = [(1, "the cat sat"), (1, "the cat sat"), (1, "the cat sat"), (2, "the dog sat"), (2, "a bird"), (7, "the cat ran"), (None, "")]
    rows += [(k, f"w{k % 7} the w{k % 3}") for k in range(10, 60)] * 2
    model = Brute([t for _, t in rows])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = katz.score(df, F.lit(False), block_bytes=200).collect()
    assert len(got) == len(rows) and {r.train_tokens for r in got} == {model.n}
    want = {(i, len(Brute.tokens(t)), round(sum(model.log(h, w) for h, w in zip(["<s>", *Brute.tokens(t)], Brute.tokens(t), strict=False)), 6))
            for i, t in rows}
    assert {(r.id, r.n_tokens, round(r.score, 6)) for r in got} == want
    bases = {(i, round(sum(math.log10((model.one[w] + 1) / (model.n + len(model.one) + 1)) for w in Brute.tokens(t)), 6)) for i, t in rows}
    assert {(r.id, round(r.base_score, 6)) for r in got} == bases
