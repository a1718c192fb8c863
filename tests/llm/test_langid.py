import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from lacuna.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs.withColumn("held", F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    model = langid.learn(docs.where("not held"))
    got = langid.predict(docs.where("held"), model, with_row=True).select("lang", "score", "row.held", F.col("row.lang").alias("want")).collect()
    assert sum(r.lang == r.want for r in got) / len(got) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_mixture_finds_both_languages(spark, docs):
    by = {r.lang: r.text for r in docs.where("length(text) between 1500 and 4000").collect()}
    model = langid.learn(docs)
    df = spark.createDataFrame([(1, by["en"][:1200] + "\n" + by["de"][:1200])], "doc_id long, text string")
    row = langid.predict(df, model).first()
    assert set(row.languages) == {"en", "de"} and abs(sum(row.shares) - 1) < 1e-6 and 0.3 < row.score < 0.7


def test_only_the_text_counts(docs):
    model = langid.learn(docs)
    plain = {r.id: r.lang for r in langid.predict(docs, model).collect()}
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("src0")})
    assert {r.id: r.lang for r in langid.predict(other, model).collect()} == plain


def test_odd_rows(odd, none):
    model = langid.learn(odd)
    assert model[0] == ["en", "fr"]
    got = langid.predict(odd, model).collect()
    assert len(got) == odd.count()
    und = {r.id for r in got if r.lang == "und"}
    assert und == {3, 4, 5, 8, 9} and all(r.score == 0 for r in got if r.lang == "und")
    assert langid.predict(none, model).collect() == []
    empty = langid.learn(none)
    assert {r.lang for r in langid.predict(odd, empty).collect()} == {"und"}


def test_mixture_of_four_languages(spark, docs):
    by = {r.lang: r.text for r in docs.where("length(text) between 1500 and 4000").orderBy("doc_id").collect()}
    assert set(by) == {"en", "fr", "de", "es"}
    df = spark.createDataFrame([(1, "\n".join(t[:1000] for _, t in sorted(by.items())))], "doc_id long, text string")
    row = langid.predict(df, langid.learn(docs)).first()
    assert set(row.languages) == set(by) and min(row.shares) > 0.15 and abs(sum(row.shares) - 1) < 1e-6


def made_up(count, seed):
    """A model of ``count`` languages with an alphabet of six letters each, and a maker of words."""
    rng = np.random.default_rng(seed)
    sets = [[chr(0x4E00 + 6 * i + k) for k in range(6)] for i in range(count)]
    words = lambda i, n: " ".join("".join(rng.choice(sets[i], 5)) for _ in range(n))
    counts = np.stack([np.bincount(langid.trigrams([words(i, 2000)])[0], minlength=langid.BUCKETS) for i in range(count)], axis=1)
    return np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * langid.BUCKETS)).astype(np.float32), words


def test_sets_of_any_size():
    table, words = made_up(9, 1)
    texts = [" ".join(words(i, 40) for i in range(k)) for k in range(1, 10)]
    shares, _ = langid.mixtures(texts, table)
    assert [np.flatnonzero(s).tolist() for s in shares] == [list(range(k)) for k in range(1, 10)]


def test_a_small_part_is_reported():
    table, words = made_up(4, 2)
    shares, _ = langid.mixtures([words(0, 1000) + " " + words(2, 4)], table)
    assert np.flatnonzero(shares[0]).tolist() == [0, 2] and shares[0, 2] < 0.005


def test_small_part_is_listed_by_predict(spark):
    table, words = made_up(4, 2)
    df = spark.createDataFrame([(1, words(0, 1000) + " " + words(2, 4))], "doc_id long, text string")
    row = langid.predict(df, (["a", "b", "c", "d"], table)).first()
    assert row.languages == ["a", "c"] and row.shares[1] < 0.005


def plain_em(like, steps=20_000):
    share = np.full(like.shape[1], 1 / like.shape[1])
    for _ in range(steps):
        part = like * share
        share = (part / part.sum(axis=1, keepdims=True)).mean(axis=0)
    return share, float(np.log(like @ share).sum())


def mixture(likes):
    words = np.array([len(x) for x in likes])
    like = np.concatenate(likes)
    return langid._mixture(like, np.zeros(len(like)), np.repeat(np.arange(len(words)), words), np.cumsum(words) - words,
                           np.ones((len(words), like.shape[1])), words)


def test_proportions_of_related_languages():
    """Two languages that agree on most: few steps of expectation-maximisation stay near one half."""
    like = np.array([[1, 0.8]] * 600 + [[0.75, 1]] * 400)
    share, total, _ = mixture([like, like[:1], like[::-1][:400]])
    want, best = plain_em(like)
    assert share[0] == pytest.approx(want, abs=2e-3) and share[0, 0] == pytest.approx(0.80, abs=5e-3)
    assert best - 1e-4 <= total[0] <= best + 1e-9
    assert share[1, 0] > 0.999 and share[2, 1] > 0.999


@pytest.mark.parametrize("seed", range(5))
def test_proportions_match_plain_em(seed):
    rng = np.random.default_rng(seed)
    likes = [np.exp(rng.normal(0, rng.uniform(0.05, 2), (int(rng.integers(1, 300)), 5))) for _ in range(8)]
    share, total, slope = mixture(likes)
    assert share.sum(axis=1) == pytest.approx(np.ones(8)) and (share >= 0).all()
    for k, like in enumerate(likes):
        best = plain_em(like)[1]
        assert total[k] >= best - 1e-4 and total[k] + len(like) * np.log(slope[k].max()) >= best - 1e-9


def test_equal_languages_share_alike():
    share, total, _ = mixture([np.ones((50, 3))])
    assert share[0] == pytest.approx([1 / 3] * 3) and total[0] == pytest.approx(0)


def test_set_matches_a_search_of_all_sets():
    table, words = made_up(4, 5)
    rng = np.random.default_rng(8)
    texts = [" ".join(words(i, int(n)) for i, n in enumerate(rng.integers(0, 60, 4) * rng.integers(0, 2, 4)) if n) or words(0, 3)
             for _ in range(12)]
    shares, _ = langid.mixtures(texts, table)
    for text, got in zip(texts, shares, strict=True):
        bucket, first, _ = langid.trigrams([text])
        like = np.exp(np.add.reduceat(table[bucket], first, axis=0).astype(float))
        scores = {s: plain_em(like[:, s], 300)[1] - float(langid._penalty(len(s), np.array([len(like)]))[0])
                  for k in range(1, 5) for s in itertools.combinations(range(4), k)}
        assert tuple(np.flatnonzero(got).tolist()) == max(scores, key=scores.get)


def test_long_texts_are_read_whole_and_alone():
    assert list(langid.stretches([])) == [(0, 0)]
    assert list(langid.stretches([langid.CHARACTERS + 1, 5, langid.CHARACTERS, 1])) == [(0, 1), (1, 2), (2, 3), (3, 4)]
    table, words = made_up(3, 4)
    text = words(0, 100_000) + " " + words(1, 100_000)
    shares, _ = langid.mixtures([text], table)
    assert shares[0] == pytest.approx([0.5, 0.5, 0], abs=0.01)
