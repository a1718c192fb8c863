"""Language identification of mixed texts.

Each language is a smoothed distribution over hashed letter trigrams (with word ends),
counted over all labelled training rows.  A word's likelihood in a language is the
product over its trigrams; a document is a mixture whose proportions are found by
expectation-maximisation over its words, with extrapolated steps, until the log-likelihood
is proven to be within ``TOLERANCE`` of its maximum.  The set of languages is the one with the best
likelihood after a BIC penalty for each proportion.  Sets are nested, in order of the
proportions over all languages, and may be of any size: a text's larger sets are left
out only when a bound shows that the penalty outweighs any gain they could have.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.llm.common import map_batches
from lacuna.session import ship

#: Hashed trigrams a language; the model is languages x BUCKETS numbers.
BUCKETS = 1 << 16
#: Most languages a model may have (its size bound: 256 x 65,536 x 4 bytes).
MAX_LANGUAGES = 256
#: A text's proportions are done when its log-likelihood lacks at most this much of the maximum.
TOLERANCE = 1e-4
#: Characters that are looked at side by side; a longer text is taken alone.
CHARACTERS = 1 << 21


@cache
def _letters() -> np.ndarray:
    """Code point -> lower-case letter, 0 for what is no letter."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000 and (ch := chr(c)).isalpha():
            table[c] = ord(low) if len(low := ch.lower()) == 1 else c
    return table


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the trigram centred on every letter, the first letter of every word, and each word's text.

    Words are runs of letters; the two sides of a word count as one boundary sign.
    """
    raw = "\n".join(texts).encode("utf-32-le")
    code = _letters()[np.frombuffer(raw, dtype="<u4")].astype(np.uint64)
    code = np.concatenate(([0], code, [0])).astype(np.uint64)
    at = np.flatnonzero(code)
    mixed = (code[at - 1] * np.uint64(0x9E3779B97F4A7C15) ^ code[at] * np.uint64(0xC2B2AE3D27D4EB4F)
             ^ code[at + 1] * np.uint64(0x165667B19E3779F9))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    bucket = (mixed >> np.uint64(48)).astype(np.int64)
    first = np.flatnonzero(code[at - 1] == 0)
    ends = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(ends, at[first] - 1, side="right")
    return bucket, first, owner


def learn(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities [BUCKETS, languages]) of all rows with a text and a language.

    Counts are added up in each task before the shuffle, so a hot language costs one
    row a bucket and task.  Languages are in order of name.  No labelled row: no language.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                by: dict[str, list[str]] = {}
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    by.setdefault(lang, []).append(text)
                for lang, texts in by.items():
                    n = np.bincount(trigrams(texts)[0], minlength=BUCKETS)
                    sums[lang] = sums[lang] + n if lang in sums else n
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])],
                                             names=["lang", "bucket", "n"])

    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    counts = known.mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    langs: dict[str, np.ndarray] = {}
    for lang, at, n in counts.groupBy("lang").agg(F.collect_list("bucket"), F.collect_list("n")).toLocalIterator():
        if len(langs) == MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
        langs[lang] = np.zeros(BUCKETS)
        langs[lang][at] = n
    names = sorted(langs)
    table = np.stack([langs[x] for x in names], axis=1) if names else np.zeros((BUCKETS, 0))
    smooth = 0.5
    return names, np.log((table + smooth) / (table.sum(axis=0) + smooth * BUCKETS)).astype(np.float32)


def _mixture(like: np.ndarray, base: np.ndarray, owner: np.ndarray, starts: np.ndarray, allowed: np.ndarray,
             words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Proportions, log-likelihood and its slopes of each text over its ``allowed`` languages.

    The log-likelihood is concave in the proportions, so it is nowhere more than
    words * log(largest slope) above a point; each text is worked on until that is at most
    ``TOLERANCE``.  Two steps of expectation-maximisation are extrapolated (SQUAREM); an
    extrapolation that lowers the likelihood is taken back.
    """
    final = allowed / allowed.sum(axis=1, keepdims=True)
    total, slopes = np.empty(len(words)), np.empty_like(final)
    constant = np.add.reduceat(base, starts)
    ids = np.arange(len(words))
    share, back, reached = final.copy(), final.copy(), np.full(len(words), -np.inf)

    def look(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole = (like * at[owner]).sum(axis=1)
        return np.add.reduceat(like / whole[:, None], starts, axis=0) / words[:, None], np.add.reduceat(np.log(whole), starts)

    while len(ids):
        slope, value = look(share)
        worse = value < reached
        if worse.any():
            share[worse] = back[worse]
            slope, value = look(share)
        done = words * np.log(np.maximum((slope * allowed).max(axis=1), 1.0)) <= TOLERANCE
        if done.any():
            at = ids[done]
            final[at], total[at], slopes[at] = share[done], value[done] + constant[done], slope[done]
            left = ~done
            rows = left[owner]
            like, owner = like[rows], (np.cumsum(left) - 1)[owner[rows]]
            share, slope, value, back, allowed, constant, words, ids = (
                x[left] for x in (share, slope, value, back, allowed, constant, words, ids))
            starts = np.cumsum(words) - words
            if not len(ids):
                break
        one = share * slope
        two = one * look(one)[0]
        step, bend = one - share, two - 2 * one + share
        length = np.sqrt((step ** 2).sum(axis=1) / np.maximum((bend ** 2).sum(axis=1), 1e-300))[:, None]
        ahead = share + 2 * length * step + length ** 2 * bend
        ahead = np.where(ahead > 0, ahead, two * 1e-3)
        ahead, two = np.maximum(ahead, 1e-30 * allowed), np.maximum(two, 1e-30 * allowed)  # never 0, so that it can come back
        ahead /= ahead.sum(axis=1, keepdims=True)
        share, back, reached = np.where(length > 1, ahead, two), two, value
    return final, total, slopes


def _penalty(k: int, words: np.ndarray) -> np.ndarray:
    return 0.5 * (k - 1) * np.log(words + 1.0) + 2.0 * (k - 1)


def stretches(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours with at most ``CHARACTERS`` together, or of one."""
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > CHARACTERS:
            yield start, i
            start, held = i, 0
        held += size
    yield start, len(sizes)


def mixtures(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chosen proportions [texts, languages]; a row of zeros where there is no letter."""
    count = table.shape[1]
    out = np.zeros((len(texts), count))
    bucket, first, owner = trigrams(texts)
    if not len(first) or not count:
        return out, out.sum(axis=1)
    word = np.add.reduceat(table[bucket], first, axis=0).astype(np.float64)
    base = word.max(axis=1)
    like = np.exp(np.maximum(word - base[:, None], -200))
    present, starts, words = np.unique(owner, return_index=True, return_counts=True)
    row = np.searchsorted(present, owner)
    share, top, slope = _mixture(like, base, row, starts, np.ones((len(present), count)), words)
    # The log-likelihood is concave in the proportions, so its slopes here bound it everywhere.
    bound = top + words * np.log(slope.max(axis=1))
    rank = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1, kind="stable")
    best, gain = np.zeros_like(share), np.full(len(present), -np.inf)
    for k in range(1, count + 1):
        open_ = bound - _penalty(k, words) > gain
        if not open_.any():
            break
        at, some = np.flatnonzero(open_[row]), words[open_]
        share, score, _ = _mixture(like[at], base[at], np.repeat(np.arange(len(some)), some), np.cumsum(some) - some,
                                (rank[open_] < k).astype(np.float64), some)
        score = score - _penalty(k, some)
        better = score > gain[open_]
        chosen = np.flatnonzero(open_)[better]
        best[chosen], gain[chosen] = share[better], score[better]
    out[present] = best
    return out, out.max(axis=1)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], *, id_col: str = "doc_id", text_col: str = "text",
            with_row: bool = False) -> DataFrame:
    """(id, lang, score, languages, shares) for every row; ``with_row`` adds the whole row as ``row``.

    ``lang`` has the largest proportion and ``score`` is that proportion; ``languages``
    and ``shares`` are the chosen set.  A null text, a text without a letter, or a model
    without languages gives ``und``, 0 and empty lists.  Ties go to the first name.  A very
    long text is read whole, by itself.
    Only the text is looked at; repeated rows get equal answers.
    """
    names, table = model
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batch: dict[str, list]) -> dict[str, list]:
        given = [t or "" for t in (batch["text"] if not with_row else [r[text_col] for r in batch["row"]])]
        parts = [mixtures(given[a:b], shared.value) for a, b in stretches([len(t) for t in given])]
        shares, top = (np.concatenate(x) for x in zip(*parts, strict=True))
        best = shares.argmax(axis=1) if names else [0] * len(given)
        sets = [np.flatnonzero(s > 0) for s in shares]
        return batch | {
            "lang": [names[b] if t > 0 else "und" for b, t in zip(best, top, strict=True)],
            "score": [min(1.0, float(t)) for t in top], "languages": [[names[i] for i in s] for s in sets],
            "shares": [[float(r[i]) for i in s] for r, s in zip(shares, sets, strict=True)]}

    base = docs.select(F.col(id_col).alias("id"), F.struct("*").alias("row") if with_row else F.col(text_col).alias("text"))
    schema = T.StructType([*base.drop("text").schema, *T.StructType.fromDDL(
        "lang string, score double, languages array<string>, shares array<double>")])
    return map_batches(base, run, schema)
