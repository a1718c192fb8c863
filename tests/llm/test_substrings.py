import hashlib

import numpy as np
import pytest

from lacuna.llm import substrings


def brute(rows):
    seen, out = set(), {}
    for i, t in rows:
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if (w := b[p:p + 100]) in seen:
                gone[p:p + 100] = b"\1" * 100
            else:
                seen.add(w)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, f in zip(b, gone, strict=True) if not f)).hexdigest())
    return out


def answers(df):
    return {r.id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_cover_has_every_distance():
    c = substrings.COVER.tolist()
    assert {(a - b) % substrings.MODULUS for a in c for b in c} == set(range(substrings.MODULUS))


def test_window_hashes_depend_on_the_bytes_only():
    data = np.frombuffer(np.random.default_rng(1).integers(0, 4, 300, dtype=np.uint8).tobytes() * 2, dtype=np.uint8)
    for size in (1, 28, 100):
        h = substrings.window_hashes(data, size)
        assert len(h) == 601 - size and (h[:300 - size] == h[300:600 - size]).all()
        assert len(set(h[:200].tolist())) == len({data[i:i + size].tobytes() for i in range(200)})


@pytest.mark.parametrize("size", [8 << 20, 30_000])
def test_matches_brute_force(docs, texts, size):
    assert answers(substrings.remove_repeats(docs, block_bytes=size)) == brute(sorted(texts.items()))


def test_repeats_within_and_across(spark):
    a, b = "".join(chr(97 + i * i % 26) for i in range(150)), "".join(chr(65 + i * 7 % 26) for i in range(130))
    rows = [(3, a + b + a), (1, "x" + a[:99]), (2, a[1:] + "é" * 60), (4, "z" * 500), (5, a + b + a), (6, "é" * 49), (7, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert answers(substrings.remove_repeats(df, block_bytes=300)) == brute(sorted(rows))
    kept = {r.id: bytes(r.kept) for r in substrings.remove_repeats(df, with_text=True).collect()}
    assert kept[5] == b"" and kept[7] == b"" and kept[4] == b"z"


def test_odd_rows(odd, none):
    got = substrings.remove_repeats(odd)
    assert got.count() == odd.count()
    rows = [((-1 if r.doc_id is None else r.doc_id), r.text or "") for r in odd.dropDuplicates(["doc_id", "text"]).collect()]
    want = brute(sorted(rows))
    assert {(-1 if k is None else k): v for k, v in answers(got).items()} == want
    assert substrings.remove_repeats(none).collect() == []
