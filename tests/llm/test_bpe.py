import hashlib
import random

import numpy as np
import public_tokenizers as P
import tiktoken

from lacuna.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
REF = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_matches_the_library(texts):
    codec = bpe.Codec(RANKS, bpe.Merges(RANKS), P.PATTERN)
    rng = random.Random(1)
    given = list(texts.values()) + ["", "a" * 5000, "ab" * 3000, " " * 3000, "🙂é漢" * 200, "<|endoftext|>"]
    given += ["".join(rng.choice("abAB aaa  \n\té漢1'st") for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    got = codec.encode(given)
    assert got == REF.encode_ordinary_batch(given)
    assert [codec.decode(x).decode() for x in got] == given


def test_one_word_and_common_replay_agree():
    merges = bpe.Merges(RANKS)
    rng = random.Random(2)
    words = [bytes(rng.choice(b"ehtinaosr\xc3\xa9") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    assert bpe.replay(words, merges) == [bpe.replay_one(w, merges) for w in words]


def test_vocabulary_with_a_token_before_its_parts():
    ranks = {bytes([b]): b + 10 for b in range(256)} | {b"abc": 0, b"ab": 1, b"bca": 2, b"aa": 3}
    ref = tiktoken.Encoding("x", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
    merges = bpe.Merges(ranks)
    rng = random.Random(3)
    words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 14))) for _ in range(500)]
    whole = [[ranks[w]] if w in ranks else bpe.replay([w], merges)[0] for w in words]
    assert whole == [ref.encode_ordinary(w.decode()) for w in words]


def test_odd_rows(odd, none):
    rows = bpe.round_trip(odd, PATH, P.PATTERN, with_ids=True, keep=["id", "row"]).collect()
    assert len(rows) == odd.count()
    want = {r.doc_id: r.text or "" for r in odd.collect()}
    for r in rows:
        ids = REF.encode_ordinary(want[r.id])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(want[r.id].encode()).hexdigest()
    assert bpe.round_trip(none, PATH, P.PATTERN).collect() == []
    coded = bpe.encode(odd, PATH, P.PATTERN)
    assert {r.id: r.data.decode() for r in bpe.decode(coded, PATH, P.PATTERN).collect()} == want
