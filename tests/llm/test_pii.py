import random
import re

from lacuna.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    out = []
    for kind, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m[0])
            good = {"email": True, "ip": name == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[name]
            if good:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_matches_the_plain_patterns(texts):
    rng = random.Random(4)
    given = list(texts.values()) + ["".join(rng.choice("a1@.+ -(2.0@b") for _ in range(80)) for _ in range(5000)]
    for t in given:
        assert sorted((a, k, b) for k, a, b in pii.base_spans(t)) == brute(t)


def test_crf_fits_its_table_and_new_text():
    model = pii.Crf()
    for line in pii.LABELLED.strip().split("\n"):
        words, tags = model._parse(line)
        assert model.decode([words])[0] == tags
    cases = {"my ssn is 321-54-9876 ok": [("idnum", "321-54-9876")], "call (917) 555-0123 today": [("localphone", "(917) 555-0123")],
             "mail joe (at) site (dot) org now": [("spelledmail", "joe (at) site (dot) org")], "chapter 14 page 3": [],
             "IBAN DE02 1203 0000 0000 2020 51 danke": [("iban", "DE02 1203 0000 0000 2020 51")]}
    got = pii.crf_spans(list(cases), model)
    assert [[(pii.KINDS[k], t[a:b]) for k, a, b in s] for t, s in zip(cases, got, strict=True)] == list(cases.values())


def test_windows_hold_every_marked_word(texts):
    for t in texts.values():
        inside = {p for w in pii.windows(t) for p in w}
        assert all(m.span() in inside for m in re.finditer(r"\S+", t) if re.search("[0-9]", m[0]))


def test_odd_rows(spark, odd, none):
    got = pii.find(odd).collect()
    assert len(got) == odd.count() and all(r.spans == r.base for r in got)
    assert pii.find(none).collect() == []
    df = spark.createDataFrame([(1, "mail a.b@c.de or +1 (555) 010-9999, ssn 321-54-9876 x", 1), (2, None, 2), (3, "clean", 3)],
                               "doc_id long, text string, spans int")
    out = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert out == {1: "mail <email> or <phone>, ssn <idnum> x", 2: None, 3: "clean"}


def test_long_texts_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "+1" + "." * 300_000, "a@" * 100_000, "1.2." * 50_000):
        pii.base_spans(t)
    pii.crf_spans(["a1" * 100_000, "1 " * 20_000], pii.Crf(rounds=1))


def test_a_shape_reads_the_whole_word():
    assert pii.shape("A-" * 25 + "x1") != pii.shape("A-" * 25 + "x%")
    assert pii.shape("abc" * 30 + "12") == "a99" and pii.shape("Ab" + "7" * 100) == "Aa9+"
    assert pii._features("1" * 70 + "-x") != pii._features("1" * 70 + "-%")
    assert pii._features("a" * 63 + "1") == pii._features("a" * 64 + "1")
