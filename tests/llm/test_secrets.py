import random
import re

from lacuna.llm import secrets

BASE = (("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24))


def brute(text):
    out = []
    for k, (_, pattern, group, least) in enumerate(BASE):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return sorted(out)


def test_trigram_queries():
    q = {r.kind: secrets.trigram_query(r.pattern) for r in secrets.RULES}
    assert q["hex"] is None and q["access"] == [["aki", "kia"]]
    assert ["ken", "oke", "tok"] in q["assign"] and len(q["assign"]) == 6
    assert secrets.trigram_query("ab") is None and secrets.trigram_query("(abc|.)x") is None
    assert secrets.trigram_query("(foo|bar)+x") == [["bar"], ["foo"]]


def test_base_matches_the_plain_patterns(spark, docs):
    rng = random.Random(7)
    bits = ["token", "secret", " ", "=", ":", '"', "abc", "é", "🙂", "0123456789abcdef", "AKIA", "ABCDEFGH1234", "API_KEY", "passwd", "x"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    df = docs.select("doc_id", "text").union(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(made)], "doc_id long, text string"))
    want = {r.doc_id: brute(r.text) for r in df.collect()}
    got = {r.id: [(s.start, s.number, s.end) for s in r.base] for r in secrets.scan(df).collect()}
    assert got == want and sum(map(bool, want.values())) > 100


def test_more_rules_find_more(spark):
    df = spark.createDataFrame([(1, "ghp_" + "a1B2" * 9 + " and -----BEGIN RSA PRIVATE KEY-----"), (2, "ghp_short")], "doc_id long, text string")
    got = {r.id: [s.kind for s in r.spans] for r in secrets.scan(df).collect()}
    assert got == {1: ["github", "pem"], 2: []}


def test_odd_rows(odd, none):
    rows = secrets.scan(odd).collect()
    assert len(rows) == odd.count()
    want = {r.doc_id: brute(r.text) for r in odd.collect()}
    assert {r.id: [(s.start, s.number, s.end) for s in r.base] for r in rows} == want
    assert secrets.scan(none).collect() == []
    assert all(r.spans == [] for r in secrets.scan(odd, rules=()).collect())


def test_no_python_in_the_plan(odd):
    plan = secrets.scan(odd)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
