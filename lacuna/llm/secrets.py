"""Secret scans by a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression.  From its syntax follow the strings that every match
must contain; their trigrams form a Boolean query (one conjunction for each choice of
strings).  An index from trigram to document, kept for the trigrams that some query
uses, gives each rule its candidates: the postings of a conjunction are intersected by
counting.  Candidates are then verified with the rule itself.  A rule without a mandatory
trigram scans all documents.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Strings followed through one rule at most; a rule with more choices keeps its shorter parts.
MAX_CHOICES = 64


@dataclass(frozen=True)
class Rule:
    """A match counts when ``group`` has ``least`` code points or more.

    ``pattern`` must read alike for Python, which takes it apart, and for Spark, which runs it.
    """

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    base: bool = False


#: The base rules first, in their order.  A run of one class with a least length is written with that length.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
)


def _choices(tree) -> tuple[set[str] | None, list[set[str]]]:
    """(every string the tree can be, or None if that is unknown; sets of strings of which one must occur)."""
    must: list[set[str]] = []
    run, exact = {""}, True  # strings since the last unknown piece
    for op, arg in tree:
        piece, inner = _piece(op, arg)
        must += inner
        if piece is not None and len(run) * len(piece) <= MAX_CHOICES:
            run = {a + b for a in run for b in piece}
        else:
            must.append(run)
            run, exact = piece or {""}, False
    must.append(run)
    return (run if exact else None), [m for m in must if m and all(len(x) >= 3 for x in m)]


def _piece(op, arg) -> tuple[set[str] | None, list[set[str]]]:
    if op is sre.LITERAL:
        return {chr(arg).lower()}, []
    if op is sre.IN and len(arg) <= 8 and all(o is sre.LITERAL for o, _ in arg):
        return {chr(c).lower() for _, c in arg}, []
    if op is sre.AT:
        return {""}, []
    if op is sre.SUBPATTERN:
        return _choices(arg[3])
    if op is sre.BRANCH:
        found = [_choices(x) for x in arg[1]]
        if all(s is not None for s, _ in found):
            return set().union(*(s for s, _ in found)), []
        best = [max(m, key=_worth, default=None) for _, m in found]
        return None, [set().union(*best)] if all(best) else []
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        low, high, body = arg
        one, inner = _choices(body)
        if one is not None and high != sre.MAXREPEAT and sum(len(one) ** n for n in range(low, high + 1)) <= MAX_CHOICES:
            return {"".join(p) for n in range(low, high + 1) for p in product(one, repeat=n)}, []
        return None, inner if low else []
    return None, []


def _worth(strings: set[str]) -> tuple[int, int]:
    return min(map(len, strings)), -len(strings)


def trigram_query(pattern: str) -> list[list[str]] | None:
    """Any of these lists, all trigrams of a list; None when no trigram is mandatory.

    Letters are folded to lower case on both sides, which can only add candidates.
    """
    _, must = _choices(parser.parse(pattern))
    if not must:
        return None
    return [sorted({x[i:i + 3] for i in range(len(x) - 2)}) for x in sorted(max(must, key=_worth))]


def postings(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """(trigram, key): the inverted index of ``docs`` (key, text) over the given trigrams."""
    terms = F.array(*map(F.lit, trigrams))
    held = F.transform(F.array(F.lower("text")), lambda low: F.filter(terms, lambda t: F.contains(low, t)))[0]
    return docs.select("key", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, queries: dict[int, list[list[str]]]) -> DataFrame:
    """(key, rules): numbers of the rules whose query the document's postings satisfy."""
    spark = index.sparkSession
    rows = [F.struct(F.lit(r).alias("rule"), F.lit(c).alias("choice"), F.lit(len(terms)).alias("size"), F.lit(t).alias("trigram"))
            for r, q in queries.items() for c, terms in enumerate(q) for t in terms]
    wanted = spark.range(1).select(F.inline(F.array(*rows)))  # as large as the rules, whatever the data
    met = (index.join(F.broadcast(wanted), "trigram").groupBy("key", "rule", "choice", "size")
           .agg(F.count("*").alias("n")).where("n >= size"))
    return met.groupBy("key").agg(F.collect_set("rule").alias("rules"))


def _spans(rule: Rule, number: int) -> Column:
    """Matches of the rule in ``text`` as (start, number, end, kind), in code points."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all("text", pattern, F.lit(0))
    checked = F.regexp_extract_all("text", pattern, F.lit(rule.group)) if rule.group else found
    gaps = F.split("text", rule.pattern, -1)
    parts = F.zip_with(F.zip_with(found, F.slice(gaps, 1, F.greatest(F.size(found), F.lit(1))),
                                  lambda m, g: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"))),
                       checked, lambda x, c: F.struct(x["gap"].alias("gap"), x["size"].alias("size"),
                                                      (F.length(c) >= rule.least).alias("good")))
    none = F.expr("cast(array() as array<struct<start:int,number:int,end:int,kind:string>>)")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["size"]
        span = F.struct(start.alias("start"), F.lit(number).alias("number"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        return F.struct(end.alias("at"), F.when(x["good"], F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    walked = F.aggregate(F.filter(parts, lambda x: x["size"].isNotNull()),
                         F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(F.size(found) > 0, walked).otherwise(none)


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """(id, base, spans) for every row: matches as (start, number, end, kind), by start, then rule.

    ``base`` holds those of the base rules.  Null and empty texts have none.  Repeated
    rows are answered each for itself: the index names a row by a hash of id and text,
    and a shared hash could only add a candidate.  No rule, no span.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("id", "text"))
    queries = {n: q for n, r in enumerate(rules) if (q := trigram_query(r.pattern)) is not None}
    if queries:
        terms = sorted({t for q in queries.values() for terms in q for t in terms})
        rows = rows.join(candidates(postings(rows, terms), queries), "key", "left")
    else:
        rows = rows.withColumn("rules", F.lit(None).cast("array<int>"))
    none = F.expr("cast(array() as array<struct<start:int,number:int,end:int,kind:string>>)")
    each = [F.when(F.array_contains("rules", n), _spans(r, n)).otherwise(none) if n in queries else _spans(r, n)
            for n, r in enumerate(rules)]
    base = [n for n, r in enumerate(rules) if r.base]
    return rows.select("id", F.array_sort(F.concat(none, *each)).alias("spans")).select(
        "id", F.filter("spans", lambda s: s["number"].isin(base) if base else F.lit(False)).alias("base"), "spans")
