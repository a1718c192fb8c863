"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

All in DataFrame functions.  A document is the set of digests of its paragraphs.  Each
digest goes to three cells of a sketch; a cell holds a count, the digests and their check
sums, both added by exclusive or.  The cells of two versions are subtracted, and cells
that then hold one digest are peeled until none is left: the peeled digests are the
difference.  When peeling sticks, the same is tried with a sketch four times larger, and
in the end with one sized for both sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.llm.blocks import keyed
from lacuna.llm.common import settle

#: Cells of the sketch that is a document's fingerprint, and of those tried when it is too small.
CELLS = 24
LARGER = (96, 384, 1536)
#: A paragraph is a line, or this many code points of a longer line.
PIECE = 200
ROUNDS = 40
#: One in so many digests is in the stratum that tells how large a difference is about.
STRATUM = 8

_CELL = "struct<c:int,n:int,k:bigint,v:bigint>"
_NONE = f"cast(array() as array<{_CELL}>)"
_KEYS = "cast(array() as array<bigint>)"


def digests(text: str) -> Column:
    """The set of paragraph digests of a text column; empty for a text without a paragraph."""
    pieces = f"flatten(transform(split({text}, '\\n+', -1), line -> regexp_extract_all(line, '(?s).{{1,{PIECE}}}', 0)))"
    return F.expr(f"array_distinct(transform({pieces}, piece -> xxhash64(piece)))")


def _three(key: str, count: str, m: str) -> str:
    """The three cells of a key, one in each third of a sketch of ``m`` cells."""
    return "array(" + ", ".join(
        f"named_struct('c', cast({t} * ({m} div 3) + pmod(xxhash64({key}, {t}), {m} div 3) as int), 'n', {count}, "
        f"'k', {key}, 'v', xxhash64({key}, 77))" for t in range(3)) + ")"


def _add(cells: str) -> str:
    """Cells with equal numbers added up, in order; cells that hold nothing are left out.

    Finished cells gather in chunks of 32, so that adding one never copies them all.
    """
    step = (
        "(s, x) -> if(s.cur.c = x.c, named_struct('done', s.done, 'part', s.part, 'cur', "
        "named_struct('c', x.c, 'n', s.cur.n + x.n, 'k', s.cur.k ^ x.k, 'v', s.cur.v ^ x.v)), "
        f"if(size(s.part) >= 31, named_struct('done', concat(s.done, array(concat(s.part, array(s.cur)))), 'part', {_NONE}, 'cur', x), "
        "named_struct('done', s.done, 'part', concat(s.part, array(s.cur)), 'cur', x)))")
    start = (f"named_struct('done', cast(array() as array<array<{_CELL}>>), 'part', {_NONE}, "
             "'cur', named_struct('c', -1, 'n', 0, 'k', 0L, 'v', 0L))")
    end = ("s -> filter(flatten(concat(s.done, array(concat(s.part, array(s.cur))))), "
           "y -> y.n <> 0 or y.k <> 0L or y.v <> 0L)")
    return f"aggregate(sort_array({cells}), {start}, {step}, {end})"


def _sketch(keys: str, m: str) -> str:
    return _add(f"flatten(transform({keys}, d -> {_three('d', '1', m)}))")


def cells(keys: str) -> Column:
    """The sketch of ``CELLS`` cells of a digest set: a document's fingerprint."""
    return F.expr(_sketch(keys, str(CELLS)))


def fingerprint(held: str) -> Column:
    """A sketch as text: number, count, digests and check sums of each cell in use."""
    cell = "concat_ws('.', x.c, x.n, lower(hex(x.k)), substring(lower(hex(x.v)), -8, 8))"
    return F.expr(f"array_join(transform({held}, x -> {cell}), ',')")


def _minus(a: str, b: str) -> str:
    """Cells of one sketch less those of another; cells that hold nothing are left out."""
    return _add(f"concat({a}, transform({b}, x -> named_struct('c', x.c, 'n', -x.n, 'k', x.k, 'v', x.v)))")


def _peeled(a: str, b: str, cells: str, m: str) -> str:
    """(left, right) keys in one set only, or null if peeling sticks."""
    def pure(count: int) -> str:
        return (f"array_distinct(transform(filter(s.cells, x -> x.n = {count} and x.v = xxhash64(x.k, 77)), x -> x.k))")

    gone = (f"flatten(concat(transform(p.l, q -> {_three('q', '-1', m)}), transform(p.r, q -> {_three('q', '1', m)})))")
    step = (f"(s, i) -> if(not s.live, s, transform(array(named_struct('l', {pure(1)}, 'r', {pure(-1)})), "
            "p -> if(size(p.l) + size(p.r) = 0, "
            "named_struct('cells', s.cells, 'left', s.left, 'right', s.right, 'live', false), "
            f"named_struct('cells', {_add(f'concat(s.cells, {gone})')}, 'left', concat(s.left, p.l), "
            "'right', concat(s.right, p.r), 'live', true)))[0])")
    start = f"named_struct('cells', {cells}, 'left', {_KEYS}, 'right', {_KEYS}, 'live', true)"
    whole = f"size(s.cells) = 0 and size({a}) - size(s.left) = size({b}) - size(s.right)"
    return (f"aggregate(sequence(1, {ROUNDS}), {start}, {step}, "
            f"s -> if({whole}, named_struct('left', s.left, 'right', s.right), null))")


def difference(a: str, b: str, cells_a: str, cells_b: str) -> Column:
    """Digests in only one of two digest sets, as (left, right), by sketches of growing size.

    The given fingerprints are tried first; with hardly an empty cell after subtraction
    they hold too many digests to peel and count as failed.  A larger sketch is passed
    over when the difference of one stratum of the digests says it must stick, too.  The last has eight
    cells for each digest of both sets; should even that one stick, which no data is
    known to cause, the sets themselves are compared.
    """
    first = (f"transform(array({_minus(cells_a, cells_b)}), held -> if(size(held) > {CELLS - 4}, null, "
             f"{_peeled(a, b, 'held', str(CELLS))}))[0]")
    one, two = (f"filter({x}, d -> d & {STRATUM - 1} = 0)" for x in (a, b))
    about = f"{STRATUM} * (size(array_except({one}, {two})) + size(array_except({two}, {one})))"
    larger = [f"if({about} > {m}, null, {_peeled(a, b, _minus(_sketch(a, m), _sketch(b, m)), m)})" for m in map(str, LARGER)]
    last = f"(24 * (1 + size({a}) + size({b})) div 3)"
    tries = ", ".join([first, *larger, _peeled(a, b, _minus(_sketch(a, last), _sketch(b, last)), last)])
    return F.expr(f"coalesce({tries}, named_struct('left', array_except({a}, {b}), 'right', array_except({b}, {a})))")


def likeness(a: str, b: str, apart: str) -> Column:
    """Shared digests over all digests of two sets (0 to 1); 1 if both are empty."""
    d = f"(size({apart}.left) + size({apart}.right))"
    both = f"(size({a}) + size({b}))"
    return F.expr(f"if({both} = 0, 1D, cast({both} - {d} as double) / ({both} + {d}))")


def successors(rows: DataFrame) -> DataFrame:
    """(id, key, h, n, next_key, next_h): the next row in order of id, then key; after the last the first.

    Ids are dealt into ranges; a range is ordered by itself, and only the first rows of
    the ranges meet in one place.
    """
    keys = settle(rows.select("id", "key", "h", F.length("text").alias("n")).distinct().repartitionByRange("id", "key")
                  .withColumn("part", F.spark_partition_id()))
    firsts = keys.groupBy("part").agg(F.min(F.struct("id", "key", "h")).alias("first"))  # one row a partition
    along = Window.orderBy("part")
    turns = firsts.select("part", F.coalesce(F.lead("first").over(along), F.min_by("first", "part").over(
        Window.partitionBy())).alias("turn"))
    inside = F.lead(F.struct("id", "key", "h")).over(Window.partitionBy("part").orderBy("id", "key"))
    return (keys.withColumn("inside", inside).join(F.broadcast(turns), "part")
            .withColumn("next", F.coalesce("inside", "turn"))
            .select("id", "key", "h", "n", F.col("next.key").alias("next_key"), F.col("next.h").alias("next_h")))


def versions(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, edited, own, changed, following): every text, edited, with the digest sets of both and of the next.

    ``edited`` has the last quarter of the code points replaced by the first as many, or
    all, of the next row's.  A null text is empty.  Rows are in order of id (nulls
    first), equal ids in a fixed order; rows equal in id and text count once in that
    order and are all answered.  A single row is its own next.  The texts are shuffled
    once, by their own key; a second shuffle moves only the quarters that replace.
    """
    rows = keyed(docs, id_col, text_col)
    texts = rows.select("text", "key", "h")  # the same columns on both sides, so that Spark reuses the exchange
    wanted = successors(rows).select("id", F.col("key").alias("for_key"), F.col("h").alias("for_h"), F.expr("n div 4").cast("int").alias("k"),
                                     F.col("next_key").alias("key"), F.col("next_h").alias("h"))
    heads = (texts.join(wanted, ["key", "h"])
             .select("id", "for_key", "for_h", F.expr("left(text, k)").alias("head"), digests("text").alias("following"))
             .groupBy(F.col("for_key").alias("key"), F.col("for_h").alias("h"))
             .agg(F.first("id").alias("id"), F.first("head").alias("head"), F.first("following").alias("following")))
    return (texts.join(heads, ["key", "h"]).withColumn("n", F.length("text"))
            .withColumn("edited", F.expr("concat(left(text, cast(n - n div 4 as int)), head)"))
            .select("id", "n", "edited", digests("text").alias("own"), digests("edited").alias("changed"), "following"))
