"""SimHash near-duplicates: segment-popcount embedding, grid range-join, exact check.

The 64 bits are cut into 16 segments of 4.  Flipping one bit moves one segment's bit
count by one, so the Manhattan distance of the count vectors never exceeds the Hamming
distance.  Two vectors within distance 2 have a common neighbour within distance 1 of
each; every fingerprint is therefore filed under its own cell and the cells one step
away, and only fingerprints that meet in a cell are compared exactly.

A radius is fixed for three-word shingles only.  For other sizes documents link at an
exact Jaccard similarity of their shingle sets (``similar``).  There too the sets that
meet in the grid are compared first.  Fingerprints of sets that similar may differ in
more bits than any grid reaches, so an exact way for the rest follows: such sets have
many of their first hashes in common.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.joins import measured_join
from lacuna.llm import blocks
from lacuna.llm.blocks import bucket_edges, keyed, note_table, pack_sorted, unpack_sorted
from lacuna.llm.common import map_batches, parts_for, pick, settle
from lacuna.llm.graph import connected_components
from lacuna.session import ship

#: Cells with more fingerprints than this are linked by shared one-bit variants instead of pairs.
CROWDED = 64


def shingle_hashes(data: bytes, size: int) -> list[int]:
    words = data.lower().split()  # ASCII only: A-Z, and the six ASCII white-space bytes
    if not words:
        return []
    h, flat = xxhash.xxh64_intdigest, b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(size, len(words)) - 1
    return [h(flat[a:b], 42) for a, b in zip(starts.tolist(), ends[last:].tolist(), strict=False)]


def fingerprint(hashes: list[int] | np.ndarray) -> int:
    """Majority bits as a signed 64-bit number; 0 for no shingle."""
    if not len(hashes):
        return 0
    bits = np.unpackbits(np.asarray(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int32) * 2 > len(hashes)
    return int(np.packbits(ones, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp, cell): SimHash and grid cell of every row.  A null or empty text has fingerprint 0."""

    def run(batch: dict[str, list]) -> dict[str, list]:
        fps = [fingerprint(shingle_hashes(t.encode("utf-8"), shingle)) for t in batch["text"]]
        return {"id": batch["id"], "fp": fps, "cell": [cell_of(x) for x in fps]}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(pick(docs, id_col, text_col), run, f"id {kind}, fp bigint, cell bigint")


def cell_of(fp: int) -> int:
    """Sixteen 4-bit counts packed in one number; every count is 4 at most."""
    x = fp & 0xFFFFFFFFFFFFFFFF
    x = (x & 0x5555555555555555) + (x >> 1 & 0x5555555555555555)
    return (x & 0x3333333333333333) + (x >> 2 & 0x3333333333333333)


def links(nodes: DataFrame) -> DataFrame:
    """Links between distinct fingerprints at 2 or fewer differing bits, enough to keep every component.

    Pairs are formed inside cells of at most ``CROWDED`` fingerprints.  In a fuller
    cell each fingerprint is tied to the least one that shares a one-bit variant with
    it: all that share a variant are within 2 bits of each other, so no link is lost
    or added and the work stays in proportion to the rows.
    """
    near = ", ".join(
        f"if(shiftrightunsigned(cell, {4 * i}) % 16 {test}, cell {sign} shiftleft(1L, {4 * i}), null)"
        for i in range(16) for sign, test in (("+", "< 4"), ("-", "> 0")))
    near = near.replace("% 16", "& 15")
    filed = nodes.select("fp", "cell", F.explode(F.expr(f"filter(array(cell, {near}), k -> k is not null)")).alias("key"))
    met = filed.withColumn("n", F.expr("count(*) over (partition by key)")).where("n > 1")
    left = met.where(f"n <= {CROWDED}").alias("x")
    right = met.where(f"n <= {CROWDED}").alias("y")
    same = "(x.cell <> y.cell or x.key = x.cell)"  # vectors that agree share 33 cells; compare them in one
    pairs = (left.join(right, F.expr(f"x.key = y.key and x.fp < y.fp and {same} and bit_count(x.fp ^ y.fp) <= 2"))
             .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")))
    flips = ", ".join(f"fp ^ shiftleft(1L, {i})" for i in range(64))
    crowd = (met.where(f"n > {CROWDED}").select("fp").distinct()
             .select("fp", F.explode(F.expr(f"array(fp, {flips})")).alias("variant")))
    stars = crowd.join(crowd.groupBy("variant").agg(F.min("fp").alias("least"), F.count("*").alias("n"))
                       .where("n > 1").drop("n"), "variant")
    return pairs.union(stars.where("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b")))


def _set(text: str, shingle: int) -> np.ndarray:
    """Distinct shingle hashes in rising order."""
    return np.unique(np.array(shingle_hashes(text.encode("utf-8"), shingle), dtype="<u8"))


def _depth(n: int | np.ndarray) -> int | np.ndarray:
    return np.maximum(1, n // 5)


def _head_size(n: int) -> int:
    """Two sets at Jaccard 4/5 or more have the ``_depth`` of the smaller in common among the first so many of each."""
    return n - (4 * n + 4) // 5 + int(_depth(n)) if n else 0


def _marked(rows: DataFrame, shingle: int) -> DataFrame:
    """(id, key, h, node, size, head): hash and size of each row's shingle set, and its first hashes.

    ``head`` has the upper five bytes of each hash: it serves to rule sets out, and a
    hash taken for another one can only keep a set in.
    """

    def run(batch: dict[str, list]) -> dict[str, list]:
        sets = [_set(t, shingle) for t in batch["text"]]
        heads = [x[:_head_size(len(x))].view(np.uint8).reshape(-1, 8)[:, 3:].tobytes() for x in sets]
        return {k: batch[k] for k in ("id", "key", "h")} | {
            "node": [xxhash.xxh64_intdigest(x.tobytes(), 7) - (1 << 63) for x in sets], "size": [len(x) for x in sets], "head": heads}

    kind = rows.schema["id"].dataType.simpleString()
    return map_batches(rows.select("id", "key", "h", "text"), run,
                       f"id {kind}, key bigint, h bigint, node bigint, size bigint, head binary")


def _heads(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a block's heads, end to end, and the row of each."""
    data = rows.column("head").to_pylist()
    wide = np.zeros((sum(map(len, data)) // 5, 8), dtype=np.uint8)
    wide[:, 3:] = np.frombuffer(b"".join(data), dtype=np.uint8).reshape(-1, 5)
    return wide.view("<u8").reshape(-1), np.repeat(np.arange(len(data)), [len(x) // 5 for x in data])


def _ask_heads(rows: pa.Table, buckets: int) -> pa.Table:
    hashes, n = np.unique(_heads(rows)[0], return_counts=True)
    number = rows.column("block")[0].as_py()
    return note_table([{"block": number, "bucket": k, "data": pack_sorted(hashes[a:b]), "more": np.packbits(n[a:b] > 1).tobytes()}
                       for k, a, b in bucket_edges(hashes, buckets)])


def _answer_heads(sent: pa.Table) -> pa.Table:
    """One bit for each hash: whether two or more sets sent it."""
    rows = sent.to_pylist()
    parts = [unpack_sorted(r["data"]) for r in rows]
    times = [1 + np.unpackbits(np.frombuffer(r["more"], dtype=np.uint8), count=len(p)) for r, p in zip(rows, parts, strict=True)]
    _, at = np.unique(np.concatenate(parts), return_inverse=True)
    shared = np.bincount(at, weights=np.concatenate(times))[at] > 1
    return note_table([{"block": r["block"], "bucket": r["bucket"], "data": np.packbits(x).tobytes()} for r, x in zip(
        rows, np.split(shared, np.cumsum([len(p) for p in parts])[:-1]), strict=True)])


def _keep_heads(rows: pa.Table, given: pa.Table, buckets: int) -> pa.Table:
    """The block's sets that have enough of their first hashes in common with other sets."""
    hashes, row = _heads(rows)
    distinct, at = np.unique(hashes, return_inverse=True)
    told = {g["bucket"]: g["data"] for g in given.to_pylist()}
    bits = [np.unpackbits(np.frombuffer(told[k], dtype=np.uint8), count=b - a) for k, a, b in bucket_edges(distinct, buckets)]
    shared = np.concatenate([np.zeros(0, dtype=np.uint8), *bits])[at]
    size = rows.column("size").to_numpy()
    least = _depth((4 * size + 4) // 5)
    keep = (np.bincount(row, weights=shared, minlength=len(size)) >= least) & (size > 0)
    return rows.select(["key", "h", "node"]).filter(pa.array(keep))


def _candidates(marks: DataFrame) -> DataFrame:
    """(key, h, node): one row for each set that may have a partner, settled."""
    spark = marks.sparkSession
    ship(spark)
    with blocks.short_lived_shuffles(spark):
        nodes = settle(marks.drop("id").dropDuplicates(["node"]))
        parts = parts_for(nodes.agg(F.sum(F.octet_length("head"))).first()[0] or 0, blocks.BLOCK_BYTES // 2)
        buckets = 3 * parts  # the first hashes are small numbers: most fall into the lower buckets
        rows = nodes.withColumn("block", F.pmod("node", F.lit(parts)).cast("int"))
        sent = rows.groupBy("block").applyInArrow(lambda r: _ask_heads(r, buckets), blocks.NOTES)
        told = settle(blocks.answered(sent, _answer_heads))
        return settle(blocks.visit(rows, told, lambda r, g: _keep_heads(r, g, buckets), "key bigint, h bigint, node bigint"))


def _whole(rows: DataFrame, shingle: int) -> DataFrame:
    """(node, size, hashes, fp, cell) of the given rows; SimHash and grid cell are those of the set."""

    def run(batch: dict[str, list]) -> dict[str, list]:
        sets = [_set(t, shingle) for t in batch["text"]]
        fps = [fingerprint(x) for x in sets]
        return {"node": batch["node"], "size": [len(x) for x in sets], "hashes": [x.view("<i8") for x in sets],
                "fp": fps, "cell": [cell_of(x) for x in fps]}

    return map_batches(rows.select("node", "text"), run,
                       "node bigint, size bigint, hashes array<bigint>, fp bigint, cell bigint").dropDuplicates(["node"])


def _met_in_grid(sets: DataFrame) -> DataFrame:
    """(a, b): every set beside one whose fingerprint is its own or, by the grid, 2 or fewer bits from it.

    One set stands for all with its fingerprint, and that one meets the least of its
    neighbours; so there are fewer pairs than sets, however large a group is.
    """
    nodes = settle(sets.groupBy("fp", "cell").agg(F.min("node").alias("first")))
    near = links(nodes).groupBy(F.col("b").alias("fp")).agg(F.min("a").alias("beside"))
    beside = nodes.select(F.col("fp").alias("beside"), F.col("first").alias("b"))
    across = near.join(nodes, "fp").join(beside, "beside").select(F.col("first").alias("a"), "b")
    same = sets.select("node", "fp").join(nodes, "fp").where("node <> first")
    return across.union(same.select(F.col("node").alias("a"), F.col("first").alias("b")))


def _filed(sets: DataFrame) -> DataFrame:
    """(token, node, size, common, pos): the hashes of each set under which it can meet a partner.

    Hashes are ordered by the number of sets that hold them, rarest first, the same way in
    all sets.  Two sets at Jaccard 4/5 or more share one of the first ``size - 4/5 size + 1``
    of each; those that stand in one set only come first and lead nowhere.  ``common`` is
    how many hashes of a set others hold, ``pos`` the place among them.  A hash that stands
    in a third of all sets comes last, and is counted by an aggregation, not in one task.
    """
    tokens = sets.select("node", "size", F.explode("hashes").alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("often")).where("often > 1")
    held = tokens.join(often, "token")
    order = Window.partitionBy("node").orderBy("often", "token")
    placed = held.withColumns({"pos": F.row_number().over(order), "common": F.count("*").over(Window.partitionBy("node"))})
    return placed.where("pos <= common - (4 * size + 4) div 5 + 1").select("token", "node", "size", "common", "pos")


#: What two sets that meet under a hash can have in common at most, against what they need.
FITS = "9 * least(x.common - x.pos, y.common - y.pos) + 9 >= 4 * (x.size + y.size)"
#: Sets each set is compared with, one a round, after the grid and before all that are left are.
CENTRES = ("common / size", "xxhash64(node)", "xxhash64(node, 1)", "xxhash64(node, 2)")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, near, apart): whether two sets are at an exact Jaccard similarity of 4/5 or more, and their distance."""
    x, y = (sets.select(F.col("node").alias(k), F.col("hashes").alias(f"{k}_hashes")) for k in "ab")
    met = pairs.join(x, "a").join(y, "b").selectExpr(
        "a", "b", "size(array_intersect(a_hashes, b_hashes)) as both", "size(a_hashes) + size(b_hashes) as total")
    return met.selectExpr("a", "b", "9 * both >= 4 * total as near", "1 - both / (total - both) as apart")


def similar(rows: DataFrame, *, shingle: int) -> DataFrame:
    """(id, key, h, root) for every row of (id, text, key, h): ``root`` names its group of near-duplicates.

    Rows link when the Jaccard similarity of their shingle sets is 4/5 or more; equal
    sets and empty texts link too.  First the sets that meet in the grid of fingerprints
    are compared exactly, and groups are joined.  No other pair is missed: two such sets
    meet under one of their rarest hashes.  In each of a few rounds a set is compared with
    one other that it meets, the centre of most of its hashes, and groups are joined; so a
    group of near copies is never expanded into its pairs.  Sets that meet and are in
    different groups still are compared in the end, but for those whose distances to a
    centre that both were compared with differ by more than 1/5: no such two can link.
    """
    with blocks.short_lived_shuffles(rows.sparkSession):
        marks = settle(_marked(rows, shingle))
        sets = settle(_whole(measured_join(rows, _candidates(marks), ["key", "h"], limit=64 << 20), shingle))
        filed = settle(_filed(sets))
        compared = settle(_compared(_met_in_grid(sets), sets))
        tied = compared.where("near").selectExpr("a as node", "b as root")
        for weight in CENTRES:
            rooted = filed.join(tied, "node", "left").withColumn("root", F.coalesce("root", "node"))
            centres = rooted.groupBy("token").agg(
                F.max(F.struct(F.expr(weight).alias("w"), "node", "size", "common", "pos", "root")).alias("x"),
                (F.min("root") < F.max("root")).alias("open")).where("open").drop("open")
            met = rooted.join(centres, "token").withColumn("y", F.struct("size", "common", "pos")).where(f"x.root <> root and {FITS}")
            one = met.groupBy("node", F.col("x.node").alias("b")).agg(F.count("*").alias("n")).groupBy("node").agg(
                F.max_by("b", F.struct("n", "b")).alias("b")).withColumnRenamed("node", "a")
            found = settle(_compared(one.join(compared, ["a", "b"], "left_anti"), sets))
            compared = compared.union(found)
            tied = settle(connected_components(tied.union(found.where("near").select("a", "b")), "node", "root"))
        # the centre's distance to itself is nothing
        known = compared.select(F.col("a").alias("node"), F.col("b").alias("c"), "apart").union(
            compared.selectExpr("b", "b", "0D")).distinct()
        known = known.groupBy("node").agg(F.collect_list(F.struct("c", "apart")).alias("known"))
        rooted = (filed.join(tied, "node", "left").withColumn("root", F.coalesce("root", "node")).join(known, "node", "left")
                  .withColumn("known", F.coalesce("known", F.expr("cast(array() as array<struct<c:bigint,apart:double>>)"))))
        sized = rooted.groupBy("token", "root").agg(F.count("*").alias("n"))
        largest = sized.groupBy("token").agg(F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1")
        open_ = settle(rooted.join(largest.select("token", F.col("top.root").alias("top")), "token"))
        far = "exists(x.known, s -> exists(y.known, t -> s.c = t.c and abs(s.apart - t.apart) > 0.2000001D))"
        across = (open_.where("root <> top").alias("x").join(open_.alias("y"), F.expr(
            f"x.token = y.token and x.root <> y.root and (y.root = y.top or x.node < y.node) and {FITS} and not {far}"))
            .selectExpr("least(x.node, y.node) as a", "greatest(x.node, y.node) as b").distinct())
        last = _compared(across, sets)
        tied = connected_components(tied.union(last.where("near").select("a", "b")), "node", "root")
    return marks.join(tied, "node", "left").select("id", "key", "h", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int | None = None) -> DataFrame:
    """(id, fp, component): one row per input row; ``component`` is the least id reachable over links.

    With a radius of 2, which is the rule for three-word shingles, equal fingerprints
    link, and so do those at 2 or fewer differing bits; null and empty texts have
    fingerprint 0 and link like any other.  Without a radius, the rule for other
    sizes, rows link at a Jaccard similarity of 4/5 (see ``similar``) and ``fp`` is
    the hash of the group.  Repeated rows are kept and share their component.  A null
    id keeps its row; it is never a component's least id unless the component has no
    other.  An empty table gives an empty result.  Copies are joined through one row
    per fingerprint or set and are never expanded into pairs.
    """
    if radius not in (None, 2):
        raise ValueError("a fingerprint radius is 2 bits")
    if radius is None and shingle != 3:
        found = similar(keyed(docs, id_col, text_col), shingle=shingle)
        least = found.groupBy("root").agg(F.min("id").alias("component"))
        return found.join(least, "root").select("id", F.col("root").alias("fp"), "component")
    marks = settle(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    nodes = settle(marks.groupBy("fp", "cell").agg(F.min("id").alias("least")))
    tied = connected_components(links(nodes), "a", "b")
    named = tied.join(nodes, F.col("node") == F.col("fp"))
    low = named.groupBy("root").agg(F.min("least").alias("component"))
    linked = tied.join(low, "root").select(F.col("node").alias("fp"), "component")
    heads = nodes.join(linked, "fp", "left").select("fp", F.coalesce("component", "least").alias("component"))
    return marks.join(heads, "fp").select("id", "fp", "component")
