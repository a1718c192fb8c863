"""Repair of conversation structure: the cheapest edits to an optional system turn and user/assistant pairs.

A row is one of nine symbols, from the initial of its role and its fault.  Conversations
are strings of symbols, cut into pieces; a Re-Pair grammar over all pieces of a batch
names repeated pairs of symbols.  Every symbol and every rule has a 4 x 4 min-plus matrix:
the least cost from state to state and the edits as a rope, the ASCII-least of equal
cost.  Rules are evaluated bottom-up, once for all pieces that hold them.  The matrices
of a conversation's pieces are multiplied in order, the edits are read off, and the rows
stream past them to be repaired.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lacuna.session import ship

#: Most symbols of a piece, and of the pieces that share a grammar.
PIECE = 1 << 16
BATCH = 1 << 18
#: A pair of symbols becomes a rule from this many uses on.
USES = 4

KEEP, REROLE, DELETE, INSERT = b"K", b"R", b"D", b"I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
#: What it costs to leave a truncated row in.
TRUNCATED = 5

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "-": {}}
#: The role that a rerole or an insertion gives after each state.
FILLED = ("user", "user", "assistant", "user")
#: Symbols: a row that must go; then rows without a fault, and truncated ones, by initial.
GONE, INITIALS = 0, "sua-"
LEGAL = {"su", "ua", "au"}

#: Characters that are no text.
WHITE = " \t\n\x0b\x0c\r"

Rope = bytes | tuple
Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def join(a: Rope, b: Rope) -> Rope:
    if isinstance(a, bytes) and isinstance(b, bytes) and len(a) + len(b) <= 256:
        return a + b
    return a, b


def leaves(rope: Rope) -> Iterator[bytes]:
    todo = [rope]
    while todo:
        top = todo.pop()
        if isinstance(top, bytes):
            yield top
        else:
            todo += (top[1], top[0])


def less(a: Rope, b: Rope) -> bool:
    """Whether rope ``a`` comes before rope ``b``; what both hold as one object is passed over."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if isinstance(x, bytes) and isinstance(y, bytes):
            size = min(len(x), len(y))
            if x[:size] != y[:size]:
                return x < y
            left += [x[size:]] if x[size:] else []
            right += [y[size:]] if y[size:] else []
            continue
        left += (x[1], x[0]) if isinstance(x, tuple) else (x,)
        right += (y[1], y[0]) if isinstance(y, tuple) else (y,)
    rest = [any(part for rope in ropes for part in leaves(rope)) for ropes in (left, right)]
    return rest == [False, True]


def better(a: Entry, b: Entry) -> Entry:
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if less(a[1], b[1]) else b


def product(a: Matrix, b: Matrix) -> Matrix:
    """Least cost and edits through ``a``, then ``b``."""
    out: Matrix = []
    for row in a:
        made: list[Entry] = [None] * len(b[0])
        for through, first in enumerate(row):
            if first is None:
                continue
            for to, second in enumerate(b[through]):
                if second is not None:
                    made[to] = better(made[to], (first[0] + second[0], join(first[1], second[1])))
        out.append(made)
    return out


def _identity() -> Matrix:
    return [[(0, b"") if p == q else None for q in range(4)] for p in range(4)]


def _inserted() -> Matrix:
    """No, one or two insertions; more never pay."""
    once: Matrix = [[None] * 4 for _ in range(4)]
    for steps in (STEPS["u"], STEPS["a"]):
        for p, q in steps.items():
            once[p][q] = COST[INSERT], INSERT
    twice = product(once, once)
    none = _identity()
    return [[better(none[p][q], better(once[p][q], twice[p][q])) for q in range(4)] for p in range(4)]


def _edited(symbol: int) -> Matrix:
    """One row deleted, kept or given another role."""
    out: Matrix = [[(COST[DELETE], DELETE) if p == q else None for q in range(4)] for p in range(4)]
    if symbol == GONE:
        return out
    late, which = divmod(symbol - 1, len(INITIALS))
    for edit, roles in ((KEEP, INITIALS[which]), (REROLE, "ua")):
        for role in roles:
            for p, q in STEPS[role].items():
                out[p][q] = better(out[p][q], (COST[edit] + TRUNCATED * late, edit))
    return out


INSERTED = _inserted()
SYMBOLS = [product(INSERTED, _edited(s)) for s in range(1 + 2 * len(INITIALS))]


def re_pair(strings: list[np.ndarray], uses: int = USES) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Rules (left, right), numbered after the symbols, and the strings written in them."""
    sequence = np.concatenate([np.append(s, -1) for s in strings]).astype(np.int64) if strings else np.zeros(0, np.int64)
    rules: list[tuple[int, int]] = []
    while len(sequence) > 1:
        size = len(SYMBOLS) + len(rules)
        pair = np.where((sequence[:-1] < 0) | (sequence[1:] < 0), -1, sequence[:-1] * size + sequence[1:])
        counts = np.bincount(pair[pair >= 0], minlength=1) if size < 512 else None
        if counts is None:
            names, numbers = np.unique(pair[pair >= 0], return_counts=True)
            best = int(names[numbers.argmax()]) if len(names) else -1
        else:
            best = int(counts.argmax())
        at = np.flatnonzero(pair == best)
        left, right = divmod(best, size)
        if left == right and len(at):  # of a run, every second place
            run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
        if best < 0 or len(at) < uses:
            break
        rules.append((left, right))
        sequence[at] = size
        sequence = np.delete(sequence, at + 1)
    ends = np.flatnonzero(sequence < 0)
    return rules, [part[part >= 0].tolist() for part in np.split(sequence, ends)[:len(strings)]]


def matrices(strings: list[bytes]) -> dict[bytes, Matrix]:
    """The matrix of every distinct string of symbols, over one grammar."""
    distinct = sorted(set(strings))
    rules, written = re_pair([np.frombuffer(s, dtype=np.uint8) for s in distinct])
    held = list(SYMBOLS)
    for left, right in rules:
        held.append(product(held[left], held[right]))
    out = {}
    for string, symbols in zip(distinct, written, strict=True):
        made = held[symbols[0]] if symbols else _identity()
        for s in symbols[1:]:
            made = product(made, held[s])
        out[string] = made
    return out


def finish(vector: list[Entry]) -> tuple[int, bytes]:
    """The cheapest way to end after nothing or after an assistant turn, with the insertions that takes."""
    ended = product([vector], INSERTED)[0]
    cost, rope = better(ended[START], ended[ASSISTANT])
    return cost, b"".join(leaves(rope))


def digest(role: Column, text: Column) -> Column:
    """Sixteen bytes that name a role and text."""
    return F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)


def faults(rows: DataFrame) -> DataFrame:
    """(conv, turn, digest, initial, blank, truncated, repeated, n): equal rows of a turn together.

    Of the ``n`` equal rows all but the first repeat it; the first does if its role and
    text stand at an earlier turn, which a minimum a digest finds without a window.
    """
    said = F.rtrim("text", F.lit(WHITE))
    entries = rows.select(
        "conv", "turn", digest(F.col("role"), F.col("text")).alias("digest"), F.substring("role", 1, 1).alias("initial"),
        (said == "").alias("blank"), (~F.right(said, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    entries = entries.groupBy(*entries.columns).agg(F.count("*").alias("n"))
    at = F.struct(F.col("turn").isNotNull(), "turn")
    firsts = entries.where("not blank").groupBy("conv", "digest").agg(F.min(at).alias("first")).withColumnsRenamed(
        {"conv": "_conv", "digest": "_digest"})
    joined = entries.join(firsts, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")), "left")
    return joined.withColumn("repeated", F.coalesce(at > F.col("first"), F.lit(False))).drop("_conv", "_digest", "first")


@dataclass
class Piece:
    """Consecutive rows of a conversation: what is counted of them, and their symbols."""

    conv: object
    turn: int | None
    digest: bytes
    seq: int
    head: str
    tail: str
    symbols: bytearray = field(default_factory=bytearray)
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: int | None = None
    last: int | None = None
    turns: int = 0

    def add(self, turn: int | None, initial: str, symbol: int, fault: str | None, n: int) -> None:
        if self.symbols and self.tail + initial not in LEGAL:
            self.illegal += 1
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        self.illegal += n - 1
        self.tail = initial
        if fault:
            setattr(self, fault, getattr(self, fault) + n)
        self.symbols += bytes([symbol]) * n


_COUNTS = "blank long, duplicate long, truncated long, illegal long"
_SUMMARY = ("seq long, head string, tail string, blank long, duplicate long, truncated long, illegal long, "
            "first long, last long, turns long, costs array<long>, audits array<binary>")


def _symbol(initial: str, truncated: bool) -> int:
    return 1 + len(INITIALS) * truncated + (INITIALS.index(initial) if initial in ("s", "u", "a") else 3)


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Piece]:
    """Pieces of at most ``most`` symbols, from entries in order."""
    piece: Piece | None = None
    for batch in batches:
        for r in batch.to_pylist():
            n, initial = r["n"], r["initial"]
            if r["blank"]:
                todo = [("blank", GONE, n)]
            elif r["repeated"]:
                todo = [("duplicate", GONE, n)]
            else:
                todo = [("truncated" if r["truncated"] else None, _symbol(initial, r["truncated"]), 1),
                        ("duplicate", GONE, n - 1)]
            for fault, symbol, left in todo:
                while left:
                    if piece is not None and (piece.conv != r["conv"] or len(piece.symbols) >= most):
                        yield piece
                        again = piece.conv == r["conv"]
                        piece = Piece(r["conv"], r["turn"], r["digest"], piece.seq + 1 if again else 0, initial, initial)
                    elif piece is None:
                        piece = Piece(r["conv"], r["turn"], r["digest"], 0, initial, initial)
                    some = min(left, most - len(piece.symbols))
                    piece.add(r["turn"], initial, symbol, fault, some)
                    left -= some
    if piece is not None:
        yield piece


def pieces(entries: DataFrame, most: int = PIECE) -> DataFrame:
    """(conv, turn, digest, + summary): matrices and counts of the pieces of every conversation.

    Entries are dealt into ranges of (conversation, turn, digest), so a conversation of any
    length is spread; a piece is named by its first row.
    """
    ship(entries.sparkSession)
    order = ["conv", "turn", "digest"]
    ranged = entries.repartitionByRange(*order).sortWithinPartitions(*order)
    summary = StructType.fromDDL(_SUMMARY)
    schema = StructType([*(entries.schema[c] for c in order), *summary])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)

        def flushed(held: list[Piece]) -> pa.RecordBatch:
            found = matrices([bytes(p.symbols) for p in held])
            flat = {s: [e for row in m for e in row] for s, m in found.items()}
            costs = {s: [None if e is None else e[0] for e in m] for s, m in flat.items()}
            audits = {s: [None if e is None else b"".join(leaves(e[1])) for e in m] for s, m in flat.items()}
            rows = [{**{k: getattr(p, k) for k in schema.names[:-2]}, "costs": costs[bytes(p.symbols)],
                     "audits": audits[bytes(p.symbols)]} for p in held]
            return pa.RecordBatch.from_pylist(rows, schema=arrow)

        held: list[Piece] = []
        size = 0
        for piece in _cut(batches, most):
            held.append(piece)
            size += len(piece.symbols)
            if size >= BATCH:
                yield flushed(held)
                held, size = [], 0
        if held:
            yield flushed(held)

    return ranged.mapInArrow(run, schema)


class Run:
    """One conversation as it streams by: first its pieces, then its rows."""

    def __init__(self, conv: object) -> None:
        self.conv = conv
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.vector: list[Entry] = [(0, b""), None, None, None]
        self.tail: str | None = None
        self.first: int | None = None
        self.last: int | None = None
        self.turns = 0
        self.audit: bytes | None = None
        self.cost = 0
        self.at = 0
        self.state = START

    def piece(self, p: dict) -> None:
        for name in self.counts:
            self.counts[name] += p[name]
        if self.tail is not None and self.tail + p["head"] not in LEGAL:
            self.counts["illegal"] += 1
        self.tail = p["tail"]
        if p["first"] is not None:
            self.turns += p["turns"] - (self.last == p["first"])
            self.first = p["first"] if self.first is None else self.first
            self.last = p["last"]
        entries = [None if c is None else (c, a) for c, a in zip(p["costs"], p["audits"], strict=True)]
        self.vector = product([self.vector], [entries[4 * i:4 * i + 4] for i in range(4)])[0]

    def _fill(self) -> Iterator[tuple[str, str, str]]:
        """The rows inserted here."""
        while self.audit[self.at:self.at + 1] == INSERT:
            yield self._put(FILLED[self.state], "", "I")

    def _put(self, role: str, text: str, edit: str) -> tuple[str, str, str]:
        self.at += 1
        self.state = STEPS[role[0]][self.state]
        return role, text, edit

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(role, text, edit) of what stands in place of the next row."""
        if self.audit is None:
            self.cost, self.audit = finish(self.vector)
        yield from self._fill()
        edit = self.audit[self.at:self.at + 1]
        if edit == DELETE:
            self.at += 1
        else:
            yield self._put(role if edit == KEEP else FILLED[self.state], text, edit.decode())

    def end(self) -> Iterator[tuple[str, str, str]]:
        if self.audit is None:
            self.cost, self.audit = finish(self.vector)
        yield from self._fill()

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.turns


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Run, Iterator[tuple[str, str, str]] | None]]:
    """Each conversation's run with what each row turns into; the last time with None, at its end."""
    run: Run | None = None
    for batch in batches:
        for r in batch.to_pylist():
            if run is None or r["conv"] != run.conv:
                if run is not None:
                    yield run, run.end()
                    yield run, None
                run = Run(r["conv"])
            if r["piece"] is not None:
                run.piece(r["piece"])
            elif r["text"] is not None:
                yield run, run.row(r["role"], r["text"])
    if run is not None:
        yield run, run.end()
        yield run, None


def _together(rows: DataFrame, convs: DataFrame, most: int) -> DataFrame:
    """Markers of all conversations, then pieces, then rows, in order, each conversation in one stream."""
    found = pieces(faults(rows), most)
    named = found.select("conv", "turn", "digest", "seq", F.struct(
        *(F.col(f.name) for f in StructType.fromDDL(_SUMMARY))).alias("piece"))
    kinds = {"piece": named.schema["piece"].dataType, "seq": "long", "turn": "long", "digest": "binary", "role": "string",
             "text": "string"}

    def shaped(df: DataFrame, kind: int) -> DataFrame:
        return df.select("conv", F.lit(kind).alias("kind"), *(
            (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()))

    marked = shaped(convs.select("conv").distinct(), 0)
    lined = shaped(rows.withColumn("digest", digest(F.col("role"), F.col("text"))), 2)
    return marked.union(shaped(named, 1)).union(lined).repartition("conv").sortWithinPartitions(
        "conv", "kind", "turn", "digest", "seq")


def _named(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    space = F.lit(" ")
    return df.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                     F.coalesce(role_col, space).alias("role"), F.coalesce(text_col, space).alias("text"))


def repair(rows: DataFrame, convs: DataFrame | None = None, *, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text", most: int = PIECE) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    Rows go by turn, nulls first; rows of one turn by a digest of role and text, so the
    order never depends on the input's.  A null role or text is one space, a null
    conversation id is one conversation, and ``convs`` may name conversations without
    rows: zeros, no edits, the hash of nothing.  A role that starts with no s, u or a
    cannot be kept.  Empty tables give no rows; other columns are not read.  A long text
    is hashed as it streams by; a conversation of any length holds its edits, one byte a
    row, and a few rows at a time.
    """
    given = _named(rows, conv_col, turn_col, role_col, text_col)
    stream = _together(given, given if convs is None else convs.select(F.col(conv_col).alias("conv")), most)
    schema = StructType([stream.schema["conv"], *StructType.fromDDL(
        f"gaps long, {_COUNTS}, cost long, audit string, repaired_sha256 string")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        done, sha, lines = [], hashlib.sha256(), 0
        for conv, made in _streams(batches):
            if made is not None:
                for role, text, _ in made:
                    sha.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1
                continue
            done.append({"conv": conv.conv, "gaps": conv.gaps, **conv.counts, "cost": conv.cost,
                         "audit": conv.audit.decode(), "repaired_sha256": sha.hexdigest()})
            sha, lines = hashlib.sha256(), 0
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
                done = []
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=arrow)

    return stream.mapInArrow(run, schema)


def repaired(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv, place, role, text, edit): the repaired conversations themselves, row by row from place 0."""
    given = _named(rows, conv_col, turn_col, role_col, text_col)
    stream = _together(given, given, PIECE)
    schema = StructType([stream.schema["conv"], *StructType.fromDDL("place long, role string, text string, edit string")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        out, size, place = [], 0, 0
        for conv, made in _streams(batches):
            if made is None:
                place = 0
                continue
            for role, text, edit in made:
                out.append({"conv": conv.conv, "place": place, "role": role, "text": text, "edit": edit})
                place, size = place + 1, size + len(text)
            if len(out) >= 1000 or size >= 1 << 24:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return stream.mapInArrow(run, schema)


def damage(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Rows with planted faults, dealt by a checksum of ``conv:turn``: one in twenty each of five kinds.

    Dropped, emptied, without ``[.!?]``, repeated, or said by the user.  Nulls are one space.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    text = F.coalesce(text_col, space)
    dealt = rows.select(conv_col, turn_col, F.coalesce(role_col, space).alias("_role"), text.alias("_text"),
                        (F.crc32(key) % 20).alias("_deal")).where("_deal <> 0")
    times = F.when(F.col("_deal") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return dealt.select(
        conv_col, turn_col, F.when(F.col("_deal") == 4, "user").otherwise(F.col("_role")).alias(role_col),
        F.when(F.col("_deal") == 1, "").when(F.col("_deal") == 2, F.regexp_replace("_text", "[.!?]", ""))
        .otherwise(F.col("_text")).alias(text_col), F.explode(times).alias("_time")).drop("_time")
