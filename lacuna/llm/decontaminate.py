"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton of all items is built once on the driver from a bounded block of items
and broadcast; every task streams the words of its texts through it and tracks the
longest current match.  A benchmark larger than a block becomes several automata, each
of bounded size, run over the texts one after the other; the hits are united.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.llm.common import map_batches, pick

#: Words of one automaton: at most twice as many states, some 100 MB in a task.
BLOCK_WORDS = 150_000

_KEEP = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: A-Z to a-z, everything between words to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if _KEEP.match(bytes([b])) else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_FOLD).split()


class Automaton:
    """Suffix automaton over word numbers of many items.

    ``window`` consecutive words of an item are a window; an item with fewer words,
    but not none, is one window.
    """

    def __init__(self, items: Iterable[tuple[object, list[bytes]]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.short: dict[int, list[tuple[int, int]]] = {}
        self.least = window
        self.items: list[object] = []
        coded = []
        for item, words in items:
            if words:
                code = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                self.least = min(self.least, len(code))
                self.items.append(item)
                coded.append(code)
                self._add(code)
        # the state that holds the window-long suffix, and the nearest one with a short item
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        self.at_window = [-1] * len(order)
        for s in order:
            if self.length[s] >= window:
                up = self.link[s]
                self.at_window[s] = self.at_window[up] if self.length[up] >= window else s
        self.holders: dict[int, set[int]] = {}
        for k, code in enumerate(coded):
            state = 0
            for i, w in enumerate(code):
                state = self.next[state][w]
                if i + 1 >= window:
                    self.holders.setdefault(self.at_window[state], set()).add(k)
            if len(code) < window:
                while self.length[self.link[state]] >= len(code):
                    state = self.link[state]
                self.short.setdefault(state, []).append((len(code), k))
        self.near_short = [-1] * len(order)
        for s in order:
            self.near_short[s] = s if s in self.short else self.near_short[self.link[s]] if self.link[s] >= 0 else -1

    def _add(self, code: list[int]) -> None:
        last = 0
        for w in code:
            last = self._extend(last, w)

    def _copy(self, state: int, length: int) -> int:
        self.next.append(dict(self.next[state]))
        self.link.append(self.link[state])
        self.length.append(length)
        self.link[state] = len(self.link) - 1
        return self.link[state]

    def _redirect(self, state: int, w: int, old: int, new: int) -> None:
        while state >= 0 and self.next[state].get(w) == old:
            self.next[state][w] = new
            state = self.link[state]

    def _extend(self, last: int, w: int) -> int:
        known = self.next[last].get(w)
        if known is not None:  # another item came this way
            if self.length[known] == self.length[last] + 1:
                return known
            twin = self._copy(known, self.length[last] + 1)
            self._redirect(last, w, known, twin)
            return twin
        new = len(self.link)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        state = last
        while state >= 0 and w not in self.next[state]:
            self.next[state][w] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][w]
            if self.length[target] == self.length[state] + 1:
                self.link[new] = target
            else:
                twin = self._copy(target, self.length[state] + 1)
                self._redirect(state, w, target, twin)
                self.link[new] = twin
        return new

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit word ranges (start, end) in order and without overlap, and the numbers of the items."""
        find = self.vocabulary.get
        codes = [find(w, -1) for w in words]
        known = np.array(codes, dtype=np.int64) >= 0
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
        ranges: list[tuple[int, int]] = []
        items: set[int] = set()
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= self.least:
                self._stream(codes, a, b, ranges, items)
        return ranges, items

    def _stream(self, codes: list[int], a: int, b: int, ranges: list[tuple[int, int]], items: set[int]) -> None:
        state = size = 0
        for i in range(a, b):
            w = codes[i]
            while state and w not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                size += 1
            start = i + 1
            if size >= self.window:
                start = i + 1 - size
                items |= self.holders[self.at_window[state]]
            s = self.near_short[state]
            while s > 0:
                for length, k in self.short[s]:
                    if length <= size:
                        items.add(k)
                        start = min(start, i + 1 - length)
                s = self.near_short[self.link[s]]
            if start <= i:
                while ranges and ranges[-1][1] >= start:
                    start = min(start, ranges.pop()[0])
                ranges.append((start, i + 1))


def automata(bench: DataFrame, item_col: str, text_col: str, window: int, block: int) -> Iterator[Automaton]:
    """One automaton for each block of items; the items stream through the driver, a block is never exceeded
    but by a single item that is longer."""
    held: list[tuple[object, list[bytes]]] = []
    size = 0
    for row in pick(bench, item_col, text_col).distinct().toLocalIterator():
        words = words_of(row["text"])
        if held and size + len(words) > block:
            yield Automaton(held, window)
            held, size = [], 0
        held.append((row["id"], words))
        size += len(words)
    yield Automaton(held, window)


def overlaps(docs: DataFrame, bench: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text", window: int = 10,
             block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, n_words, spans, items) for every row of ``docs``.

    ``spans`` are the word ranges [start, end) inside an occurrence of a window, in
    order and apart; ``items`` are the ids, as strings, of the items with an occurring
    window.  Null and empty texts have no words and no hits; null and empty items
    match nothing; items with the same text are all named.  An empty benchmark hits
    nothing.  Repeated rows are answered each for itself.
    """
    held = docs.select(F.col(id_col).alias("id"), F.struct(F.col(text_col).alias("text")).alias("row"))
    schema = T.StructType([held.schema["id"], *_FOUND])
    return _stream_all(held, automata(bench, item_col, item_text_col, window, block_words), "text",
                       lambda row, n, spans, items: {"n_words": n, "spans": spans, "items": items}, schema)


_FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
    T.StructField("items", T.ArrayType(T.StringType()))])


def _stream_all(held: DataFrame, blocks: Iterator[Automaton], text_col: str,
                finish: Callable[[dict, int, list, list], dict | None], schema: T.StructType) -> DataFrame:
    """Run every automaton over ``held`` (columns and ``row``), uniting what they find.

    ``finish`` turns a row and its findings into result columns, or None to drop it, in
    the pass of the last automaton; a benchmark of one block takes a single pass.
    """
    carried = [f.name for f in held.schema if f.name != "row"]

    def step(df: DataFrame, automaton: Automaton, last: bool) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(automaton)
        target = schema if last else T.StructType([*held.schema, *_FOUND])

        def run(batch: dict[str, list]) -> dict[str, list]:
            found = shared.value
            out: dict[str, list] = {f.name: [] for f in target}
            for k, row in enumerate(batch["row"]):
                words = words_of(row[text_col] or "")
                ranges, numbers = found.hits(words)
                names = {str(found.items[n]) for n in numbers}
                if "spans" in batch:  # from the automata before
                    ranges, names = united([*map(tuple, batch["spans"][k]), *ranges]), names | {*batch["items"][k]}
                findings = len(words), [list(r) for r in ranges], sorted(names)
                result = finish(row, *findings) if last else dict(zip(_FOUND.names, findings, strict=True)) | {"row": row}
                if result is not None:
                    for name, value in ({c: batch[c][k] for c in carried} | result).items():
                        out[name].append(value)
            return out

        return map_batches(df, run, target)

    waiting = None
    for automaton in blocks:
        if waiting is not None:
            held_now = step(held if waiting[1] else held_now, waiting[0], False)
        waiting = automaton, waiting is None
    return step(held if waiting[1] else held_now, waiting[0], True)


def united(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut_words(text: str, spans: list[list[int]]) -> str:
    """``text`` without the words of ``spans`` and the marks between them."""
    if not spans:
        return text
    data = text.encode("utf-8")
    folded = data.translate(_FOLD)
    at = [m.span() for m in re.finditer(rb"[^ ]+", folded)]
    kept, end = [], 0
    for a, b in spans:
        kept.append(data[end:at[a][0]])
        end = at[b - 1][1]
    kept.append(data[end:])
    return b"".join(kept).decode("utf-8")


def decontaminate(docs: DataFrame, bench: DataFrame, *, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 10,
                  max_span: int = 0, max_coverage: float = 0.8, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with the same columns, the text without hit spans of more than ``max_span`` words.

    A row whose hit words are more than ``max_coverage`` of its words goes.  A span of
    under ``window`` words is made of short items that stand there whole, so by default
    they are cut too; a ``max_span`` above 0 leaves spans of so many words in.  Null
    texts stay null.  Other columns are untouched.
    """
    def finish(row: dict, n_words: int, spans: list[list[int]], items: list[str]) -> dict | None:
        if sum(b - a for a, b in spans) > max_coverage * n_words:
            return None
        if row[text_col] is not None:
            row[text_col] = cut_words(row[text_col], [s for s in spans if s[1] - s[0] > max_span])
        return {"row": row}

    held = docs.select(F.struct("*").alias("row"))
    return _stream_all(held, automata(bench, item_col, item_text_col, window, block_words), text_col, finish,
                       held.schema).select("row.*")
