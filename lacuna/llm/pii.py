"""Personal data: four exact patterns, and a linear-chain CRF for what they miss.

The CRF reads word shapes.  It is trained on the small labelled table below by maximum
likelihood, and finds identity numbers, bank accounts, phone numbers without a leading
plus, and spelled-out mail addresses.  Its sequences are the stretches of words within
``REACH`` words of one that holds a digit or an @ sign; they are decoded by Viterbi in
numpy batches, all sequences of a batch side by side.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.llm.common import map_batches, pick

KINDS = ("email", "ip", "card", "phone", "idnum", "iban", "localphone", "spelledmail")
REACH = 4
_LEFT = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits is tried from its start only: a later start fails where this one does.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int, int]  # kind number, start, end

#: Labelled sentences: [kind:words] marks a span.
LABELLED = """
my social security number is [idnum:078-05-1120] on the form
ssn [idnum:219-09-9999] was given at the desk
the applicant , [idnum:123-45-6789] , signed today
his number [idnum:457-55-5462] is on file
tax id [idnum:987-65-4321]
Insured under [idnum:536-22-8145] since May
id: [idnum:401-18-2277] please
SSN: [idnum:612-34-9087]. Next line
pay into account [iban:DE89 3704 0044 0532 0130 00] by Friday
iban [iban:GB29 NWBK 6016 1331 9268 19] for the rent
IBAN: [iban:FR14 2004 1010 0505 0001 3M02 606] merci
send it to [iban:ES91 2100 0418 4502 0005 1332] now
transfer to [iban:DE75 5121 0800 1245 1261 99] please
the account [iban:NL91 ABNA 0417 1643 00] is closed
call me on [localphone:555-123-4567] after six
my phone is [localphone:(555) 123-4567] at work
ring [localphone:(212) 555-0199] for details
phone [localphone:415-555-2671] or write
reach us at [localphone:(808) 555-0143] daily
Tel. [localphone:312-555-7788] in the morning
contact: [localphone:(646) 555-4410]
write to [spelledmail:john (at) example (dot) com] soon
mail [spelledmail:ann.lee (at) mail7 (dot) org] please
address is [spelledmail:sales [at] shop [dot] net] today
contact [spelledmail:bob99 [at] example [dot] com] for more
in 2019 there were 40 people in the hall
chapter 12 page 345 of the book
the price is 1,299.00 or 15 percent off
version 2.0 of the licence , section 4.1
see pages 100-120 and 130-145 of volume 3
on 2021-05-17 at 10:30 the train left
between 12-05-2020 and 17-06-2021 we met
room 404 , floor 3 , building 12
order 8812 shipped on 05/06/2020
a score of 3-2 after 90 minutes
they sold 1000000 units in 12 months
token = "9f86d081884c7d65" was found
item 4567 of 9999 costs 12.50
call number 12 on the list of 100
the years 1999-2004 were good
ip 10.0.0.1 and port 8080 are open
look at the end (at) the 2 doors
The 1,024 bytes of 16 blocks
from 555 to 777 in 3 steps
part no. 12-345-67 is out of stock
isbn 978-3-16-148410-0 was reprinted
und 34 von 120 Seiten im Jahr 1998
le 14 juillet 1789 et 3 autres
el 12 de mayo de 1975 con 20 personas
user@example.com wrote 2 lines
section 12.3.4 and figure 7
"""

_WORD = re.compile(r"\S+")
_TRIM = "\"'“”‘’,;:.!?"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The four patterns, leftmost and non-overlapping per kind; matches that fail their check are dropped."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at - len(run) + len(run.rstrip(_LEFT)) if (run := text[end:at]) else at
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
        end = m.end() if m else at + 1
        at = text.find("@", end)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def shape(word: str) -> str:
    """The whole word with letters to A and a, digits to 9 with their number up to four, other signs kept."""
    out: list[str] = []
    for c in word:
        k = "9" if "0" <= c <= "9" else "a" if c.islower() else "A" if c.isalpha() else c
        if k != "9" and out and out[-1] == k:
            continue
        out.append(k)
    return re.sub("9{5,}", "9+", "".join(out))


def _features(word: str) -> tuple[str, ...]:
    """Long words are rare; they are not kept, so the cache stays small."""
    return _short_features(word) if len(word) <= 64 else _read_features(word)


def _read_features(word: str) -> tuple[str, ...]:
    body = word.strip(_TRIM)
    return ("s=" + shape(body), "t=" + shape(word), "n=" + str(min(len(word), 9)),
            "w=" + (word.lower() if word.isalpha() or word[:1] in "([" else "-"))


_short_features = lru_cache(200_000)(_read_features)


class Crf:
    """Labels O, B-kind, I-kind over the words of a sequence."""

    def __init__(self, labelled: str = LABELLED, rounds: int = 300, decay: float = 0.02) -> None:
        self.labels = ["O"] + [f"{b}-{k}" for k in KINDS[4:] for b in "BI"]
        data = [self._parse(x) for x in labelled.strip().split("\n")]
        self.index: dict[str, int] = {}
        for words, _ in data:
            for row in self._named(words):
                for f in row:
                    self.index.setdefault(f, len(self.index))
        size = len(self.labels)
        self.emit = np.zeros((len(self.index) + 1, size))
        self.move = np.zeros((size, size))
        self._train(data, rounds, decay)
        self.move[self._forbidden()] = -1e4
        self.start = np.array([-1e4 if x[0] == "I" else 0.0 for x in self.labels])

    def _forbidden(self) -> np.ndarray:
        return np.array([[b[0] == "I" and a[1:] != b[1:] for b in self.labels] for a in self.labels])

    def _parse(self, line: str) -> tuple[list[str], list[int]]:
        words, tags = [], []
        pieces = re.split(r"\[(\w+:(?:[^\[\]]|\[at\]|\[dot\])+)\]", line)
        for n, piece in enumerate(pieces):
            kind, _, body = piece.partition(":") if n % 2 else ("", "", piece)
            for i, w in enumerate(_WORD.findall(body)):
                words.append(w)
                tags.append(self.labels.index(("B-" if i == 0 else "I-") + kind) if n % 2 else 0)
        return words, tags

    def _named(self, words: list[str]) -> list[list[str]]:
        own = [_features(w) for w in words]
        edge = ("s=<>", "t=<>", "n=0", "w=<>")
        rows = []
        for i, f in enumerate(own):
            left, right = own[i - 1] if i else edge, own[i + 1] if i + 1 < len(own) else edge
            rows.append([*f, "l" + left[0], "r" + right[0], "lw" + left[3], "rw" + right[3]])
        return rows

    def rows(self, words: list[str]) -> np.ndarray:
        """Feature numbers [words, 8]; unknown features share the last, zero row."""
        get, none = self.index.get, len(self.emit) - 1
        return np.array([[get(f, none) for f in row] for row in self._named(words)], dtype=np.int32).reshape(-1, 8)

    def _train(self, data: list[tuple[list[str], list[int]]], rounds: int, decay: float) -> None:
        """Full-batch gradient of the log-likelihood by forward-backward, with Adam steps."""
        sets = [(self.rows(w), np.array(t)) for w, t in data]
        moments = [np.zeros_like(x) for x in (self.emit, self.emit, self.move, self.move)]
        for step in range(1, rounds + 1):
            grads = [-decay * self.emit, -decay * self.move]
            for rows, tags in sets:
                unary = self.emit[rows].sum(axis=1)
                n = len(tags)
                fwd, bwd = np.empty_like(unary), np.zeros_like(unary)
                fwd[0] = unary[0]
                for i in range(1, n):
                    fwd[i] = unary[i] + np.logaddexp.reduce(fwd[i - 1][:, None] + self.move, axis=0)
                for i in range(n - 2, -1, -1):
                    bwd[i] = np.logaddexp.reduce(self.move + unary[i + 1] + bwd[i + 1], axis=1)
                total = np.logaddexp.reduce(fwd[-1])
                error = -np.exp(fwd + bwd - total)
                error[np.arange(n), tags] += 1
                np.add.at(grads[0], rows, error[:, None, :])
                for i in range(1, n):
                    grads[1] -= np.exp(fwd[i - 1][:, None] + self.move + (unary[i] + bwd[i]) - total)
                    grads[1][tags[i - 1], tags[i]] += 1
            grads[0][-1] = 0
            for k, (value, grad) in enumerate(zip((self.emit, self.move), grads, strict=True)):
                moments[2 * k] = 0.9 * moments[2 * k] + 0.1 * grad
                moments[2 * k + 1] = 0.99 * moments[2 * k + 1] + 0.01 * grad * grad
                value += 0.1 * (moments[2 * k] / (1 - 0.9**step)) / (np.sqrt(moments[2 * k + 1] / (1 - 0.99**step)) + 1e-8)

    def decode(self, sequences: list[list[str]]) -> list[list[int]]:
        """Best labels of each sequence; sequences run side by side, longest first."""
        if not sequences:
            return []
        order = sorted(range(len(sequences)), key=lambda k: -len(sequences[k]))
        unary = [self.emit[self.rows(sequences[k])].sum(axis=1) for k in order]
        lengths = np.array([len(u) for u in unary])
        score = np.stack([u[0] for u in unary]) + self.start
        back: list[np.ndarray] = []
        for i in range(1, int(lengths[0])):
            live = int(np.searchsorted(-lengths, -i, side="left"))
            paths = score[:live, :, None] + self.move
            best = paths.argmax(axis=1)
            score[:live] = np.take_along_axis(paths, best[:, None], axis=1)[:, 0] + np.stack([u[i] for u in unary[:live]])
            back.append(best)
        out: list[list[int]] = [[] for _ in sequences]
        last = score.argmax(axis=1)
        for n, k in enumerate(order):
            label = int(last[n])
            labels = [label]
            for i in range(int(lengths[n]) - 2, -1, -1):
                label = int(back[i][n, label])
                labels.append(label)
            out[k] = labels[::-1]
        return out


_MARK = re.compile(r"[0-9]|[(\[]at[)\]]", re.I)


def windows(text: str) -> list[list[tuple[int, int]]]:
    """Words, as positions, within ``REACH`` words of one with a digit or a spelled @."""
    out: list[list[tuple[int, int]]] = []
    done = 0
    for mark in _MARK.finditer(text):
        if mark.start() < done:
            continue
        start = mark.start()
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        left: list[tuple[int, int]] = []
        at = start
        while len(left) < REACH and at > done:
            end = at
            while end > done and text[end - 1].isspace():
                end -= 1
            at = end
            while at > done and not text[at - 1].isspace():
                at -= 1
            if at < end:
                left.append((at, end))
        right: list[tuple[int, int]] = []
        quiet = 0
        for m in _WORD.finditer(text, max(start, done)):
            right.append(m.span())
            quiet = 0 if _MARK.search(m[0]) else quiet + 1
            if quiet > REACH:
                break
        if not right:
            continue
        span = left[::-1] + right
        if out and not text[done:span[0][0]].strip():  # no word between them
            out[-1] += span
        else:
            out.append(span)
        done = span[-1][1]
    return out


def crf_spans(texts: list[str], model: Crf) -> list[list[Span]]:
    found: list[list[Span]] = [[] for _ in texts]
    places = [(k, w) for k, text in enumerate(texts) for w in windows(text)]
    labels = model.decode([[texts[k][a:b] for a, b in w] for k, w in places])
    for (k, w), row in zip(places, labels, strict=True):
        i = 0
        while i < len(row):
            if row[i] == 0:
                i += 1
                continue
            kind = 4 + (row[i] - 1) // 2
            j = i + 1
            while j < len(row) and row[j] == row[i] + 1 and row[i] % 2:
                j += 1
            a, b = w[i][0], w[j - 1][1]
            a += b - a - len(texts[k][a:b].lstrip(_TRIM))
            b = a + len(texts[k][a:b].rstrip(_TRIM))
            if a < b:
                found[k].append((kind, a, b))
            i = j
    return found


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) for every row.

    ``base`` are the pattern matches and ``spans`` also those of the CRF, as (kind,
    start, end) in code points, by start, then kind in the order of ``KINDS``.  A CRF
    span that touches a base span is left out.  Null and empty texts have none.
    Repeated rows are answered each for itself.
    """
    base = pick(docs, id_col, text_col)
    span = "array<struct<kind:string,start:int,end:int>>"
    schema = T.StructType([base.schema["id"], *T.StructType.fromDDL(f"base {span}, spans {span}")])
    shared = docs.sparkSession.sparkContext.broadcast(Crf())

    def run(batch: dict[str, list]) -> dict[str, list]:
        fixed, whole = found_in(batch["text"], shared.value)
        return {"id": batch["id"], "base": [named(x) for x in fixed], "spans": [named(x) for x in whole]}

    return map_batches(base, run, schema)


def named(spans: list[Span]) -> list[dict]:
    return [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(spans, key=lambda s: (s[1], s[0]))]


def found_in(texts: list[str], model: Crf) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans and all spans of each text."""
    fixed = [base_spans(t) for t in texts]
    whole = [b + [s for s in c if all(s[2] <= x[1] or x[2] <= s[1] for x in b)]
             for b, c in zip(fixed, crf_spans(texts, model), strict=True)]
    return fixed, whole


def mask(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with the same columns, every span replaced by its kind in angle brackets.

    Overlapping spans are replaced together, under the kind of the first.  Null texts
    stay null; no row goes.
    """
    base = docs.select(F.struct("*").alias("row"))
    shared = docs.sparkSession.sparkContext.broadcast(Crf())

    def run(batch: dict[str, list]) -> dict[str, list]:
        _, whole = found_in([r[text_col] or "" for r in batch["row"]], shared.value)
        for row, spans in zip(batch["row"], whole, strict=True):
            if spans:
                row[text_col] = masked(row[text_col], named(spans))
        return batch

    return map_batches(base, run, base.schema).select("row.*")


def masked(text: str, spans: list) -> str:
    out, end = [], 0
    for s in spans:
        if s["start"] >= end:
            out += [text[end:s["start"]], f"<{s['kind']}>"]
        end = max(end, s["end"])
    return "".join([*out, text[end:]])
