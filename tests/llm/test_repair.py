import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from lacuna.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        deal = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if deal == 1 else "".join(c for c in text if c not in ".!?") if deal == 2 else text
        out += [(conv, turn, "user" if deal == 4 else role, text)] * (0 if deal == 0 else 2 if deal == 3 else 1)
    return out


def cheapest(symbols):
    """Least (cost, edits) of a list of (initial, fault), by a search over whole edit strings."""
    best = {0: (0, "")}

    def inserted(best):
        for _ in range(3):
            for p, (c, a) in list(best.items()):
                for q in {PATTERN[p].get("u"), PATTERN[p].get("a")} - {None}:
                    best[q] = min(best.get(q, (10**9, "")), (c + 5, a + "I"))
        return best

    for initial, fault in symbols:
        new = {}
        for p, (c, a) in inserted(best).items():
            moves = [(p, 2, "D")]
            if fault not in ("blank", "duplicate"):
                late = 5 * (fault == "truncated")
                moves += [(PATTERN[p][initial], late, "K")] if initial in PATTERN[p] else []
                moves += [(PATTERN[p][r], 1 + late, "R") for r in "ua" if r in PATTERN[p]]
            for q, cost, letter in moves:
                new[q] = min(new.get(q, (10**9, "")), (c + cost, a + letter))
        best = new
    return min(v for p, v in inserted(best).items() if p in (0, 3))


def plain(rows, convs):
    """The contract for damaged rows, conversation by conversation."""
    out = []
    for conv in convs:
        mine = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1], r[2])))
        seen, symbols = set(), []
        for _, role, text in mine:
            said = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
            seen.add((role, text))
            symbols.append((role[:1], fault))
        cost, audit = cheapest(symbols)
        kept, state, left = [], 0, list(mine)
        for e in audit:
            role, text = (None, "") if e == "I" else left.pop(0)[1:]
            if e != "D":
                role = role if e == "K" else "assistant" if state == 2 else "user"
                state = PATTERN[state][role[0]]
                kept.append(f"{role}:{text}")
        turns = [r[0] for r in mine if r[0] is not None]
        faults = [f for _, f in symbols]
        pairs = [a + b for (a, _), (b, _) in itertools.pairwise(symbols)]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
                    faults.count("duplicate"), faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs),
                    cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_rows(seed, convs, turns):
    rng = random.Random(seed)
    return [(c, t if rng.random() < .9 else rng.choice([None, t + 3]), rng.choice(["user", "assistant", "assistant", "system", "tool", "", None]),
             rng.choice(["Yes.", "No!", "Why?  \n", "cut", " \t", "", None, f"text {t}.", f"more {c}"]))
            for c in range(convs) for t in range(rng.randrange(turns))]


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert got(repair.repair(repair.damage(df), df)) == plain(damaged(rows), {r[0] for r in rows})


def test_many_faults(spark):
    rows = random_rows(1, 120, 14)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = plain(damaged(rows), {r[0] for r in rows})
    assert got(repair.repair(repair.damage(df), df)) == want
    assert got(repair.repair(repair.damage(df), df, most=3)) == want  # pieces shorter than a conversation


def test_one_conversation_with_most_rows(spark):
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Same.", f"Own {t}.", f"cut {t}", ""])) for t in range(4000)]
    rows += [(1, 7, "user", "Equal row.")] * 500 + [(c, t, "user", "Hi.") for c in range(2, 40) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert got(repair.repair(df, most=64)) == plain(rows, {r[0] for r in rows})


def test_rows_of_the_repaired_conversations(spark):
    rows = damaged(random_rows(5, 30, 9))
    df = spark.createDataFrame(rows, SCHEMA)
    want = {r[0]: r for r in plain(rows, {r[0] for r in rows})}
    lines, edits = {}, {}
    for r in sorted(repair.repaired(df).collect(), key=lambda r: (r.conv, r.place)):
        lines.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
        edits[r.conv] = edits.get(r.conv, "") + r.edit
    for conv, row in want.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == row[8]
        assert edits.get(conv, "") == row[7].replace("D", "")


def test_odd_tables(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", "Hi."), (1, None, "user", "Hi."), (1, 5, "user", "é" * 400_000 + "."),
            (2, 2**40, "assistant", "漢字!"), (2, -5, "system", "\n\n"), (3, 0, "User", "Upper."), (4, 1, "user", "a.\nb:c?")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as conv", "2 as piece", "3 as kind", "4 as _deal", "5 as n")
    want = plain(damaged(rows), {r[0] for r in rows})
    assert got(repair.repair(repair.damage(df), df)) == want
    assert repair.repair(df.where("false")).collect() == []
    gone = got(repair.repair(df.where("false"), df.where("conv_id = 4")))
    assert gone == [(4, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_grammar_gives_the_strings_back():
    rng = np.random.default_rng(2)
    strings = [rng.integers(0, 3, n).astype(np.uint8) for n in (0, 1, 2, 50, 700, 700)] + [np.zeros(41, np.uint8)]
    rules, written = repair.re_pair(strings)
    assert rules and sum(map(len, written)) < sum(map(len, strings)) / 2

    def spelled(s):
        return [s] if s < len(repair.SYMBOLS) else [x for part in rules[s - len(repair.SYMBOLS)] for x in spelled(part)]

    assert [[x for s in w for x in spelled(s)] for w in written] == [s.tolist() for s in strings]


def test_matrices_of_rules_equal_those_of_plain_products():
    rng = random.Random(8)
    strings = [bytes(rng.randrange(9) for _ in range(rng.randrange(1, 30))) for _ in range(200)]
    flat = lambda m: [e and (e[0], b"".join(repair.leaves(e[1]))) for row in m for e in row]
    for string, made in repair.matrices(strings).items():
        want = repair._identity()
        for s in string:
            want = repair.product(want, repair.SYMBOLS[s])
        assert flat(made) == flat(want)


@pytest.mark.parametrize("seed", range(5))
def test_ropes_compare_like_strings(seed):
    rng = random.Random(seed)

    def rope(depth):
        return (rope(depth - 1), rope(depth - 1)) if depth and rng.random() < .8 else bytes(rng.choices(b"DK", k=rng.randrange(3)))

    shared = rope(4)
    for _ in range(300):
        a, b = (rope(3), shared), ((shared, rope(3)) if rng.random() < .5 else (rope(3), shared))
        assert repair.less(a, b) == (b"".join(repair.leaves(a)) < b"".join(repair.leaves(b)))
