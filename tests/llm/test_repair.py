"""Conversation repair beside an exhaustive search over pairs of cost and string, and on rows that go wrong."""

import hashlib
import random
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from feedloom.llm import repair

ROLE = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def search(rows: str) -> tuple[int, str]:
    """The least (cost, audit), with up to three insertions at any place."""
    @lru_cache(None)
    def best(i: int, last: str, inserts: int):
        found = []
        if i == len(rows):
            if last in ("", "a"):
                found.append((0, ""))
        else:
            initial, cut = rows[i].lower(), rows[i].isupper()
            found.append((3, "D", best(i + 1, last, 3)))
            for role, after in NEXT[last].items():
                if rows[i] != "-" and role == initial:
                    found.append((int(cut), "K", best(i + 1, after, 3)))
                if rows[i] != "-" and role != "s":
                    found.append((2 + cut, "R", best(i + 1, after, 3)))
        for role, after in NEXT[last].items():
            if inserts and role != "s":
                found.append((2, "I", best(i, after, inserts - 1)))
        ends = [f if len(f) == 2 else (f[0] + f[2][0], f[1] + f[2][1]) for f in found if len(f) == 2 or f[2]]
        return min(ends, default=None)

    return best(0, "", 3)


def repaired(rows: str, piece: int) -> tuple[int, str]:
    at, places = [0, None, None, None], 0
    for i in range(0, len(rows), piece):
        part = rows[i:i + piece]
        at = repair.join_map(at, places, repair.piece_map(part), 3 * len(part))
        places += 3 * len(part)
    return repair.finish(at, places)


@pytest.mark.parametrize("piece", [1, 2, 3, 100])
def test_weights_find_the_least_repair(piece):
    draw = random.Random(piece)
    cases = ["", "s", "S", "-", "su", "us", "asu", "uuaa", "aUuA-x"]
    cases += ["".join(draw.choice("suaxSUAX--") for _ in range(draw.randrange(1, 9))) for _ in range(400)]
    for rows in cases:
        assert repaired(rows, piece) == search(rows), rows


def test_joined_maps_do_not_depend_on_the_grouping():
    rows = "".join(random.Random(7).choice("suaxSUAX-uaua") for _ in range(3_000))
    assert repaired(rows, 512) == repaired(rows, 97) == repaired(rows, 7)


def by_hand(rows: list[tuple]) -> tuple:
    """One conversation's result from its rows (turn, role, text)."""
    rows = sorted(((t is not None, t or 0, r, x) for t, r, x in rows))
    faults, seen, letters = [], set(), ""
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
        letters += "-" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
    cost, audit = search(letters)
    out, last, left = [], "", iter(rows)
    for edit in audit:
        row = next(left) if edit != "I" else None
        if edit == "D":
            continue
        wanted = next(r for r in NEXT[last] if r != "s")
        role, text = (ROLE[wanted], "") if edit == "I" else (row[2], row[3]) if edit == "K" else (ROLE[wanted], row[3])
        out.append(f"{role}:{text}")
        last = NEXT[last][role[0]]
    turns = {r[1] for r in rows if r[0]}
    initials = [r[2][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def test_rows_of_all_kinds(spark):
    draw = random.Random(3)
    texts = ["Yes.", "no", "", " \t", "What? ", "a\x0b", "é!", "."]
    rows = [(c, draw.choice([None, *range(12)]), draw.choice(["user", "assistant", "system", "tool", "", "usr", "User"]), draw.choice(texts))
            for c in [None, *range(60)] for _ in range(draw.randrange(1, 8))]
    rows += [(999, 5, "user", "Yes.")] * 40 + [(998, -(1 << 63), "user", "a."), (998, (1 << 63) - 1, "assistant", "b.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit("x")).withColumn("at", F.lit(1))
    names = spark.createDataFrame([(c,) for c in [None, 1, 5000]], "conv_id long")
    got = {r[0]: tuple(r)[1:] for r in repair.repair_conversations(df, names).collect()}
    groups = {}
    for c, *row in rows:
        groups.setdefault(c, []).append(tuple(row))
    want = {c: by_hand(g) for c, g in groups.items()}
    want[998] = (repair.LONG, *want[998][1:])
    want[5000] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == want


def test_nulls_are_spaces_and_empty_tables_have_no_rows(spark):
    df = spark.createDataFrame([("a", None, None, None), ("a", 1, "user", None), ("a", 2, "user", "Hi.")], "conv_id string, turn int, role string, text string")
    row = repair.repair_conversations(df).first()
    assert (row.conv_id, row.blank, row.cost, row.audit) == ("a", 2, 8, "DDKI")
    assert repair.repair_conversations(df.where("1 = 0"), df.where("1 = 0")).count() == 0
    assert repair.repair_conversations(repair.damage(df)).columns[0] == "conv_id"


def test_a_long_conversation_is_cut_into_pieces_and_ranges(spark):
    n, draw = 6_000, random.Random(5)
    rows = [(7, i, draw.choice(["user", "assistant"]), f"t{draw.randrange(4_000)}{draw.choice(['.', ''])}") for i in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    row = repair.repair_conversations(df).first()
    seen, letters = set(), ""
    for _, _, role, text in rows:
        letters += "-" if (role, text) in seen else role[0] if text[-1] == "." else role[0].upper()
        seen.add((role, text))
    assert (row.cost, row.audit) == repaired(letters, 64)
    assert repair._pieces(repair.ordered_rows(df)).count() >= n // repair.PIECE and row.audit.count("I") + n == len(row.audit)
