"""Cheapest repair of conversations whose turns are blank, doubled, cut off or out of turn.

A repaired conversation has roles of the form (system)? (user assistant)+, or no row at all. Every row is kept,
given another role or deleted, and rows without text may be inserted. Each choice has one scalar weight, a Python
integer: its high digits are the cost, its low digits, of fixed width, spell the audit letters from the left and are
zero behind the last. Of two weights the smaller is the cheaper repair or, at equal cost, the one whose audit string
comes first in ASCII, so that the recursion over the graph of rows and role states only takes minima of integers.

Long conversations are not gathered: rows are put in order by ranges, pieces of at most ``PIECE`` rows become maps
from the state before to the weights of the states behind, and maps are joined in order, in a stream. Pieces of equal
cost over the same rows never begin one another (a longer one would have paid for its insertions), so minima of pieces
are minima of the whole.

Defined results: a null conversation id is a conversation of its own; null roles and texts are one space, null turns
come first; rows that tie on the turn are taken by role, then text, and equal rows are copies of each other; an empty
role, like one that starts with another letter, fits nowhere and can be changed or deleted; a conversation that lost
all its rows has zeros, an empty audit and the hash of the empty string; turns so far apart that the gaps exceed a
long give the largest long; an empty table gives no rows. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from feedloom.llm.common import stage

PIECE = 512
SPACE = " \t\n\x0b\f\r"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4  # digits in the order of the letters
LETTERS = str.maketrans("1234", "DIKR")
DIGIT = 3  # bits
COSTS = {"delete": 3, "insert": 2, "rerole": 2, "truncated": 1}
STATES = range(4)  # nothing yet; behind the system row; behind a user row; behind an assistant row
ENDS = (0, 3)
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = ("u", "u", "a", "u")  # the role that an inserted or changed row takes in a state
LONG = (1 << 63) - 1

Weights = list[int | None]


# ---- weights ---------------------------------------------------------------------------------------------

def _before(weight: int | None, cost: int, letter: int, bits: int) -> int | None:
    """The weight with one more edit in front: its letter takes the first place, the others move one back."""
    if weight is None:
        return None
    letters = weight & ((1 << bits) - 1)
    return (((weight >> bits) + cost) << bits) | (letter << (bits - DIGIT)) | (letters >> DIGIT)


def _least(*weights: int | None) -> int | None:
    return min((w for w in weights if w is not None), default=None)


def _with_inserts(at: Weights, bits: int) -> Weights:
    """At most two insertions before what ``at`` weighs; of three, two neighbours could be left out."""
    best = layer = at
    for _ in range(2):
        layer = [_before(layer[NEXT[q, WANTED[q]]], COSTS["insert"], INSERT, bits) for q in STATES]
        best = [_least(a, b) for a, b in zip(best, layer)]
    return best


@lru_cache(maxsize=4_096)
def piece_map(rows: str) -> tuple[tuple[int | None, ...], ...]:
    """Weights of a piece from each state to each state, letters in ``3 * len(rows)`` places.

    ``rows`` holds one letter per row: the initial of its role (``x`` if it fits nowhere), upper case if the text is
    cut off, ``-`` for a row that must go.
    """
    bits = DIGIT * 3 * len(rows)
    columns = []
    for end in STATES:
        at: Weights = [0 if q == end else None for q in STATES]
        for row in reversed(rows):
            initial, extra = row.lower(), COSTS["truncated"] if row.isupper() else 0
            here: Weights = []
            for q in STATES:
                best = _before(at[q], COSTS["delete"], DELETE, bits)
                if row != "-":
                    if (q, initial) in NEXT:
                        best = _least(best, _before(at[NEXT[q, initial]], extra, KEEP, bits))
                    best = _least(best, _before(at[NEXT[q, WANTED[q]]], COSTS["rerole"] + extra, REROLE, bits))
                here.append(best)
            at = _with_inserts(here, bits)
        columns.append(at)
    return tuple(tuple(columns[end][q] for end in STATES) for q in STATES)


def join_weights(a: int, a_places: int, b: int, b_places: int) -> int:
    """The weight of one run of edits behind another; the second's letters follow the first's last one."""
    a_letters, b_letters = a & ((1 << DIGIT * a_places) - 1), b & ((1 << DIGIT * b_places) - 1)
    free = a_places if not a_letters else ((a_letters & -a_letters).bit_length() - 1) // DIGIT
    cost = (a >> DIGIT * a_places) + (b >> DIGIT * b_places)
    return (cost << DIGIT * (a_places + b_places)) | (a_letters << DIGIT * b_places) | (b_letters << DIGIT * free)


def join_map(at: Weights, places: int, piece: tuple, piece_places: int) -> Weights:
    """The least weights of all states behind one more piece."""
    return [
        _least(*(join_weights(at[q], places, piece[q][end], piece_places)
                 for q in STATES if at[q] is not None and piece[q][end] is not None))
        for end in STATES
    ]


def finish(at: Weights, places: int) -> tuple[int, str]:
    """Cost and audit string, after the insertions at the end."""
    tails = _with_inserts([0 if q in ENDS else None for q in STATES], DIGIT * 2)
    best = min(join_weights(at[q], places, tails[q], 2) for q in STATES if at[q] is not None and tails[q] is not None)
    bits = DIGIT * (places + 2)
    letters = best & ((1 << bits) - 1)
    return best >> bits, f"{letters:0{places + 2}o}".rstrip("0").translate(LETTERS) if letters else ""


# ---- rows ------------------------------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """The damage of the test: by the checksum of ``conv_id:turn`` a row goes, loses its text or the ends of its
    sentences, is doubled, or becomes the user's."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind, text = F.col("kind"), F.coalesce("text", blank)
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("kind"))
    return rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"))


def _fault(first_turn: Column) -> Column:
    """The first fault of a row; its copies are blank or duplicate."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    return (
        F.when(trimmed == "", "blank").when(F.col("at") > first_turn, "duplicate")
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated")
    )


def ordered_rows(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, text, copies, fault, at``: equal rows made one, their faults, and their place ``at``.

    Copies are counted map-side. Rows are dealt by ranges of the whole order, so a conversation of any size is spread.
    """
    keys = (F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    merged = rows.select(*keys, copies.cast("long").alias("copies")).groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    merged = merged.withColumn("at", F.struct(F.col("turn").isNotNull(), "turn"))
    first = merged.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("text").alias("t")).agg(F.min("at").alias("first"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t"))
    judged = merged.join(first, same).select("conv", "turn", "role", "text", "copies", _fault(F.col("first")).alias("fault"))
    order = ("conv", "turn", "role", "text")
    return stage(judged.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "turns")


_PIECE = """conv {conv}, at long, rows string, blank long, duplicate long, truncated long, illegal long,
 first_role string, last_role string, low long, high long, turns long, first_turn long, last_turn long"""


def _pieces(turns: DataFrame) -> DataFrame:
    """What one piece of neighbours in a conversation tells; a piece has at most ``PIECE`` distinct rows."""
    entry = F.struct("at", F.substring("role", 1, 1).alias("role"), "fault", "turn", "copies")
    # A range starts a new count of ``at``, and so a new piece.
    groups = turns.groupBy("conv", F.shiftright("at", PIECE.bit_length() - 1).alias("piece")).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    conv = turns.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [_tell(e) for e in batch.column("entries").to_pylist()]
            names = [c.split()[0] for c in _PIECE.split(",")][1:]
            types = [pa.string() if n in ("rows", "first_role", "last_role") else pa.int64() for n in names]
            yield pa.record_batch([batch.column("conv"), *(pa.array([t[n] for t in told], k) for n, k in zip(names, types))], names=["conv", *names])

    return groups.select("conv", "entries").mapInArrow(run, _PIECE.format(conv=conv))


def _tell(entries: list[dict]) -> dict:
    told = {"at": entries[0]["at"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    letters, roles, turns = [], [], []
    for e in entries:
        again, fault = e["copies"] - 1, e["fault"]
        letter = e["role"] if e["role"] and e["role"] in "sua" else "x"
        letters += ["-" if fault in ("blank", "duplicate") else letter.upper() if fault else letter, "-" * again]
        if fault:
            told[fault] += 1
        told["blank" if fault == "blank" else "duplicate"] += again
        told["illegal"] += again + (bool(roles) and _illegal(roles[-1], e["role"]))
        roles.append(e["role"])
        if e["turn"] is not None and (not turns or turns[-1] != e["turn"]):
            turns.append(e["turn"])
    low, high = (turns[0], turns[-1]) if turns else (None, None)
    return told | {"rows": "".join(letters), "first_role": roles[0], "last_role": roles[-1], "low": low, "high": high,
                   "turns": len(turns), "first_turn": low, "last_turn": high}


def _illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


_PLAN = "conv {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            yield from batch.slice(start, 512).to_pylist()


def _table(rows: Iterator[dict], conv: tuple[str, DataType], strings: tuple[str, ...], size: int = 2_000) -> Iterator[pa.RecordBatch]:
    """Batches of the rows that a stream yields."""
    schema = pa.schema([(conv[0], to_arrow_type(conv[1])), *((c, pa.int64()) for c in _COUNTS), *((c, pa.string()) for c in strings)])
    while some := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(some, schema)


class _Plan:
    """A conversation's repair while its pieces pass."""

    def __init__(self, conv: object) -> None:
        self.row = {"conv": conv} | dict.fromkeys(_COUNTS, 0)
        self.at: Weights = [0, None, None, None]
        self.places, self.role, self.low, self.high, self.turns = 0, None, None, None, 0

    def add(self, p: dict) -> None:
        for c in ("blank", "duplicate", "truncated", "illegal"):
            self.row[c] += p[c]
        self.row["illegal"] += self.role is not None and _illegal(self.role, p["first_role"])
        self.role = p["last_role"]
        if p["turns"]:
            self.turns += p["turns"] - (self.high == p["low"])
            self.low, self.high = p["low"] if self.low is None else self.low, p["high"]
        for start in range(0, len(p["rows"]), PIECE):
            rows = p["rows"][start:start + PIECE]
            self.at = join_map(self.at, self.places, piece_map(rows), 3 * len(rows))
            self.places += 3 * len(rows)

    def done(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, audit = finish(self.at, self.places)
        return self.row | {"gaps": min(gaps, LONG), "cost": cost, "audit": audit}


def plan_repairs(turns: DataFrame) -> DataFrame:
    """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation that has rows."""
    pieces = _pieces(turns)
    conv = turns.schema["conv"].dataType
    schema = _PLAN.format(conv=conv.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def plans() -> Iterator[dict]:
            plan = None
            for p in _rows(batches):
                if plan is None or plan.row["conv"] != p["conv"]:
                    if plan:
                        yield plan.done()
                    plan = _Plan(p["conv"])
                plan.add(p)
            if plan:
                yield plan.done()

        yield from _table(plans(), ("conv", conv), ("audit",))

    return pieces.repartition("conv").sortWithinPartitions("conv", "at").mapInArrow(run, schema)


class Replay:
    """Carries out an audit string over the rows in order and hashes what comes out."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0
        self.hash, self.empty = hashlib.sha256(), True

    def _emit(self, role: str, text: str) -> None:
        self.state = NEXT[self.state, role[0]]
        self.hash.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False

    def _wanted(self) -> str:
        return "user" if WANTED[self.state] == "u" else "assistant"

    def inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._emit(self._wanted(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._emit(role if edit == "K" else self._wanted(), text)

    def digest(self) -> str:
        self.inserts()
        return self.hash.hexdigest()


def repair_conversations(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation.

    ``rows`` has ``conv_id, turn, role, text`` and may count ``copies``; ``conversations`` names by ``conv_id`` those
    that shall appear even without rows. A hash reads its conversation in order, so the rows of one conversation pass
    through one task, in a stream that holds a row at a time and the audit string.
    """
    turns = ordered_rows(rows)
    plans = plan_repairs(turns)
    none = {c: F.lit(None).cast("long") for c in _COUNTS} | {c: F.lit(None).cast("string") for c in ("audit", "role", "text")}

    def part(df: DataFrame, kind: int, at: Column, copies: Column) -> DataFrame:
        have = set(df.columns)
        return df.select("conv", F.lit(kind).alias("kind"), at.alias("at"), copies.alias("copies"), *((F.col(c) if c in have else v).alias(c) for c, v in none.items()))

    nothing = F.lit(0).cast("long")
    stream = part(plans, 0, nothing, nothing).unionByName(part(turns, 2, F.col("at"), F.col("copies")))
    if conversations is not None:
        names = conversations.select(F.col("conv_id").alias("conv")).distinct()
        stream = stream.unionByName(part(names, 1, nothing, nothing))
    conv = turns.schema["conv"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def repaired() -> Iterator[dict]:
            row = replay = None
            for r in _rows(batches):
                if row is None or row["conv_id"] != r["conv"]:
                    if row:
                        yield row | {"repaired_sha256": replay.digest()}
                    row = {"conv_id": r["conv"]} | {c: r[c] or 0 for c in _COUNTS} | {"audit": r["audit"] or ""}
                    replay = Replay(row["audit"])
                for _ in range(r["copies"]):
                    replay.row(r["role"], r["text"])
            if row:
                yield row | {"repaired_sha256": replay.digest()}

        yield from _table(repaired(), ("conv_id", conv), ("audit", "repaired_sha256"))

    schema = f"conv_id {conv.simpleString()}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string, repaired_sha256 string"
    return stream.repartition("conv").sortWithinPartitions("conv", "kind", "at").mapInArrow(run, schema)
