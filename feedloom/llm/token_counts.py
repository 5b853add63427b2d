"""Token counts by a compiled finite-state transducer.

``Lattice`` is the deterministic transducer: its transitions carry the change of the token count. A text is cut into
chunks at any position. A chunk's map says what it does from every entry state: what lies between its first and last
boundary (a place no piece spans) counts the same from all of them, so the map keeps that count and the raw ends. Maps
compose associatively, the ends of neighbours closing up, and are folded as a balanced scan. Within a chunk, words
between boundaries are transitions of their own, remembered per task.

Defined results: a null or empty text has no tokens and no bytes; repeated rows count each on their own; long texts are
chunks of bounded size; an empty table gives no rows. Only the id and the text are read, so extra columns do not clash.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from feedloom.llm.bpe_lattice import SPACE, Lattice, load_pieces
from feedloom.llm.common import Rows, map_batches

CHUNK_CHARS = 1 << 16
MEMO_WORDS = 400_000


class ChunkMap(NamedTuple):
    """``count`` is None if the chunk has no boundary; then it is all head."""

    head: str
    count: int | None
    tail: str


class Memo(dict):
    """Counts of words; forgets all of them when full, which changes no result."""

    def __init__(self, count, prefix: str, limit: int = MEMO_WORDS) -> None:
        super().__init__()
        self.count, self.prefix, self.limit = count, prefix, limit

    def __missing__(self, word: str) -> int:
        n = self.count(self.prefix + word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = n
        return n


class TokenCounter:
    def __init__(self, model: str) -> None:
        self.lattice = Lattice(load_pieces(model))
        pairs = self.lattice.pairs
        if any(b == SPACE != a for a, b in pairs):
            raise ValueError("pieces of this model span word starts")
        self.line_breaks = not any("\n" in p for p in pairs)
        self.marked, self.bare = Memo(self.walk, SPACE), Memo(self.walk, "")

    def walk(self, text: str) -> int:
        """Run the transducer over one stretch, from the start state."""
        state, n, step = self.lattice.start, 0, self.lattice.step
        for char in text:
            move = state.get(char) or step(state, char)
            state = move[0]
            n += move[2]
        return n

    def run(self, text: str) -> int:
        """The count of a stretch that begins at a boundary, word by word."""
        total, marked = 0, self.marked.__getitem__
        lines = text.split("\n") if self.line_breaks else [text]
        for line in lines:
            if SPACE + SPACE in line:
                words = re.findall(f"{SPACE}+[^{SPACE}]*|^[^{SPACE}]+", line)
                total += sum(self.bare[w] for w in words)
            else:
                first, *words = line.split(SPACE)
                total += sum(map(marked, words)) + (self.bare[first] if first else 0)
        return total + len(lines) - 1

    def chunk_map(self, text: str) -> ChunkMap:
        pairs = self.lattice.pairs
        spots = range(1, len(text))
        first = next((i for i in spots if text[i - 1:i + 1] not in pairs), None)
        if first is None:
            return ChunkMap(text, None, "")
        last = next(i for i in reversed(spots) if text[i - 1:i + 1] not in pairs)
        return ChunkMap(text[:first], self.run(text[first:last]), text[last:])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if a.count is None:
            return ChunkMap(a.head + b.head, b.count, b.tail)
        if b.count is None:
            return ChunkMap(a.head, a.count, a.tail + b.head)
        return ChunkMap(a.head, a.count + self.run(a.tail + b.head) + b.count, b.tail)

    def count(self, text: str | None, chunk: int = CHUNK_CHARS) -> int:
        text = self.lattice.surface(text or "")
        if len(text) <= chunk:
            return self.run(text)
        maps = [self.chunk_map(text[i:i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        whole = maps[0]
        return self.run(whole.head) + (whole.count or 0) + self.run(whole.tail)


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every row. ``model`` is the tokenizer's file on each executor."""
    def make() -> Rows:
        counter = TokenCounter(model)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).to_pylist()
            tokens = [counter.count(t) for t in texts]
            return pa.record_batch([
                batch.column(0), pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_()),
            ], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

        return step

    rows = docs.select(id_col, text_col)
    return map_batches(rows, make, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
