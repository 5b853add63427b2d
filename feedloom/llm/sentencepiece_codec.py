"""SentencePiece encoding and decoding by a streaming Viterbi lattice.

The model is a byte-pair one, whose lattice keeps one back-pointer for each position (``Lattice``); following them
from the end gives the library's ids. The encoder reads characters as they come and keeps the back-pointers of a window
only. Paths survive at the alive positions, at most the longest piece back; as soon as all of them run through one
boundary, the pieces before it are committed and leave the window. Where no piece spans a word's start, the lattice runs once per
distinct word of a task, and the ids of texts are gathered from a table of words.

Defined results: null text, null ids and null text again; an empty text has no ids; repeated rows are encoded each on
their own; very long texts and words stream through the bounded window; empty tables give no rows. Decoding gives the
text back, except that the mark U+2581 in a text reads as a space, as the library has it.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from feedloom.llm.bpe_lattice import SPACE, Lattice, Pieces, load_pieces
from feedloom.llm.common import Rows, map_batches
from feedloom.llm.word_batches import WordLists

MEMO_WORDS = 700_000
TABLE_IDS = 2_000_000
_CHECK_EVERY = 32
_TAKEN = 4_096


class Encoder:
    """Ids of one text, character by character: ``feed`` returns what is committed, ``finish`` the rest."""

    def __init__(self, lattice: Lattice) -> None:
        self.lattice, self.state, self.window, self.widest = lattice, lattice.start, [], 0

    def feed(self, text: str) -> list[int]:
        done: list[int] = []
        state, window, step = self.state, self.window, self.lattice.step
        for at in range(0, len(text), _CHECK_EVERY):
            if window:
                self.widest = max(self.widest, len(window))
                done += self.commit(self.meeting(state.depths))
            for char in text[at:at + _CHECK_EVERY]:
                move = state.get(char) or step(state, char)
                state = move[0]
                window.append(move[1])
        self.state = state
        return done

    def path(self, end: int) -> Iterable[int]:
        """The boundaries on the best path to a position of the window."""
        while end > 0:
            yield end
            end -= len(self.window[end - 1])
        yield 0

    def meeting(self, depths: list[int]) -> int:
        """The last boundary that the paths to all surviving positions share."""
        paths = [set(self.path(len(self.window) - d)) for d in depths]
        return max(set.intersection(*paths))

    def commit(self, end: int) -> list[int]:
        window, at, pieces = self.window, end, []
        while at:
            pieces.append(window[at - 1])
            at -= len(pieces[-1])
        get, ids = self.lattice.pieces.ids.get, []
        for piece in reversed(pieces):
            known = get(piece)
            if known is None:
                ids += self.piece_ids(piece)
            else:
                ids.append(known)
        del window[:end]
        return ids

    def piece_ids(self, piece: str) -> list[int]:
        known = self.lattice.pieces.ids.get(piece)
        return [known] if known is not None else [self.lattice.pieces.byte_ids[b] for b in piece.encode()]

    def finish(self) -> list[int]:
        return self.commit(len(self.window))


class Memo(dict):
    def __init__(self, encode, prefix: str, limit: int = MEMO_WORDS) -> None:
        super().__init__()
        self.encode, self.prefix, self.limit = encode, prefix, limit

    def __missing__(self, word: str) -> list[int]:
        ids = self.encode(self.prefix + word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = ids
        return ids


class Codec:
    def __init__(self, model: str) -> None:
        self.pieces: Pieces = load_pieces(model)
        self.lattice = Lattice(self.pieces)
        self.marked, self.bare = Memo(self.stream, SPACE), Memo(self.stream, "")
        self.by_words = not any(b == SPACE != a for a, b in self.lattice.pairs)
        self.break_id = None if any("\n" in p for p in self.lattice.pairs) else Encoder(self.lattice).piece_ids("\n")
        self.shown = [n.replace(SPACE, " ").encode() for n in self.pieces.names]
        for byte, i in enumerate(self.pieces.byte_ids):
            self.shown[i] = bytes([byte])
        self.table = WordLists(self.encode_words, TABLE_IDS)

    def stream(self, text: str) -> list[int]:
        encoder = Encoder(self.lattice)
        return encoder.feed(text) + encoder.finish()

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.runs(text)))

    def runs(self, text: str) -> list[list[int]]:
        """The ids of a text, in runs between boundaries."""
        text = self.lattice.surface(text)
        if not self.by_words:
            return [self.stream(text)]
        runs: list[list[int]] = []
        for k, line in enumerate(text.split("\n") if self.break_id else [text]):
            if k:
                runs.append(self.break_id)
            if SPACE + SPACE in line:
                runs += [self.bare[word] for word in re.findall(f"{SPACE}+[^{SPACE}]*|^[^{SPACE}]+", line)]
            else:
                first, *words = line.split(SPACE)
                if first:
                    runs.append(self.bare[first])
                runs += map(self.marked.__getitem__, words)
        return runs

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, each streamed through the lattice; every one is decoded again, as a proof."""
        flat, counts = array("i"), np.zeros(len(words), np.int64)
        for at in range(0, len(words), _TAKEN):  # few words at a time as objects
            for k, word in enumerate(words.slice(at, _TAKEN).to_pylist(), at):
                ids = self.stream(word.replace(" ", SPACE))
                if b"".join(map(self.shown.__getitem__, ids)).decode() != word.replace(SPACE, " "):
                    raise ValueError("ids that do not decode to their word")
                flat.extend(ids)
                counts[k] = len(ids)
        return np.frombuffer(flat, np.int32), counts

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """The ids of all texts in a row, how many each has, and whether they decode to the very text."""
        if self.by_words:
            if self.pieces.dummy_prefix:  # the mark in front of a text is like a space there
                texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(pa.scalar(" "), texts, pa.scalar("")))
            flat, counts = self.table.texts(texts)
            return flat, counts, pc.fill_null(pc.invert(pc.match_substring(texts, SPACE)), True)
        plain = texts.to_pylist()
        ids = [[] if t is None else self.encode(t) for t in plain]
        counts = np.array([len(i) for i in ids], np.int64)
        exact = [t is None or self.decode(i) == t for i, t in zip(ids, plain)]
        return np.fromiter(chain.from_iterable(ids), np.int32, counts.sum()), counts, pa.array(exact, pa.bool_())

    def decode(self, ids: list[int]) -> str:
        out = b"".join(map(self.shown.__getitem__, ids))
        text = out.decode(errors="replace")
        return text[1:] if self.pieces.dummy_prefix and text.startswith(" ") else text


@lru_cache(maxsize=1)
def shared_codec(model: str) -> Codec:
    """The codec of a Python worker: later tasks in it go on with the states and words that earlier ones met."""
    return Codec(model)


def encode_texts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_ids, ids, exact``; ``exact`` says whether decoding the ids gives the very text."""
    def make() -> Rows:
        codec = shared_codec(model)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            flat, counts, exact = codec.encode_batch(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(flat, pa.int32()), mask=pc.is_null(batch.column(1)))
            return pa.record_batch([batch.column(0), pa.array(counts), lists, exact], names=[id_col, "n_ids", "ids", "exact"])

        return step

    rows = docs.select(id_col, text_col)
    return map_batches(rows, make, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, n_ids long, ids array<int>, exact boolean")


def decode_ids(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text`` of encoded rows."""
    def make() -> Rows:
        codec = Codec(model)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [None if i is None else codec.decode(i) for i in batch.column(1).to_pylist()]
            return pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

        return step

    rows = encoded.select(id_col, ids_col)
    return map_batches(rows, make, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, text string")
