"""Token ids in binary files: a canonical, length-limited Huffman code over blocks that are read on their own.

Writing takes three steps. Texts become ids, in the order of the documents kept by a table. The ids are counted over
the whole table, and from the counts, no more than the vocabulary has, the package-merge method makes code lengths of
at most ``MAX_BITS``. Then documents go to files by ranges of their id, and each file is a row of blocks.

A folder holds ``codes`` (one JSON line with the code length of each id) and ``blocks``, whose files are
``length, checksum, record, line feed`` again and again. A record is a JSON header, the bit offsets of every
``EVERY``-th id, and the code bits. The header names the documents in the block, the place of the block in its range,
and how many ids of the range stand before it. A block needs nothing but the codes to be read: every offset starts a
lane, and all lanes go on together, one table look-up per id.

Defined results: a null or empty text has the end id only; rows that share an id are documents of their own, in the
order of their counts and checksums; null ids come first; a text of any length is cut over blocks; an empty table
makes a folder without blocks, and reads as no rows. Only the id and the text are read, so extra columns do not clash.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import Rows, fresh_path, map_batches, stage
from feedloom.llm.word_batches import PLAIN, WordLists

MAX_BITS = 18
BLOCK_IDS = 1 << 18
EVERY = 128
FILE_BLOCKS = 32
MEMO_IDS = 2_000_000
ROW = 100
CALL = 64


# ---- ids of texts ----------------------------------------------------------------------------------------

class Tokenizer:
    """Ids as the tokenizers library gives them, without added special tokens.

    A byte-level tokenizer that splits with its own pattern never joins over a cut of ``word_batches``, so the
    library is asked once for each distinct word of a task. Words go to it in rows of ``ROW``; the bytes that each id
    stands for say where a word ends. For a tokenizer of another kind, whole texts go to the library.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; every thread would keep memory of its own
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(self.library.to_str())
        split, added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
        exact = not any(t[k] for t in added for k in ("lstrip", "rstrip", "single_word", "normalized")) and not any(" " in t["content"] for t in added)
        self.by_words = exact and spec["normalizer"] is None and split.get("type") == "ByteLevel" and bool(split.get("use_regex")) and not split.get("add_prefix_space")
        self.size = self.library.get_vocab_size()
        self.words = WordLists(self.encode_words, MEMO_IDS)
        if self.by_words:  # a character of a piece is a byte
            self.bytes = np.zeros(self.size, np.int64)
            for piece, i in self.library.get_vocab().items():
                self.bytes[i] = len(piece)
            for t in added:
                self.bytes[t["id"]] = len(t["content"].encode())

    def encode_each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(e.ids, np.int32) for k in range(0, len(texts), CALL) for e in self.library.encode_batch_fast(texts[k:k + CALL], add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.int32), *found]), np.fromiter(map(len, found), np.int64, len(found))

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, and how many each has."""
        row = pc.match_substring_regex(words, rf"\A {PLAIN}(?s:.*{PLAIN})?\z").to_numpy(zero_copy_only=False)
        flat, _ = self.encode_each(joined(words.filter(pa.array(row)), ROW))
        others, own = self.encode_each(words.filter(pa.array(~row)).to_pylist())
        ends, size = np.cumsum(self.bytes[flat]), pc.binary_length(words).to_numpy().astype(np.int64)
        wanted = np.cumsum(size[row])
        stops = np.searchsorted(ends, wanted) + 1
        if len(stops) and (stops[-1] != len(flat) or (ends[stops - 1] != wanted).any()):
            raise ValueError("this tokenizer joins words")
        lengths = np.zeros(len(words), np.int64)
        lengths[row], lengths[~row] = np.diff(np.r_[0, stops]), own
        out = np.empty(int(lengths.sum()), np.int32)
        in_row = np.repeat(row, lengths)
        out[in_row], out[~in_row] = flat, others
        return out, lengths

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        if self.by_words:
            return self.words.texts(texts)
        return self.encode_each([t or "" for t in texts.to_pylist()])


def joined(words: pa.Array, row: int) -> list[str]:
    """The words in rows of ``row``, without anything between them."""
    words = pa.concat_arrays([words])
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    data, cuts = words.buffers()[2], [*ends[:-1:row].tolist(), int(ends[-1])] if len(words) else [0]
    return [data[a:b].to_pybytes().decode() for a, b in zip(cuts, cuts[1:])]


def tokenize(docs: DataFrame, model: str, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n, crc, ids, row`` of every row, written down; ``ids`` are little-endian, 16 bits wide if the vocabulary
    allows it, ``crc`` is that of the ids as 32-bit integers. ``model`` is the tokenizer's file on each executor."""
    def make() -> Rows:
        library = Tokenizer(model)
        wide = np.dtype("<u2" if max(library.size - 1, end_id or 0) < 1 << 16 else "<u4")

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            flat, n = library.ids(batch.column(1))
            if end_id is not None:
                flat, n = np.insert(flat, np.cumsum(n), end_id), n + 1
            ends = np.cumsum(n)
            long, short = flat.astype("<u4"), flat.astype(wide)
            spans = list(zip((ends - n).tolist(), ends.tolist()))
            return pa.record_batch([
                batch.column(0), pa.array(n), pa.array([zlib.crc32(long[a:b]) for a, b in spans], pa.int64()),
                pa.array([short[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([wide.itemsize] * len(n), pa.int32()),
            ], names=["id", "n", "crc", "ids", "width"])

        return step

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    made = map_batches(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, n long, crc long, ids binary, width int")
    return stage(made.withColumn("row", F.monotonically_increasing_id()), "token-ids")


# ---- the code --------------------------------------------------------------------------------------------

def id_counts(tokens: DataFrame) -> dict[int, int]:
    """How often each id occurs, at most one entry per id of the vocabulary; tasks count before they shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            data, width = batch.column(0), batch.column(1)[0].as_py() if batch.num_rows else 4
            ends = np.frombuffer(data.buffers()[1], np.int32)[[data.offset, data.offset + len(data)]]
            ids = np.frombuffer(data.buffers()[2], np.uint8)[slice(*ends)].view(f"<u{width}") if ends[0] < ends[1] else []
            for k in range(0, len(ids), 1 << 20):
                here = np.bincount(ids[k:k + (1 << 20)], minlength=len(total))
                here[:len(total)] += total
                total = here
        ids = np.flatnonzero(total)
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["token", "n"])

    counts = tokens.select("ids", "width").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r.token: r.n for r in counts.collect()}


def code_lengths(counts: dict[int, int], max_bits: int = MAX_BITS) -> dict[int, int]:
    """Optimal code lengths of at most ``max_bits`` by package-merge: on every level pairs of the level before join
    the symbols, and a symbol's length is the number of levels on which the cheapest choice has it."""
    ids = sorted(counts, key=lambda i: (counts[i], i))
    if len(ids) < 2:
        return dict.fromkeys(ids, 1)
    if len(ids) > 1 << max_bits:
        raise ValueError(f"{len(ids)} ids need codes of more than {max_bits} bits")
    leaves = np.array([counts[i] for i in ids], np.int64)
    level, leaf_marks = leaves[:0], []
    for _ in range(max_bits):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        order = np.argsort(both, kind="stable")
        level = both[order]
        leaf_marks.append(order < len(leaves))
    lengths, take = np.zeros(len(ids), np.int64), 2 * len(ids) - 2
    for marks in reversed(leaf_marks):
        used = int(marks[:take].sum())
        lengths[:used] += 1
        take = 2 * (take - used)
    return dict(zip(ids, lengths.tolist()))


class Code:
    """The canonical code of given lengths: codes ascend with length, then id."""

    def __init__(self, lengths: dict[int, int]) -> None:
        order = sorted(lengths, key=lambda i: (lengths[i], i))
        self.bits = max(lengths.values(), default=1)
        if self.bits > 24 or max(order, default=0) >> 27:
            raise ValueError("codes of more than 24 bits, or ids of more than 27, do not fit the reader's table")
        top = max(order, default=0) + 1
        self.code, self.length = np.zeros(top, np.uint32), np.zeros(top, np.int64)
        ids, n = np.array(order, np.int64), np.array([lengths[i] for i in order], np.int64)
        spans = 1 << (self.bits - n)
        starts = np.cumsum(spans) - spans
        if len(ids) and starts[-1] + spans[-1] > 1 << self.bits:
            raise ValueError("no code has these lengths")
        self.code[ids], self.length[ids] = starts >> (self.bits - n), n
        rest = (1 << self.bits) - int(spans.sum())
        # What the next bits say: the id, and in the low five bits how many of them it takes.
        self.table = np.concatenate([np.repeat(ids << 5 | n, spans), np.ones(rest, np.int64)]).astype(np.uint32)

    def pack(self, ids: np.ndarray, every: int = EVERY) -> tuple[bytes, np.ndarray]:
        """The code bits of ids, and where each ``every``-th id starts."""
        n = self.length[ids]
        if not n.all():
            raise ValueError("an id without a code")
        ends = np.cumsum(n)
        starts = ends - n
        # A code lies in at most two words of 32 bits; what codes give to a word does not overlap, so it can be added.
        pair = self.code[ids].astype(np.uint64) << (64 - n - (starts & 31)).astype(np.uint64)
        size = int(ends[-1] >> 5) + 2 if len(ids) else 0
        words = np.bincount(starts >> 5, pair >> np.uint64(32), size) + np.bincount((starts >> 5) + 1, pair & np.uint64(0xFFFFFFFF), size)
        return words.astype(">u4").tobytes()[:int(n.sum() + 7) >> 3], starts[::every].astype("<u4")

    def unpack(self, data: bytes, offsets: np.ndarray, n: int, every: int = EVERY) -> np.ndarray:
        """The ``n`` ids of code bits; a lane that does not end where the next one starts is an error."""
        padded = np.frombuffer(data + bytes(every * self.bits // 8 + 8), np.uint8).astype(np.uint32)
        windows = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
        at, out = offsets.astype(np.int64), np.empty((every, len(offsets)), np.uint32)
        mask, shift = np.uint32((1 << self.bits) - 1), 32 - self.bits
        for k in range(every):
            found = self.table[(windows[at >> 3] >> (shift - (at & 7)).astype(np.uint32)) & mask]
            out[k] = found >> 5
            at += found & 31
        if (at[:-1] != offsets[1:]).any():
            raise ValueError("code bits do not meet the offsets")
        return out.T.reshape(-1)[:n]


# ---- blocks ----------------------------------------------------------------------------------------------

def frame(header: dict, offsets: np.ndarray, data: bytes) -> bytes:
    head = json.dumps(header, separators=(",", ":")).encode()
    body = len(head).to_bytes(4, "little") + head + offsets.tobytes() + data
    return len(body).to_bytes(4, "little") + zlib.crc32(body).to_bytes(4, "little") + body


def frames(content: bytes) -> Iterator[tuple[dict, np.ndarray, bytes]]:
    """The blocks of a file: header, offsets and code bits."""
    at = 0
    while at < len(content):
        size = int.from_bytes(content[at:at + 4], "little")
        body = content[at + 8:at + 8 + size]
        if len(body) != size or zlib.crc32(body) != int.from_bytes(content[at + 4:at + 8], "little"):
            raise ValueError("a block is damaged")
        at += size + 9  # with the line feed of the writer
        start = 4 + int.from_bytes(body[:4], "little")
        header = json.loads(body[4:start])
        lanes = -(-header["n"] // header["every"])
        yield header, np.frombuffer(body, "<u4", lanes, start), body[start + 4 * lanes:]


def _blocks(code: Code, block_ids: int):
    """Cuts the documents of a range, as they come, into blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, doc, before = TaskContext.get().partitionId(), -1, 0
        docs: list[list] = []
        held: list[np.ndarray] = []
        n = 0

        def close() -> pa.RecordBatch:
            nonlocal docs, held, n, before
            data, offsets = code.pack(np.concatenate(held))
            header = {"part": part, "before": before, "n": n, "every": EVERY, "doc": doc - len(docs) + 1, "docs": docs}
            before, docs, held, n = before + n, [], [], 0
            return pa.record_batch([pa.array([frame(header, offsets, data)], pa.binary())], names=["value"])

        for batch in batches:
            for name, data, width in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                ids, at = np.frombuffer(data.as_buffer(), f"<u{width}"), 0
                doc += 1
                while at < len(ids):
                    piece = ids[at:at + block_ids - n]
                    docs.append([name, len(piece)])
                    held.append(piece)
                    n, at = n + len(piece), at + len(piece)
                    if n == block_ids:
                        yield close()
        if n:
            yield close()

    return run


def write_ids(tokens: DataFrame, path: str | None = None, max_bits: int = MAX_BITS, block_ids: int = BLOCK_IDS) -> str:
    """Write what ``tokenize`` made, in ascending order of the ids; returns the folder, in the shared one if none is
    named. A document has one id at least, so each stands in some block."""
    spark = tokens.sparkSession
    path = path or fresh_path(spark, "token-store")
    lengths = code_lengths(id_counts(tokens), max_bits)
    meta = {"id_type": tokens.schema["id"].dataType.simpleString(), "lengths": sorted(lengths.items())}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/codes")
    order = ("id", "n", "crc", "row")
    ranges = tokens.where("n > 0").repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = ranges.select("id", "ids", "width").mapInArrow(_blocks(Code(lengths), block_ids), "value binary")
    blocks.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", FILE_BLOCKS).option("compression", "none").text(f"{path}/blocks")
    return path


def read_pieces(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """``part, doc, at, id, n, crc`` and, if wanted, ``ids`` of each piece of a document that a block holds.

    ``at`` counts the ids of the range before the piece, ``doc`` the documents of the range.
    """
    meta = json.loads(spark.read.text(f"{path}/codes").first()[0])
    lengths = {i: n for i, n in meta["lengths"]}
    names = ["part", "doc", "at", "id", "n", "crc", *(["ids"] if ids else [])]
    schema = f"part int, doc long, at long, id {meta['id_type']}, n long, crc long" + (", ids array<long>" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for batch in batches:
            for content in batch.column(0):
                for header, offsets, data in frames(content.as_py()):
                    found = code.unpack(data, offsets, header["n"], header["every"]).astype("<u4")
                    rows, at = [], 0
                    for k, (name, n) in enumerate(header["docs"]):
                        mine = found[at:at + n]
                        rows.append((header["part"], header["doc"] + k, header["before"] + at, name, n, zlib.crc32(mine), *([mine.tolist()] if ids else [])))
                        at += n
                    types = [pa.int32(), pa.int64(), pa.int64(), None, pa.int64(), pa.int64(), pa.list_(pa.int64())]
                    yield pa.record_batch([pa.array(c, pa.string() if t is None and meta["id_type"] == "string" else t) for c, t in zip(zip(*rows), types)], names=names)

    return spark.read.format("binaryFile").load(f"{path}/blocks").select("content").mapInArrow(run, schema)


# ---- whole documents -------------------------------------------------------------------------------------

def crc_joined(first: int, second: int, second_bytes: int) -> int:
    """The CRC-32 of two stretches in a row from those of each: the first is carried over the second's bytes, a
    product with x^(8 n) modulo the polynomial, in its bit-reversed form."""
    def times(a: int, b: int) -> int:
        out = 0
        for k in range(31, -1, -1):
            if a >> k & 1:
                out ^= b
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        return out

    power, square, n = 1 << 31, 1 << 23, second_bytes  # x^0 and x^8
    while n:
        if n & 1:
            power = times(power, square)
        square, n = times(square, square), n >> 1
    return times(power, first) ^ second


def document_digests(pieces: DataFrame) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of each document; ``start`` counts the ids of all documents before it.

    Ranges follow one another, so what stands before a range is a sum over one row per range.
    """
    spark = pieces.sparkSession
    pieces = stage(pieces.select("part", "doc", "at", "id", "n", "crc"), "token-pieces")
    sizes = sorted((r.part, r.n) for r in pieces.groupBy("part").agg(F.sum("n").alias("n")).collect())
    offsets, total = [], 0
    for part, n in sizes:
        offsets.append((part, total))
        total += n
    before = F.broadcast(spark.createDataFrame(offsets, "part int, offset long"))
    docs = pieces.groupBy("part", "doc").agg(
        F.first("id").alias("id"), F.min("at").alias("at"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
        F.min("crc").alias("crc"), F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("parts"))

    def join() -> Rows:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for parts in batch.column("parts").to_pylist():
                crc = 0
                for p in parts:
                    crc = crc_joined(crc, p["crc"], 4 * p["n"])
                out.append(crc)
            return batch.drop_columns(["parts"]).set_column(batch.schema.get_field_index("crc"), "crc", pa.array(out, pa.int64()))

        return step

    cut = docs.where("k > 1").drop("k")
    joined = map_batches(cut, join, cut.drop("parts").schema)
    whole = docs.where("k = 1").select(*joined.columns).unionByName(joined).join(before, "part")
    return whole.select("id", (F.col("at") + F.col("offset")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
