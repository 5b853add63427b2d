"""Benchmark decontamination by n-grams.

Words are runs of ASCII letters, digits and characters beyond ASCII, with A-Z in lower case. A window is ``n``
consecutive words of a benchmark item, or all words of a shorter one. The windows are broadcast as a set, in blocks of
at most ``BLOCK_WINDOWS``; a larger benchmark takes one pass over the documents for each block, one after the other, so
the driver and the broadcast hold one block at any size. In a document, rolling hashes of its words find candidate windows, and comparing the words
verifies them.

Defined results: a null text has no words; an item without words has no window; a null item_id hits but is not listed;
repeated items and rows count once in a list of items, and each document row gives its own result; empty tables give no
windows, or no rows. Extra columns are not read, or pass through where documents are rewritten.
"""

from __future__ import annotations

import re
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import Rows, free_names, map_batches, rewrite_text, row_keys, stage

N = 10
BLOCK_WINDOWS = 1 << 20
_TABLE = bytes(ord(chr(i).lower()) if i < 128 and chr(i).isalnum() else 32 if i < 128 else i for i in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


def benchmark_windows(bench: DataFrame, n: int = N, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``length, words, items``: each distinct window with the sorted ids, as strings, of the items that hold it."""
    def make() -> Rows:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for item, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = words_of(t)
                rows += [(item, min(n, len(w)), b" ".join(w[i:i + n]).decode()) for i in range(max(1, len(w) - n + 1))] if w else []
            cols = list(zip(*rows)) or [(), (), ()]
            return pa.record_batch([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string())], names=["item", "length", "words"])

        return step

    rows = bench.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    return map_batches(rows, make, "item string, length int, words string").groupBy("length", "words").agg(F.sort_array(F.collect_set("item")).alias("items"))


class Block(NamedTuple):
    """Windows by length: their words, and the items of each."""

    windows: list[tuple[int, str, tuple[str, ...]]]


class Scanner:
    def __init__(self, block: Block) -> None:
        self.by_length: dict[int, dict[bytes, tuple[str, ...]]] = defaultdict(dict)
        for length, words, items in block.windows:
            self.by_length[length][words.encode()] = tuple(items)
        self.hashes = {}
        for length, windows in self.by_length.items():
            lists = [w.split() for w in windows]
            flat = np.fromiter((hash(x) for w in lists for x in w), np.int64, len(lists) * length).astype(np.uint64)
            self.hashes[length] = np.unique(self.roll(flat.reshape(-1, length).T))
        self.longest = max(self.by_length, default=0)

    @staticmethod
    def roll(columns) -> np.ndarray:
        out = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            out = (out ^ c) * _MIX
            out ^= out >> np.uint64(32)
        return out

    def candidates(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Positions of all texts together at which a window of that length may start."""
        m = len(hashes) - length + 1
        if m <= 0:
            return np.empty(0, np.int64)
        rolled = self.roll([hashes[k:k + m] for k in range(length)])
        known = self.hashes[length]
        at = np.searchsorted(known, rolled)
        at[at == len(known)] = 0
        return np.flatnonzero(known[at] == rolled)

    def scan(self, texts: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[str]]]:
        """For each text the spans of its hits, (start, end) in words, and the ids of the items."""
        found: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in texts]
        ends = np.cumsum([len(t) for t in texts])
        flat = [w for t in texts for w in t]
        if not flat or not self.longest:
            return found
        hashes = np.fromiter(map(hash, flat), np.int64, len(flat)).view(np.uint64)
        for length, windows in self.by_length.items():
            at = self.candidates(hashes, length)
            for i, d in zip(at.tolist(), np.searchsorted(ends, at, side="right").tolist()):
                if i + length <= ends[d] and (items := windows.get(b" ".join(flat[i:i + length]))) is not None:
                    start = i - (int(ends[d]) - len(texts[d]))
                    found[d][0].append((start, start + length))
                    found[d][1].update(items)
        return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def parts_of(windows: DataFrame, limit: int = BLOCK_WINDOWS) -> int:
    """How many blocks of bounded size the windows make."""
    return max(1, -(-windows.count() // max(1, limit // 2)))


def block_of(windows: DataFrame, k: int, parts: int) -> Broadcast:
    """Block ``k`` on all executors; the driver holds one block at a time."""
    part = windows.where(F.pmod(F.xxhash64("words"), F.lit(parts)) == k) if parts > 1 else windows
    return windows.sparkSession.sparkContext.broadcast(Block([(r.length, r.words, tuple(r["items"])) for r in part.collect()]))


def scan_documents(docs: DataFrame, bench: DataFrame, n: int = N, id_col: str = "doc_id", text_col: str = "text",
                   limit: int = BLOCK_WINDOWS) -> DataFrame:
    """``id_col, n_words, spans, items``: merged hit spans in words, and the sorted ids of the items that occur."""
    return _scanned(docs, stage(benchmark_windows(bench, n), "bench"), id_col, text_col, limit)


def _scanned(docs: DataFrame, windows: DataFrame, id_col: str, text_col: str, limit: int) -> DataFrame:
    parts = parts_of(windows, limit)
    key, = free_names(docs, "scan_key")
    rows = docs.select(id_col, text_col) if parts == 1 else row_keys(docs, key, id_col, text_col)
    key_type = rows.schema[id_col].dataType.simpleString()
    lead = f"`{id_col}` {key_type}" if parts == 1 else f"{key} long, `{id_col}` {key_type}"
    schema = f"{lead}, n_words long, spans array<struct<start:int,end:int>>, items array<string>"
    if parts == 1:
        return map_batches(rows, _scan(block_of(windows, 0, 1)), schema)
    total = None
    for k in range(parts):  # a benchmark beyond one block: its results meet by the row's key
        block = block_of(windows, k, parts)
        found = stage(map_batches(rows, _scan(block), schema), "hits")
        block.destroy()  # what was found is written, so nothing reads the block again
        if total is None:
            total = found
            continue
        right = found.select(key, F.col("spans").alias("more_spans"), F.col("items").alias("more_items"))
        total = stage(total.join(right, key).select(
            key, id_col, "n_words", F.concat("spans", "more_spans").alias("spans"),
            F.array_sort(F.array_union("items", "more_items")).alias("items")), "hits")
    return map_batches(total.drop(key), lambda: _merge_spans, schema.split(", ", 1)[1])


def _scan(block):
    def make() -> Rows:
        scanner = Scanner(block.value)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = [words_of(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            found = scanner.scan(words)
            return pa.record_batch([
                *batch.columns[:-1], pa.array([len(w) for w in words], pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in merged(s)] for s, _ in found], _SPANS),
                pa.array([sorted(i) for _, i in found], pa.list_(pa.string())),
            ], names=[*batch.schema.names[:-1], "n_words", "spans", "items"])

        return step

    return make


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _merge_spans(batch: pa.RecordBatch) -> pa.RecordBatch:
    spans = [[{"start": a, "end": b} for a, b in merged([(x["start"], x["end"]) for x in s])] for s in batch.column("spans").to_pylist()]
    return batch.set_column(batch.schema.get_field_index("spans"), "spans", pa.array(spans, _SPANS))


def summary(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and the digest of the item list of every document."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return scanned.select(
        id_col, "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans; what stands between a removed word and the next goes with it."""
    data = text.encode()
    words = [m.span() for m in re.finditer(rb"[^ ]+", data.translate(_TABLE))]
    kept, at = [], 0
    for start, end in spans:
        kept.append(data[at:words[start][0]])
        at = words[end][0] if end < len(words) else words[-1][1]
    return b"".join([*kept, data[at:]]).decode()


def remove_spans(docs: DataFrame, bench: DataFrame, n: int = N, text: str = "text", limit: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` without the words of benchmark windows; a text without a hit stays as it is.

    With one block of windows this is one pass; with more, spans are gathered by a key of the rows first.
    """
    windows = stage(benchmark_windows(bench, n), "bench")
    parts = parts_of(windows, limit)
    if parts == 1:
        block = block_of(windows, 0, 1)

        def make():
            scanner = Scanner(block.value)

            def change(texts: list) -> list:
                spans = [merged(s) for s, _ in scanner.scan([words_of(t) for t in texts])]
                return [cut(t, s) if s else t for t, s in zip(texts, spans)]

            return change

        return rewrite_text(docs, make, text)
    key, found = free_names(docs, "cut_key", "cut_spans")
    keyed = row_keys(docs, key, *docs.columns)
    spans = _scanned(keyed.select(key, text), windows, key, text, limit).select(key, F.col("spans").alias(found))
    joined = keyed.join(spans, key).drop(key)
    schema = joined.schema

    def make_cut() -> Rows:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            at = batch.schema.get_field_index(text)
            new = [cut(t, [(x["start"], x["end"]) for x in s]) if s else t
                   for t, s in zip(batch.column(at).to_pylist(), batch.column(found).to_pylist())]
            return batch.set_column(at, text, pa.array(new, batch.column(at).type))

        return step

    done = map_batches(joined, make_cut, schema).drop(found)
    return done.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done
