"""Substring deduplication with suffix automata of reference shards.

A word goes if a window of ``window`` words over it also starts in a document with a smaller id. The reference is the
corpus itself, so its automata have no size bound and are not broadcast: matching parts meet in shards instead.

1. *Anchors.* The smallest hash of the five-word grams of a window is its anchor; equal windows have equal anchors. Each
   task sends every anchor once per document to the anchor's bucket, and learns which are shared by two documents and
   the smallest document (owner) of each. Anchors of very many documents are marked hot, by tasks on their own already.
2. *Segments.* Runs of windows whose anchors are shared and have one owner go to the owner's shard, and equal ones are
   summed map-side. Windows of hot anchors go to shards by their own content, so no shard holds them all: each slice of
   a task sends its distinct ones once, with their smallest document, in one row per shard. So neither a window that
   many documents have nor the number of windows of a hot run makes rows.
3. *Automata.* A shard builds suffix automata over its segments, in blocks of bounded size, with the smallest document
   of each state. Streaming the segments through them gives matching statistics, capped at the window's length, and
   so the first document of each window.
4. *Removal.* Segments return to their documents; windows with a smaller first document are removed. A window of a hot
   anchor is removed unless its shard names the document as its first: the shard sends each first document the words of
   its windows, once however many documents have them, and the document compares words.

Words decide everywhere; hashes only say who meets. One 64-bit hash tells rows of the same id apart by their texts.

Defined results: ids are integers, or strings that Spark casts to long; a null text has no words; a row with a null id
loses nothing and is no reference; rows that repeat an id are not copies of each other; documents shorter than a window
keep all words; an empty table gives no rows. Extra columns of any name are not read, or pass through where documents
are rewritten.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import Rows, free_names, hex_digest, map_batches, stage

WINDOW, GRAM = 13, 5
HOT_DOCS, HOT_IN_TASK = 512, 64
SHARD_WORDS = 100_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Automaton:
    """A suffix automaton over sequences of words; each state knows the smallest document that ends there."""

    def __init__(self) -> None:
        self.moves: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [1 << 62]

    def _state(self, moves: dict, link: int, length: int, first: int) -> int:
        self.moves.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.moves) - 1

    def _split(self, p: int, q: int, word) -> int:
        """The part of ``q`` that is one longer than ``p``, as a state of its own."""
        copy = self._state(dict(self.moves[q]), self.link[q], self.length[p] + 1, 1 << 62)
        while p >= 0 and self.moves[p].get(word) == q:
            self.moves[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, words: list, doc: int) -> None:
        last, moves, link, length = 0, self.moves, self.link, self.length
        for word in words:
            q = moves[last].get(word)
            if q is not None:  # this prefix is known from another sequence
                last = q if length[q] == length[last] + 1 else self._split(last, q, word)
            else:
                new, p = self._state({}, 0, length[last] + 1, 1 << 62), last
                while p >= 0 and word not in moves[p]:
                    moves[p][word] = new
                    p = link[p]
                if p >= 0:
                    q = moves[p][word]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, q, word)
                last = new
            if doc < self.first[last]:
                self.first[last] = doc

    def close(self) -> None:
        """Hand the smallest documents on to shorter suffixes."""
        for v in sorted(range(1, len(self.moves)), key=self.length.__getitem__, reverse=True):
            up = self.link[v]
            if self.first[v] < self.first[up]:
                self.first[up] = self.first[v]

    def statistics(self, words: list, cap: int):
        """For each word the length of the longest match that ends there, at most ``cap``, and its first document."""
        v = size = 0
        moves, link, length, first = self.moves, self.link, self.length, self.first
        for word in words:
            while v and word not in moves[v]:
                v = link[v]
                size = length[v]
            q = moves[v].get(word)
            if q is not None:
                v, size = q, size + 1
            if size >= cap:
                size = cap
                while length[link[v]] >= cap:
                    v = link[v]
            yield size, first[v]


def words_of(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def anchors(words: list[bytes], window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """The anchor of each window of a sequence of words."""
    n = len(words) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h, m = _hashes(words), len(words) - gram + 1
    grams = np.zeros(m, np.uint64)
    for k in range(gram):
        grams = (grams ^ h[k:k + m]) * _MIX
        grams ^= grams >> np.uint64(29)
    least = grams[:n].copy()
    for k in range(1, window - gram + 1):
        np.minimum(least, grams[k:k + n], out=least)
    return least


def _binary(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Binary values cut from one array at ``starts``."""
    bounds = (np.r_[starts, len(data)] * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])


_ASK = "bucket int, doc long, anchors binary, docs binary, hot binary"


def _ask(buckets: int, window: int):
    """Questions per bucket: anchors with their documents, or one hot mark. Answers to documents that hold anchors hot
    within the task already travel along, with ``doc`` set."""
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts, ids = [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a = np.unique(anchors(words_of(text), window))
            parts.append(a)
            ids.append(np.full(len(a), doc, np.int64))
        anchor, doc = (np.concatenate(x) if x else np.empty(0, t) for x, t in ((parts, np.uint64), (ids, np.int64)))
        order = np.lexsort((doc, anchor))
        anchor, doc = anchor[order], doc[order]
        new = np.r_[True, (anchor[1:] != anchor[:-1])] if len(anchor) else np.empty(0, bool)
        group = np.cumsum(new) - 1
        hot = np.bincount(group)[group] >= HOT_IN_TASK if len(anchor) else np.empty(0, bool)
        out = []
        asked = ~hot | new
        bucket = (anchor[asked] % np.uint64(buckets)).astype(np.int32)
        by = np.argsort(bucket, kind="stable")
        a, d, h, bucket = anchor[asked][by], doc[asked][by], hot[asked][by], bucket[by]
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(a) else np.empty(0, int)
        out.append((bucket[starts], None, _binary(a, starts), _binary(d, starts), _binary(h.astype(np.uint8), starts)))
        by = np.argsort(doc[hot], kind="stable")
        a, d = anchor[hot][by], doc[hot][by]
        starts = np.flatnonzero(np.r_[True, d[1:] != d[:-1]]) if len(a) else np.empty(0, int)
        out.append(((d[starts] % buckets).astype(np.int32), d[starts], _binary(a, starts), _binary(d, starts), _binary(np.ones(len(a), np.uint8), starts)))
        names = [x.split()[0] for x in _ASK.split(", ")]
        return pa.concat_tables(pa.table([
            pa.array(b, pa.int32()), pa.nulls(len(b), pa.int64()) if to is None else pa.array(to, pa.int64()), x, y, z], names=names) for b, to, x, y, z in out)

    return step


_ANSWER = "doc long, anchors binary, owners binary, hot binary"


def _answer(table: pa.Table) -> pa.Table:
    """What a bucket knows of its anchors, for each document that asked and shares one."""
    names = [x.split()[0] for x in _ANSWER.split(", ")]
    given = table.filter(pc.is_valid(table["doc"]))
    asked = table.filter(pc.is_null(table["doc"]))
    join = lambda name, kind: np.frombuffer(b"".join(asked[name].to_pylist()), kind)
    anchor, doc, flag = join("anchors", np.uint64), join("docs", np.int64), join("hot", np.uint8)
    passed = pa.table([given["doc"], given["anchors"], given["docs"], given["hot"]], names=names)
    if not len(anchor):
        return passed
    order = np.lexsort((doc, anchor))
    anchor, doc, flag = anchor[order], doc[order], flag[order]
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(anchor)]))
    fresh = np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]
    count = np.add.reduceat(fresh, starts, dtype=np.int64)
    hot = (np.maximum.reduceat(flag, starts) > 0) | (count > HOT_DOCS)
    pick = ((count > 1) | hot)[group] & fresh & (flag == 0)
    owner, heat = doc[starts][group][pick], hot[group][pick].astype(np.uint8)
    anchor, doc = anchor[pick], doc[pick]
    order = np.argsort(doc, kind="stable")
    anchor, doc, owner, heat = anchor[order], doc[order], owner[order], heat[order]
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.empty(0, int)
    mine = pa.table([pa.array(doc[starts], pa.int64()), _binary(anchor, starts), _binary(owner, starts), _binary(heat, starts)], names=names)
    return pa.concat_tables([mine, passed.cast(mine.schema)])


COLD, HOT, HOT_STARTS = 0, 1, 2
_SEGMENT = "kind int, doc long, version long, start int, route long, words binary, docs binary"


def _segments(window: int, routes: int):
    """Runs of windows with shared anchors; for hot ones the distinct windows of the batch, packed by route, with their
    smallest documents, and where each document has some. The batch has doc, version, text and the answers."""
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[], [], [], [], [], []]
        firsts: dict[bytes, int] = {}
        cols = [c.to_pylist() for c in batch.columns]
        for doc, version, text, answers in zip(*cols):
            gather = lambda name, kind: np.frombuffer(b"".join(x[name] for x in answers), kind)
            words = words_of(text)
            mine = anchors(words, window)
            known = gather("anchors", np.uint64)
            order = np.argsort(known)
            known = known[order]
            at = np.searchsorted(known, mine)
            at[at == len(known)] = 0
            ok = known[at] == mine
            owners = gather("owners", np.int64)[order][at]
            heat = gather("hot", np.uint8)[order][at] > 0
            cut = np.flatnonzero(np.r_[True, (ok[1:] != ok[:-1]) | (owners[1:] != owners[:-1]) | heat[1:] | heat[:-1], True])
            rows = [(COLD, a, int(owners[a]), b" ".join(words[a:b + window - 1]))
                    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()) if ok[a] and not heat[a]]
            starts = np.flatnonzero(ok & heat)
            for a in starts.tolist():
                part = b" ".join(words[a:a + window])
                if firsts.get(part, doc) >= doc:
                    firsts[part] = doc
            if len(starts):
                rows.append((HOT_STARTS, -1, 0, starts.astype(np.int32).tobytes()))
            for kind, start, route, part in rows:
                for column, value in zip(out, (kind, doc, version, start, route, part)):
                    column.append(value)
        packed: dict[int, list[bytes]] = {}
        for part in firsts:
            packed.setdefault(xxhash.xxh64_intdigest(part) % routes, []).append(part)
        docs: list = [None] * len(out[0])
        for route, parts in packed.items():
            for column, value in zip(out, (HOT, None, None, None, route, b"\n".join(parts))):
                column.append(value)
            docs.append(np.array([firsts[p] for p in parts], np.int64).tobytes())
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.record_batch([pa.array(c, t) for c, t in zip((*out, docs), types)], names=[x.split()[0] for x in _SEGMENT.split(", ")])

    return step


def first_documents(segments: list[list], docs: list[int], window: int, block_words: int = SHARD_WORDS) -> list[list[int]]:
    """For each window of each segment the smallest document among those of equal windows, block by block."""
    best = [[1 << 62] * (len(s) - window + 1) for s in segments]
    at = 0
    while at < len(segments):
        automaton, size = Automaton(), 0
        while at < len(segments) and (not size or size + len(segments[at]) <= block_words):
            automaton.add(segments[at], docs[at])
            size += len(segments[at])
            at += 1
        automaton.close()
        for k, words in enumerate(segments):
            mine = best[k]
            for i, (length, doc) in enumerate(automaton.statistics(words, window)):
                if length == window and doc < mine[i - window + 1]:
                    mine[i - window + 1] = doc
    return best


_FIRSTS = "route long, words binary, firsts array<long>"


def _shards(window: int, block_words: int = SHARD_WORDS):
    """Streams the segments of a partition, sorted by route, through automata of whole routes."""
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        # Routes are apart by their words' windows, so several small ones may share an automaton.
        firsts = first_documents([r[1].split(b" ") for r in rows], [r[2] for r in rows], window, block_words)
        # Where no document has to lose something, nothing is said.
        kept = [(route, words, found) for (route, words, _, last), found in zip(rows, firsts) if min(found) < last]
        cols = list(zip(*kept)) or [(), (), ()]
        types = (pa.int64(), pa.binary(), pa.list_(pa.int64()))
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=["route", "words", "firsts"])

    def run(batches):
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= block_words // 2 and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += row[1].count(b" ") + 1
        if rows:
            yield solve(rows)

    return run


_KEPT = "doc long, kept binary"


def _hot_shards(window: int, block_words: int = SHARD_WORDS):
    """The packed windows of a partition, sorted by route: for each document the windows it is the first to have.

    Equal windows are merged as they arrive, so a route holds its distinct ones; those go through automata in blocks,
    each window through the block that holds it, since no window lies in another of the same length."""
    def solve(firsts: dict[bytes, int]) -> pa.RecordBatch:
        mine: dict[int, list[bytes]] = {}
        parts, per = list(firsts), max(1, block_words // window)
        for at in range(0, len(parts), per):
            block = parts[at:at + per]
            for part, (doc,) in zip(block, first_documents([p.split(b" ") for p in block], [firsts[p] for p in block], window, block_words)):
                mine.setdefault(doc, []).append(part)
        return pa.record_batch([pa.array(list(mine), pa.int64()), pa.array([b"\n".join(p) for p in mine.values()], pa.binary())], names=["doc", "kept"])

    def run(batches):
        route, firsts = None, {}
        for batch in batches:
            for at, words, docs in zip(*(c.to_pylist() for c in batch.columns)):
                if at != route and firsts:
                    yield solve(firsts)
                    firsts = {}
                route = at
                for part, doc in zip(words.split(b"\n"), np.frombuffer(docs, np.int64).tolist()):
                    if firsts.get(part, doc) >= doc:
                        firsts[part] = doc
        if firsts:
            yield solve(firsts)

    return run


def segments_of(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What documents send to the shards, and where their hot windows are."""
    routes = max(32, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    buckets = 4 * routes
    source = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    asked = map_batches(source, lambda: _ask(buckets, window), _ASK)
    answers = asked.groupBy("bucket").applyInArrow(_answer, _ANSWER)
    lists = answers.groupBy("doc").agg(F.collect_list(F.struct("anchors", "owners", "hot")).alias("answers"))
    met = source.join(lists, "doc").select("doc", F.xxhash64("text").alias("version"), "text", "answers")
    return map_batches(met, lambda: _segments(window, routes), _SEGMENT)


def removals(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, parts``: what documents lose, for ``_gone``; each part names the text (its hash) or is for all of the id."""
    segments = stage(segments_of(docs, window, id_col, text_col), "segments")
    kind = lambda k: segments.where(F.col("kind") == k)
    distinct = kind(COLD).groupBy("route", "words").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    dealt = distinct.select("route", "words", "first", "last").repartition("route").sortWithinPartitions("route")
    firsts = stage(dealt.mapInArrow(_shards(window), _FIRSTS), "firsts")
    kept = kind(HOT).select("route", "words", "docs").repartition("route").sortWithinPartitions("route").mapInArrow(_hot_shards(window), _KEPT)
    no = {"version": "long", "start": "int", "gone": "array<boolean>", "hot": "binary", "kept": "binary"}
    part = lambda **has: F.struct(*(has.get(k, F.lit(None).cast(t)).alias(k) for k, t in no.items())).alias("part")
    cold = kind(COLD).join(firsts, ["route", "words"]).select(
        "doc", "version", "start", F.transform("firsts", lambda f: f < F.col("doc")).alias("gone")).where(F.exists("gone", lambda g: g))
    parts = cold.select("doc", part(version=F.col("version"), start=F.col("start"), gone=F.col("gone"))).unionByName(
        kind(HOT_STARTS).select("doc", part(version=F.col("version"), hot=F.col("words")))).unionByName(
        kept.select("doc", part(kept=F.col("kept"))))
    return parts.groupBy("doc").agg(F.collect_set("part").alias("parts"))


def _gone(words: list[bytes], version: int, parts: list[dict] | None, window: int) -> np.ndarray:
    """Which words are covered by a removed window."""
    step = np.zeros(len(words) + 1, np.int64)
    kept = {w for p in parts or () if p["kept"] is not None for w in p["kept"].split(b"\n")}
    for p in parts or ():
        if p["version"] != version:
            continue
        if p["hot"] is not None:
            starts = np.frombuffer(p["hot"], np.int32).tolist()
            at = np.array([i for i in starts if b" ".join(words[i:i + window]) not in kept], np.int64)
        else:
            at = p["start"] + np.flatnonzero(p["gone"])
        np.add.at(step, at, 1)
        np.add.at(step, at + window, -1)
    return np.cumsum(step[:-1]) > 0


def _with_parts(docs: DataFrame, window: int, id_col: str, text_col: str) -> tuple[DataFrame, str, str]:
    """``docs`` with what they lose and with the hash of the text, and the names of these two columns."""
    doc, lost, version = free_names(docs, "dedup_doc", "dedup_parts", "dedup_version")
    parts = removals(docs, window, id_col, text_col).select(F.col("doc").alias(doc), F.col("parts").alias(lost))
    return docs.join(parts, docs[id_col].cast("long") == F.col(doc), "left").drop(doc).withColumn(version, F.xxhash64(text_col)), lost, version


def dedup_digest(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, n_removed, kept_sha256`` of every row."""
    def make() -> Rows:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, removed, digest = [], [], []
            for text, parts, version in zip(*(c.to_pylist() for c in batch.columns[1:])):
                words = words_of(text)
                gone = _gone(words, version, parts, window)
                n.append(len(words))
                removed.append(int(gone.sum()))
                digest.append(hex_digest(b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if removed[-1] else b" ".join(words)))
            return pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())],
                                   names=[id_col, "n_words", "n_removed", "kept_sha256"])

        return step

    rows = docs.select(id_col, text_col)
    schema = f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string"
    joined, lost, hashed = _with_parts(rows, window, id_col, text_col)
    return map_batches(joined.select(id_col, text_col, lost, hashed), make, schema)


def dedup_texts(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the repeated words; a text that loses none stays as it is, others are kept words and spaces."""
    joined, lost, hashed = _with_parts(docs, window, id_col, text_col)

    def make() -> Rows:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            at, new = batch.schema.get_field_index(text_col), []
            for text, parts, version in zip(*(batch.column(c).to_pylist() for c in (text_col, lost, hashed))):
                words = words_of(text)
                gone = _gone(words, version, parts, window)
                new.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode() if gone.any() else text)
            return batch.set_column(at, text_col, pa.array(new, batch.column(at).type))

        return step

    out = map_batches(joined, make, joined.schema)
    if "n_chars" in docs.columns:
        changed = F.xxhash64(text_col) != F.col(hashed)
        out = out.withColumn("n_chars", F.when(changed, F.length(text_col).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
