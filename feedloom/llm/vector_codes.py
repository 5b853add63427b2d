"""Vectors as short codes: product quantisation with exact k-means over metric trees.

A vector of integers is cut into equal parts, and each part is replaced by the number of the nearest entry in the
codebook of its place. Blocks of vectors become one metric tree per part, once; every round sends the codebooks, whose
size does not grow with the data, to the trees. A ball whose candidates have shrunk to one entry adds its cached sum
and count and is not entered. Sums are added per task, then per entry by Spark, and only they come to the driver.

All arithmetic is on integers, so results do not depend on the order of rows or on how they are dealt out.

Defined results: vectors that are null or hold null or non-finite components are left out; vectors shorter than the
longest, or of a length that the parts do not divide, are as if they ended in zeros; rows that repeat an id are vectors
of their own, equal ids are ordered by their components, and null ids come last; fewer vectors than entries make
smaller codebooks; errors above the largest long are that long; an empty table gives no rows. Only the named columns
are read.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from feedloom.llm.common import stage
from feedloom.llm.metric_tree import Tree, as_integers, assign, build
from feedloom.session import broadcast_if_small

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BLOCK = 4_096
LIMB = 40  # bits; sums of any size travel as limbs that Spark adds as longs
LONG = (1 << 63) - 1

Books = list[np.ndarray]


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``id, vector, label`` of the rows that take part."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    return rows.where(F.forall("vector", lambda c: F.coalesce(F.abs(c) < F.lit(math.inf), F.lit(False))))


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)``; a double beyond 2^53 is an integer already."""
    if not values.size or np.abs(values).max() < 1 << 40:
        return np.floor(scale * values).astype(np.int64)
    cells = [int(v) * scale if abs(v) >= 1 << 53 else math.floor(scale * v) for v in values.ravel().tolist()]
    return np.array(cells, object).reshape(values.shape)


def _matrix(vectors: list[list[float]], width: int, scale: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return integers(out, scale)


def _cut(matrix: np.ndarray, parts: int) -> Books:
    return [as_integers(p) for p in np.split(matrix, parts, axis=1)]


def plant(rows: DataFrame, width: int, parts: int = PARTS, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """``ids, labels, trees`` of blocks of at most ``block`` vectors, written down; ``trees`` has one tree per part."""
    id_type, label_type = rows.schema["id"].dataType, rows.schema["label"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0

        def grown(some: pa.Table) -> pa.RecordBatch:
            trees = [_small(build(p)) for p in _cut(_matrix(some.column("vector").to_pylist(), width, scale), parts)]
            return pa.record_batch([
                pa.array([some.column("id").to_pylist()], pa.list_(to_arrow_type(id_type))),
                pa.array([some.column("label").to_pylist()], pa.list_(to_arrow_type(label_type))),
                pa.array([pickle.dumps(trees, 5)], pa.binary()),
            ], names=["ids", "labels", "trees"])

        for batch in batches:
            for start in range(0, batch.num_rows, block):
                held.append(batch.slice(start, block))
                count += held[-1].num_rows
                if count >= block:
                    whole = pa.Table.from_batches(held)
                    yield grown(whole.slice(0, block))
                    held = whole.slice(block).to_batches()
                    count -= block
        if count:
            yield grown(pa.Table.from_batches(held))

    schema = f"ids array<{id_type.simpleString()}>, labels array<{label_type.simpleString()}>, trees binary"
    return stage(rows.mapInArrow(run, schema), "part-trees")


def _small(tree: Tree) -> Tree:
    """The tree with its points in the fewest bytes."""
    if tree.points.dtype == object or not tree.points.size:
        return tree
    bound = max(int(tree.points.max()), -int(tree.points.min()) - 1)
    return tree._replace(points=tree.points.astype(next(t for t in (np.int8, np.int16, np.int32) if bound <= np.iinfo(t).max)))


def _trees(data: pa.Scalar) -> list[Tree]:
    return [t._replace(points=t.points if t.points.dtype == object else t.points.astype(np.int64)) for t in pickle.loads(data.as_buffer())]


def first_books(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE) -> Books:
    """The parts of the vectors with the smallest ids."""
    first = rows.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()
    return _cut(_matrix([r.vector for r in first], width, scale), parts)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    sign, value, k = (-1, -value, 0) if value < 0 else (1, value, 0)
    while value or not k:
        yield k, sign * (value & ((1 << LIMB) - 1))
        value, k = value >> LIMB, k + 1


def next_books(blocks: DataFrame, books: Books) -> Books:
    """Every entry moves to the floor of the mean of the parts nearest to it; an unused one stays."""
    sent = blocks.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = sent.value
        sums = [np.zeros(b.shape, object) for b in mine]
        counts = [np.zeros(len(b), np.int64) for b in mine]
        for batch in batches:
            for data in batch.column(0):
                for tree, book, total, count in zip(_trees(data), mine, sums, counts):
                    here = np.zeros(book.shape, tree.sums.dtype)
                    for a, b, entry, ball in assign(tree, book):
                        if ball >= 0:
                            here[entry] += tree.sums[ball]
                            count[entry] += b - a
                        else:
                            np.add.at(here, entry, tree.points[a:b])
                            np.add.at(count, entry, 1)
                    total += here
        rows = []
        for part, (total, count) in enumerate(zip(sums, counts)):
            for entry in np.flatnonzero(count).tolist():
                rows.append((part, entry, -1, 0, int(count[entry])))
                rows += [(part, entry, at, k, limb) for at, v in enumerate(total[entry].tolist()) for k, limb in _limbs(v)]
        columns = list(zip(*rows)) or [()] * 5
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.int32()] * 4 + [pa.int64()])], names=["part", "entry", "at", "limb", "value"])

    told = blocks.select("trees").mapInArrow(run, "part int, entry int, at int, limb int, value long")
    sums: dict[tuple, int] = {}
    for r in told.groupBy("part", "entry", "at", "limb").agg(F.sum("value").alias("value")).collect():
        key = (r.part, r.entry, r.at)
        sums[key] = sums.get(key, 0) + (r.value << LIMB * r.limb)
    sent.destroy()
    moved = [b.astype(object) for b in books]
    for (part, entry, at), value in sums.items():
        if at >= 0:
            moved[part][entry, at] = value // sums[part, entry, -1]
    return [as_integers(b) for b in moved]


def coded(blocks: DataFrame, books: Books) -> DataFrame:
    """``id, label, code, error`` of every vector."""
    id_type, label_type = (blocks.schema[c].dataType.elementType for c in ("ids", "labels"))
    sent = blocks.sparkSession.sparkContext.broadcast(books)
    names = ["id", "label", "code", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, data in zip(*batch.columns):
                trees = _trees(data)
                n = len(ids)
                codes, errors = np.zeros((n, len(trees)), np.uint8), np.zeros(n, np.int64)
                for part, (tree, book) in enumerate(zip(trees, sent.value)):
                    found = np.empty(n, np.int64)
                    for a, b, entry, _ in assign(tree, book):
                        found[a:b] = entry
                    gap = tree.points - book[found]
                    codes[tree.order, part] = found
                    back = np.empty(n, np.int64)
                    back[tree.order] = np.arange(n)
                    errors = errors + (gap * gap).sum(-1)[back]
                text, digits = codes.tobytes().hex(), 2 * len(trees)
                yield pa.record_batch([
                    ids.values, labels.values, pa.array([text[i:i + digits] for i in range(0, n * digits, digits)], pa.string()),
                    pa.array([min(e, LONG) for e in errors.tolist()], pa.int64())], names=names)

    schema = f"id {id_type.simpleString()}, label {label_type.simpleString()}, code string, error long"
    return blocks.mapInArrow(run, schema)


def books_digest(books: Books) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, Books]:
    """``id, label, code, error`` of every usable vector, written down, and the codebooks of its code."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits per part, so 1 to 256 entries")
    rows = usable(vectors, id_col, vector_col, label_col)
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    width = -(-longest // parts) * parts
    books = first_books(rows, width, parts, entries, scale)
    blocks = plant(rows, width, parts, scale)
    for _ in range(rounds):
        books = next_books(blocks, books)
    return stage(coded(blocks, books), "vector-codes"), books


def code_report(spark: SparkSession, codes: DataFrame, books: Books) -> DataFrame:
    """``id, code, error, label_error, codebooks_sha256``; ``label_error`` is the sum over rows of an equal label."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")
    sums = codes.groupBy(F.col("label").alias("same")).agg(total.alias("label_error"))
    joined = codes.join(broadcast_if_small(sums), F.col("label").eqNullSafe(F.col("same")))
    return joined.select("id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
