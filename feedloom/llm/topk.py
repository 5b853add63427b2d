"""Exact top-k search by inner product.

Vectors are processed by descending length in chunks of at most ``CHUNK`` rows, each broadcast in its turn; the query
rows stay where they are and carry their best ``k`` so far. A query drops out when its length times the length of the
next chunk's longest vector cannot reach its k-th score; when all have, the search ends. Inside a chunk, vectors are
rotated by the singular vectors of the whole table, so that the first ``HEAD`` coordinates hold most of each product;
Cauchy-Schwarz bounds the rest, and only what passes is multiplied out, in integers.

Components are quantised to floor(64 * x), kept as doubles, which hold these integers exactly at any size. A product
is a sum of doubles where the lengths of both vectors say that no partial sum reaches 2^52, else of Python integers; so
the order is exact throughout. A score that a long cannot hold is returned as the nearest long.

Defined results: vectors that are null, empty or hold a null or non-finite component, or (in columns of doubles) one of
2^490 or more, take no part; shorter vectors count as padded by zeros; rows that share the query's id are the query's own;
ties go to the smaller id; repeated rows count each time; fewer candidates give fewer rows; empty tables give none.
Extra columns are not read.
"""

from __future__ import annotations

from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import map_batches, stage

K, STRIDE, CHUNK, HEAD, TILE = 20, 20, 1 << 16, 16, 2048
EXACT, LONG = 2.0 ** 52, 1 << 62  # below: sums of doubles, and 64-bit integers, are exact


def quantised(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v (array of integral doubles), norm2 (double)`` of the vectors that take part."""
    x = F.col(vector).cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0 ** 490)
    # From 2^53 on, doubles are integers already, and floor() would make longs of them.
    v = F.transform(x, lambda c: F.when(F.abs(c * 64) < 2.0 ** 53, F.floor(c * 64).cast("double")).otherwise(c * 64))
    used = rows.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(x, finite))
    return used.select(F.col(id_col).alias("vec_id"), v.alias("v")).withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    lists = column.to_pylist()
    out = np.zeros((len(lists), width))
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all rows, from their Gram matrix: partial sums of width * width numbers."""
    def grams(batches):
        total = np.zeros((width, width))
        for b in batches:
            m = _matrix(b.column(0), width)
            total += m.T @ m
        yield pa.record_batch([pa.array([0], pa.int32()), pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["one", "g"])

    parts = vectors.select("v").mapInArrow(grams, "one int, g array<double>")
    cells = parts.select(F.posexplode("g").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect()
    gram = np.zeros(width * width)
    for r in cells:
        gram[r["at"]] = r["x"]
    values, axes = np.linalg.eigh(gram.reshape(width, width))
    return axes[:, np.argsort(-values)]


class Best:
    """The k best of one query so far: by score, then by smaller id."""

    def __init__(self, k: int, scores: list[int], ids: list[int]) -> None:
        self.k, self.scores, self.ids = k, integers(scores), np.array(ids, np.int64)

    def least(self) -> int | float:
        return int(self.scores[-1]) if len(self.scores) == self.k else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        if scores.dtype == object:
            order = sorted(range(len(ids)), key=lambda i: (-int(scores[i]), ids[i]))[:self.k]
        else:
            order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]


def integers(values: list[int]) -> np.ndarray:
    """64-bit integers where they hold the values, else Python's."""
    return np.array(values, np.int64 if all(-LONG < v < LONG for v in values) else object)


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of rows of any size, as integers."""
    q = [int(c) for c in query]
    return integers([sum(map(mul, map(int, v), q)) for v in vectors.tolist()])


class Chunk:
    """Vectors by descending length, rotated, with the length of what the first coordinates leave."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, axes: np.ndarray) -> None:
        norm = (vectors * vectors).sum(axis=1)
        order = np.argsort(-norm, kind="stable")
        self.ids, self.vectors, self.norm = ids[order], vectors[order], np.sqrt(norm[order])
        self.axes, turned = axes, self.vectors @ axes
        self.head = np.ascontiguousarray(turned[:, :HEAD])
        self.rest = np.sqrt((turned[:, HEAD:] ** 2).sum(axis=1))

    def search(self, queries: np.ndarray, own: np.ndarray, best: list[Best]) -> None:
        turned = queries @ self.axes
        head, rest = turned[:, :HEAD], np.sqrt((turned[:, HEAD:] ** 2).sum(axis=1))
        length = np.sqrt((queries * queries).sum(axis=1))
        active = np.arange(len(queries))
        for at in range(0, len(self.ids), TILE):
            tile = slice(at, at + TILE)
            least = np.array([float(best[q].least()) for q in active])
            reach = length[active] * self.norm[at]
            active, least = active[reach * (1 + 1e-9) + 1e-6 >= least], least[reach * (1 + 1e-9) + 1e-6 >= least]
            if not len(active):
                return
            bound = head[active] @ self.head[tile].T + rest[active, None] * self.rest[None, tile]
            bound += 1e-9 * length[active, None] * self.norm[None, tile] + 1e-6  # room for rounding
            passed = bound >= least[:, None]
            dense = passed.mean() > 0.1  # then one product of matrices is cheaper than rows one by one
            whole = queries[active] @ self.vectors[tile].T if dense else None
            for row, q in enumerate(active):
                hits = np.flatnonzero(passed[row] & (self.ids[tile] != own[q]))
                if len(hits):
                    if length[q] * self.norm[at] < EXACT:
                        exact = whole[row, hits] if dense else self.vectors[hits + at] @ queries[q]
                        scores = np.rint(exact).astype(np.int64)
                    else:
                        scores = products(self.vectors[hits + at], queries[q])
                    good = (scores >= best[q].least()).astype(bool)
                    best[q].add(scores[good], self.ids[hits[good] + at])


def top_k(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = K, stride: int = STRIDE, chunk: int = CHUNK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of every row whose id is divisible by ``stride``."""
    spark = rows.sparkSession
    vectors = stage(quantised(rows, id_col, vector), "vectors")
    width = vectors.agg(F.max(F.size("v"))).head()[0] or 0
    result = "query_id long, rank int, vec_id long, score long"
    if not width:
        return spark.createDataFrame([], result)
    axes = rotation(vectors, width)
    blocks = stage(_packed(vectors, chunk), "blocks")
    found = stage(vectors.where(F.pmod("vec_id", F.lit(stride)) == 0).repartition("vec_id").select(
        F.col("vec_id").alias("query_id"), "v", F.array().cast("array<string>").alias("scores"), F.array().cast("array<long>").alias("ids")), "best")
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for ids in _chunks(blocks, chunk):
        taken = blocks.where(F.col("block").isin(ids)).collect()  # at most ``chunk`` rows
        shared = spark.sparkContext.broadcast((
            np.concatenate([np.frombuffer(r["ids"], np.int64) for r in taken]),
            np.concatenate([np.frombuffer(r["vectors"], np.float64).reshape(-1, r["width"]) if r["width"] == width else
                            np.pad(np.frombuffer(r["vectors"], np.float64).reshape(-1, r["width"]), ((0, 0), (0, width - r["width"]))) for r in taken]), axes))
        found = stage(map_batches(found.repartition(tasks), _search(shared, k), found.schema, 1 << 30), "best")
        least = F.when(F.size("scores") == k, F.element_at("scores", -1)).otherwise(F.lit("-Infinity")).cast("double")
        own = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))
        following = blocks.where(F.col("block") > max(ids)).agg(F.max("norm2")).head()[0]
        if following is None or not found.where(own * float(np.sqrt(following)) * (1 + 1e-9) + 1e-6 >= least).head(1):
            break  # no longer vector is left that could reach a k-th score
    pair = F.arrays_zip(F.col("ids"), F.col("scores"))
    return found.select("query_id", F.posexplode(pair).alias("at", "p")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("p.ids").alias("vec_id"), _long(F.col("p.scores")).alias("score"))


def _long(digits: Column) -> Column:
    """The nearest long."""
    return F.coalesce(digits.try_cast("long"), F.when(digits.startswith("-"), F.lit(-(1 << 63))).otherwise(F.lit((1 << 63) - 1)))


def _packed(vectors: DataFrame, chunk: int) -> DataFrame:
    """Rows by descending length in numbered blocks: ``block, rows, norm2, width, ids, vectors``."""
    def pack(batches):
        from pyspark import TaskContext

        seq, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, chunk // 4 or 1):
                b = batch.slice(at, chunk // 4 or 1)
                lists = b.column("v").to_pylist()
                width = max(map(len, lists))
                m = _matrix(b.column("v"), width)
                yield pa.record_batch([
                    pa.array([(part << 32) + seq], pa.int64()), pa.array([b.num_rows], pa.int64()), pa.array([b.column("norm2").to_numpy().max()], pa.float64()),
                    pa.array([width], pa.int32()), pa.array([b.column("vec_id").to_numpy().astype(np.int64).tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary()),
                ], names=["block", "rows", "norm2", "width", "ids", "vectors"])
                seq += 1

    return vectors.orderBy(F.desc("norm2"), "vec_id").mapInArrow(pack, "block long, rows long, norm2 double, width int, ids binary, vectors binary")


def _chunks(blocks: DataFrame, chunk: int):
    """Numbers of neighbouring blocks, at most ``chunk`` rows together."""
    group, total = [], 0
    for r in blocks.select("block", "rows").orderBy("block").toLocalIterator():
        if group and total + r["rows"] > chunk:
            yield group
            group, total = [], 0
        group.append(r["block"])
        total += r["rows"]
    if group:
        yield group


def _search(shared, k: int):
    def make():
        ids, vectors, axes = shared.value
        chunk = Chunk(ids, vectors, axes)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            best = [Best(k, [int(x) for x in s], i) for s, i in zip(batch.column("scores").to_pylist(), batch.column("ids").to_pylist())]
            queries = _matrix(batch.column("v"), vectors.shape[1])
            own = batch.column("query_id").to_numpy()
            for at in range(0, len(queries), 256):
                chunk.search(queries[at:at + 256], own[at:at + 256], best[at:at + 256])
            digits = pa.array([[str(x) for x in b.scores.tolist()] for b in best], pa.list_(pa.string()))
            return pa.record_batch([
                batch.column("query_id"), batch.column("v"), digits, pa.array([b.ids.tolist() for b in best], pa.list_(pa.int64())),
            ], names=["query_id", "v", "scores", "ids"])

        return step

    return make
