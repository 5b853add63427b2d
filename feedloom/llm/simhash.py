"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint has 64 bits. Its embedding counts the set bits of each two-bit segment: 32 coordinates from 0 to 2.
Flipping a bit moves one coordinate by one, so the Manhattan distance of two embeddings is a lower bound of the Hamming
distance. The range join under that bound runs on grids: the coordinates form six groups, and two embeddings at
distance 3 or less agree in three whole groups at least. Each of the 20 choices of three groups is a grid whose cells
are the coordinates there; pairs meet in a cell, pass the Manhattan bound and are then verified on the bits.

Rows are reduced to distinct fingerprints first, with map-side sums. A cell is compared in blocks of at most ``BLOCK``
members, dealt to tasks as pairs of blocks; each gives a spanning forest of its links, at most one per member, never
all pairs. ``components`` joins them.

Defined results: a null or empty text has fingerprint zero and links like any other; a null id counts as no id: its row
gets the component of its fingerprint; repeated rows stay rows; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import Rows, map_batches, stage
from feedloom.llm.components import components
from feedloom.session import broadcast_if_small

SEED, SHINGLE, MAX_BITS = 42, 3, 3
GROUPS, BLOCK = 6, 512
_ODD = 0x5555555555555555


def hashes_of(text: str | None, shingle: int = SHINGLE) -> list[int]:
    """XXH64 of the word shingles, repeats included; of the whole sequence if there are fewer words."""
    w = text.encode().lower().split() if text else []
    if not w:
        return []
    join, h = b" ".join, xxhash.xxh64_intdigest
    if len(w) <= shingle:
        return [h(join(w), SEED)]
    return [h(x, SEED) for x in map(join, zip(*(w[k:] for k in range(shingle))))]


def fingerprint(hashes: list[int]) -> int:
    """A bit is set if it is in over half of the hashes."""
    if not len(hashes):
        return 0
    raw, total = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), np.zeros(64, np.int64)
    for i in range(0, len(raw), 1 << 14):
        total += np.unpackbits(raw[i:i + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", features=hashes_of) -> DataFrame:
    """``id_col, bits``: the fingerprint of every row as a long. ``features`` gives the hashes of a text."""
    def make() -> Rows:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            bits = np.array([fingerprint(features(t)) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            return pa.record_batch([batch.column(0), pa.array(bits, pa.int64())], names=[id_col, "bits"])

        return step

    rows = docs.select(id_col, text_col)
    return map_batches(rows, make, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, bits long")


def embed(bits: Column) -> Column:
    """The 32 coordinates, two bits each: per two-bit segment, the sum of its bits."""
    first, second = bits.bitwiseAND(F.lit(_ODD)), F.shiftrightunsigned(bits, 1).bitwiseAND(F.lit(_ODD))
    return first.bitwiseXOR(second).bitwiseOR(F.shiftleft(first.bitwiseAND(second), 1))  # a sum without carries


def _group_masks() -> list[int]:
    """Coordinates dealt to the groups in turn; a mask covers the bits of a group's coordinates."""
    masks = [0] * GROUPS
    for segment in range(32):
        masks[segment % GROUPS] |= 3 << (2 * segment)
    return masks


def grids(max_bits: int = MAX_BITS) -> list[int]:
    """The bits of the coordinates that a grid reads; signed, as Spark's longs are."""
    unions = [sum(c) for c in combinations(_group_masks(), GROUPS - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in unions]


def links(points: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``a, b``: links of nodes that connect all those within ``max_bits`` of each other in a layer.

    ``points`` has ``node``, ``layer`` and ``bits``; layers are fingerprints of different kinds, compared each alone.
    """
    point, masks = embed(F.col("bits")), grids(max_bits)
    cells = points.select("node", "bits", "layer", F.posexplode(F.array(*(point.bitwiseAND(F.lit(m)) for m in masks))).alias("grid", "cell")).withColumn(
        "grid", F.col("grid") + F.col("layer") * len(masks))
    sizes = cells.groupBy("grid", "cell").agg(F.count("*").alias("n")).where("n > 1")
    # A cell of n members is b blocks, and b * (b + 1) / 2 pairs of blocks; each member goes to the b pairs of its block.
    members = cells.join(sizes, ["grid", "cell"]).select(
        "grid", "cell", "node", "bits", F.ceil(F.col("n") / block).cast("int").alias("b"),
        F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / block)).cast("int").alias("mine"))
    dealt = members.select("grid", "cell", "node", "bits", "mine", F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("other")).select(
        "grid", "cell", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "bits")
    keys = ["grid", "cell", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(_cell_links(max_bits), "a long, b long").distinct()


def close(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs of fingerprints link: the Manhattan bound on the embeddings first, then the bits themselves.

    With coordinates of two bits, a difference shows in their exclusive or: an odd one is 1, an even one 2.
    """
    odd, one = np.uint64(_ODD), np.uint64(1)
    x = ((a & odd) + ((a >> one) & odd)) ^ ((b & odd) + ((b >> one) & odd))
    low, high = x & odd, (x >> one) & odd
    near = np.bitwise_count(low) + 2 * np.bitwise_count(high & ~low) <= max_bits
    near[near] = np.bitwise_count(np.broadcast_to(a, near.shape)[near] ^ np.broadcast_to(b, near.shape)[near]) <= max_bits
    return near


class Forest:
    """Keeps only links that join two trees."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        while (p := self.parent.get(x, x)) != x:
            self.parent[x] = self.parent.get(p, p)
            x = p
        return x

    def add(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _cell_links(max_bits: int):
    small = 64

    def within(nodes: np.ndarray, bits: np.ndarray, cell: np.ndarray) -> list[tuple[int, int, int]]:
        """Links inside many small cells at once: neighbours at each distance in the sorted order."""
        found = []
        for o in range(1, len(bits)):
            same = np.flatnonzero(cell[o:] == cell[:-o])
            if not len(same):
                break
            same = same[close(bits[same], bits[same + o], max_bits)]
            found += zip(cell[same].tolist(), nodes[same].tolist(), nodes[same + o].tolist())
        return found

    def between(nodes: np.ndarray, bits: np.ndarray, others: np.ndarray, other_bits: np.ndarray) -> list[tuple[int, int]]:
        found, forest = [], Forest()
        for start in range(0, len(nodes), 256):
            part = slice(start, start + 256)
            rows, cols = np.nonzero(close(bits[part, None], other_bits[None, :], max_bits))
            found += [(a, b) for a, b in zip(nodes[part][rows].tolist(), others[cols].tolist()) if a != b and forest.add(a, b)]
        return found

    def emit(keys: np.ndarray, mine: np.ndarray, nodes: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
        change = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        starts, ends = np.r_[0, change], np.r_[change, len(keys)]
        cell = np.repeat(np.arange(len(starts)), ends - starts)
        large = (ends - starts > small) | (keys[starts, 2] != keys[starts, 3])
        pick = ~large[cell]
        trees = Forest()  # one for each cell, so that no link depends on what else the batch holds
        found = [(a, b) for k, a, b in within(nodes[pick], bits[pick], cell[pick]) if trees.add((k, a), (k, b))]
        for k in np.flatnonzero(large):
            here = slice(starts[k], ends[k])
            i, j = keys[starts[k], 2:]
            a, b = mine[here] == i, mine[here] == j
            found += between(nodes[here][a], bits[here][a], nodes[here][b], bits[here][b])
        both = np.array(found, np.int64).reshape(-1, 2)
        return pa.record_batch([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    def run(batches):
        kept: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(k).to_numpy() for k in range(4)]).astype(np.int64)
            kept.append((keys, batch.column(4).to_numpy(), batch.column(5).to_numpy(), batch.column(6).to_numpy().view(np.uint64)))
            first = kept[0][0][0]
            if (keys[-1] == first).all():
                continue  # still the same cell: at most two blocks of members wait here
            parts = [np.concatenate(x) for x in zip(*kept)]
            keys = parts[0]
            last = np.flatnonzero((keys != keys[-1]).any(axis=1))[-1] + 1
            yield emit(*(x[:last] for x in parts))
            kept = [tuple(x[last:] for x in parts)]
        if kept:
            yield emit(*(np.concatenate(x) for x in zip(*kept)))

    return run


def classes(marked: DataFrame, id_col: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """``id_col, bits, component_id`` of rows with fingerprints: the smallest id that links reach."""
    marked = stage(marked, "bits")
    groups = stage(marked.groupBy("bits").agg(F.min(id_col).alias("first_id")), "groups")
    rooted = groups.join(components(links(groups.select(F.col("bits").alias("node"), F.lit(0).alias("layer"), "bits"), max_bits)), F.col("bits") == F.col("node"), "left").select(
        "bits", "first_id", F.coalesce("root", "bits").alias("root"))
    rooted = stage(rooted, "roots")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked.join(rooted.select("bits", "root").join(least, "root").select("bits", "component_id"), "bits").select(id_col, "bits", "component_id")


def hex_bits(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; rows without an id stay, as do rows
    that repeat the id and the text of the one kept. Of other texts with that id, one stays.

    A row is known by its id and a 64-bit hash of its text, so one of two texts under the same id could only be taken
    for the other if their hashes met.
    """
    named = docs.where(F.col(id_col).isNotNull()).select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text")).alias("key"), F.col(text_col).alias("text"))
    found = classes(fingerprints(named, "key", "text"), "key", max_bits)
    gone = stage(found.where("key <> component_id").select("key").distinct(), "copies")
    copy = broadcast_if_small(gone)
    return docs.join(copy, (F.col(id_col) == copy["key"]["id"]) & (F.xxhash64(text_col) == copy["key"]["text"]), "left_anti").select(*docs.columns)
