"""Vector codes beside plain k-means over all parts and entries, and trees beside exhaustive search."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import metric_tree, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("seed, spread", [(1, 5), (2, 200), (3, 1 << 22), (4, 1 << 40)])
def test_trees_give_the_nearest_entry(seed, spread):
    draw = np.random.default_rng(seed)
    for n, d in ((1, 3), (30, 1), (700, 4), (900, 2)):
        points = draw.integers(-spread, spread, (n, d))
        points[n // 2:] += points[:n - n // 2] // 2
        points[draw.integers(0, n, n // 3)] = points[0]
        points, entries = metric_tree.as_integers(points), metric_tree.as_integers(np.concatenate([points[:20], points[:5]]))
        tree, found, owned = metric_tree.build(points), np.full(n, -1), 0
        assert sorted(tree.order.tolist()) == list(range(n)) and (tree.points == points[tree.order]).all()
        for a, b, entry, ball in metric_tree.assign(tree, entries):
            found[tree.order[a:b]] = entry
            if ball >= 0:
                owned += b - a
                assert (tree.sums[ball] == tree.points[a:b].sum(0)).all() and (tree.first[ball], tree.last[ball]) == (a, b)
        assert found.tolist() == metric_tree.squared(points, entries).argmin(1).tolist()
        assert owned or n == 1 or n == 30 or spread > 5


def test_separate_clusters_are_owned_as_balls():
    draw = np.random.default_rng(9)
    points = np.concatenate([draw.integers(0, 50, (1_000, 4)) + 10_000 * k for k in range(8)])
    entries = np.array([[10_000 * k + 25] * 4 for k in range(8)])
    tree = metric_tree.build(points)
    stretches = list(metric_tree.assign(tree, entries))
    assert all(ball >= 0 for *_, ball in stretches) and len(stretches) < 40


def test_integers_are_floors_of_any_finite_double():
    values = [0.0, -0.0, 1 / 256, -1 / 512, 5e-324, -5e-324, 1e15 + 0.5, -(2.0 ** 52) - 0.5, 3.4e38, -1.7e308]
    got = vector_codes.integers(np.array([values])).tolist()[0]
    assert got == [math.floor(Fraction(v) * 256) for v in values]


def plain(rows, parts=16, entries=64, rounds=2):
    """The contract by hand, over Python integers."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    w = width // parts
    cut = [[[math.floor(Fraction(c) * 256) for c in (list(v) + [0.0] * (width - len(v)))[p * w:p * w + w]] for p in range(parts)] for _, v, _ in kept]
    books = [[x[p] for x in cut[:entries]] for p in range(parts)]

    def choose():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)] for x in cut]

    for _ in range(rounds):
        chosen = choose()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [x[p] for x, c in zip(cut, chosen) if c[p][1] == k]
                if mine:
                    books[p][k] = [sum(column) // len(mine) for column in zip(*mine)]
    chosen = choose()
    errors = [sum(d for d, _ in c) for c in chosen]
    total = {}
    for (_, _, label), e in zip(kept, errors):
        total[label] = total.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    top = vector_codes.LONG
    return sorted(str((r[0], "".join(f"{k:02x}" for _, k in c), min(e, top), min(total[r[2]], top), digest)) for r, c, e in zip(kept, chosen, errors))


def got(spark, df, **options):
    report = vector_codes.code_report(spark, *vector_codes.compress(df, **options))
    assert report.columns == ["id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(str(tuple(r)) for r in report.collect())


def test_codes_are_those_of_plain_rounds(spark, monkeypatch):
    draw = random.Random(11)
    rows = [(i, [draw.choice([-1.0, -0.3, 0.0, 0.2, draw.uniform(-1, 1)]) for _ in range(32)], draw.choice([None, 0, 1, 2])) for i in range(400)]
    rows += [(7, rows[50][1], 1), (7, [0.5] * 32, 1), (None, rows[3][1], None)] + [(900 + k, [0.25] * 32, 3) for k in range(150)]
    rows += [(-1, None, 0), (-2, [None] * 32, 0), (-3, [float("nan")] * 32, 0), (-4, [float("inf")] + [0.0] * 31, None), (-5, [0.0] * 31 + [float("-inf")], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain(rows)
    extra = df.withColumn("id", F.lit("x")).withColumn("code", F.lit(0)).withColumn("same", F.lit(1))
    assert got(spark, extra.repartition(6)) == want == got(spark, df.coalesce(1))
    real = vector_codes.plant
    monkeypatch.setattr(vector_codes, "plant", lambda *a: real(*a, block=37))
    assert got(spark, df.repartition(2)) == want


def test_large_components_and_uneven_lengths(spark):
    draw = random.Random(12)
    rows = [(i, [draw.choice([3.4e38, -3e38, 1e12, 2.0 ** 40 + 0.5, 0.1, -1e300]) for _ in range(draw.choice([0, 3, 17, 20]))], i % 2) for i in range(90)]
    assert got(spark, spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_few_vectors_empty_vectors_and_empty_tables(spark):
    few = [(3, [0.1] * 16, None), (1, [0.2] * 16, 1)]
    assert got(spark, spark.createDataFrame(few, SCHEMA)) == plain(few)
    empty = [(1, [], 0), (2, [], None)]
    assert got(spark, spark.createDataFrame(empty, SCHEMA)) == plain(empty)
    assert got(spark, spark.createDataFrame([(1, None, 0)], SCHEMA)) == got(spark, spark.createDataFrame([], SCHEMA)) == []


def test_other_parameters(spark):
    draw = random.Random(13)
    rows = [(i, [draw.uniform(-2, 2) for _ in range(6)], 0) for i in range(120)]
    assert got(spark, spark.createDataFrame(rows, SCHEMA), parts=3, entries=5, rounds=4) == plain(rows, 3, 5, 4)
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame(rows, SCHEMA), entries=257)
