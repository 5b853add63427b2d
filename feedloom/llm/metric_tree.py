"""Metric trees of integer points, built by anchors from the middle out.

About the square root of the points become anchors: each new one is the point farthest from its anchor, and takes over
the points that are nearer to it; the triangle inequality rules out those that cannot be. The balls of the anchors are
merged from the middle up, always the two whose common ball is smallest, and divided from the middle down in the same
way, until a ball has at most ``LEAF`` points or no extent. Each ball keeps the sum and the number of its points.

Coordinates are integers of any size: those below ``EXACT`` as 64-bit numbers, others as Python integers. Bounds are
floats with a slack that is far above their rounding, so they never rule out an entry that is nearest or ties.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

LEAF = 32
EXACT = 1 << 24  # squared distances over 2^14 coordinates stay below 2^63
SLACK = 1e-9


class Tree(NamedTuple):
    """Balls in preorder. A ball's points are ``order[first:last]``; a leaf's next ball is its right neighbour."""

    points: np.ndarray  # in the order of the balls
    order: np.ndarray  # the row of each point
    first: np.ndarray
    last: np.ndarray
    after: np.ndarray  # the ball behind the whole subtree
    pivot: np.ndarray  # float
    radius: np.ndarray
    sums: np.ndarray


def as_integers(values: np.ndarray) -> np.ndarray:
    """Integers in the form that is exact for squared distances: 64 bits, or Python's own."""
    small = not values.size or max(abs(int(values.max())), abs(int(values.min()))) < EXACT
    return values.astype(np.int64 if small else object)


def distances(points: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    gap = points - pivot
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


class _Ball:
    __slots__ = ("rows", "parts", "pivot", "radius")

    def __init__(self, rows: np.ndarray, pivot: np.ndarray, radius: float, parts: tuple[_Ball, _Ball] | None = None) -> None:
        self.rows, self.pivot, self.radius, self.parts = rows, pivot, radius, parts


def _anchors(points: np.ndarray, rows: np.ndarray, wanted: int) -> list[_Ball]:
    """At most ``wanted`` balls around points of ``rows``, each row with its nearest anchor."""
    mine = points[rows]
    pivots = [mine[0]]
    owner, away = np.zeros(len(rows), np.int64), distances(mine, mine[0])
    while len(pivots) < wanted:
        far = int(away.argmax())
        if away[far] == 0:
            break
        new = mine[far]
        between = distances(np.array(pivots), new)
        open_ = np.flatnonzero(away * 2 > between[owner])  # others are nearer to their anchor for sure
        to_new = distances(mine[open_], new)
        taken = to_new < away[open_]
        rows_taken = open_[taken]
        owner[rows_taken], away[rows_taken] = len(pivots), to_new[taken]
        owner[far], away[far] = len(pivots), 0.0
        pivots.append(new)
    return [_Ball(rows[own], pivots[k], float(away[own].max())) for k in range(len(pivots)) if (own := np.flatnonzero(owner == k)).size]


def _merged(balls: list[_Ball]) -> _Ball:
    """One ball, by merging the two whose common ball is smallest until one is left."""
    balls = list(balls)
    pivots, radii = np.array([b.pivot for b in balls]), np.array([b.radius for b in balls])
    gaps = np.sqrt(((pivots[:, None] - pivots[None]) ** 2).sum(-1))
    size = (gaps + radii[:, None] + radii[None]) / 2
    np.fill_diagonal(size, np.inf)
    alive = len(balls)
    while alive > 1:
        a, b = divmod(int(size.argmin()), len(balls))
        left, right = balls[a], balls[b]
        n, m = len(left.rows), len(right.rows)
        pivot = (left.pivot * n + right.pivot * m) / (n + m)
        radius = max(float(np.linalg.norm(pivot - s.pivot)) + s.radius for s in (left, right))
        balls[a] = _Ball(np.concatenate([left.rows, right.rows]), pivot, radius, (left, right))
        pivots[a], radii[a] = pivot, radius
        size[b], size[:, b] = np.inf, np.inf
        there = np.isfinite(size[a])
        row = (distances(pivots, pivot) + radii + radius) / 2
        size[a] = np.where(there, row, np.inf)
        size[:, a] = size[a]
        alive -= 1
        top = balls[a]
    return top if len(balls) > 1 else balls[0]


def _divided(points: np.ndarray, ball: _Ball) -> _Ball:
    """The whole tree below the points of a ball."""
    if len(ball.rows) <= LEAF or ball.radius == 0:
        return ball
    parts = _anchors(points, ball.rows, max(2, int(len(ball.rows) ** 0.5)))
    if len(parts) < 2:
        return ball
    return _deepened(points, _merged(parts))


def _deepened(points: np.ndarray, top: _Ball) -> _Ball:
    """Divides the balls at the bottom of a merged tree; no recursion, since a merged tree can be a long chain."""
    todo = [top]
    while todo:
        ball = todo.pop()
        if ball.parts is None:
            below = _divided(points, ball)
            ball.parts = below.parts
        else:
            todo += ball.parts
    return top


def build(points: np.ndarray) -> Tree:
    """The tree of ``points`` (rows of integers, at least one)."""
    floats = points.astype(np.float64)
    rows = np.arange(len(points))
    middle = floats.mean(0)
    top = _divided(floats, _Ball(rows, middle, float(distances(floats, middle).max())))
    # Preorder; the points of a subtree lie in a row.
    first, last, after, balls, order = [], [], [], [], []
    stack: list[tuple[_Ball, int]] = [(top, -1)]
    place = 0
    while stack:
        ball, done = stack.pop()
        if done >= 0:
            last[done], after[done] = place, len(balls)
            continue
        at = len(balls)
        balls.append(ball)
        first.append(place)
        last.append(0)
        after.append(0)
        stack.append((ball, at))
        if ball.parts is None:
            order.append(ball.rows)
            place += len(ball.rows)
        else:
            stack += [(ball.parts[1], -1), (ball.parts[0], -1)]
    order = np.concatenate(order)
    sorted_points = points[order]
    start, end = np.array(first), np.array(last)
    running = np.concatenate([sorted_points[:1] * 0, np.cumsum(sorted_points, axis=0)])  # 2^24 by a block's points
    pivots, radii = np.empty((len(balls), points.shape[1])), np.empty(len(balls))
    for k, (a, b) in enumerate(zip(first, last)):  # the tightest ball around the mean
        mine = floats[order[a:b]]
        pivots[k] = mine.mean(0)
        radii[k] = distances(mine, pivots[k]).max()
    return Tree(sorted_points, order.astype(np.int32), start.astype(np.int32), end.astype(np.int32), np.array(after, np.int32), pivots, radii, running[end] - running[start])


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, points by entries."""
    gap = points[:, None, :] - entries[None, :, :]
    return (gap * gap).sum(-1)


def assign(tree: Tree, entries: np.ndarray) -> Iterator[tuple[int, int, int | np.ndarray, int]]:
    """Yields ``first, last, entry, ball`` for stretches of ``tree.points``. A wholly owned ball has one entry; at a
    leaf ``entry`` is an array and ``ball`` is -1. Of nearest entries that tie, the first counts.

    A ball inherits the candidates of the ball around it and drops those whose distance from its pivot exceeds the
    least by more than its diameter: they are nearest to none of its points, nor tie.
    """
    as_floats = entries.astype(np.float64)
    scale = max(float(np.abs(as_floats).max(initial=0)), float(np.abs(tree.pivot).max(initial=0)), 1.0) * max(1, entries.shape[1]) ** 0.5
    slack = SLACK * scale
    stack = [(0, np.arange(len(entries)))]
    first, last, after, radius = tree.first.tolist(), tree.last.tolist(), tree.after.tolist(), tree.radius.tolist()
    while stack:
        ball, candidates = stack.pop()
        if len(candidates) > 1:
            away = distances(as_floats[candidates], tree.pivot[ball])
            candidates = candidates[away <= away.min() + 2 * radius[ball] + slack]
        a, b = first[ball], last[ball]
        if len(candidates) == 1:
            yield a, b, int(candidates[0]), ball
        elif after[ball] == ball + 1:
            yield a, b, candidates[squared(tree.points[a:b], entries[candidates]).argmin(1)], -1
        else:
            left = ball + 1
            stack += [(after[left], candidates), (left, candidates)]
