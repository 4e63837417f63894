"""Metric trees of points, built by the anchors hierarchy (middle-out).

``sqrt(n)`` anchors are chosen one after the other, each the point farthest
from the anchor of the widest ball; a new anchor takes over the points that are
nearer to it, and distances between anchors spare it the balls and the inner
points that cannot lose any. The anchors are then joined two at a time, the
pair with the tightest common ball first, up to a root, and the points of each
anchor get a tree of their own below it. Every ball caches its points' sum,
number, centre (their mean) and radius.

The nodes are in order of depth, parents before children; the points of a node
are the places ``begin`` to below ``end`` of ``order``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Points below which a ball is not split.
LEAF = 16


@dataclass
class Tree:
    order: np.ndarray  # points, those of a ball side by side
    parent: np.ndarray  # -1 for the root
    begin: np.ndarray
    end: np.ndarray
    leaf: np.ndarray
    sums: np.ndarray
    centre: np.ndarray
    radius: np.ndarray


def anchors(points: np.ndarray) -> list[np.ndarray]:
    """The points of each of about ``sqrt(n)`` anchors, as numbers; none is empty."""
    n = len(points)
    far = np.sqrt(((points - points[0]) ** 2).sum(1))
    own = [np.argsort(-far, kind="stable")]  # farthest first
    dist = [far[own[0]]]
    centre = [points[0]]
    for _ in range(int(np.ceil(np.sqrt(n))) - 1):
        widest = max(range(len(own)), key=lambda i: dist[i][0])
        if dist[widest][0] == 0:  # only equal points are left together
            break
        new = points[own[widest][0]]
        apart = np.sqrt(((np.array(centre) - new) ** 2).sum(1)).tolist()
        taken, taken_dist = [], []
        for i, gap in enumerate(apart):
            # A point nearer to its anchor than half the gap cannot change over.
            reach = int(np.searchsorted(-dist[i], -gap / 2, "right"))
            if not reach:
                continue
            near = np.sqrt(((points[own[i][:reach]] - new) ** 2).sum(1))
            moves = near < dist[i][:reach]
            if moves.any():
                taken.append(own[i][:reach][moves])
                taken_dist.append(near[moves])
                stay = np.append(np.flatnonzero(~moves), np.arange(reach, len(own[i])))
                own[i], dist[i] = own[i][stay], dist[i][stay]
        members, member_dist = np.concatenate(taken), np.concatenate(taken_dist)
        order = np.argsort(-member_dist, kind="stable")
        own.append(members[order])
        dist.append(member_dist[order])
        centre.append(new)
        full = [i for i, x in enumerate(own) if len(x)]
        own, dist, centre = [own[i] for i in full], [dist[i] for i in full], [centre[i] for i in full]
    return own


class _Ball:
    __slots__ = ("members", "children", "centre", "radius")

    def __init__(self, points: np.ndarray, members: np.ndarray, children: tuple = ()):
        self.members, self.children = members, children
        own = points[members]
        self.centre = own.mean(0)
        self.radius = float(np.sqrt(((own - self.centre) ** 2).sum(1).max()))


def _joined(points: np.ndarray, balls: list[_Ball]) -> _Ball:
    """Two balls at a time into one, until one is left."""
    k, i = len(balls), 0
    centre, radius = np.array([b.centre for b in balls]), np.array([b.radius for b in balls])
    gap = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(2))
    # Radius of a ball around two: half of their span, no less than either's own.
    width = np.maximum((gap + radius[:, None] + radius[None]) / 2, np.maximum(radius[:, None], radius[None]))
    np.fill_diagonal(width, np.inf)
    for _ in range(k - 1):
        i, j = divmod(int(width.argmin()), k)
        balls[i] = _Ball(points, np.concatenate((balls[i].members, balls[j].members)), (balls[i], balls[j]))
        width[j], width[:, j] = np.inf, np.inf
        centre[i], radius[i] = balls[i].centre, balls[i].radius
        live = np.isfinite(width[i])
        gap = np.sqrt(((centre[live] - centre[i]) ** 2).sum(1))
        width[i, live] = np.maximum((gap + radius[live] + radius[i]) / 2, np.maximum(radius[live], radius[i]))
        width[live, i] = width[i, live]
    return balls[i]


def _grow(points: np.ndarray, members: np.ndarray) -> _Ball:
    """The ball of ``members``, with its tree."""
    ball = _Ball(points, members)
    if len(members) <= LEAF or ball.radius == 0:
        return ball
    parts = anchors(points[members])
    if len(parts) < 2:
        return ball
    return _joined(points, [_grow(points, members[p]) for p in parts])


def tree(points: np.ndarray) -> Tree:
    """The tree of a block of points, integers in rows."""
    exact = points.astype(np.int64)
    root = _grow(points.astype(np.float64), np.arange(len(points)))
    place, order, stack = {}, [], [root]
    n = 0
    while stack:  # leaves from left to right give the points their places
        ball = stack.pop()
        place[id(ball)] = n
        if ball.children:
            stack += [ball.children[1], ball.children[0]]
        else:
            order.append(ball.members)
            n += len(ball.members)
    parent, balls = [-1], [root]
    for at, ball in enumerate(balls):
        for child in ball.children:
            parent.append(at)
            balls.append(child)
    order = np.concatenate(order)
    begin = np.array([place[id(b)] for b in balls])
    end = begin + np.array([len(b.members) for b in balls])
    upto = np.vstack([np.zeros((1, points.shape[1]), np.int64), np.cumsum(exact[order], axis=0)])
    return Tree(order, np.array(parent), begin, end, np.array([not b.children for b in balls]), upto[end] - upto[begin],
                np.array([b.centre for b in balls]), np.array([b.radius for b in balls]))


#: Error allowed for squared distances in floating point, as a share of the squared lengths.
SLACK = 1e-12


def owners(held: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest of ``entries`` for every point, as far down as needed:
    ``owner[node]`` for balls that one entry owns as a whole (-1 for other
    nodes), ``nearest[place]`` for the points of leaves (-1 for those in owned
    balls).

    A ball inherits its parent's candidates and drops each that is farther from
    its centre than the nearest one by more than the ball's diameter: it owns no
    point. Exact integer distances decide in the leaves, ties to the lower entry."""
    n = len(held.parent)
    owner, nearest = np.full(n, -1, np.int64), np.full(len(held.order), -1, np.int64)
    first = np.searchsorted(held.parent[1:], np.arange(n)) + 1  # children stand together, in their parents' order
    kids = np.append(first[1:], n) - first
    entry = entries.astype(np.float64)
    norm = (entry ** 2).sum(1)
    level, lists = np.array([0]), np.ones((1, len(entries)), bool)
    while len(level):
        centre = held.centre[level]
        scale = norm[None] + (centre ** 2).sum(1)[:, None]
        gap = np.sqrt(np.maximum(scale - 2 * centre @ entry.T, 0))
        unsure = 2 * np.sqrt(SLACK * (1 + scale))
        least = np.where(lists, gap + unsure, np.inf).min(1, keepdims=True)
        lists &= gap - unsure <= least + 2 * held.radius[level][:, None]
        single = lists.sum(1) == 1
        owner[level[single]] = lists[single].argmax(1)
        for at in np.flatnonzero(~single & held.leaf[level]).tolist():
            node, some = level[at], np.flatnonzero(lists[at])
            lo, hi = held.begin[node], held.end[node]
            own = held.order[lo:lo + 1] if held.radius[node] == 0 else held.order[lo:hi]
            apart = points[own].astype(np.int64)[:, None] - entries[some][None]
            nearest[lo:hi] = some[(apart ** 2).sum(2).argmin(1)]
        down = np.flatnonzero(~single & ~held.leaf[level])
        times = kids[level[down]]
        begin = np.repeat(first[level[down]] - (np.cumsum(times) - times), times)
        lists, level = lists[np.repeat(down, times)], begin + np.arange(len(begin))
    return owner, nearest
