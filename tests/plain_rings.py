"""Rings of a relation put together in plain Python, for the tests to compare with."""

from __future__ import annotations

from collections import defaultdict

import numpy as np

Point = tuple[float, float]


def inside(p: Point, ring: list[Point]) -> bool:
    """Whether p lies within the ring, by crossings."""
    x, y = p
    out = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            out = not out
    return out


def rings_of(lines: list[list[Point]]) -> list[list[Point]] | None:
    """Closed rings from the segments of all lines; None if some end stays open.

    Segments that occur twice cancel out. At a point where more than two segments
    meet the walk takes any, so touching rings still separate.
    """
    count: dict[tuple[Point, Point], int] = defaultdict(int)
    for line in lines:
        for a, b in zip(line, line[1:], strict=False):
            if a != b:
                count[min(a, b), max(a, b)] += 1
    near: dict[Point, set[Point]] = defaultdict(set)
    for (a, b), n in count.items():
        if n % 2:
            near[a].add(b)
            near[b].add(a)
    if any(len(x) % 2 for x in near.values()):
        return None
    rings = []
    for start in sorted(near):
        while near[start]:
            path, seen = [start], {start: 0}
            at = start
            while True:
                to = min(near[at])
                near[at].discard(to)
                near[to].discard(at)
                at = to
                if at in seen:
                    # the loop that closes here is a ring; what led to it goes on
                    first = seen[at]
                    rings.append([*path[first:], at])
                    for p in path[first + 1 :]:
                        del seen[p]
                    path = path[: first + 1]
                    if len(path) == 1 and not near[at]:
                        break
                    if not near[at]:
                        return None
                else:
                    seen[at] = len(path)
                    path.append(at)
            if len(path) > 1:
                return None
    return rings


def crosses_itself(rings: list[list[Point]]) -> bool:
    """Whether two segments cross: each is held against those that begin, from left to
    right, before it ends, and whose heights meet its own."""
    own = np.array([(*min(a, b), *max(a, b)) for r in rings for a, b in zip(r, r[1:], strict=False)])
    own = own[np.argsort(own[:, 0], kind="stable")]
    x1, y1, x2, y2 = own.T
    low, high = np.minimum(y1, y2), np.maximum(y1, y2)
    last = np.searchsorted(x1, x2, side="right")

    def side(ox, oy, px, py, qx, qy):
        return (px - ox) * (qy - oy) - (py - oy) * (qx - ox)

    for k in range(len(own)):
        near = slice(k + 1, last[k])
        at = k + 1 + np.flatnonzero((low[near] <= high[k]) & (high[near] >= low[k]))
        if not len(at):
            continue
        a, b = (x1[k], y1[k]), (x2[k], y2[k])
        s1, s2 = side(*a, *b, x1[at], y1[at]), side(*a, *b, x2[at], y2[at])
        s3, s4 = side(x1[at], y1[at], x2[at], y2[at], *a), side(x1[at], y1[at], x2[at], y2[at], *b)
        if ((s1 * s2 < 0) & (s3 * s4 < 0)).any():
            return True
    return False


def polygons_of(rings: list[list[Point]]) -> list[list[list[Point]]]:
    """Outer rings with their inner rings, told apart by how deep they lie."""

    def middle(r: list[Point]) -> Point:
        return (r[0][0] + r[1][0]) / 2, (r[0][1] + r[1][1]) / 2

    def surface(r: list[Point]) -> float:
        return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:], strict=False)))

    boxes = np.array([(*map(min, zip(*r, strict=True)), *map(max, zip(*r, strict=True))) for r in rings]).reshape(-1, 4)

    def around(at: int) -> list[int]:
        """The rings that the ring `at` lies in; only those whose boxes hold it are walked."""
        low, high = boxes[at, :2], boxes[at, 2:]
        held = (boxes[:, :2] <= low).all(axis=1) & (boxes[:, 2:] >= high).all(axis=1)
        return [k for k in np.flatnonzero(held).tolist() if k != at and inside(middle(rings[at]), rings[k])]

    holders = [around(at) for at in range(len(rings))]
    out: dict[int, list[list[Point]]] = {k: [rings[k]] for k, h in enumerate(holders) if len(h) % 2 == 0}
    for k, h in enumerate(holders):
        if len(h) % 2:
            # the smallest ring around it at an outer level
            owner = min((o for o in h if o in out), key=lambda o: surface(rings[o]), default=None)
            if owner is not None:
                out[owner].append(rings[k])
    return [out[k] for k in sorted(out, key=lambda k: min(rings[k]))]


def assemble(lines: list[list[Point]]) -> list[list[list[Point]]]:
    """The multipolygon of a relation's member lines; empty where rings are broken."""
    rings = rings_of(lines)
    if not rings or crosses_itself(rings):
        return []
    return polygons_of([r for r in rings if len(r) >= 4])
