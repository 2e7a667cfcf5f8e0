"""How two geometries lie to each other: the nine-intersection dimensions.

A geometry is (dimension, parts): points [(x, y)...], lines [[(x, y)...]...] or
polygons [[ring, ...], ...]. The result names, for interior, boundary and exterior
of one with interior, boundary and exterior of the other, the dimension of what they
share (-1: nothing); exterior with exterior is always 2 and left out.
"""

from __future__ import annotations

from itertools import chain

Point = tuple[float, float]
NAMES = ("II", "IB", "IE", "BI", "BB", "BE", "EI", "EB")
INSIDE, ON, OUTSIDE = "I", "B", "E"


def _on_segment(p: Point, a: Point, b: Point) -> bool:
    if not (min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])):
        return False
    turn = (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    size = abs(b[0] - a[0]) + abs(b[1] - a[1])
    return abs(turn) <= 1e-12 * max(1.0, size)


class Shape:
    """One geometry, with what comparisons need."""

    def __init__(self, dimension: int, parts: list):
        self.dimension = dimension
        self.parts = parts
        if dimension == 2:
            self.segments = [(a, b) for g in parts for r in g for a, b in zip(r, r[1:], strict=False) if a != b]
        elif dimension == 1:
            self.segments = [(a, b) for line in parts for a, b in zip(line, line[1:], strict=False) if a != b]
        else:
            self.segments = []
        if dimension == 1:
            # an end point of an odd number of lines is boundary
            ends: dict[Point, int] = {}
            for line in parts:
                for p in (line[0], line[-1]):
                    ends[p] = ends.get(p, 0) + 1
            self.ends = {p for p, n in ends.items() if n % 2}
            # a line without length is a point
            if not self.segments:
                self.dimension, self.parts, self.ends = 0, [line[0] for line in parts], set()

    def place(self, p: Point) -> str:
        """Where p lies in this geometry."""
        if self.dimension == 0:
            return INSIDE if p in self.parts else OUTSIDE
        if self.dimension == 1:
            if p in self.ends:
                return ON
            return INSIDE if any(_on_segment(p, a, b) for a, b in self.segments) else OUTSIDE
        x, y = p
        inside = False
        for a, b in self.segments:
            if _on_segment(p, a, b):
                return ON
            if (a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0]:
                inside = not inside
        return INSIDE if inside else OUTSIDE


def _cuts(a: Point, b: Point, others: list[tuple[Point, Point]]) -> list[float]:
    """Where along a-b the other segments meet it, from 0 to 1."""
    found = {0.0, 1.0}
    dx, dy = b[0] - a[0], b[1] - a[1]
    size = dx * dx + dy * dy
    low_x, high_x, low_y, high_y = min(a[0], b[0]), max(a[0], b[0]), min(a[1], b[1]), max(a[1], b[1])
    for c, d in others:
        if max(c[0], d[0]) < low_x or min(c[0], d[0]) > high_x or max(c[1], d[1]) < low_y or min(c[1], d[1]) > high_y:
            continue
        for p in (c, d):
            if _on_segment(p, a, b):
                found.add(((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / size)
        ex, ey = d[0] - c[0], d[1] - c[1]
        turn = dx * ey - dy * ex
        if turn:
            t = ((c[0] - a[0]) * ey - (c[1] - a[1]) * ex) / turn
            u = ((c[0] - a[0]) * dy - (c[1] - a[1]) * dx) / turn
            if 0 <= t <= 1 and 0 <= u <= 1:
                found.add(t)
    return sorted(found)


def _pieces(one: Shape, other: Shape) -> list[tuple[str, Point, Point, Point]]:
    """(place in other, middle, from, to) of each piece of one's segments."""
    out = []
    for a, b in one.segments:
        at = _cuts(a, b, other.segments)
        for s, t in zip(at, at[1:], strict=False):
            if t - s < 1e-13:
                continue
            m = (s + t) / 2
            middle = (a[0] + (b[0] - a[0]) * m, a[1] + (b[1] - a[1]) * m)
            out.append((other.place(middle), middle, a, b))
    return out


def _meetings(one: Shape, other: Shape) -> list[Point]:
    """Points where segments of the two meet, and the ends of segments."""
    out = []
    for a, b in one.segments:
        for t in _cuts(a, b, other.segments):
            out.append(a if t == 0 else b if t == 1 else (a[0] + (b[0] - a[0]) * t, a[1] + (b[1] - a[1]) * t))
    return out


def relate(one: Shape, other: Shape) -> dict[str, int]:
    """The nine-intersection dimensions of two geometries that are not empty."""
    m = dict.fromkeys(NAMES, -1)

    def mark(key: str, dimension: int) -> None:
        m[key] = max(m[key], dimension)

    if one.dimension == 2 and other.dimension == 2:
        _surfaces(one, other, mark)
        return m
    if one.dimension == 2 or (one.dimension == 1 and other.dimension == 0):
        turned = relate(other, one)
        return {k: turned[k[::-1]] for k in NAMES}
    # from here on, one has no surface, and other at least one's dimension
    if one.dimension == 0:
        for p in one.parts:
            mark(f"I{other.place(p)}", 0)
        if other.dimension == 0:
            if any(p not in one.parts for p in other.parts):
                mark("EI", 0)
        else:
            mark("EI", other.dimension)
            if other.dimension == 2:
                mark("EB", 1)
            elif any(p not in one.parts for p in other.ends):
                mark("EB", 0)
        return m
    for place, *_ in _pieces(one, other):
        mark(f"I{place}", 1)
    for p in _meetings(one, other):
        where = other.place(p)
        if where != OUTSIDE:
            mark(f"{one.place(p)}{where}", 0)
    for p in one.ends:
        mark(f"B{other.place(p)}", 0)
    if other.dimension == 2:
        mark("EI", 2)
        if any(place == OUTSIDE for place, *_ in _pieces(other, one)):
            mark("EB", 1)
        return m
    if any(place == OUTSIDE for place, *_ in _pieces(other, one)):
        mark("EI", 1)
    for p in other.ends:
        if one.place(p) == OUTSIDE:
            mark("EB", 0)
        else:
            mark(f"{one.place(p)}B", 0)
    return m


def _surfaces(one: Shape, other: Shape, mark) -> None:
    for a, b, turn in ((one, other, False), (other, one, True)):
        key = (lambda k: k[::-1]) if turn else (lambda k: k)
        for place, middle, p, q in _pieces(a, b):
            if place == INSIDE:
                # both sides of a's edge are inside b
                mark(key("BI"), 1)
                mark("II", 2)
                mark(key("EI"), 2)
            elif place == OUTSIDE:
                mark(key("BE"), 1)
                mark(key("IE"), 2)
            else:
                mark("BB", 1)
                # which sides of the shared edge belong to which surface
                reach = 1e-7 * max(abs(q[0] - p[0]) + abs(q[1] - p[1]), 1e-9)
                nx, ny = -(q[1] - p[1]), q[0] - p[0]
                size = (nx * nx + ny * ny) ** 0.5
                for side in (1, -1):
                    near = (middle[0] + side * reach * nx / size, middle[1] + side * reach * ny / size)
                    in_a, in_b = a.place(near) == INSIDE, b.place(near) == INSIDE
                    if in_a and in_b:
                        mark("II", 2)
                    elif in_a:
                        mark(key("IE"), 2)
                    elif in_b:
                        mark(key("EI"), 2)
    for p in chain(_meetings(one, other), _meetings(other, one)):
        if one.place(p) == ON and other.place(p) == ON:
            mark("BB", 0)


def predicates(m: dict[str, int], dim_a: int, dim_b: int) -> dict[str, bool]:
    """The seven relations of a to b."""
    has = {k: v >= 0 for k, v in m.items()}
    meets = has["II"] or has["IB"] or has["BI"] or has["BB"]
    within_a = not has["EI"] and not has["EB"]
    within_b = not has["IE"] and not has["BE"]
    both = has["II"] and has["IE"] and has["EI"]
    if dim_a == dim_b == 1:
        overlaps, crosses = both and m["II"] == 1, m["II"] == 0
    elif dim_a == dim_b:
        overlaps, crosses = both, False
    else:
        overlaps = False
        crosses = has["II"] and (has["IE"] if dim_a < dim_b else has["EI"])
    return {
        "Intersects": meets,
        "Contains": has["II"] and within_a,
        "Covers": meets and within_a,
        "Touches": meets and not has["II"],
        "Equals": has["II"] and within_a and within_b,
        "Overlaps": overlaps,
        "Crosses": crosses,
    }
