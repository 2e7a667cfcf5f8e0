"""Geometry that needs loops: hulls, boxes, centroids, simplification, relations."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Point = tuple[float, float]


def cross(o: Point, a: Point, b: Point) -> float:
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def convex_hull(points: Sequence[Point]) -> list[Point]:
    """The hull as a closed ring, counter-clockwise; of one point that point alone.

    It begins at the lowest of the rightmost points; two points give a, b, a.
    """
    own = sorted(set(points))
    if len(own) <= 1:
        return own
    halves = []
    for run in (own, own[::-1]):
        half: list[Point] = []
        for p in run:
            while len(half) > 1 and cross(half[-2], half[-1], p) <= 0:
                half.pop()
            half.append(p)
        halves.append(half[:-1])
    ring = halves[0] + halves[1]
    if len(ring) == 2:
        return [ring[0], ring[1], ring[0]]
    at = max(range(len(ring)), key=lambda k: (ring[k][0], -ring[k][1]))
    ring = ring[at:] + ring[:at]
    return [*ring, ring[0]]


#: Points of all groups that a task holds before it keeps their hulls only.
HELD_POINTS = 1 << 18


def hulls_of_groups(points: DataFrame) -> DataFrame:
    """(key, hull): the hull, as a closed ring, of all points (key, x, y) of each key.

    A task keeps the hull of what it has seen of a key; hulls of tasks meet in one group of
    a key and have a hull again. So a key's points need not stand in one row, or meet in
    one task, before they are few. Points without a place are left out.
    """
    kind = points.schema["key"].dataType.simpleString()
    told = points.filter("x is not null and y is not null").select("key", "x", "y")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[object, list[Point]] = {}
        held, key_type = 0, None
        for batch in batches:
            key_type = batch.column(0).type
            keys, x, y = (c.to_pylist() for c in batch.columns)
            for k, a, b in zip(keys, x, y, strict=True):
                seen.setdefault(k, []).append((a, b))
            held += len(keys)
            if held >= HELD_POINTS:
                seen = {k: convex_hull(own) for k, own in seen.items()}
                held = sum(map(len, seen.values()))
                if held >= HELD_POINTS // 2:
                    # many keys, or hulls that take all points: others may join them
                    yield rows(seen, key_type)
                    seen, held = {}, 0
        if seen:
            yield rows({k: convex_hull(own) for k, own in seen.items()}, key_type)

    def rows(seen: dict[object, list[Point]], key_type: pa.DataType | None) -> pa.RecordBatch:
        flat = [(k, p) for k, own in seen.items() for p in own]
        columns = [pa.array([k for k, _ in flat], key_type), pa.array([p[0] for _, p in flat], pa.float64()), pa.array([p[1] for _, p in flat], pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=["key", "x", "y"])

    def whole(table: pa.Table) -> pa.Table:
        ring = convex_hull(list(zip(table["x"].to_pylist(), table["y"].to_pylist(), strict=True)))
        point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
        hull = pa.array([[{"x": a, "y": b} for a, b in ring]], pa.list_(point))
        return pa.Table.from_arrays([table["key"].combine_chunks()[:1], hull], names=["key", "hull"])

    few = told.mapInArrow(partial, f"key {kind}, x double, y double")
    return few.groupBy("key").applyInArrow(whole, f"key {kind}, hull array<struct<x: double, y: double>>")


def oriented_box(points: Sequence[Point]) -> list[Point]:
    """The hull of the smallest-area rectangle around the points, at any angle."""
    hull = convex_hull(points)
    if len(hull) <= 3:
        return hull if len(hull) < 3 else [hull[1], hull[1], hull[0], hull[0], hull[1]]
    best: tuple[float, list[Point]] | None = None
    for a, b in zip(hull, hull[1:], strict=False):
        size = math.hypot(b[0] - a[0], b[1] - a[1])
        ux, uy = (b[0] - a[0]) / size, (b[1] - a[1]) / size
        along = [p[0] * ux + p[1] * uy for p in hull]
        across = [p[1] * ux - p[0] * uy for p in hull]
        low, high, near, far = min(along), max(along), min(across), max(across)
        extent = (high - low) * (far - near)
        if best is None or extent < best[0] - 1e-15:
            corners = [(s * ux - t * uy, s * uy + t * ux) for s, t in ((low, near), (high, near), (high, far), (low, far))]
            best = extent, corners
    return convex_hull(best[1])


def ring_centroid(ring: Sequence[Point]) -> tuple[float, Point]:
    """Signed area and the centre of mass of a ring."""
    area = cx = cy = 0.0
    ox, oy = ring[0]
    for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]], strict=True):
        x1, y1, x2, y2 = x1 - ox, y1 - oy, x2 - ox, y2 - oy
        part = x1 * y2 - x2 * y1
        area += part
        cx += (x1 + x2) * part
        cy += (y1 + y2) * part
    if area == 0:
        return 0.0, (sum(p[0] for p in ring) / len(ring), sum(p[1] for p in ring) / len(ring))
    return area / 2, (ox + cx / (3 * area), oy + cy / (3 * area))


def line_centroid(line: Sequence[Point]) -> Point:
    """Weighted by the segments' lengths; of a line without length its first point."""
    total = cx = cy = 0.0
    for (x1, y1), (x2, y2) in zip(line, line[1:], strict=False):
        size = math.hypot(x2 - x1, y2 - y1)
        total += size
        cx += size * (x1 + x2) / 2
        cy += size * (y1 + y2) / 2
    return (cx / total, cy / total) if total else line[0]


def polygons_centroid(polygons: Sequence[Sequence[Sequence[Point]]]) -> Point:
    """Weighted by area; inner rings count against their polygon."""
    total = cx = cy = 0.0
    for rings in polygons:
        for k, ring in enumerate(rings):
            area, (x, y) = ring_centroid(ring)
            weight = abs(area) * (1 if k == 0 else -1)
            total += weight
            cx += weight * x
            cy += weight * y
    if not total:
        return line_centroid(polygons[0][0])
    return cx / total, cy / total


def simplified(line: Sequence[Point], epsilon: float) -> list[Point]:
    """Douglas-Peucker, without recursion; both ends stay."""
    if len(line) <= 2:
        return list(line)
    keep = [False] * len(line)
    keep[0] = keep[-1] = True
    todo = [(0, len(line) - 1)]
    own = np.asarray(line, float)
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        p, q = own[a], own[b]
        d = q - p
        size = float(np.hypot(*d))
        inside = own[a + 1 : b] - p
        if size:
            # to the segment, not to the endless line
            t = np.clip(inside @ d / size**2, 0, 1)
            gaps = np.hypot(*(inside - t[:, None] * d).T)
        else:
            gaps = np.hypot(*inside.T)
        k = int(gaps.argmax())
        if gaps[k] > epsilon:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return [p for p, stays in zip(line, keep, strict=True) if stays]


#: Fixed value: the share of a line's length that one unit of deviation is.
SIMPLIFICATION = 0.001


def simplified_wkt_line(line: Sequence[Point], deviation: float) -> list[Point]:
    """The line that a WKT literal shows: tolerance follows the length."""
    size = sum(math.hypot(b[0] - a[0], b[1] - a[1]) for a, b in zip(line, line[1:], strict=False))
    while True:
        out = simplified(line, SIMPLIFICATION * size * deviation)
        size /= 2
        if out or size < SIMPLIFICATION:
            return out


_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_POINTS = pa.list_(_POINT)


def _pairs(points) -> list[Point]:
    return [(p["x"], p["y"]) for p in points or ()]


def read_points(column: pa.Array) -> list:
    """Python values of points and of lists of them, of any depth: tuples for points."""
    if pa.types.is_struct(column.type):
        x, y = (column.field(k).to_numpy(zero_copy_only=False).tolist() for k in (0, 1))
        return list(zip(x, y, strict=True))
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    starts = column.offsets.to_numpy()
    inner = read_points(column.values)
    known = column.is_valid().to_pylist()
    return [inner[a:b] if ok else None for a, b, ok in zip(starts[:-1].tolist(), starts[1:].tolist(), known, strict=True)]


def points_array(lines: Sequence[Sequence[Point] | None]) -> pa.Array:
    """Lines, null ones included, as a column."""
    sizes = np.fromiter((0 if line is None else len(line) for line in lines), np.int64, len(lines))
    flat = np.array([p for line in lines if line is not None for p in line], np.float64).reshape(-1, 2)
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    null = pa.array([line is None for line in lines], pa.bool_())
    inner = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], fields=list(_POINT))
    return pa.ListArray.from_arrays(ends, inner, type=_POINTS, mask=null)


#: What is made, until it is taken apart.
_MADE = "_made_lines"
#: What makes a line: the column it reads, the column it makes, and the function.
Maker = tuple[str, str, Callable[[list], Sequence[Point]]]


def with_lines(df: DataFrame, makers: Sequence[Maker]) -> DataFrame:
    """`df` with the lines that all `makers` make, in one pass; null of null.

    Only the columns that are read travel to Python.
    """
    if not makers:
        return df
    sources = list(dict.fromkeys(source for source, _, _ in makers))
    line = "array<struct<x: double, y: double>>"

    def make(*columns: pa.Array) -> pa.Array:
        read = {source: read_points(column) for source, column in zip(sources, columns, strict=True)}
        made = [points_array([None if g is None else f(g) for g in read[source]]) for source, _, f in makers]
        return pa.StructArray.from_arrays(made, names=[target for _, target, _ in makers])

    made = F.arrow_udf(make, ", ".join(f"`{target}` {line}" for _, target, _ in makers))
    told = df.withColumn(_MADE, made(*(F.col(f"`{s}`") for s in sources)))
    for _, target, _ in makers:
        told = told.withColumn(target, F.col(_MADE)[target])
    return told.drop(_MADE)


def hull_maker(source: str = "points", target: str = "hull", more_than: int = 0, deviation: float = 0.0) -> Maker:
    """Hulls, simplified where they have more than `more_than` (> 0) points and stay rings."""

    def make(points: list[Point]) -> list[Point]:
        ring = convex_hull(points)
        if not 0 < more_than < len(ring):
            return ring
        shown = simplified_wkt_line(ring, deviation)
        return shown if len(shown) >= 4 else ring

    return source, target, make


def oriented_box_maker(source: str = "points", target: str = "obb") -> Maker:
    return source, target, oriented_box


def line_centroid_maker(source: str = "points", target: str = "centroid") -> Maker:
    return source, target, lambda p: [line_centroid(p)] if p else []


def area_centroid_maker(source: str = "polygons", target: str = "centroid") -> Maker:
    """An array of one point for each multipolygon; of none: empty."""
    return source, target, lambda g: [polygons_centroid(g)] if g else []


def with_hull(df: DataFrame, source: str = "points", target: str = "hull") -> DataFrame:
    return with_lines(df, [hull_maker(source, target)])


def with_oriented_box(df: DataFrame, source: str = "points", target: str = "obb") -> DataFrame:
    return with_lines(df, [oriented_box_maker(source, target)])


def with_line_centroid(df: DataFrame, source: str = "points", target: str = "centroid") -> DataFrame:
    return with_lines(df, [line_centroid_maker(source, target)])


def with_area_centroid(df: DataFrame, source: str = "polygons", target: str = "centroid") -> DataFrame:
    return with_lines(df, [area_centroid_maker(source, target)])


def with_simplified(df: DataFrame, more_than: int, deviation: float, source: str = "points", target: str = "shown") -> DataFrame:
    """Lines of more than `more_than` (> 0) points simplified, others as they are."""
    shown = lambda p: simplified_wkt_line(p, deviation) if 0 < more_than < len(p) else p
    return with_lines(df, [(source, target, shown)])


def simplified_lines(lines: Sequence[Sequence[Point]], deviation: float, closed: bool) -> list[list[Point]]:
    """All lines of one geometry with the tolerance that its whole length gives.

    A ring that would lose its surface stays as it is.
    """
    size = sum(math.hypot(b[0] - a[0], b[1] - a[1]) for line in lines for a, b in zip(line, line[1:], strict=False))
    out = [simplified(line, SIMPLIFICATION * size * deviation) for line in lines]
    return [list(o) if closed and len(n) < 4 else n for o, n in zip(lines, out, strict=True)]


def with_simplified_geometry(df: DataFrame, more_than: int, deviation: float, source: str, target: str, *, closed: bool) -> DataFrame:
    """`df` with `target`: the geometry `source`, lists of lines of any depth, simplified
    where it has more than `more_than` points; null of null."""
    kind = df.schema[source].dataType.simpleString()

    def lines_of(geometry) -> Iterator[list]:
        for part in geometry:
            if part and isinstance(part[0], dict):
                yield part
            elif not part or isinstance(part[0], list):
                yield from lines_of(part)

    def rebuilt(geometry, made: Iterator[list[Point]]):
        out = []
        for part in geometry:
            if part and isinstance(part[0], dict):
                out.append([{"x": x, "y": y} for x, y in next(made)])
            else:
                out.append(rebuilt(part, made))
        return out

    def one(geometry):
        if geometry is None:
            return None
        lines = [_pairs(line) for line in lines_of(geometry)]
        if not 0 < more_than < sum(map(len, lines)):
            return geometry
        return rebuilt(geometry, iter(simplified_lines(lines, deviation, closed)))

    def make(column: pa.Array) -> pa.Array:
        return pa.array([one(g) for g in column.to_pylist()], column.type)

    return df.withColumn(target, F.arrow_udf(make, kind)(F.col(f"`{source}`")))
