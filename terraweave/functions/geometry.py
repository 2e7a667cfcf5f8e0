"""Measures and texts of geometries as column expressions.

A point is struct<x, y> (degrees), a line an array of points, a polygon an array of
rings of which the first is the outer one, a multipolygon an array of polygons.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocabulary as V
from .text import trimmed

POINT = "struct<x: double, y: double>"
LINE = f"array<{POINT}>"
POLYGON = f"array<{LINE}>"
MULTIPOLYGON = f"array<{POLYGON}>"


def point(x: Column | str, y: Column | str) -> Column:
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def valid(x: Column, y: Column) -> Column:
    """Within the ranges of longitude and latitude; a missing location is not."""
    return F.coalesce(x.between(-180, 180) & y.between(-90, 90), F.lit(False))


def without_repeats(line: Column) -> Column:
    """The line without invalid points and points equal to the one before."""
    good = F.filter(line, lambda p: valid(p["x"], p["y"]))
    # each point stands beside the one before, so long lines take steps in proportion
    beside = F.arrays_zip(good, F.concat(F.array(F.lit(None).cast(POINT)), good)).cast(f"array<struct<p: {POINT}, before: {POINT}>>")
    return F.filter(beside, lambda z: z["p"].isNotNull() & (z["before"].isNull() | (z["p"] != z["before"])))["p"]


def closed(line: Column) -> Column:
    """More than one reference, both ends located, at the same coordinates."""
    first, last = F.get(line, F.lit(0)), F.get(line, F.size(line) - 1)
    return F.coalesce(
        (F.size(line) > 1) & valid(first["x"], first["y"]) & (first["x"] == last["x"]) & (first["y"] == last["y"]),
        F.lit(False),
    )


def _sum_pairs(line: Column, f) -> Column:
    """The sum of f(a, b) over neighbouring points."""
    n = F.greatest(F.size(line) - 1, F.lit(0))
    parts = F.zip_with(F.slice(line, 1, n), F.slice(line, 2, n), f)
    return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)


def haversine(a: Column, b: Column, radius: float, pi: float) -> Column:
    # the order of the steps decides the last bits, and those which way a length is rounded
    s, t = (F.sin((b[c] - a[c]) * pi / 180 / 2) for c in "yx")
    h = s * s + t * t * F.cos(a["y"] * pi / 180) * F.cos(b["y"] * pi / 180)
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def length(line: Column) -> Column:
    """Metres along the line."""
    return _sum_pairs(line, lambda a, b: haversine(a, b, V.RADIUS_LENGTH, math.pi))


def next_distance(a: Column, b: Column) -> Column:
    """Metres to the next node, by the constants that this fact is defined with."""
    return haversine(a, b, V.RADIUS_NEXT, V.PI_NEXT)


def _ring_area(ring: Column) -> Column:
    """Square metres in a ring, on an equal-area projection."""
    rad = math.pi / 180
    flat = F.transform(
        ring,
        lambda p: F.struct((F.lit(V.RADIUS_AREA) * (p["x"] * rad)).alias("x"), (F.lit(V.RADIUS_AREA) * F.sin(p["y"] * rad)).alias("y")),
    )
    # the ring closes itself; the order of the terms decides the last digits
    before = F.concat(F.slice(flat, F.size(flat), 1), F.slice(flat, 1, F.size(flat) - 1))
    terms = F.zip_with(flat, before, lambda p, q: (q["x"] + p["x"]) * (q["y"] - p["y"]))
    return F.when(F.size(ring) > 0, F.abs(F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)) / 2).otherwise(0.0)


def polygon_area(polygon: Column) -> Column:
    """The outer ring's area less those of the inner rings."""
    areas = F.transform(polygon, lambda r: _ring_area(r))
    return F.aggregate(
        F.transform(areas, lambda a, i: F.when(i == 0, a).otherwise(-a)), F.lit(0.0), lambda acc, x: acc + x
    )


def multipolygon_area(polygons: Column) -> Column:
    return F.aggregate(F.transform(polygons, polygon_area), F.lit(0.0), lambda acc, x: acc + x)


def box(points: Column) -> Column:
    """struct<minx, miny, maxx, maxy> of an array of points."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy")
    )


def outer_points(polygons: Column) -> Column:
    """All points of the outer rings."""
    return F.flatten(F.transform(polygons, lambda g: F.get(g, F.lit(0))))


# -- texts --------------------------------------------------------------------


def path_wkt(texts: Column) -> Column:
    """A line of the texts of its coordinates; null ones are left out."""
    return F.concat(F.lit("LINESTRING("), F.array_join(texts, ","), F.lit(")"))


def coordinates(p: Column, digits: int) -> Column:
    return F.concat_ws(" ", trimmed(p["x"], digits), trimmed(p["y"], digits))


def _path(line: Column, digits: int) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(line, lambda p: coordinates(p, digits)), ","), F.lit(")"))


def point_wkt(p: Column, digits: int) -> Column:
    return F.concat(F.lit("POINT("), coordinates(p, digits), F.lit(")"))


def line_wkt(line: Column, digits: int) -> Column:
    return F.concat(F.lit("LINESTRING"), _path(line, digits))


def _rings(polygon: Column, digits: int) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(polygon, lambda r: _path(r, digits)), ","), F.lit(")"))


def polygon_wkt(polygon: Column, digits: int) -> Column:
    return F.concat(F.lit("POLYGON"), _rings(polygon, digits))


def area_wkt(polygons: Column, digits: int) -> Column:
    """POLYGON of one polygon, MULTIPOLYGON of several."""
    many = F.concat(
        F.lit("MULTIPOLYGON("), F.array_join(F.transform(polygons, lambda g: _rings(g, digits)), ","), F.lit(")")
    )
    return F.when(F.size(polygons) == 1, polygon_wkt(F.get(polygons, F.lit(0)), digits)).otherwise(many)


def box_wkt(b: Column, digits: int) -> Column:
    """Lower left, lower right, upper right, upper left, lower left."""
    corners = (("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy"), ("minx", "miny"))
    return polygon_wkt(F.array(F.array(*(F.struct(b[x].alias("x"), b[y].alias("y")) for x, y in corners))), digits)


def collection_wkt(parts: Column) -> Column:
    return F.concat(F.lit("GEOMETRYCOLLECTION("), F.array_join(parts, ","), F.lit(")"))


#: Fixed value: half the width of the web mercator map in metres.
MERCATOR_HALF = 20037508.34
#: Fixed value: the latitude where the map ends.
MERCATOR_EDGE = 85.05112877980659


def mercator(x: Column, y: Column, per_metre: int = 10) -> Column:
    """A point in degrees on the web mercator map, in whole steps of 1 / per_metre metres,
    cut towards zero. The map has no place for the poles: points beyond its edge go to it."""
    east = x * MERCATOR_HALF / 180
    y = F.least(F.lit(MERCATOR_EDGE), F.greatest(F.lit(-MERCATOR_EDGE), y))
    north = F.log(F.tan((y + 90) * math.pi / 360)) / (math.pi / 180) * MERCATOR_HALF / 180
    whole = lambda v: (v * per_metre).cast("long").cast("double")
    return F.struct(whole(east).alias("x"), whole(north).alias("y"))
