"""Measures, hulls, simplification and relations of small geometries."""

import math
import random

import pytest
from pyspark.sql import functions as F

from terraweave import vocabulary as V
from terraweave.functions import geometry as G
from terraweave.functions import kernels as K
from tests import plain_rings
from tests import plain_relate as R
from terraweave.functions.wkt import shape_of


def line(*points):
    return F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points))


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_lengths(spark):
    assert one(spark, F.round(G.length(line((48, 7.51), (48.1, 7.61))), 2)) == 15674.68
    assert one(spark, F.round(G.length(line((48, 7.51), (48.1, 7.61), (48.1, 7.51), (48, 7.51))), 2)) == 37843.09
    assert one(spark, G.length(line((1, 1)))) == 0
    far = [
        one(spark, F.format_string("%.6f", G.next_distance(F.get(line(a, b), F.lit(0)), F.get(line(a, b), F.lit(1)))))
        for a, b in (((48, 7.51), (48.1, 7.61)), ((48.1, 7.61), (48.1, 7.51)), ((48.1, 7.51), (48, 7.51)))
    ]
    assert far == ["15657.137001", "11119.490351", "11024.108103"]


def test_area(spark):
    ring = line((48, 7.51), (48, 7.61), (48.1, 7.61), (48.1, 7.51), (48, 7.51))
    assert one(spark, F.format_string("%.4f", G.multipolygon_area(F.array(F.array(ring))))) == "122568687.4654"
    hole = line((48.02, 7.52), (48.04, 7.52), (48.04, 7.54), (48.02, 7.54), (48.02, 7.52))
    whole, less = (one(spark, G.polygon_area(F.array(*r))) for r in ((ring,), (ring, hole)))
    assert less == pytest.approx(whole - one(spark, G.polygon_area(F.array(hole))))


def test_texts(spark):
    assert one(spark, G.point_wkt(F.get(line((7.51, 48)), F.lit(0)), 1)) == "POINT(7.5 48)"
    assert one(spark, G.line_wkt(F.array().cast(G.LINE), 7)) == "LINESTRING()"
    assert one(spark, G.box_wkt(G.box(line((50, 50), (200, 200))), 1)) == "POLYGON((50 50,200 50,200 200,50 200,50 50))"


def test_repeats_and_closing(spark):
    a, b = (1, 1), (2, 2)
    assert len(one(spark, G.without_repeats(line(a, b, b, b, a)))) == 3
    assert one(spark, G.closed(line(a, b, a))) and not one(spark, G.closed(line(a, b))) and not one(spark, G.closed(line(a)))
    assert len(one(spark, G.without_repeats(line(a, (999, 1), a, b)))) == 2


def test_hulls():
    assert K.convex_hull([(48, 7.51), (48.1, 7.61)]) == [(48, 7.51), (48.1, 7.61), (48, 7.51)]
    box = [(48, 7.5), (48, 7.6), (48.1, 7.6), (48.1, 7.5), (48, 7.5)]
    assert K.convex_hull(box) == [(48.1, 7.5), (48.1, 7.6), (48, 7.6), (48, 7.5), (48.1, 7.5)]
    assert K.convex_hull([(1, 1)]) == [(1, 1)]
    rng = random.Random(3)
    for _ in range(50):
        points = [(rng.randint(0, 9), rng.randint(0, 9)) for _ in range(12)]
        ring = K.convex_hull(points)
        for a, b in zip(ring, ring[1:], strict=False):
            assert all(K.cross(a, b, p) >= 0 for p in points)


def test_oriented_box_holds_all():
    rng = random.Random(4)
    for _ in range(30):
        points = [(rng.random(), rng.random()) for _ in range(8)]
        ring = K.oriented_box(points)
        assert len(ring) == 5
        assert all(K.cross(a, b, p) > -1e-9 for a, b in zip(ring, ring[1:], strict=False) for p in points)


def test_centroids():
    square = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
    assert K.polygons_centroid([[square]]) == pytest.approx((1, 1))
    assert K.line_centroid([(0, 0), (4, 0)]) == (2, 0)
    hole = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    assert K.polygons_centroid([[square, hole]]) == pytest.approx((7 / 6, 7 / 6))


def test_simplification():
    up = [(0, 0), (0, 80), (0, 160), (0, 240), (0, 500), (0, 1000)]
    assert K.simplified_wkt_line(up, 5) == [(0, 0), (0, 1000)]
    bent = [(0, 0), (0, 80), (100, 1000)]
    assert K.simplified_wkt_line(bent, 5) == bent
    assert K.simplified_wkt_line(bent, 80) == [(0, 0), (100, 1000)]


def square(x, y, n=2):
    return [[[(x, y), (x + n, y), (x + n, y + n), (x, y + n), (x, y)]]]


def names(a, b):
    m = R.relate(a, b)
    return {k for k, v in R.predicates(m, a.dimension, b.dimension).items() if v}


def test_relations():
    s = R.Shape(2, square(0, 0))
    assert names(s, R.Shape(2, square(0, 0))) == {"Intersects", "Contains", "Covers", "Equals"}
    assert names(s, R.Shape(2, square(1, 1))) == {"Intersects", "Overlaps"}
    assert names(s, R.Shape(2, square(2, 0))) == {"Intersects", "Touches"}
    assert names(s, R.Shape(2, square(2, 2))) == {"Intersects", "Touches"}
    assert names(s, R.Shape(2, square(5, 5))) == set()
    assert names(R.Shape(2, square(0, 0, 9)), s) == {"Intersects", "Contains", "Covers"}
    assert names(s, R.Shape(0, [(1, 1)])) == {"Intersects", "Contains", "Covers"}
    assert names(s, R.Shape(0, [(0, 1)])) == {"Intersects", "Covers", "Touches"}
    assert names(R.Shape(1, [[(-1, 1), (3, 1)]]), s) == {"Intersects", "Crosses"}
    assert names(R.Shape(1, [[(0, 0), (0, 2)]]), s) == {"Intersects", "Touches"}
    assert names(s, R.Shape(1, [[(0.5, 0.5), (1, 1)]])) == {"Intersects", "Contains", "Covers"}
    a, b = R.Shape(1, [[(0, 0), (2, 2)]]), R.Shape(1, [[(0, 2), (2, 0)]])
    assert names(a, b) == {"Intersects", "Crosses"}
    assert names(a, R.Shape(1, [[(1, 1), (3, 3)]])) == {"Intersects", "Overlaps"}
    assert names(a, R.Shape(1, [[(2, 2), (3, 0)]])) == {"Intersects", "Touches"}
    assert names(a, R.Shape(0, [(1, 1)])) == {"Intersects", "Contains", "Covers"}
    hole = R.Shape(2, [[square(0, 0, 9)[0][0], square(3, 3, 3)[0][0]]])
    assert names(hole, R.Shape(2, square(4, 4, 1))) == set()
    assert names(hole, R.Shape(2, square(3, 3, 3))) == {"Intersects", "Touches"}


def test_rings():
    lines = [[(0, 0), (4, 0), (4, 4)], [(4, 4), (0, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]]
    made = plain_rings.assemble(lines)
    assert len(made) == 1 and len(made[0]) == 2
    assert plain_rings.assemble([[(0, 0), (4, 0), (4, 4)]]) == []
    assert plain_rings.assemble([[(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]]) == []
    two = plain_rings.assemble([*lines[:2], [(8, 8), (9, 8), (9, 9), (8, 8)]])
    assert len(two) == 2


def test_wkt():
    assert shape_of("POINT(1 2)")["points"] == [{"x": 1.0, "y": 2.0}]
    assert len(shape_of("MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5)))")["polygons"]) == 2
    assert len(shape_of("LINESTRING (0 0, 1 1)")["lines"][0]) == 2
    assert shape_of(None) is None and shape_of("nonsense") is None


def test_lengths_take_the_steps_of_their_sql(spark):
    pairs = [tuple(((7919 * k + 104729 * c) % 100003 / 100003 - 0.5) * s for c, s in enumerate((360, 180, 360, 180), 1)) for k in range(4000)]
    rows = spark.createDataFrame(pairs, "x0 double, y0 double, x1 double, y1 double")
    line = F.array(F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")), F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")))

    def metres(x0, y0, x1, y1):
        s, t = (math.pow(math.sin((b - a) * math.pi / 180 / 2), 2) for a, b in ((y0, y1), (x0, x1)))
        return 2 * V.RADIUS_LENGTH * math.asin(math.sqrt(min(1.0, s + t * math.cos(y0 * math.pi / 180) * math.cos(y1 * math.pi / 180))))

    got = [r.m for r in rows.select("*", G.length(line).alias("m")).sort("x0", "y0").collect()]
    unlike = sum(m != metres(*p) for m, p in zip(got, sorted(pairs), strict=True))
    assert unlike < 700, unlike  # sines of other libraries differ in a last bit now and then
