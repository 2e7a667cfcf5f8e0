"""Slanted, concave and holed shapes over the suppliers, with relations known by counting.

Each supplier gets one of the TEMPLATES, drawn on a lattice of cells, at one of six places
of its tile; the lattice is then sheared, so that no line is level. Shearing changes no
relation, so the checking SQL can count the cells, edges and corners that two shapes
share, and needs neither segments nor angles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import spatial

#: (dimension, parts): polygons of rings, lines, or points, in lattice corners.
TEMPLATES = [
    (2, [[[(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2), (0, 0)]]]),
    (2, [[[(0, 0), (3, 0), (3, 3), (0, 3), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]]]),
    (2, [[[(0, 0), (0, 2), (1, 2), (1, 1), (2, 1), (2, 2), (3, 2), (3, 0), (0, 0)]]]),
    (2, [[[(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]]]),
    (2, [[[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]], [[(2, 2), (3, 2), (3, 3), (2, 3), (2, 2)]]]),
    (2, [[[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]]]),
    (1, [[(0, 0), (1, 0), (1, 1), (2, 1), (2, 2)]]),
    (1, [[(0, 1), (3, 1)]]),
    (1, [[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]]),
    (1, [[(1, 0), (1, 1)], [(1, 1), (2, 1)]]),
    (1, [[(1, 1), (1, 2)]]),
    (0, [(1, 1)]),
    (0, [(0, 0), (2, 1)]),
]
#: The cells of the surfaces, by template.
CELLS = {
    0: [(0, 0), (1, 0), (0, 1)],
    1: [(0, 0), (1, 0), (2, 0), (0, 1), (2, 1), (0, 2), (1, 2), (2, 2)],
    2: [(0, 0), (1, 0), (2, 0), (0, 1), (2, 1)],
    3: [(1, 1)],
    4: [(0, 0), (2, 2)],
    5: [(0, 0), (1, 0), (0, 1), (1, 1)],
}
ACROSS, UP = 3, 2
TILE = len(TEMPLATES) * ACROSS * UP
#: Degrees of a lattice step, a power of two: all corners are exact.
STEP = 1 / 512
#: How much shearing enlarges a cell.
SHEARED = 7


def placed(suppliers: DataFrame) -> DataFrame:
    """(id, template, ox, oy, tile) of every supplier."""
    k, n = F.col("s_suppkey"), len(TEMPLATES)
    place = F.floor(k / n)
    return suppliers.select(
        k.cast("long").alias("id"), (k % n).cast("int").alias("template"), (place % ACROSS).alias("ox"),
        (F.floor(place / ACROSS) % UP).alias("oy"), F.floor(k / TILE).alias("tile"),
    )


def sheared(x: Column, y: Column) -> Column:
    """A lattice corner of a tile in degrees."""
    left, low = F.col("tile") % 300 - 150, F.floor(F.col("tile") / 300) % 150 - 75
    return F.struct((left + (2 * x + y) * STEP).cast("double").alias("x"), (low + (3 * y - x) * STEP).cast("double").alias("y"))


def shapes(suppliers: DataFrame) -> DataFrame:
    """(id, shape) of every supplier."""
    corner = lambda p: sheared(F.col("ox") + p[0], F.col("oy") + p[1])
    line = lambda points: F.array(*map(corner, points))
    made = F.lit(None).cast(spatial.SHAPE)
    for k, (dimension, parts) in enumerate(TEMPLATES):
        if dimension == 0:
            own = spatial.shape(points=line(parts))
        elif dimension == 1:
            own = spatial.shape(lines=F.array(*map(line, parts)))
        else:
            own = spatial.shape(polygons=F.array(*(F.array(*map(line, g)) for g in parts)))
        made = F.when(F.col("template") == k, own.cast(spatial.SHAPE)).otherwise(made)
    return placed(suppliers).select("id", made.alias("shape"))


def collections(suppliers: DataFrame) -> DataFrame:
    """(collection, member): in each tile, suppliers by the remainder of their number by 9; the
    collections' ids are below zero."""
    rows = placed(suppliers)
    return rows.select((-1 - F.col("tile") * 9 - F.col("id") % 9).cast("long").alias("collection"), F.col("id").alias("member"))


def _box(x: int, y: int, w: int) -> list[tuple[int, int]]:
    return [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]


#: Relations by remainder: their lines, and what they make: polygons, rings and half cells; none if broken.
RELATIONS = [
    ([_box(0, 0, 5)[:3], _box(0, 0, 5)[2:], _box(1, 1, 3), _box(2, 2, 1)[::-1]], (2, 3, 34)),
    ([_box(0, 0, 1)[1:] + [(1, 0)], _box(1, 1, 1)], (2, 2, 4)),
    ([_box(0, 0, 3), [(0, 0), (2, 1), (1, 2)], [(0, 0), (1, 2)]], (1, 2, 15)),
    ([_box(0, 0, 1), _box(1, 0, 1)], (1, 1, 4)),
    ([_box(0, 0, 2), _box(1, 1, 2)], None),
    ([_box(0, 0, 2)[:4]], None),
    ([_box(0, 0, 5), _box(1, 1, 1), _box(2, 2, 1)[:3], _box(2, 2, 1)[2:]], (1, 3, 46)),
    ([[(0, 0), (4, 0), (2, 2), (4, 4)], [(4, 4), (0, 4), (2, 2), (0, 0)]], (2, 2, 16)),
]


def relation_lines(suppliers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(relations, shaped ways): each supplier's lines of RELATIONS, as members."""
    own = placed(suppliers).select("id", "ox", "oy", "tile", (F.col("id") % len(RELATIONS)).cast("int").alias("kind"))
    drawn = [(kind, k, points) for kind, (parts, _) in enumerate(RELATIONS) for k, points in enumerate(parts)]
    lines = suppliers.sparkSession.createDataFrame(drawn, "kind int, k int, drawn array<struct<x: int, y: int>>")  # some twenty rows
    ways = own.join(F.broadcast(lines), "kind").withColumn("points", F.transform("drawn", lambda p: sheared(F.col("ox") + p["x"], F.col("oy") + p["y"])))
    shaped = ways.select((F.col("id") * 10 + F.col("k")).alias("id"), "points", F.transform("points", lambda p, i: i.cast("long")).alias("nds"))
    member = F.struct(F.lit("way").alias("type"), (F.col("id") * 10 + F.col("k")).alias("ref"), F.lit("").alias("role"))
    tags = F.array(F.struct(F.lit("type").alias("k"), F.lit("boundary").alias("v")))
    return ways.groupBy("id").agg(F.collect_list(member).alias("members")).withColumn("tags", tags), shaped


_made = [(k, *made) for k, (_, made) in enumerate(RELATIONS) if made]


def _values(rows: list[tuple]) -> str:
    return ", ".join(str(r) for r in rows)


def _edges() -> list[tuple]:
    """(template, kind, x, y) of the unit edges of all lines."""
    out = []
    for t, (dimension, parts) in enumerate(TEMPLATES):
        for line in parts if dimension == 1 else ():
            for (x0, y0), (x1, y1) in zip(line, line[1:], strict=False):
                for k in range(abs(x1 - x0)):
                    out.append((t, "h", min(x0, x1) + k, y0))
                for k in range(abs(y1 - y0)):
                    out.append((t, "v", x0, min(y0, y1) + k))
    return out


_cells = [(t, x, y) for t, own in CELLS.items() for x, y in own]
_dots = [(t, x, y) for t, (d, own) in enumerate(TEMPLATES) if d == 0 for x, y in own]
_dims = [(t, d) for t, (d, _) in enumerate(TEMPLATES)]

#: What two shapes share: (a, b, flags), for every pair in a tile that shares anything, and itself.
_SHARED = f"""
dims(t, dim) AS (VALUES {_values(_dims)}), cells(t, x, y) AS (VALUES {_values(_cells)}),
edges(t, kind, x, y) AS (VALUES {_values(_edges())}), dots(t, x, y) AS (VALUES {_values(_dots)}),
cell_edges AS (
  SELECT t, 'h' AS kind, x, y FROM cells UNION ALL SELECT t, 'h', x, y + 1 FROM cells
  UNION ALL SELECT t, 'v', x, y FROM cells UNION ALL SELECT t, 'v', x + 1, y FROM cells
), cell_corners AS (SELECT t, x + dx AS x, y + dy AS y FROM cells, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) c(dx, dy)),
edge_ends AS (SELECT t, x, y FROM edges UNION ALL SELECT t, x + (kind = 'h')::INT, y + (kind = 'v')::INT FROM edges),
el(t, kind, x, y, d, inner_) AS (
  SELECT t, 'c', x, y, 2, true FROM cells
  UNION ALL SELECT t, kind, x, y, 1, count(*) = 2 FROM cell_edges GROUP BY t, kind, x, y
  UNION ALL SELECT t, 'p', x, y, 0, count(*) = 4 FROM cell_corners GROUP BY t, x, y
  UNION ALL SELECT t, kind, x, y, 1, true FROM edges
  UNION ALL SELECT t, 'p', x, y, 0, count(*) % 2 = 0 FROM edge_ends GROUP BY t, x, y
  UNION ALL SELECT t, 'p', x, y, 0, true FROM dots
), own AS (
  SELECT s_suppkey::BIGINT AS id, s_suppkey % {len(TEMPLATES)} AS t, s_suppkey // {len(TEMPLATES)} % {ACROSS} AS ox,
    s_suppkey // {len(TEMPLATES) * ACROSS} % {UP} AS oy, s_suppkey // {TILE} AS tile FROM supplier
), placed AS (SELECT id, tile, kind, x + ox AS x, y + oy AS y, d, inner_ FROM own JOIN el USING (t)),
sizes AS (SELECT id, tile, dim, count(*) AS n, count(*) FILTER (inner_) AS n_inner FROM placed JOIN own USING (id, tile) JOIN dims USING (t) GROUP BY id, tile, dim),
met AS (
  SELECT a.id AS a, b.id AS b, count(*) AS n, count(*) FILTER (a.inner_) AS of_a, count(*) FILTER (b.inner_) AS of_b,
    bool_or(a.inner_ AND b.inner_) AS ii, coalesce(bool_or(a.inner_ AND b.inner_ AND a.d > 0), false) AS ii1
  FROM placed a JOIN placed b USING (tile, kind, x, y) GROUP BY a.id, b.id
), shared AS (
  SELECT a, b, p.dim AS dim_a, q.dim AS dim_b, ii, ii1, of_a < p.n_inner AS ie, of_b < q.n_inner AS ei,
    met.n - of_a < p.n - p.n_inner AS be, met.n - of_b < q.n - q.n_inner AS eb
  FROM met JOIN sizes p ON p.id = a JOIN sizes q ON q.id = b
)"""


def _named(table: str, where: str) -> str:
    told = {
        "Intersects": "true", "Contains": "ii AND NOT (ei OR eb)", "Covers": "NOT (ei OR eb)", "Touches": "NOT ii",
        "Equals": "ii AND NOT (ie OR be OR ei OR eb)",
        "Overlaps": "dim_a = dim_b AND ii AND ie AND ei AND (dim_a <> 1 OR ii1)",
        "Crosses": "ii AND CASE WHEN dim_a = 1 AND dim_b = 1 THEN NOT ii1 WHEN dim_a < dim_b THEN ie WHEN dim_a > dim_b THEN ei ELSE false END",
    }
    return " UNION ALL ".join(f"SELECT a, '{n}' AS predicate, b FROM {table} WHERE {where} AND {c}" for n, c in told.items())


#: DuckDB SQL of the relations between all shapes.
RELATIONS_SQL = f"WITH {_SHARED} {_named('shared', 'a <> b')}"
_LIFTED = """SELECT m.c AS a, s.b, any_value(m.dim) AS dim_a, any_value(s.dim_b) AS dim_b, bool_or(ii) AS ii, bool_or(ii1) AS ii1,
  bool_or(ie) OR count(*) < any_value(m.size) AS ie, bool_and(ei) AS ei, bool_or(be) OR count(*) < any_value(m.size) AS be, bool_and(eb) AS eb
  FROM {table} s JOIN members m ON m.id = s.a GROUP BY m.c, s.b"""
#: The same with collections, of which one side is one at least.
COLLECTIONS_SQL = f"""WITH {_SHARED}, belong AS (SELECT -1 - tile * 9 - id % 9 AS c, id, dim FROM sizes),
members AS (SELECT c, id, max(dim) OVER (PARTITION BY c) AS dim, count(*) OVER (PARTITION BY c) AS size FROM belong),
single AS ({_LIFTED.format(table='shared')}),
turned AS (SELECT b AS a, a AS b, dim_b AS dim_a, dim_a AS dim_b, ii, ii1, ei AS ie, ie AS ei, eb AS be, be AS eb FROM single),
last AS ({_LIFTED.format(table='turned')}),
double AS (SELECT p.* REPLACE (q.ie AS ei, q.be AS eb) FROM last p JOIN last q ON p.a = q.b AND p.b = q.a),
every AS (SELECT * FROM single UNION ALL SELECT * FROM turned UNION ALL SELECT * FROM double)
{_named('every', 'a <> b')}"""
#: DuckDB SQL of the areas that the relations make.
AREAS_SQL = f"""SELECT s_suppkey::BIGINT AS obj_id, polygons::BIGINT AS polygons, rings::BIGINT AS rings, half_cells::BIGINT AS half_cells,
 CASE WHEN polygons > 1 THEN 'MULTIPOLYGON' ELSE 'POLYGON' END AS kind
 FROM supplier JOIN (VALUES {_values(_made)}) m(k, polygons, rings, half_cells) ON s_suppkey % {len(RELATIONS)} = k"""
