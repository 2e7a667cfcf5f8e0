"""Facts, joins, spatial relations, graphs, configuration, files: on small inputs."""

import bz2
import json

import pytest
from pyspark.sql import functions as F

from terraweave import config as C
from terraweave import vocabulary as V
from terraweave.functions import geometry as G
from tests import plain_relate as R
from tests import plain_rings
from terraweave.operators import areas, graph, joins, registry, spatial, stats
from terraweave.operators.facts import Facts
from terraweave.plans import lattice, queries
from terraweave.plans.dump import TIMINGS, Dump, Entities, main
from terraweave.sinks import triples as sink
from terraweave.sources import formats
from terraweave.sources.tables import TAGS
from terraweave.timing import Timings

META = "changeset long, seconds long, user string, uid long, version long, visible boolean"
NONE = (0, 0, "", 0, 0, True)


def nodes(spark, rows):
    return spark.createDataFrame([(*r, *NONE) for r in rows], f"id long, lon double, lat double, tags {TAGS}, {META}")


def ways(spark, rows):
    return spark.createDataFrame([(*r, *NONE) for r in rows], f"id long, nds array<long>, tags {TAGS}, {META}")


def relations(spark, rows):
    kind = "array<struct<type: string, ref: long, role: string>>"
    return spark.createDataFrame([(*r, *NONE) for r in rows], f"id long, members {kind}, tags {TAGS}, {META}")


def short(line):
    """Own prefixes by their role."""
    return line.replace(f"{V.GEOM}:", "GEOM:").replace(f"{V.FACT}:", "FACT:")


def lines(df):
    return {short(f"{r.s} {r.p} {r.o}") for r in df.collect()}


def config(**options):
    return C.Config(**{"output_format": "ttl", "wkt_precision": 1, **options}).normalised()


def test_node(spark):
    f = Facts(config(add_hasobb=True, add_hasconvexhull=True, add_hasenvelope=True))
    got = lines(f.nodes(nodes(spark, [(42, 7.51, 48.0, [("city", "Bremen")])])))
    wkt = "^^geo:wktLiteral"
    assert got == {
        "osmnode:42 rdf:type osm:node",
        'osmnode:42 osmmeta:timestamp "1970-01-01T00:00:00"^^xsd:dateTime',
        'osmnode:42 osmmeta:version "0"^^xsd:integer',
        'osmnode:42 osmkey:city "Bremen"',
        'osmnode:42 FACT:facts "1"^^xsd:integer',
        "osmnode:42 geo:hasGeometry GEOM:osmnode_42",
        f'GEOM:osmnode_42 geo:asWKT "POINT(7.5 48)"{wkt}',
        f'osmnode:42 GEOM:obb "POLYGON((7.5 48))"{wkt}',
        f'osmnode:42 GEOM:convex_hull "POLYGON((7.5 48))"{wkt}',
        f'osmnode:42 GEOM:envelope "POLYGON((7.5 48,7.5 48,7.5 48,7.5 48,7.5 48))"{wkt}',
    }


def test_missing_and_invalid_locations(spark):
    got = lines(Facts(config(no_osm_metadata=True)).nodes(nodes(spark, [(1, None, None, []), (2, 200.0, 1.0, [])])))
    assert got == {"osmnode:1 rdf:type osm:node", "osmnode:2 rdf:type osm:node"}


def test_unnamable_key(spark):
    got = lines(Facts(config(no_osm_metadata=True)).nodes(nodes(spark, [(1, 1.0, 1.0, [("not:Aß%I.R.I\u2000", "value")])])))
    assert any(" osm:tag _:" in x for x in got)
    assert any(x.endswith('osmkey:key "not:Aß%I.R.I\u2000"') for x in got) and any(x.endswith('osmkey:value "value"') for x in got)


def test_way_and_next_nodes(spark):
    n = nodes(spark, [(1, 48.0, 7.51, []), (2, 48.1, 7.61, []), (4, 48.1, 7.51, []), (3, 48.0, 7.51, [])])
    w = ways(spark, [(42, [1, 2, 4, 3], []), (43, [], []), (44, [9, 1], [])])
    shaped = joins.shape_ways(joins.locate_ways(w, formats.locations(n)))
    f = Facts(config(add_way_metadata=True, add_way_node_spatial_metadata=True, no_osm_metadata=True))
    got = lines(f.ways(shaped))
    for pos, metres in enumerate(("15657.137001", "11119.490351", "11024.108103")):
        assert f'_:way_42_{pos} osmway:next_node_distance "{metres}"^^xsd:decimal' in got
    assert 'osmway:42 FACT:length "37843.09"^^xsd:double' in got
    assert not any(x.startswith("_:way_42_3 osmway:next") for x in got)
    assert 'osmway:42 osmway:is_closed "true"^^xsd:boolean' in got
    assert 'GEOM:osmway_43 geo:asWKT "LINESTRING()"^^geo:wktLiteral' in got
    assert 'osmway:44 osmway:nodeCount "2"^^xsd:integer' in got and 'osmway:44 osmway:uniqueNodeCount "1"^^xsd:integer' in got


@pytest.mark.parametrize(
    ("nds", "tags", "closed", "area"),
    [
        ([1, 2, 1], [], True, False),
        ([1, 2, 3, 4], [("a", "b")], False, False),
        ([1, 2, 3, 1], [], True, False),
        ([1, 2, 3, 1], [("some", "tag")], True, True),
        ([1, 2, 3, 1], [("area", "no")], True, False),
        ([1, 9, 3, 9], [("some", "tag")], False, False),
    ],
)
def test_area_rule(spark, nds, tags, closed, area):
    n = nodes(spark, [(k, float(k), float(k * k), []) for k in (1, 2, 3, 4)])
    row = joins.shape_ways(joins.locate_ways(ways(spark, [(7, nds, tags)]), formats.locations(n))).first()
    assert (row.closed, row.is_area) == (closed, area)


def test_relation(spark):
    n = nodes(spark, [(23, 7.51, 48.0, []), (1, 7.52, 48.0, []), (2, 7.61, 48.0, [])])
    w = ways(spark, [(55, [1, 2], [])])
    r = relations(
        spark,
        [
            (42, [("node", 23, "label"), ("way", 55, "outer")], []),
            (10, [("node", 1, "label"), ("way", 1, "outer"), ("relation", 1, "foo"), ("odd", 3, "bar")], []),
        ],
    )
    geometries = joins.relation_geometries(r, w, formats.locations(n))
    got = lines(Facts(config(no_osm_metadata=True, add_hasenvelope=True)).relations(r, geometries))
    assert 'GEOM:osmrel_42 geo:asWKT "GEOMETRYCOLLECTION(POINT(7.5 48),LINESTRING(7.5 48,7.6 48))"^^geo:wktLiteral' in got
    assert 'osmrel:42 FACT:hasCompleteGeometry "true"^^xsd:boolean' in got
    assert 'osmrel:42 GEOM:envelope "POLYGON((7.5 48,7.6 48,7.6 48,7.5 48,7.5 48))"^^geo:wktLiteral' in got
    assert 'osmrel:10 FACT:hasCompleteGeometry "false"^^xsd:boolean' in got
    assert '_:relation_10_2 osmrel:member_role "foo"' in got and not any("_:relation_10_3" in x for x in got)


def test_area_facts(spark):
    ring = [(48.0, 7.51), (48.0, 7.61), (48.1, 7.61), (48.1, 7.51), (48.0, 7.51)]
    a = spark.createDataFrame([(42, 21, True, [[ring]]), (21, 10, False, [[ring]])], f"area_id long, obj_id long, from_way boolean, polygons {G.MULTIPOLYGON}")
    got = lines(Facts(config(add_hasconvexhull=True)).areas(a))
    assert 'GEOM:osmway_21 geo:asWKT "POLYGON((48 7.5,48 7.6,48.1 7.6,48.1 7.5,48 7.5))"^^geo:wktLiteral' in got
    assert 'osmway:21 FACT:area "122568687.4654"^^xsd:double' in got
    assert 'osmrel:10 FACT:hasCompleteGeometry "true"^^xsd:boolean' in got
    assert 'osmway:21 GEOM:convex_hull "POLYGON((48.1 7.5,48.1 7.6,48 7.6,48 7.5,48.1 7.5))"^^geo:wktLiteral' in got


def test_grid_join_equals_all_pairs(spark):
    import random

    rng = random.Random(5)
    rows, shapes = [], {}
    for k in range(60):
        x, y, n = rng.randint(-20, 20), rng.randint(-20, 20), rng.choice((1, 2, 3, 30))
        if k % 3 == 0:
            parts = (0, [(x, y)], [], [])
            shapes[k] = R.Shape(0, [(x, y)])
        elif k % 3 == 1:
            own = [(float(x), float(y)), (x + n, y + n / 2)]
            parts = (1, [], [own], [])
            shapes[k] = R.Shape(1, [own])
        else:
            ring = [(x, y), (x + n, y), (x + n, y + n), (x, y + n), (x, y)]
            parts = (2, [], [], [[ring]])
            shapes[k] = R.Shape(2, [[ring]])
        f = lambda p: (float(p[0]), float(p[1]))
        d, p, lns, g = parts
        rows.append((k, (d, [f(q) for q in p], [[f(q) for q in ln] for ln in lns], [[[f(q) for q in r] for r in h] for h in g])))
    df = spark.createDataFrame(rows, f"id long, shape {spatial.SHAPE}")
    got = {(r.a, r.predicate, r.b) for r in spatial.relations(df).collect()}
    want = set()
    for a, s in shapes.items():
        for b, t in shapes.items():
            if a != b:
                m = R.relate(s, t)
                want |= {(a, n, b) for n, v in R.predicates(m, s.dimension, t.dimension).items() if v}
    assert got == want


def star(rng, x, y, reach, n):
    """A closed ring around (x, y), concave and slanted, of whole coordinates."""
    import math

    ring = []
    for k in range(n):
        at, far = 2 * math.pi * k / n, reach * rng.uniform(0.35, 1)
        ring.append((float(x + round(far * math.cos(at))), float(y + round(far * math.sin(at)))))
    return [*ring, ring[0]]


def test_slanted_shapes_equal_all_pairs(spark):
    """Stars, some with a square hole, some with corners on others' edges, lines of many points."""
    import random

    rng = random.Random(11)
    rows, shapes = [], {}
    for k in range(36):
        x, y = rng.randint(-60, 60), rng.randint(-40, 40)
        if k % 4 == 0:
            line = [(float(x + 7 * j), float(y + rng.randint(-9, 9))) for j in range(rng.randint(2, 6))]
            lines = [line, [line[-1], (line[-1][0] + 3, line[-1][1] + 8)]] if k % 8 == 0 else [line]
            rows.append((k, (1, [], lines, [])))
            shapes[k] = R.Shape(1, lines)
        else:
            g = [star(rng, x, y, 40, 9)]
            if k % 4 == 1:
                g.append([(x - 4.0, y - 4.0), (x + 4.0, y - 4.0), (x + 4.0, y + 4.0), (x - 4.0, y + 4.0), (x - 4.0, y - 4.0)])
            rows.append((k, (2, [], [], [g])))
            shapes[k] = R.Shape(2, [g])
    # parts of a shape that is there: a piece of its ring as a line, a ring that shares edges, a far part
    ring = shapes[2].parts[0][0]
    extra = [(1, [], [ring[:4]], []), (2, [], [], [[[*ring[:4], ring[0]]]]), (2, [], [], [[ring], [star(rng, 150, 70, 9, 5)]]), (0, [ring[1], (150.0, 70.0)], [], [])]
    for k, (dim, *kinds) in enumerate(extra, 100):
        rows.append((k, (dim, *kinds)))
        shapes[k] = R.Shape(dim, kinds[dim])
    df = spark.createDataFrame(rows, f"id long, shape {spatial.SHAPE}")
    found = spatial.relations(df)
    assert "Python" not in found._jdf.queryExecution().toString()
    got = {(r.a, r.predicate, r.b) for r in found.collect()}
    want = set()
    for a, s in shapes.items():
        for b, t in shapes.items():
            if a != b:
                m = R.relate(s, t)
                want |= {(a, n, b) for n, v in R.predicates(m, s.dimension, t.dimension).items() if v}
    assert got == want, (sorted(got - want)[:9], sorted(want - got)[:9])


def ring_set(polygons):
    """Polygons as sets of rings, each turned to its least point and direction."""

    def turned(ring):
        own = [tuple(p) for p in ring[:-1]]
        k = own.index(min(own))
        one, two = own[k:] + own[:k], [own[k]] + (own[:k][::-1] + own[k + 1 :][::-1])
        return min(tuple(one), tuple(two))

    return {(turned(g[0]), frozenset(turned(r) for r in g[1:])) for g in polygons}


def test_rings_of_relations(spark):
    """Rings cut into lines at random, turned and mixed: holes, islands in holes, rings that touch at
    a point, inside and outside, doubled segments, crossings and open ends."""
    import random

    rng = random.Random(21)
    box = lambda x, y, w, h=None: [(x, y), (x + w, y), (x + w, y + (h or w)), (x, y + (h or w)), (x, y)]
    cases = {
        "plain": [box(0, 0, 9)],
        "hole and island": [box(0, 0, 30), box(5, 5, 20), box(10, 10, 5), box(40, 0, 3)],
        "holes that touch": [box(0, 0, 30), box(5, 5, 5), box(10, 10, 5)],
        "outers that touch": [box(0, 0, 5), box(5, 5, 5), box(10, 10, 5)],
        "hole at the rim": [[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(0, 0), (4, 2), (2, 4), (0, 0)]],
        "hole at two places": [box(0, 0, 10), [(0, 0), (9, 5), (10, 10), (5, 9), (0, 0)]],
        "bow": [[(0, 0), (4, 4), (8, 0), (8, 8), (4, 4), (0, 8), (0, 0)]],
        "clover": [[(0, 0), (3, 1), (1, 3), (0, 0), (-3, 1), (-1, 3), (0, 0), (-3, -1), (-1, -3), (0, 0)]],
        "shared side": [box(0, 0, 5), box(5, 0, 5)],
        "crossing": [box(0, 0, 5), box(2, 2, 5)],
        "side in part": [box(0, 0, 5), [(2, 0), (3, 0), (3, -2), (2, -2), (2, 0)]],
        "open": [box(0, 0, 5)[:4]],
        "spoke": [box(0, 0, 5), [(0, 0), (-3, -3)]],
    }
    names, rows, want = {}, [], {}
    for k, (name, rings) in enumerate((n, r) for n, r in cases.items() for _ in range(3)):
        lines = []
        for ring in rings:
            turn = rng.randrange(len(ring) - 1) if ring[0] == ring[-1] else 0
            own = ring[turn:-1] + ring[: turn + 1] if turn else list(ring)
            cuts = sorted({0, len(own) - 1, *(rng.randrange(len(own)) for _ in range(rng.randrange(4)))})
            parts = [own[a : b + 1] for a, b in zip(cuts, cuts[1:])]
            lines += [p if rng.random() < 0.5 else p[::-1] for p in parts]
        rng.shuffle(lines)
        lines = [[(float(x), float(y)) for x, y in p] for p in lines]
        rows += [(k, n, p) for n, p in enumerate(lines)]
        names[k], want[k] = name, plain_rings.assemble(lines)
    df = spark.createDataFrame(rows, f"id long, line int, points {G.LINE}")
    built = areas.assembled(df)
    assert "Python" not in built._jdf.queryExecution().toString()
    got = {r.id: r.polygons for r in built.collect()}
    for k, name in names.items():
        if name == "side in part":
            assert k not in got
        elif name == "hole at two places":
            assert sum(map(len, got[k])) == 2
        else:
            assert ring_set(got.get(k, [])) == ring_set(want[k]), (name, got.get(k), want[k])


def test_a_ring_of_many_lines(spark):
    """A ring of 4000 points in 500 lines, as rows all the way."""
    import math

    n, lines = 4000, 500
    at = lambda k: (math.cos(2 * math.pi * (k % n) / n), math.sin(2 * math.pi * (k % n) / n))
    step = n // lines
    rows = [(1, k, [at(j) for j in range(k * step, (k + 1) * step + 1)][:: 1 if k % 2 else -1]) for k in range(lines)]
    got = areas.assembled(spark.createDataFrame(rows, f"id long, line int, points {G.LINE}")).collect()
    assert len(got) == 1 and len(got[0].polygons) == 1 and len(got[0].polygons[0][0]) == n + 1
    assert {tuple(p) for p in got[0].polygons[0][0]} == {at(k) for k in range(n)}


EDGES = [(0, 1), (0, 3), (0, 4), (1, 4), (2, 4), (2, 6), (5, 0), (5, 1), (5, 2), (5, 3), (5, 4), (5, 6)]


def test_xml_files_are_bounded(spark, data, monkeypatch):
    monkeypatch.setattr(queries, "XML_ROWS", 10)
    found = queries.QUERIES["xml_nodes"](spark, data)
    n = spark.read.parquet(f"{data}/part.parquet").count()
    assert len(found.inputFiles()) >= n / 10 and found.count() == found.select("id").distinct().count() == n


def test_a_collection_may_overlap_by_members_only(spark):
    box = lambda x, y, w, h: [[[(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]]]
    # 2 lies in 1 and 3 apart from it; 5 overlaps 1
    boxes = [(1, box(0.0, 0.0, 4.0, 4.0)), (2, box(1.0, 1.0, 1.0, 1.0)), (3, box(9.0, 9.0, 1.0, 1.0)), (5, box(3.0, 3.0, 2.0, 2.0))]
    rows = spark.createDataFrame(boxes, f"id long, polygons {G.MULTIPOLYGON}")
    shapes = rows.select("id", spatial.shape(polygons=F.col("polygons")).alias("shape"))
    members = spark.createDataFrame([(-1, 2), (-1, 3), (-2, 5), (-2, 3), (-3, 1), (-3, 3)], "collection long, member long")
    told = {}
    for by_member in (False, True):
        found = spatial.with_collections(shapes, members, by_member=by_member).filter("predicate = 'Overlaps' and (a < 0 or b < 0)")
        told[by_member] = {(r.a, r.b) for r in found.collect()}
    assert (-1, 1) in told[False] and {(-1, 1), (1, -1)}.isdisjoint(told[True])
    assert {(-2, 1), (1, -2), (-3, -2), (-2, -3), (-3, 5), (5, -3)} <= told[True] <= told[False]


def test_pairs_and_rings_pass_nothing_whole_through_the_driver(spark, data):
    suppliers = spark.read.parquet(f"{data}/supplier.parquet")
    for found in (spatial.relations(lattice.shapes(suppliers)), areas.of_relations(*lattice.relation_lines(suppliers))):
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_graph(spark):
    e = spark.createDataFrame(EDGES, "src long, dst long")
    want = {(0, 1), (0, 3), (1, 4), (2, 4), (2, 6), (5, 0), (5, 2)}
    assert {tuple(r) for r in graph.reduce_dag(e).collect()} == want
    more = spark.createDataFrame([(1, 2), (1, 0), (1, 2), (2, 1)], "src long, dst long")
    with pytest.raises(RuntimeError):
        graph.Successors(more).of(1)
    assert graph.Successors(more).prepare().of(1) == [0, 2]
    assert tuple(graph.counts(more).first()) == (4, 3)
    assert any("0 -> 1" in r.line for r in graph.dot(e, object_ids=True).collect())
    closed = [(0, 6), (1, 0), (1, 2), (1, 4), (1, 6), (2, 0), (2, 4), (2, 6), (3, 6), (4, 6), (5, 0), (5, 2), (5, 3), (5, 4), (5, 6)]
    got = {tuple(r) for r in graph.reduce_closed_dag(spark.createDataFrame(closed, "src long, dst long")).collect()}
    assert got == {(0, 6), (1, 2), (2, 0), (2, 4), (3, 6), (4, 6), (5, 2), (5, 3)}


def plain_reach(edges):
    out = {}
    for s, t in edges:
        out.setdefault(s, set()).add(t)

    def of(v):
        seen, todo = set(), list(out.get(v, ()))
        while todo:
            w = todo.pop()
            if w not in seen:
                seen.add(w)
                todo += out.get(w, ())
        return seen

    return {v: of(v) for v in {x for e in edges for x in e}}


def test_search_from_given_vertices(spark):
    import random

    rng = random.Random(6)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(110)]
    e = spark.createDataFrame(edges, "src long, dst long")
    reach = plain_reach(edges)
    asked = [v for v in range(65)]
    # more sources than a number has bits, some of which have no edge, cycles among them
    got = {tuple(r) for r in graph.successors_of(e, asked).collect()}
    assert got == {(v, w) for v in asked for w in reach.get(v, ()) if w != v}
    assert graph.successors_of(e, []).count() == 0 and graph.successors_of(e.limit(0), [1]).count() == 0


def test_reduction_by_levels(spark):
    import random

    rng = random.Random(8)
    for seed in range(2):
        edges = sorted({tuple(sorted(rng.sample(range(90), 2))) for _ in range(260)})
        e = spark.createDataFrame(edges + edges[:5], "src long, dst long")
        reach = plain_reach(edges)
        of = {}
        for s, t in edges:
            of.setdefault(s, set()).add(t)
        want = {(s, t) for s, t in edges if not any(t in reach[w] for w in of[s] if w != t)}
        assert {tuple(r) for r in graph.reduce_dag(e).collect()} == want
    with pytest.raises(RuntimeError, match="cycle"):
        graph.reduce_dag(spark.createDataFrame([(1, 2), (2, 3), (3, 2)], "src long, dst long"))
    assert graph.reduce_dag(e.limit(0)).count() == 0


def test_location_stores_agree(spark):
    import random

    rng = random.Random(3)
    near = [(k, float(k % 170), float(k % 80), [("a", "b")] if k % 3 else []) for k in range(-40, 400) if k % 7]
    far = [(10**12 + 999 * k, 1.0 * k, 2.0, []) for k in range(20)]
    ids = [n[0] for n in near + far] + [5_000, -7]
    w = ways(spark, [(k, [rng.choice(ids) for _ in range(rng.randrange(30))], []) for k in range(40)])
    places = formats.locations(nodes(spark, near + far))
    told = {s: {r.id: r.located for r in joins.locate_ways(w, places, s).collect()} for s in (None, *joins.STORES, "unknown")}
    assert all(t == told[None] for t in told.values()) and any(told[None].values())
    assert joins.is_dense(formats.locations(nodes(spark, near))) and not joins.is_dense(formats.locations(nodes(spark, far)))


def test_bucketed_nodes_stay_where_they_are(spark):
    from terraweave.sources.stored import bucketed, remove_stored

    n = bucketed(nodes(spark, [(k, float(k), 1.0, []) for k in range(50)]), "nodes", "id")
    w = bucketed(ways(spark, [(k, [k, k + 1, 99], []) for k in range(40)]), "ways", "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = joins.locate_ways(w, formats.locations(n))
        assert len(found.collect()) == 40 and found.filter("size(located) = 3").count() == 40
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        # references are dealt by node and back by way; neither nodes nor ways are
        assert plan.count("Exchange hashpartitioning(ref") == 1 and plan.count("Exchange hashpartitioning(id") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    remove_stored(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(("nodes_", "ways_"))]


def test_registries(spark, monkeypatch):
    ids = [1, 1, 2, 32768, 32769, 2**40, 2**40 + 1, 0, None]
    df = spark.createDataFrame([("a" if k % 2 else "b", i) for k, i in enumerate(ids)], "kind string, ref long")
    got = {r.kind: r.n for r in registry.counted(registry.registered(df, "ref", "kind"), "kind").collect()}
    assert got == {"a": len({ids[k] for k in range(1, 9, 2)}), "b": len({ids[k] for k in range(0, 9, 2)} - {None})}
    rows = spark.createDataFrame([(i, "x") for i in (1, 2, 3, 32767, 32768, 32769, 2**40, 2**41, 0, None)], "id long, _bits string")
    for most in (8192, 0):
        monkeypatch.setattr(registry, "BROADCAST_BITMAPS", most)
        kept = registry.kept(rows, "id", registry.registered(df, "ref"))
        assert {r.id for r in kept.collect()} == {1, 2, 32768, 32769, 2**40, 0} and kept.columns == rows.columns


def test_wide_ids_can_be_kept(spark):
    w = spark.createDataFrame([(2**32 + 5,)], "id long")
    for wrap, number in ((True, 5), (False, 2**32 + 5)):
        f = Facts(config(), wrap_ids=wrap)
        assert w.select(f.subject("way").alias("s")).first().s == f"osmway:{number}"
        assert w.select(f.subject("relation").alias("s")).first().s == f"osmrel:{number}"


def test_config(tmp_path):
    f = tmp_path / "in.osm"
    f.write_text("<osm/>")
    c = C.parse([str(f), "-o", str(tmp_path / "out"), "--no-ways", "--add-way-node-spatial-metadata", "--no-member-triples"])
    assert c.no_way_facts and c.no_relation_geometric_relations and not c.no_relation_facts and not c.no_member_triples
    assert not C.parse([str(f), "--no-relations"]).no_relation_geometric_relations
    assert C.parse([str(f)]).output_compression == "none"
    for argv, code in (([], 2), ([str(tmp_path / "x")], 10), ([str(tmp_path)], 11), ([str(f), "-o", str(tmp_path)], 12)):
        with pytest.raises(C.ConfigError) as e:
            C.parse(argv)
        assert e.value.code == code
    assert len(C.option_rows(C.Config())) == 31


XML = """<?xml version='1.0'?><osm>
<node id="1" lat="0" lon="0" version="1" timestamp="2019-04-22T12:34:56Z" user=" a b " uid="3" changeset="5"/>
<node id="2" lat="0" lon="2" version="1"><tag k="name" v="  Q42  "/></node>
<node id="3" lat="2" lon="2" version="1"/><node id="4" lat="2" lon="0" version="1"/>
<node id="5" lat="1" lon="1" version="1"><tag k="a" v="b"/></node>
<way id="7" version="1"><nd ref="1"/><nd ref="2"/><nd ref="3"/><nd ref="4"/><nd ref="1"/><tag k="building" v="yes"/></way>
<relation id="9" version="1"><member type="node" ref="5" role=""/><member type="way" ref="7" role="x"/></relation>
</osm>"""
OPL = """n1 v1 dV c5 t2019-04-22T12:34:56Z i3 u%20%a%20%b%20% T x0 y0
n2 v1 Tname=%20%%20%Q42%20%%20% x2 y0
n3 v1 x2 y2
n4 v1 x0 y2
n5 v1 Ta=b x1 y1
w7 v1 Tbuilding=yes Nn1,n2,n3,n4,n1
r9 v1 Mn5@,w7@x
"""


def test_files_and_whole_run(spark, tmp_path):
    (tmp_path / "a.osm").write_text(XML)
    (tmp_path / "a.opl").write_text(OPL)
    (tmp_path / "a.osm.bz2").write_bytes(bz2.compress(XML.encode()))
    kinds = ("node", "way", "relation")
    read = lambda name: [formats.read_entities(spark, str(tmp_path / name), k) for k in kinds]
    first = read("a.osm")
    for name in ("a.opl", "a.osm.bz2"):
        for a, b in zip(first, read(name), strict=True):
            assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
    got = lines(Dump(Entities(*first), config()).triples())
    assert 'osmnode:1 osmmeta:timestamp "2019-04-22T12:34:56"^^xsd:dateTime' in got and 'osmnode:1 osmmeta:user " a b "' in got
    assert 'osmnode:2 osmkey:name "  Q42  "' in got
    assert "osmway:7 ogc:sfCovers osmnode:2" in got and "osmway:7 ogc:sfContains osmnode:5" in got
    assert "osmway:7 ogc:sfContains osmnode:2" not in got
    assert 'GEOM:osmway_7 geo:asWKT "POLYGON((0 0,2 0,2 2,0 2,0 0))"^^geo:wktLiteral' in got
    out = tmp_path / "out.ttl"
    assert main([str(tmp_path / "a.osm"), "-o", str(out), "--output-format", "ttl", "--wkt-precision", "1", "--write-rdf-statistics", "--output-merge", "concatenate"], spark) == 0
    written = bz2.decompress((tmp_path / "out.ttl.bz2").read_bytes()).decode().splitlines()
    told = {short(x.removesuffix(" .")) for x in written if not x.startswith("@prefix")}
    made = {x for x in told if x.startswith("weavemeta:info ")}
    assert len(made) == 2 and 'weavemeta:info weavemeta:version "0.2"' in made and told - made == got
    assert sum(x.startswith("@prefix") for x in written) == 25
    assert (tmp_path / "out.ttl.stats.json").exists()


def test_empty_file(spark, tmp_path):
    (tmp_path / "e.osm").write_text("<osm></osm>")
    kinds = [formats.read_entities(spark, str(tmp_path / "e.osm"), k) for k in ("node", "way", "relation")]
    dump = Dump(Entities(*kinds), config())
    assert dump.fact_triples().count() == 0 and dump.spatial_triples().count() == 0


def test_switches(spark):
    n = nodes(spark, [(1, 0.0, 0.0, []), (2, 1.0, 1.0, [("a", "b")])])
    e = Entities(n, ways(spark, [(1, [1, 2], [])]), relations(spark, [(1, [("node", 1, "")], [])]))
    assert Dump(e, config(no_facts=True)).fact_triples() is None
    assert Dump(e, config(write_ogc_geo_triples="none")).spatial_triples() is None
    kept = lines(Dump(e, config(no_untagged_nodes=True, no_osm_metadata=True)).fact_triples())
    assert "osmnode:1 rdf:type osm:node" not in kept and "osmnode:2 rdf:type osm:node" in kept
    counts = stats.kind_counts({"node": (n, True)}).first()
    assert (counts.seen, counts.dumped) == (2, 1)


def test_auxiliary_geometries(spark, tmp_path):
    (tmp_path / "aux.tsv").write_text("<x:box>\tPOLYGON((-1 -1,3 -1,3 3,-1 3,-1 -1))\n<x:none>\tnothing\n")
    shapes = formats.read_wkt(spark, str(tmp_path / "aux.tsv"))
    assert [r.id for r in shapes.collect()] == ["<x:box>"]


def test_part_names():
    assert sink.part_name("out", 3, 12) == "out.part_03" and sink.with_ending("a.bz2", "bz2") == "a.bz2"


def test_required_ids(spark):
    w = ways(spark, [(1, [1, 2, 2], [])])
    r = relations(spark, [(1, [("node", 2, ""), ("way", 1, ""), ("relation", 5, "")], [])])
    got = {x.kind: x.required for x in stats.required_ids(w, r).collect()}
    assert got == {"node": 2, "way": 1, "relation": 1}


def test_streaming(spark, data, tmp_path):
    from terraweave.streaming import events as S

    batch = spark.read.parquet(f"{data}/events.parquet")
    src = tmp_path / "in"
    batch.write.parquet(str(src))
    found = S.read_events(spark, str(src), batch.schema)
    q = S.write_stream(S.meta_triples(found, Facts(config())), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(120)
    assert spark.read.text(str(tmp_path / "out")).count() == S.meta_triples(batch, Facts(config())).count()


def test_queries_of_facts_together_are_the_whole_dump(spark, data):
    import duckdb

    from terraweave.plans import oracle, queries
    from terraweave.sources import tables as A

    own = duckdb.connect()
    for name in ("part", "orders", "customer", "nation", "region", "supplier", "lineitem"):
        own.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data}/{name}.parquet')")
    parts = ("config_metadata", "node_facts", "way_facts", "relation_facts")
    sql = " UNION ALL ".join(f"SELECT s, p, o FROM ({oracle.ORACLE_SQL[n]})" for n in parts)
    want = sorted(own.execute(sql).fetchall())
    # the adapter's areas: each has a geometry, its literal, its measure, and wholeness
    rows = [tuple(r) for r in queries.QUERIES["full_dump"](spark, data).collect()]
    number = lambda s: int(s.split(":")[-1].split("_")[-1]) if s[-1].isdigit() else 0
    shaped = {r[0] for r in rows if A.SUPPLIER_BASE <= number(r[0]) < A.REGION_BASE}
    assert sorted(r for r in rows if r[0] not in shaped) == want
    boxes = own.execute("SELECT count(*), count(*) FILTER (s_suppkey % 4 = 0) FROM supplier").fetchone()
    assert len(rows) - len(want) == 3 * boxes[0] + boxes[1]


def test_geometries_are_simplified_by_their_whole_length(spark):
    from terraweave.functions import kernels

    bent = [(0.0, 0.0), (0.0, 80.0), (100.0, 1000.0)]
    ring = [(0.0, 0.0), (50.0, 0.001), (100.0, 0.0), (100.0, 100.0), (0.0, 100.0), (0.0, 0.0)]
    tiny = [(1.0, 1.0), (1.01, 1.0), (1.01, 1.01), (1.0, 1.0)]
    as_points = lambda line: [{"x": x, "y": y} for x, y in line]
    kind = "array<array<struct<x: double, y: double>>>"
    df = spark.createDataFrame([(1, [as_points(bent)]), (2, None), (3, [])], f"id int, lines {kind}")
    shown = {r.id: r.shown for r in kernels.with_simplified_geometry(df, 2, 5.0, "lines", "shown", closed=False).collect()}
    assert [(p.x, p.y) for p in shown[1][0]] == bent and shown[2] is None and shown[3] == []
    wide = kernels.with_simplified_geometry(df, 2, 80.0, "lines", "shown", closed=False).filter("id = 1").first().shown
    assert [(p.x, p.y) for p in wide[0]] == [bent[0], bent[2]]
    polygons = spark.createDataFrame([(1, [[as_points(ring), as_points(tiny)]])], f"id int, polygons array<{kind}>")
    got = kernels.with_simplified_geometry(polygons, 3, 5.0, "polygons", "shown", closed=True).first().shown
    assert [(p.x, p.y) for p in got[0][0]] == [ring[0], *ring[2:]] and [(p.x, p.y) for p in got[0][1]] == tiny
    kept = kernels.with_simplified_geometry(polygons, 99, 5.0, "polygons", "shown", closed=True).first()
    assert kept.shown == kept.polygons


def test_parts_stay_apart_without_merge(spark, tmp_path):
    (tmp_path / "a.osm").write_text(XML)
    out = tmp_path / "out.ttl"
    told = TIMINGS.steps.get("write")
    before = told.count if told else 0
    for _ in range(2):
        assert main([str(tmp_path / "a.osm"), "-o", str(out), "--output-format", "ttl", "--write-rdf-statistics"], spark) == 0
    folder = tmp_path / "out.ttl.bz2.parts"
    names = (folder / "MANIFEST").read_text().split()
    assert not (tmp_path / "out.ttl.bz2").exists() and not (tmp_path / "out.ttl.bz2.header").exists()
    assert sorted(p.name for p in folder.glob("out*")) == sorted(names) == names and names[0] == sink.part_name("out.ttl.bz2", 0, len(names))
    lines = b"".join(bz2.decompress((folder / n).read_bytes()) for n in names).decode().splitlines()
    assert lines[0].startswith("@prefix") and not any(x.startswith("@prefix") for x in lines[-5:])
    # the counters of the one run that wrote
    found = json.loads((tmp_path / "out.ttl.stats.json").read_text())
    header = sum(x.startswith("@prefix") for x in lines)
    made = {x.split(" ")[2] for x in lines if " _:" in x}
    assert found == {"blankNodes": len(made), "header": header, "lines": len(lines), "triples": len(lines) - header}
    step = TIMINGS.steps["write"]
    assert step.count == before + 2 and 0 < step.least <= step.mean <= step.most


def test_timings():
    t = Timings()
    for _ in range(2):
        with t.of("a"):
            pass
    with pytest.raises(ValueError), t.of("b"):
        raise ValueError
    assert [(r[0], r[1]) for r in t.rows()] == [("a", 2), ("b", 1)] and all(0 <= r[2] <= r[3] <= r[4] for r in t.rows())
    t.steps["a"].add(5.0)
    assert t.steps["a"].most == 5.0 and t.steps["a"].count == 3 and Timings().rows() == []


def test_hulls_of_many_tasks(spark, monkeypatch):
    import random

    from terraweave.functions import kernels

    rng = random.Random(4)
    points = {k: [(float(rng.randint(-50, 50)), float(rng.randint(-50, 50))) for _ in range(n)] for k, n in enumerate((1, 2, 5, 400, 1000))}
    points[9] = [(float(x), 0.0) for x in range(30)]
    rows = [(k, *p) for k, own in points.items() for p in own] + [(0, None, 1.0), (3, 2.0, None)]
    rng.shuffle(rows)
    monkeypatch.setattr(kernels, "HELD_POINTS", 64)
    df = spark.createDataFrame(rows, "key long, x double, y double").repartition(5)
    got = {r.key: [tuple(p) for p in r.hull] for r in kernels.hulls_of_groups(df).collect()}
    assert got == {k: kernels.convex_hull(own) for k, own in points.items()}
    assert kernels.hulls_of_groups(df.limit(0)).count() == 0


def test_a_line_must_fit_the_buffer(spark):
    from terraweave.sinks import triples

    rows = spark.createDataFrame([("s", "p", '"' + "x" * 100 + '"')], "s string, p string, o string")
    assert len(list(triples.to_stdout(rows))) == 1
    with pytest.raises(ValueError):
        list(triples.to_stdout(rows, longest=50))


def test_shared_folder_must_be_named_on_a_cluster(spark):
    from terraweave.sources import stored

    class Conf:
        def __init__(self, **told):
            self.told = told

        def get(self, key, default=None):
            return self.told.get(key, default)

    class Session:
        def __init__(self, **told):
            self.conf = Conf(**{k.replace("_", "."): v for k, v in told.items()})

    assert stored.shared_folder(Session(spark_checkpoint_dir="/shared")) == "/shared"
    assert stored.shared_folder(Session(spark_master="local[4]")) == stored.LOCAL_FOLDER
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError):
            stored.shared_folder(Session(spark_master=master))


def test_entry_is_imported_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    told = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q) and len(q) > 60"
    subprocess.run([sys.executable, "-c", told], cwd=Path(__file__).parent.parent, check=True, timeout=120)


def test_facts_of_relations_hold_each_member_once(spark):
    from terraweave.operators.facts import exploded
    from terraweave.plans import queries as q
    from terraweave.sources import tables as A

    f, d = q.facts(), "/root/testdata/sf0.001"
    s = f.subject("relation")
    rows = A.relations(spark, d)
    none = spark.createDataFrame([], "id long, parts array<struct<pos: int, type: string, points: array<struct<x: double, y: double>>>>, complete boolean")
    want = exploded(rows, *f.object_facts(s, "relation"), f.relation_members(s))
    got = f.relations(rows, none)
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()


def test_generators_hold_no_lambdas(spark, data):
    # a generator with a lambda is interpreted as a whole, texts of all triples included
    from terraweave.plans import queries

    for name in ("full_dump", "facts_without_ways"):
        plan = queries.QUERIES[name](spark, data)._jdf.queryExecution().optimizedPlan().toString()
        made = [line for line in plan.splitlines() if "Generate explode" in line]
        assert made and not any("lambda" in line for line in made)


def test_far_references_take_no_blocks(spark):
    # dense nodes alone are no reason for blocks: each of these references would fetch its own
    far = spark.createDataFrame([(w, w * 64 + k * 640) for w in range(20) for k in range(10)], "id long, ref long")
    near = spark.createDataFrame([(w, w * 64 + k) for w in range(20) for k in range(10)], "id long, ref long")
    assert not joins.is_near(far) and joins.is_near(near)
