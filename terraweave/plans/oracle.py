"""DuckDB SQL that gives the rows of the registered queries from the same tables.

Written apart from the engine: unnest and window functions in place of arrays kept in
rows, replace chains from the vocabulary's fixed values.
"""

from __future__ import annotations

from .. import vocabulary as V
from ..functions.geometry import MERCATOR_EDGE
from ..functions.text import name
from ..sinks.triples import VERSION
from ..sources.tables import FIRST_SECOND, REGION_BASE, SUPPLIER_BASE
from . import lattice
from .queries import CONFIG, FMT, INPUTS, LINE_BASE, OPTIONS

DAY = "strftime(to_timestamp({s}) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S')"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def t(term: tuple[str, str], fmt: str = FMT) -> str:
    return lit(name(term, fmt))


def replaced(column: str, pairs) -> str:
    for a, b in pairs:
        column = f"replace({column}, {a}, {b})"
    return column


def string(column: str, quote: str = '"') -> str:
    body = replaced(
        column,
        [(lit("\\"), lit("\\\\")), (lit(quote), lit("\\" + quote)), ("chr(10)", lit("\\n")), ("chr(13)", lit("\\r"))],
    )
    return f"{lit(quote)} || {body} || {lit(quote)}"


def typed(text: str, kind: str) -> str:
    full = name(("geo", "wktLiteral") if kind == "wktLiteral" else ("xsd", kind), FMT)
    return f"""('"' || {text} || '"^^{full}')"""


def trimmed(x: str, digits: int = 7) -> str:
    fixed = f"CAST(CAST({x} AS DECIMAL(30, {digits})) AS VARCHAR)"
    bare = f"regexp_replace(regexp_replace({fixed}, '(\\.\\d*?)0+$', '\\1'), '\\.$', '')"
    return f"CASE WHEN {bare} = '-0' THEN '0' ELSE {bare} END"


def xy(x: str, y: str) -> str:
    return f"({trimmed(x)}) || ' ' || ({trimmed(y)})"


def iri_ref(column: str, qlever: bool) -> str:
    codes = [*range(1, 33), *map(ord, V.IRI_RESERVED)]
    if not qlever:
        codes = [ord("\\"), *(c for c in codes if c != ord("\\"))]
    return replaced(column, [(f"chr({c})", lit(f"%{c:02x}" if qlever else f"\\u{c:04x}")) for c in codes])


def pn_local(column: str) -> str:
    """By characters: each alone, with its place."""
    escaped = lit(V.LOCAL_ESCAPED.replace(".", "").replace("-", ""))
    one = (
        f"CASE WHEN regexp_full_match(c, '[A-Za-z0-9_:]') THEN c "
        f"WHEN c = '.' THEN CASE WHEN i = 1 OR i = length({column}) THEN '\\.' ELSE c END "
        f"WHEN c = '-' THEN CASE WHEN i = 1 THEN '\\-' ELSE c END "
        f"WHEN contains({escaped}, c) THEN '\\' || c "
        f"WHEN ascii(c) < 128 THEN '%' || lower(printf('%02x', ascii(c))) ELSE c END"
    )
    return (
        f"list_aggregate(list_transform(string_split({column}, ''), lambda c, i: {one}), 'string_agg', '')"
    )


def union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


KEY = INPUTS["key"]
PART = "SELECT p_partkey AS id, * FROM part"
NODES = f"""(SELECT p_partkey AS id, ((p_partkey * 7919000) % 3600000000 - 1800000000) / 1e7 AS lon,
 ((p_partkey * 104729000) % 1800000000 - 900000000) / 1e7 AS lat, p_partkey % 5 <> 0 AS tagged,
 p_partkey % 7 AS changeset, p_partkey + {FIRST_SECOND} AS seconds,
 CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'user' || (p_partkey % 10) END AS "user",
 p_partkey % 4 AS uid, p_partkey % 9 AS version, p_partkey % 11 <> 0 AS visible,
 p_name, p_brand, p_type, p_size FROM part)"""
REFS = """(SELECT l_orderkey AS id, l_partkey AS ref, row_number() OVER (PARTITION BY l_orderkey
 ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS pos FROM lineitem)"""
LOCATED = f"""(SELECT r.id, r.ref, r.pos, n.lon, n.lat FROM {REFS} r
 LEFT JOIN (SELECT * FROM {NODES} WHERE id % 17 <> 0) n ON r.ref = n.id)"""
# references with a place that differs from the one before among those with a place
SHAPED = f"""(SELECT * FROM (SELECT *, lag(lon) OVER w AS lon0, lag(lat) OVER w AS lat0 FROM {LOCATED} WHERE lon IS NOT NULL
 WINDOW w AS (PARTITION BY id ORDER BY pos)) WHERE lon0 IS NULL OR lon0 <> lon OR lat0 <> lat)"""
FLAGS = f"""(SELECT o.o_orderkey AS id, coalesce(r.n, 0) AS refs, coalesce(p.n, 0) AS n_points,
 coalesce(r.n > 1 AND r.x0 IS NOT NULL AND r.x1 IS NOT NULL AND r.x0 = r.x1 AND r.y0 = r.y1, false) AS closed,
 o.o_orderkey % 6 <> 0 AS tagged
 FROM orders o
 LEFT JOIN (SELECT id, count(*) AS n, max(lon) FILTER (pos = 0) AS x0, max(lat) FILTER (pos = 0) AS y0,
  max(lon) FILTER (pos = last) AS x1, max(lat) FILTER (pos = last) AS y1
  FROM (SELECT *, max(pos) OVER (PARTITION BY id) AS last FROM {LOCATED}) GROUP BY id) r ON r.id = o.o_orderkey
 LEFT JOIN (SELECT id, count(*) AS n FROM {SHAPED} GROUP BY id) p ON p.id = o.o_orderkey)"""
BOXES = f"""(SELECT s_suppkey + {SUPPLIER_BASE} AS obj_id, s_suppkey % 4 <> 0 AS from_way, s_nationkey,
 ((s_suppkey * 37) % 340 - 170)::DOUBLE AS minx, ((s_suppkey * 53) % 160 - 80)::DOUBLE AS miny,
 ((s_suppkey * 37) % 340 - 170 + s_suppkey % 7 + 1)::DOUBLE AS maxx,
 ((s_suppkey * 53) % 160 - 80 + s_suppkey % 5 + 1)::DOUBLE AS maxy FROM supplier)"""
RELATIONS = f"""(SELECT c_custkey AS id, c_custkey % 3 AS kind, c_mktsegment, c_nationkey FROM customer)"""
MEMBERS = f"""(SELECT o_custkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos,
  'way' AS type, o_orderkey AS ref, CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_orderstatus END AS role FROM orders
 UNION ALL SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey), 'node', c_nationkey, 'label' FROM customer
 UNION ALL SELECT n_regionkey + {REGION_BASE}, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1,
  'relation', n_nationkey, '' FROM nation)"""


def corner(b: str = "") -> str:
    pts = (("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy"), ("minx", "miny"))
    return " || ',' || ".join(xy(b + x, b + y) for x, y in pts)


S_NODE, S_WAY, S_REL = "'osmnode:' || id", "'osmway:' || id", "'osmrel:' || id"
ORACLE_SQL: dict[str, str] = {}


def types(table: str, key: str, subject: str, kind: str) -> str:
    return f"SELECT {subject} AS s, {t(V.TYPE)} AS p, {t((V.OBJECT, kind))} AS o FROM (SELECT {key} AS id FROM {table})"


NODE_TYPES = types("part", "p_partkey", S_NODE, "node")
WAY_TYPES = types("orders", "o_orderkey", S_WAY, "way")
ORACLE_SQL["node_type_triples"] = NODE_TYPES
ORACLE_SQL["way_type_triples"] = WAY_TYPES
ORACLE_SQL["relation_type_triples"] = types("customer", "c_custkey", S_REL, "relation")


def meta(rows: str, s: str) -> str:
    m = lambda x: t((V.META, x))
    false = typed("'false'", "boolean")
    return union(
        f"SELECT {s} AS s, {m('changeset')} AS p, 'osmchangeset:' || changeset AS o FROM {rows} WHERE changeset <> 0",
        f"SELECT {s}, {m('timestamp')}, {typed(DAY.format(s='seconds'), 'dateTime')} FROM {rows}",
        f"""SELECT {s}, {m('user')}, {string('"user"')} FROM {rows} WHERE "user" <> ''""",
        f"SELECT {s}, {m('uid')}, {typed('uid', 'integer')} FROM {rows} WHERE uid <> 0",
        f"SELECT {s}, {m('version')}, {typed('version', 'integer')} FROM {rows}",
        f"SELECT {s}, {m('visible')}, {false} FROM {rows} WHERE NOT visible",
    )


NODE_META = meta(NODES, S_NODE)
ORACLE_SQL["node_meta_triples"] = NODE_META
EVENTS = """(SELECT event_id AS id, event_id % 3 AS changeset, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, event_type AS "user",
 user_id AS uid, 1 AS version, true AS visible FROM events)"""
ORACLE_SQL["event_meta_triples"] = meta(EVENTS, S_WAY)


def raw(rows: str, key: str, value: str, s: str = S_NODE) -> str:
    return f"SELECT {s} AS s, 'osmkey:' || {key} AS p, {string(value)} AS o FROM {rows}"


ORACLE_SQL["tag_literals_docs"] = raw("(SELECT doc_id AS id, coalesce(text, '') AS v FROM documents)", "'note'", "v")
_quoted = string("coalesce(text, '')", "'")
ORACLE_SQL["literals_single_quoted"] = f"SELECT conv_id, turn, {_quoted} AS literal FROM conversations"
ORACLE_SQL["lang_tags"] = """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '@' || lang || '-x9' WHEN doc_id % 3 = 1 THEN NULL
 ELSE '@' || lang END AS tag FROM documents"""
ORACLE_SQL["tag_key_sanitise"] = "SELECT p_partkey, replace(p_type, ' ', '_') || '_x_y' AS clean FROM part"
_class = "CASE p_partkey % 7 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 6 THEN 2 ELSE 1 END"
ORACLE_SQL["tag_key_class"] = f"""SELECT p_partkey, CAST({_class} AS BIGINT) AS class,
 CASE WHEN {_class} < 2 THEN {pn_local('k')} END AS local FROM (SELECT p_partkey, {KEY} AS k FROM part)"""
_odd = f"(SELECT p_partkey AS id, p_partkey, replace({KEY}, ' ', '_') AS k FROM part)"
_blank = "'_:tag_osmnode' || id || '_0'"
ORACLE_SQL["tag_odd_keys"] = union(
    f"""SELECT {S_NODE} AS s, 'osmkey:' || {pn_local('k')} AS p, '"v"' AS o FROM {_odd} WHERE {_class} < 2""",
    f"SELECT {S_NODE}, {t(V.TAG)}, {_blank} FROM {_odd} WHERE {_class} = 2",
    f"SELECT {_blank}, {t(V.KEY_OF_TAG)}, {string('k')} FROM {_odd} WHERE {_class} = 2",
    f"""SELECT {_blank}, {t(V.VALUE_OF_TAG)}, '"v"' FROM {_odd} WHERE {_class} = 2""",
)


def value_rows(which: str, more: str = "") -> str:
    return f"(SELECT p_partkey AS id, {INPUTS[which]} AS v{more} FROM part)"


_level = value_rows("level")
_spells = "regexp_full_match(v, '\\s*[+-]?[0-9]+\\s*')"
ORACLE_SQL["tag_admin_level"] = union(
    f"SELECT {S_NODE} AS s, 'osmkey:admin_level' AS p, {typed('CAST(CAST(trim(v) AS BIGINT) AS VARCHAR)', 'integer')} AS o FROM {_level} WHERE {_spells}",
    raw(f"{_level} WHERE NOT {_spells}", "'admin_level'", "v"),
)
_wd_key = ", CASE WHEN p_partkey % 2 = 0 THEN 'wikidata' ELSE 'brand:wikidata' END AS k"
_wd = value_rows("wikidata", _wd_key)
ORACLE_SQL["tag_wikidata"] = union(
    raw(_wd, "k", "v"),
    f"SELECT {S_NODE}, '{V.KEYLINK}:' || k, 'wd:' || regexp_replace(string_split(v, ';')[1], '[^Q0-9]', '', 'g') FROM {_wd}",
)
ORACLE_SQL["tag_skip_wiki_links"] = raw(value_rows("wikidata"), "'wikidata'", "v")
_wp = value_rows("wikipedia")
_entry = iri_ref("substr(v, instr(v, ':') + 1)", False)
ORACLE_SQL["tag_wikipedia"] = union(
    raw(_wp, "'wikipedia'", "v"),
    f"""SELECT {S_NODE}, '{V.KEYLINK}:wikipedia', CASE WHEN contains(v, ':')
 THEN '<https://' || string_split(v, ':')[1] || '.wikipedia.org/wiki/' || {_entry} || '>'
 ELSE '<https://www.wikipedia.org/wiki/' || {iri_ref('v', False)} || '>' END FROM {_wp}""",
)
_pieces = f"(SELECT id, unnest(string_split(v, ';')) AS v FROM {value_rows('split')})"
ORACLE_SQL["tag_semicolon_split"] = raw(_pieces, "'ref'", "v")

_parts = "regexp_extract(v, '^(-?)([0-9]+)(?:-([0-9]+))?(?:-([0-9]+))?$', {k})"
_dated = f"""(SELECT id, v, {_parts.format(k=1)} AS e, {_parts.format(k=2)} AS y, {_parts.format(k=3)} AS m, {_parts.format(k=4)} AS d
 FROM {value_rows('date')} WHERE regexp_full_match(v, '-?[0-9]+(-[0-9]+)?(-[0-9]+)?'))"""
_year = "e || substr(CASE WHEN length(ltrim(y, '0')) < 4 THEN lpad(ltrim(y, '0'), 4, '0') ELSE ltrim(y, '0') END, 1, 4)"
_mm, _dd = "lpad(CAST(CAST(m AS INT) AS VARCHAR), 2, '0')", "lpad(CAST(CAST(d AS INT) AS VARCHAR), 2, '0')"
_p_date = f"'{V.KEYLINK}:start_date'"
ORACLE_SQL["tag_dates"] = union(
    raw(value_rows("date"), "'start_date'", "v"),
    f"SELECT {S_NODE}, {_p_date}, {typed(_year, 'gYear')} FROM {_dated} WHERE m = ''",
    f"SELECT {S_NODE}, {_p_date}, {typed(f'{_year} || {lit("-")} || {_mm}', 'gYearMonth')} FROM {_dated} WHERE m <> '' AND d = '' AND TRY_CAST(m AS INT) BETWEEN 1 AND 12",
    f"SELECT {S_NODE}, {_p_date}, {typed(f'{_year} || {lit("-")} || {_mm} || {lit("-")} || {_dd}', 'date')} FROM {_dated} "
    "WHERE d <> '' AND TRY_CAST(m AS INT) BETWEEN 1 AND 12 AND TRY_CAST(d AS INT) BETWEEN 1 AND 31",
)
_n = "CASE WHEN id % 5 = 0 THEN 0 ELSE len(string_split(v, ';')) + 3 END"
ORACLE_SQL["facts_count"] = f"SELECT {S_NODE} AS s, {t(V.FACTS)} AS p, {typed(f'({_n})', 'integer')} AS o FROM {value_rows('split')}"
_url = "url || '?q=<a b>{|}\\^`\"'"
for _fmt, _q in (("nt", False), ("qlever", True)):
    ORACLE_SQL[f"iri_ref_{_fmt}"] = f"SELECT page_id, {iri_ref(f'({_url})', _q)} AS iri FROM pages"

# -- nodes --------------------------------------------------------------------

_geom = f"'{V.GEOM}:osmnode_' || id"
_point = typed(f"'POINT(' || {xy('lon', 'lat')} || ')'", "wktLiteral")
NODE_POINTS = union(
    f"SELECT {S_NODE} AS s, {t(V.HAS_GEOMETRY)} AS p, {_geom} AS o FROM {NODES}",
    f"SELECT {_geom}, {t(V.AS_WKT)}, {_point} FROM {NODES}",
)
ORACLE_SQL["node_points"] = NODE_POINTS
_centre = f"'{V.GEOM}:osm_node_centroid_' || id"
_alone = typed(f"'POLYGON((' || {xy('lon', 'lat')} || '))'", "wktLiteral")
_five = " || ',' || ".join([xy("lon", "lat")] * 5)
ORACLE_SQL["node_degenerate_shapes"] = union(
    NODE_POINTS,
    f"SELECT {S_NODE}, {t(V.HAS_CENTROID)}, {_centre} FROM {NODES}",
    f"SELECT {_centre}, {t(V.AS_WKT)}, {_point} FROM {NODES}",
    f"SELECT {S_NODE}, {t(V.OBB)}, {_alone} FROM {NODES}",
    f"SELECT {S_NODE}, {t(V.CONVEX_HULL)}, {_alone} FROM {NODES}",
    f"SELECT {S_NODE}, {t(V.ENVELOPE)}, {typed(f'{lit("POLYGON((")} || {_five} || {lit("))")}', 'wktLiteral')} FROM {NODES}",
)
_tagged = f"(SELECT * FROM {NODES} WHERE tagged)"
NODE_TAGS = union(
    *(raw(_tagged, lit(k), v) for k, v in (("name", "p_name"), ("brand", "p_brand"), ("type", "p_type"), ("size", "CAST(p_size AS VARCHAR)"))),
    f"SELECT {S_NODE}, {t(V.FACTS)}, {typed(lit('4'), 'integer')} FROM {_tagged}",
)
ORACLE_SQL["node_facts"] = union(NODE_TYPES, NODE_META, NODE_TAGS, NODE_POINTS)
ORACLE_SQL["untagged_filters"] = union(
    f"SELECT * FROM ({NODE_TYPES}) WHERE CAST(replace(s, 'osmnode:', '') AS BIGINT) % 5 <> 0",
    NODE_TAGS,
    f"SELECT * FROM ({NODE_POINTS}) WHERE CAST(regexp_extract(s, '[0-9]+$') AS BIGINT) % 5 <> 0",
)
ORACLE_SQL["tagged_node_prefix"] = f"""SELECT '<' || CASE WHEN tagged THEN {lit(V.PREFIXES['osmnode'])}
 ELSE 'http://example.org/untagged/' END || id || '>' AS s, {t(V.TYPE, 'nt')} AS p, {t((V.OBJECT, 'node'), 'nt')} AS o FROM {NODES}"""

# -- ways ---------------------------------------------------------------------

ORACLE_SQL["way_location_blocks"] = f"""SELECT o_orderkey AS id, count(ref) AS refs, count(lon) AS located,
 coalesce(string_agg(CAST(ref AS VARCHAR), ',' ORDER BY pos) FILTER (lon IS NOT NULL), '') AS ref_order,
 coalesce(sum(CAST(round(lon * 1e6) AS BIGINT)), 0)::BIGINT AS sum_x, count(*) FILTER (lon IS NOT NULL AND ref % 5 <> 0) AS tagged
 FROM orders LEFT JOIN {LOCATED} r ON r.id = o_orderkey GROUP BY o_orderkey"""
ORACLE_SQL["way_location_join"] = f"""SELECT o_orderkey AS id, count(ref) AS refs, count(lon) AS located
 FROM orders LEFT JOIN {LOCATED} ON id = o_orderkey GROUP BY o_orderkey"""
IS_AREA = "(refs >= 4 AND closed AND tagged)"
ORACLE_SQL["way_location_buckets"] = ORACLE_SQL["way_location_join"]
ORACLE_SQL["way_shape_flags"] = f"SELECT id, n_points, closed, {IS_AREA} AS is_area FROM {FLAGS}"
_way_node = "'_:way_' || id || '_' || pos"
WAY_MEMBERS = union(
    f"SELECT {S_WAY} AS s, {t(V.WAY_MEMBER)} AS p, {_way_node} AS o FROM {REFS}",
    f"SELECT {_way_node}, {t(V.WAY_MEMBER_ID)}, 'osmnode:' || ref FROM {REFS}",
    f"SELECT {_way_node}, {t(V.WAY_MEMBER_POS)}, {typed('pos', 'integer')} FROM {REFS}",
)
ORACLE_SQL["way_member_triples"] = WAY_MEMBERS


def haversine(x1: str, y1: str, x2: str, y2: str, radius: float, pi: str) -> str:
    half = lambda a, b: f"pow(sin(({b} - {a}) * {pi} / 180 / 2), 2)"
    return f"2 * {radius} * asin(sqrt(least(1.0, {half(y1, y2)} + {half(x1, x2)} * cos({y1} * {pi} / 180) * cos({y2} * {pi} / 180))))"


ORACLE_SQL["way_next_node"] = f"""SELECT id, pos, next, CAST(round({haversine('lon', 'lat', 'lon1', 'lat1', V.RADIUS_NEXT, str(V.PI_NEXT))}) AS BIGINT) AS metres
 FROM (SELECT id, pos, lon, lat, lead(ref) OVER w AS next, lead(lon) OVER w AS lon1, lead(lat) OVER w AS lat1 FROM {LOCATED}
 WINDOW w AS (PARTITION BY id ORDER BY pos)) WHERE lon IS NOT NULL AND lon1 IS NOT NULL"""
ORACLE_SQL["way_next_node_triples"] = f"""SELECT '_:way_' || id || '_' || pos AS s, {t(V.NEXT_NODE)} AS p, 'osmnode:' || next AS o
 FROM ({ORACLE_SQL['way_next_node']})"""
ORACLE_SQL["member_namespaces"] = f"""SELECT {_way_node} AS s, {t(V.WAY_MEMBER_ID)} AS p,
 CASE WHEN coalesce(n.tagged, false) THEN 'osmnode_tagged:' || ref ELSE 'osmnode_untagged:' || ref END AS o
 FROM (SELECT r.*, (SELECT bool_or(tagged) FROM {NODES} n WHERE n.id = r.ref AND n.id % 17 <> 0) AS tagged FROM {REFS} r) n"""
ORACLE_SQL["node_lines"] = f"SELECT s || ' ' || p || ' ' || o || ' .' AS line FROM ({ORACLE_SQL['node_facts']})"
ORACLE_SQL["way_length"] = f"""SELECT o_orderkey AS id, CAST(round(coalesce(metres, 0) / 10) AS BIGINT) AS decametres FROM orders LEFT JOIN (
 SELECT id, sum({haversine('lon0', 'lat0', 'lon', 'lat', V.RADIUS_LENGTH, 'pi()')}) AS metres FROM {SHAPED} WHERE lon0 IS NOT NULL GROUP BY id)
 ON id = o_orderkey"""
LINES = f"""(SELECT f.id, f.refs, f.n_points, f.closed, {IS_AREA} AS is_area, 'LINESTRING(' || coalesce(p.pts, '') || ')' AS wkt FROM {FLAGS} f
 LEFT JOIN (SELECT id, string_agg({xy('lon', 'lat')}, ',' ORDER BY pos) AS pts FROM {SHAPED} GROUP BY id) p ON p.id = f.id)"""
_way_geom = f"'{V.GEOM}:osmway_' || id"
ORACLE_SQL["way_linestring"] = union(
    f"SELECT {S_WAY} AS s, {t(V.HAS_GEOMETRY)} AS p, {_way_geom} AS o FROM {LINES} WHERE NOT is_area",
    f"SELECT {_way_geom}, {t(V.AS_WKT)}, {typed('wkt', 'wktLiteral')} FROM {LINES} WHERE NOT is_area",
)
ORACLE_SQL["way_envelope"] = f"""SELECT id, 'POLYGON((' || {corner()} || '))' AS envelope FROM (SELECT id, min(lon) AS minx, min(lat) AS miny,
 max(lon) AS maxx, max(lat) AS maxy FROM {SHAPED} GROUP BY id)"""
_bool = typed("CAST(closed AS VARCHAR)", "boolean")
ORACLE_SQL["way_metadata"] = union(
    f"SELECT {S_WAY} AS s, {t(V.IS_CLOSED)} AS p, {_bool} AS o FROM {FLAGS}",
    f"SELECT {S_WAY}, {t(V.NODE_COUNT)}, {typed('refs', 'integer')} FROM {FLAGS}",
    f"SELECT {S_WAY}, {t(V.UNIQUE_NODE_COUNT)}, {typed('n_points', 'integer')} FROM {FLAGS}",
)
_way_rows = """(SELECT o_orderkey AS id, o_orderkey AS changeset, CAST(epoch(o_orderdate) AS BIGINT) AS seconds,
 'cust' || o_custkey AS "user", o_custkey AS uid, 1 AS version, true AS visible, o_orderstatus, o_orderpriority FROM orders)"""
_way_tagged = f"(SELECT * FROM {_way_rows} WHERE id % 6 <> 0)"
_metres = f"""(SELECT o_orderkey AS id, coalesce(metres, 0) AS metres FROM orders LEFT JOIN (
 SELECT id, sum({haversine('lon0', 'lat0', 'lon', 'lat', V.RADIUS_LENGTH, 'pi()')}) AS metres FROM {SHAPED} WHERE lon0 IS NOT NULL GROUP BY id)
 ON id = o_orderkey)"""
ORACLE_SQL["way_facts"] = union(
    WAY_TYPES,
    meta(_way_rows, S_WAY),
    raw(_way_tagged, "'status'", "o_orderstatus", S_WAY),
    raw(_way_tagged, "'priority'", "o_orderpriority", S_WAY),
    f"SELECT {S_WAY}, {t(V.FACTS)}, {typed(lit('2'), 'integer')} FROM {_way_tagged}",
    WAY_MEMBERS,
    ORACLE_SQL["way_linestring"],
    f"SELECT {S_WAY}, {t(V.LENGTH)}, {typed(f'({trimmed("metres", V.LENGTH_DIGITS)})', 'double')} FROM {_metres}",
)
_vec = "(SELECT vec_id, k, embedding[2 * k + 1]::DOUBLE AS x, embedding[2 * k + 2]::DOUBLE AS y FROM embeddings, range(32) r(k))"
ORACLE_SQL["polyline_length"] = f"""SELECT vec_id, CAST(round(sum({haversine('x0', 'y0', 'x', 'y', V.RADIUS_LENGTH, 'pi()')})) AS BIGINT) AS metres
 FROM (SELECT *, lag(x) OVER w AS x0, lag(y) OVER w AS y0 FROM {_vec} WINDOW w AS (PARTITION BY vec_id ORDER BY k)) WHERE x0 IS NOT NULL GROUP BY vec_id"""

# -- relations ------------------------------------------------------------------

_rel_node = "'_:relation_' || id || '_' || pos"
_target = "CASE type WHEN 'node' THEN 'osmnode:' WHEN 'way' THEN 'osmway:' ELSE 'osmrel:' END || ref"
ORACLE_SQL["relation_member_triples"] = union(
    f"SELECT {S_REL} AS s, {t(V.REL_MEMBER)} AS p, {_rel_node} AS o FROM {MEMBERS}",
    f"SELECT {_rel_node}, {t(V.REL_MEMBER_ID)}, {_target} FROM {MEMBERS}",
    f"""SELECT {_rel_node}, {t(V.REL_MEMBER_ROLE)}, '"' || CASE WHEN role = '' THEN 'member' ELSE role END || '"' FROM {MEMBERS}""",
    f"SELECT {_rel_node}, {t(V.REL_MEMBER_POS)}, {typed('pos', 'integer')} FROM {MEMBERS}",
)
ORACLE_SQL["relation_way_semijoin"] = """SELECT o_orderkey AS id, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS refs
 FROM orders WHERE o_custkey % 3 <> 0"""
_open = f"(id % 3 <> 0 OR id >= {REGION_BASE})"
_way_parts = f"""SELECT m.id, m.pos, count(l.lon) AS points, count(l.ref) > 0 AND count(l.lon) = count(l.ref) AS whole
 FROM {MEMBERS} m LEFT JOIN {LOCATED} l ON l.id = m.ref WHERE m.type = 'way' GROUP BY m.id, m.pos"""
_node_parts = f"""SELECT m.id, m.pos, count(n.id) AS points, count(n.id) > 0 AS whole FROM {MEMBERS} m
 LEFT JOIN (SELECT * FROM {NODES} WHERE id % 17 <> 0) n ON n.id = m.ref WHERE m.type = 'node' GROUP BY m.id, m.pos"""
ORACLE_SQL["relation_geometry"] = f"""SELECT id, count(*) FILTER (points > 0) AS parts, CAST(sum(points) AS BIGINT) AS points, bool_and(whole) AS complete
 FROM ({_way_parts} UNION ALL {_node_parts} UNION ALL SELECT id, pos, 0, false FROM {MEMBERS} WHERE type = 'relation') WHERE {_open} GROUP BY id"""
_texts = f"""SELECT m.id, m.pos, 'LINESTRING(' || string_agg({xy('l.lon', 'l.lat')}, ',' ORDER BY l.pos) || ')' AS part
 FROM {MEMBERS} m JOIN {LOCATED} l ON l.id = m.ref WHERE m.type = 'way' AND l.lon IS NOT NULL GROUP BY m.id, m.pos
 UNION ALL SELECT m.id, m.pos, 'POINT(' || {xy('n.lon', 'n.lat')} || ')' FROM {MEMBERS} m JOIN {NODES} n ON n.id = m.ref
 WHERE m.type = 'node' AND n.id % 17 <> 0"""
ORACLE_SQL["relation_collections"] = f"""SELECT id, 'GEOMETRYCOLLECTION(' || string_agg(part, ',' ORDER BY pos) || ')' AS wkt
 FROM ({_texts}) WHERE {_open} GROUP BY id"""

_rel_rows = f"""(SELECT c_custkey AS id, c_mktsegment AS v1, 'segment' AS k1,
 CASE c_custkey % 3 WHEN 0 THEN 'multipolygon' WHEN 1 THEN 'route' ELSE 'site' END AS kind FROM customer
 UNION ALL SELECT r_regionkey + {REGION_BASE}, r_name, 'name', 'collection' FROM region)"""
_rel_geom = f"'{V.GEOM}:osmrel_' || id"
ORACLE_SQL["relation_facts"] = union(
    f"SELECT {S_REL} AS s, {t(V.TYPE)} AS p, {t((V.OBJECT, 'relation'))} AS o FROM {_rel_rows}",
    f"SELECT {S_REL}, {t((V.META, 'timestamp'))}, {typed(lit('1970-01-01T00:00:00'), 'dateTime')} FROM {_rel_rows}",
    f"SELECT {S_REL}, {t((V.META, 'version'))}, {typed(lit('1'), 'integer')} FROM {_rel_rows}",
    raw(_rel_rows, "k1", "v1", S_REL),
    raw(_rel_rows, "'type'", "kind", S_REL),
    f"SELECT {S_REL}, {t(V.FACTS)}, {typed(lit('2'), 'integer')} FROM {_rel_rows}",
    ORACLE_SQL["relation_member_triples"],
    f"SELECT {S_REL}, {t(V.HAS_GEOMETRY)}, {_rel_geom} FROM ({ORACLE_SQL['relation_collections']})",
    f"SELECT {_rel_geom}, {t(V.AS_WKT)}, {typed('wkt', 'wktLiteral')} FROM ({ORACLE_SQL['relation_collections']})",
    f"SELECT {S_REL}, {t(V.COMPLETE)}, {typed('CAST(complete AS VARCHAR)', 'boolean')} FROM ({ORACLE_SQL['relation_geometry']}) WHERE parts > 0",
)

# -- areas ----------------------------------------------------------------------

ORACLE_SQL["area_polygon"] = f"""SELECT CASE WHEN from_way THEN obj_id * 2 ELSE obj_id * 2 + 1 END AS area_id,
 'POLYGON((' || {corner()} || '))' AS wkt FROM {BOXES}"""
_r = V.RADIUS_AREA
ORACLE_SQL["area_measure"] = f"""SELECT obj_id, CAST(round({_r}::DOUBLE * {_r} * (maxx - minx) * pi() / 180 * (sin(maxy * pi() / 180) - sin(miny * pi() / 180)) / 1000) AS BIGINT)
 AS area_1000m2 FROM {BOXES}"""
_hull = " || ',' || ".join(xy(x, y) for x, y in (("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy"), ("minx", "miny"), ("maxx", "miny")))
_s_box, _c_box = "'osmway:' || obj_id", f"'{V.GEOM}:osmway_centroid_' || obj_id"
_mid = typed(f"'POINT(' || {xy('(minx + maxx) / 2', '(miny + maxy) / 2')} || ')'", "wktLiteral")


def _polygon(points: str) -> str:
    return typed(f"'POLYGON((' || {points} || '))'", "wktLiteral")


ORACLE_SQL["area_shapes"] = union(
    f"SELECT {_s_box} AS s, {t(V.HAS_CENTROID)} AS p, {_c_box} AS o FROM {BOXES}",
    f"SELECT {_c_box}, {t(V.AS_WKT)}, {_mid} FROM {BOXES}",
    f"SELECT {_s_box}, {t(V.CONVEX_HULL)}, {_polygon(_hull)} FROM {BOXES}",
    f"SELECT {_s_box}, {t(V.ENVELOPE)}, {_polygon(corner())} FROM {BOXES}",
)
ORACLE_SQL["area_oriented_boxes"] = f"""SELECT obj_id, 5::BIGINT AS corners, 'POLYGON((' || {corner()} || '))' AS extent FROM {BOXES}"""
ORACLE_SQL["area_completeness"] = f"SELECT 'osmrel:' || obj_id AS s, {t(V.COMPLETE)} AS p, {typed(lit('true'), 'boolean')} AS o FROM {BOXES} WHERE NOT from_way"

_wide = "({c} + {c} % 3 * 4294967296 + 7)"
_wide_way, _wide_rel = f"'osmway:' || {_wide.format(c='o_orderkey')} % 4294967296", f"'osmrel:' || {_wide.format(c='c_custkey')} % 4294967296"
_wide_node = f"'_:relation_' || {_wide.format(c='c_custkey')} % 4294967296 || '_0'"
ORACLE_SQL["wide_ids"] = union(
    f"SELECT {_wide_way} AS s, {t(V.TYPE)} AS p, {t((V.OBJECT, 'way'))} AS o FROM orders",
    f"SELECT {_wide_rel}, {t(V.TYPE)}, {t((V.OBJECT, 'relation'))} FROM customer",
    f"SELECT {_wide_rel}, {t(V.REL_MEMBER)}, {_wide_node} FROM customer",
    f"SELECT {_wide_node}, {t(V.REL_MEMBER_ID)}, 'osmway:' || {_wide.format(c='c_custkey')} FROM customer",
    f"SELECT {_wide_node}, {t(V.REL_MEMBER_ROLE)}, '\"x\"' FROM customer",
    f"SELECT {_wide_node}, {t(V.REL_MEMBER_POS)}, {typed('0', 'integer')} FROM customer",
)

# -- spatial relations -------------------------------------------------------------

ORACLE_SQL["spatial_point_in_area"] = f"""SELECT b.obj_id AS box, n.id AS point, lon > minx AND lon < maxx AND lat > miny AND lat < maxy AS inside
 FROM {BOXES} b JOIN {NODES} n ON lon BETWEEN minx AND maxx AND lat BETWEEN miny AND maxy"""
_meet = "a.minx <= b.maxx AND b.minx <= a.maxx AND a.miny <= b.maxy AND b.miny <= a.maxy"
_deep = "a.minx < b.maxx AND b.minx < a.maxx AND a.miny < b.maxy AND b.miny < a.maxy"
_holds = "a.minx <= b.minx AND a.maxx >= b.maxx AND a.miny <= b.miny AND a.maxy >= b.maxy"
_held = "b.minx <= a.minx AND b.maxx >= a.maxx AND b.miny <= a.miny AND b.maxy >= a.maxy"
BOX_PAIRS = union(
    *(
        f"SELECT a.obj_id AS a, '{n}' AS predicate, b.obj_id AS b FROM {BOXES} a JOIN {BOXES} b ON a.obj_id <> b.obj_id AND {c}"
        for n, c in (
            ("Intersects", _meet),
            ("Contains", _holds),
            ("Covers", _holds),
            ("Touches", f"{_meet} AND NOT ({_deep})"),
            ("Equals", f"{_holds} AND {_held}"),
            ("Overlaps", f"{_deep} AND NOT ({_holds}) AND NOT ({_held})"),
        )
    )
)
ORACLE_SQL["spatial_area_relations"] = BOX_PAIRS
_in = "lon > minx AND lon < maxx AND lat > miny AND lat < maxy"
_at = "lon BETWEEN minx AND maxx AND lat BETWEEN miny AND maxy"
_joined = f"FROM {BOXES} b JOIN {NODES} n ON {_at} AND tagged"
_b, _p = "'osmway:' || obj_id", "'osmnode:' || id"
ORACLE_SQL["spatial_triples"] = union(
    f"SELECT 'osmway:' || a AS s, 'ogc:sf' || predicate AS p, 'osmway:' || b AS o FROM ({BOX_PAIRS})",
    f"SELECT {_b}, 'ogc:sfIntersects', {_p} {_joined}",
    f"SELECT {_p}, 'ogc:sfIntersects', {_b} {_joined}",
    f"SELECT {_b}, 'ogc:sfCovers', {_p} {_joined}",
    f"SELECT {_b}, 'ogc:sfContains', {_p} {_joined} AND {_in}",
    f"SELECT {_b}, 'ogc:sfTouches', {_p} {_joined} AND NOT ({_in})",
    f"SELECT {_p}, 'ogc:sfTouches', {_b} {_joined} AND NOT ({_in})",
)


def lifted(base: str, members: str, once: bool = False) -> str:
    """Relations (a, predicate, b) of collections from those of their members."""
    any_of = lambda n: f"bool_or(coalesce(forth = '{n}', false))"
    to = {
        "Intersects": any_of("Intersects"), "Contains": any_of("Contains"), "Covers": any_of("Covers"),
        "Touches": "meet > 0 AND touch = meet", "Equals": f"{any_of('Equals')} AND covered = size",
        "Overlaps": f"{any_of('Overlaps')} AND NOT {any_of('Covers')} AND covered < size", "Crosses": any_of("Crosses"),
    }
    of = {**to, "Contains": "covered = size AND bool_or(coalesce(back = 'Contains', false))", "Covers": "covered = size"}
    both = f"""(SELECT m.c, r.b AS other, r.predicate AS forth, NULL AS back FROM ({base}) r JOIN {members} m ON r.a = m.m
     UNION ALL SELECT m.c, r.a, NULL, r.predicate FROM ({base}) r JOIN {members} m ON r.b = m.m)"""
    told = f"""(SELECT j.*, count(*) FILTER (forth = 'Intersects') OVER w AS meet, count(*) FILTER (forth = 'Touches') OVER w AS touch,
     count(*) FILTER (back = 'Covers') OVER w AS covered, n.size FROM {both} j JOIN (SELECT c, count(*) AS size FROM {members} GROUP BY c) n USING (c)
     {'WHERE j.c < j.other' if once else ''} WINDOW w AS (PARTITION BY j.c, j.other))"""
    grouped = "GROUP BY c, other, meet, touch, covered, size"
    rows = [f"SELECT c AS a, '{n}' AS predicate, other AS b FROM {told} {grouped} HAVING {x}" for n, x in to.items()]
    rows += [f"SELECT other, '{n}', c FROM {told} {grouped} HAVING {x}" for n, x in of.items()]
    return union(*rows)


_nation_members = f"(SELECT DISTINCT s_nationkey::BIGINT AS c, s_suppkey + {SUPPLIER_BASE} AS m FROM supplier)"
_itself = " UNION ALL ".join(f"SELECT m, '{n}', m FROM {_nation_members}" for n in ("Intersects", "Contains", "Covers", "Equals"))
ORACLE_SQL["spatial_relation_members"] = f"""WITH base AS MATERIALIZED (SELECT a, predicate, b FROM ({BOX_PAIRS}) UNION ALL {_itself}),
 single AS MATERIALIZED ({lifted('SELECT * FROM base', _nation_members)})
 SELECT * FROM single UNION ALL ({lifted('SELECT * FROM single', _nation_members, once=True)})"""
ORACLE_SQL["spatial_slanted_relations"] = lattice.RELATIONS_SQL
ORACLE_SQL["spatial_collection_relations"] = lattice.COLLECTIONS_SQL
_lines = f"""(SELECT obj_id + {LINE_BASE} AS id, CASE WHEN obj_id % 3 = 0 THEN maxy ELSE (miny + maxy) / 2 END AS y,
 minx - CASE WHEN obj_id % 2 = 0 THEN 0.5 ELSE -0.25 END AS x0, maxx + CASE WHEN obj_id % 2 = 0 THEN 0.5 ELSE -0.25 END AS x1 FROM {BOXES})"""
_line_meets = "y BETWEEN miny AND maxy AND x0 <= maxx AND x1 >= minx"
_line_deep = "y > miny AND y < maxy AND x0 < maxx AND x1 > minx"
_line_held = "y BETWEEN miny AND maxy AND x0 >= minx AND x1 <= maxx"
_line_out = "(x0 < minx OR x1 > maxx)"
ORACLE_SQL["spatial_line_relations"] = union(
    *(
        f"SELECT {a} AS a, '{n}' AS predicate, {b} AS b FROM {_lines} l JOIN {BOXES} b ON {c}"
        for n, ways, c in (
            ("Intersects", 2, _line_meets),
            ("Contains", 1, f"{_line_held} AND {_line_deep}"),
            ("Covers", 1, _line_held),
            ("Touches", 2, f"{_line_meets} AND NOT ({_line_deep})"),
            ("Crosses", 2, f"{_line_deep} AND {_line_out}"),
        )
        for a, b in (("obj_id", "id"), ("id", "obj_id"))[:ways]
    )
)
_whole = "obj_id % 5 <> 0"
ORACLE_SQL["relation_areas"] = f"""SELECT obj_id * 2 + 1 AS area_id, obj_id, false AS from_way, 2::BIGINT AS rings,
 round((maxx - minx) * (maxy - miny), 6) AS outer_square, round((maxx - minx) * (maxy - miny) / 4, 6) AS hole_square,
 'POLYGON((' || {corner()} || '))' AS extent FROM {BOXES} WHERE {_whole}"""
ORACLE_SQL["relation_touching_areas"] = lattice.AREAS_SQL
_rim = f"(SELECT obj_id, obj_id * 10 + 1 + {LINE_BASE} AS rim, obj_id * 10 + 2 + {LINE_BASE} AS edge FROM {BOXES} WHERE {_whole})"
ORACLE_SQL["area_relation_relations"] = union(
    f"SELECT obj_id AS a, 'Intersects' AS predicate, rim AS b FROM {_rim}",
    f"SELECT rim, 'Intersects', obj_id FROM {_rim}",
    f"SELECT obj_id, 'Contains', rim FROM {_rim}",
    f"SELECT obj_id, 'Covers', rim FROM {_rim}",
    f"SELECT obj_id, 'Intersects', edge FROM {_rim}",
    f"SELECT edge, 'Intersects', obj_id FROM {_rim}",
    f"SELECT obj_id, 'Covers', edge FROM {_rim}",
    f"SELECT obj_id, 'Touches', edge FROM {_rim}",
    f"SELECT edge, 'Touches', obj_id FROM {_rim}",
)

# -- statistics, header, graph -------------------------------------------------------

ORACLE_SQL["kind_switches"] = """SELECT 'node' AS kind, count(*) AS seen, count(*) FILTER (p_partkey % 5 <> 0) AS dumped FROM part
 UNION ALL SELECT 'way', count(*), count(*) FILTER (o_orderkey % 6 <> 0) FROM orders
 UNION ALL SELECT 'relation', n, n FROM (SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM region) AS n)"""
ORACLE_SQL["stats_counts"] = """SELECT (SELECT count(*) FROM part) AS nodes, (SELECT min(p_partkey) FROM part) AS min_node,
 (SELECT max(p_partkey) FROM part) AS max_node, (SELECT count(*) FROM orders) AS ways,
 (SELECT count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)) AS way_weight,
 (SELECT count(*) FROM customer) + (SELECT count(*) FROM region) AS relations,
 2 * ((SELECT count(*) FROM orders) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM nation)) AS relation_weight"""
_width = "CASE WHEN m < 256 THEN 'uint8' WHEN m < 65536 THEN 'uint16' WHEN m < 4294967296 THEN 'uint32' ELSE 'uint64' END"
ORACLE_SQL["stats_max_id"] = f"""SELECT kind, n AS count, m AS max_id, {_width} AS width FROM (
 SELECT 'node' AS kind, count(*) AS n, max(p_partkey) AS m FROM part UNION ALL SELECT 'way', count(*), max(o_orderkey) FROM orders
 UNION ALL SELECT 'relation', (SELECT count(*) FROM customer) + count(*), max(r_regionkey) + {REGION_BASE} FROM region)"""
ORACLE_SQL["stats_required_ids"] = """SELECT 'node' AS kind, count(*) AS required FROM (SELECT l_partkey FROM lineitem UNION SELECT c_nationkey FROM customer)
 UNION ALL SELECT 'way', count(DISTINCT o_orderkey) FROM orders UNION ALL SELECT 'relation', count(DISTINCT n_nationkey) FROM nation"""
_placed_nodes = f"(SELECT * FROM ({ORACLE_SQL['node_facts']}) WHERE NOT (regexp_matches(s, '^(osmnode:|{V.GEOM}:osmnode_)') AND CAST(regexp_extract(s, '[0-9]+$') AS BIGINT) % 17 = 0))"
ORACLE_SQL["facts_without_ways"] = union(f"SELECT s, p, o FROM {_placed_nodes}", f"SELECT s, p, o FROM ({ORACLE_SQL['relation_facts']})")
ORACLE_SQL["dump_counters"] = f"""SELECT 'node' AS kind, count(*) AS seen, count(*) AS dumped, count(*) AS geometries FROM part WHERE p_partkey % 17 <> 0
 UNION ALL SELECT 'way', count(*), count(*) FILTER (tagged), count(*) FILTER (n_points > 0) FROM {FLAGS}
 UNION ALL SELECT 'relation', (SELECT count(*) FROM customer) + (SELECT count(*) FROM region),
  (SELECT count(*) FROM customer) + (SELECT count(*) FROM region), count(*) FILTER (parts > 0) FROM ({ORACLE_SQL['relation_geometry']})"""
ORACLE_SQL["run_counters"] = ORACLE_SQL["dump_counters"]
# an edge of the hull has all other points to its left, or on it
_cloud = f"(SELECT id, CAST(floor(lon * 1e4) AS BIGINT) AS x, CAST(floor(lat * 1e4) AS BIGINT) AS y, p_size AS size FROM {NODES})"
_turn = "(x1 - x0) * (o.y - y0) - (y1 - y0) * (o.x - x0)"
ORACLE_SQL["node_cloud_hulls"] = f"""WITH c AS MATERIALIZED (SELECT DISTINCT size, x, y FROM {_cloud}),
 pairs AS (SELECT a.size, a.x AS x0, a.y AS y0, b.x AS x1, b.y AS y1 FROM c a JOIN c b ON a.size = b.size AND (a.x <> b.x OR a.y <> b.y)),
 edges AS (SELECT * FROM pairs p WHERE NOT EXISTS (SELECT 1 FROM c o WHERE o.size = p.size
  AND ({_turn} < 0 OR ({_turn} = 0 AND (o.x - x0) * (o.x - x1) + (o.y - y0) * (o.y - y1) > 0)))),
 boxes AS (SELECT size, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy FROM c GROUP BY size)
 SELECT size::BIGINT AS size, count(*) AS corners, CAST(sum(x0 * y1 - x1 * y0) AS BIGINT) AS twice_area, minx, miny, maxx, maxy
 FROM edges JOIN boxes USING (size) GROUP BY size, minx, miny, maxx, maxy"""
_east = "20037508.34 / 180"
ORACLE_SQL["mercator_points"] = f"""SELECT id, CAST(round(trunc(lon * {_east} * 10) / 100) AS BIGINT) AS x,
 CAST(round(trunc(ln(tan((least({MERCATOR_EDGE}, greatest(-{MERCATOR_EDGE}, lat)) + 90) * pi() / 360)) / (pi() / 180) * {_east} * 10) / 100) AS BIGINT) AS y FROM {NODES}"""
ORACLE_SQL["projected_area_relations"] = BOX_PAIRS
ORACLE_SQL["utf8_lengths"] = """SELECT doc_id, length(text) AS n, CASE WHEN length(text) > 0 THEN unicode(text) END AS first FROM documents"""
ORACLE_SQL["stats_with_areas"] = f"""SELECT kind, n AS count, m AS max_id, {_width} AS width, g AS geometries FROM (
 SELECT 'node' AS kind, count(*) AS n, max(p_partkey) AS m, (SELECT count(*) FROM {NODES}) AS g FROM part
 UNION ALL SELECT 'area', count(*), max(CASE WHEN from_way THEN obj_id * 2 ELSE obj_id * 2 + 1 END), count(*) FROM {BOXES})"""
ORACLE_SQL["stats_required_by_areas"] = f"""SELECT 'node' AS kind, count(*) AS required FROM (SELECT l_partkey FROM lineitem UNION SELECT c_nationkey FROM customer
 UNION SELECT s_suppkey + {SUPPLIER_BASE} FROM supplier UNION SELECT 0)
 UNION ALL SELECT 'way', count(DISTINCT o_orderkey) FROM orders UNION ALL SELECT 'relation', count(DISTINCT n_nationkey) FROM nation"""
ORACLE_SQL["dump_information"] = f"""SELECT {t((V.INFO, 'info'))} AS s, '{V.INFO}:version' AS p, '"{VERSION}"' AS o
 UNION ALL SELECT {t((V.INFO, 'info'))}, '{V.INFO}:dateDumped', {typed(lit('2020-02-29T12:34:56'), 'dateTime')}"""
_own = dict(V.PREFIXES)
ORACLE_SQL["prefix_header"] = "SELECT * FROM (VALUES " + ", ".join(f"('@prefix', '{p}:', '<{i}>')" for p, i in _own.items()) + ") v(s, p, o)"
_value = lambda text, kind: lit('"' + text + '"' + (f"^^{name(('xsd', kind), FMT)}" if kind else ""))
ORACLE_SQL["config_metadata"] = (
    "SELECT * FROM (VALUES "
    + ", ".join(f"({t((V.INFO, 'option'))}, {lit(f'{V.INFO}:{n}')}, {_value(text, kind)})" for n, text, kind in OPTIONS)
    + ") v(s, p, o)"
)
ORACLE_SQL["triple_statistics"] = f"""SELECT 0::BIGINT AS "blankNodes", 25::BIGINT AS header, count(*) + 25 AS lines, count(*) AS triples
 FROM ({ORACLE_SQL['node_facts']})"""
ORACLE_SQL["blank_node_statistics"] = f"""SELECT count(DISTINCT s) FILTER (s LIKE '\\_:%' ESCAPE '\\') AS "blankNodes", 0::BIGINT AS header,
 count(*) AS lines, count(*) AS triples FROM ({ORACLE_SQL['relation_member_triples']})"""
EDGES = """(SELECT n_regionkey + 1 AS src, n_nationkey + 100 AS dst FROM nation
 UNION ALL SELECT c_nationkey + 100, c_custkey + 1000000 FROM customer UNION ALL SELECT s_nationkey + 100, s_suppkey + 2000000 FROM supplier
 UNION ALL SELECT n_regionkey + 1, s_suppkey + 2000000 FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
CLOSURE = f"""WITH RECURSIVE e AS (SELECT DISTINCT src::BIGINT AS src, dst::BIGINT AS dst FROM {EDGES}),
 c AS (SELECT src, dst FROM e UNION SELECT c.src, e.dst FROM c JOIN e ON c.dst = e.src)"""
ORACLE_SQL["graph_successors"] = f"{CLOSURE} SELECT src, dst FROM c WHERE src <> dst"
ORACLE_SQL["graph_reach"] = f"SELECT * FROM ({ORACLE_SQL['graph_successors']}) WHERE src BETWEEN 1 AND 5 OR src BETWEEN 100 AND 114"
ORACLE_SQL["graph_edge_counts"] = f"""SELECT count(*) AS num_edges, (SELECT count(*) FROM (SELECT src FROM {EDGES} UNION SELECT dst FROM {EDGES})) AS num_vertices
 FROM {EDGES}"""
_reduced = f"{CLOSURE} SELECT src, dst FROM c EXCEPT SELECT a.src, b.dst FROM c a JOIN c b ON a.dst = b.src"
ORACLE_SQL["graph_reduce"] = _reduced
ORACLE_SQL["graph_reduce_maximal"] = _reduced
ORACLE_SQL["graph_dot"] = f"""SELECT 0 AS at, 'digraph G {{' AS line UNION ALL SELECT 3, '}}'
 UNION ALL SELECT 1, '  ' || v || ' [label="' || (v // 2) || '", shape=' || CASE WHEN v % 2 = 1 THEN 'ellipse' ELSE 'box' END || '];'
 FROM (SELECT src AS v FROM {EDGES} UNION SELECT dst FROM {EDGES})
 UNION ALL SELECT 2, '  ' || src || ' -> ' || dst || ';' FROM {EDGES}"""
_meta = 'changeset, seconds, "user", uid, version, visible'
_placed = "CAST(round(lon * 1e7) AS BIGINT) AS lon7, CAST(round(lat * 1e7) AS BIGINT) AS lat7"
ORACLE_SQL["opl_nodes"] = ORACLE_SQL["xml_nodes"] = f"""SELECT id, {_placed}, CASE WHEN tagged THEN 4 ELSE 0 END::BIGINT AS n_tags,
 CASE WHEN tagged THEN 'name' END AS k, CASE WHEN tagged THEN p_name END AS v, {_meta} FROM {NODES}"""
ORACLE_SQL["opl_ways"] = f"""SELECT w.id, coalesce(nds, '') AS nds, CASE WHEN w.id % 6 <> 0 THEN 2 ELSE 0 END::BIGINT AS n_tags,
 CASE WHEN w.id % 6 <> 0 THEN 'status' END AS k, CASE WHEN w.id % 6 <> 0 THEN o_orderstatus END AS v, changeset, seconds, "user", uid, version::BIGINT AS version, visible
 FROM {_way_rows} w LEFT JOIN (SELECT id, string_agg(ref, ',' ORDER BY pos) AS nds FROM {REFS} GROUP BY id) r ON r.id = w.id"""
_e7 = lambda c, n: f"CAST(round({c} * 1e7) AS BIGINT) AS {n}"
ORACLE_SQL["wkt_geometries"] = f"""SELECT 'a' || obj_id AS id, 2::BIGINT AS dimension, {', '.join(_e7(c, c) for c in ('minx', 'miny', 'maxx', 'maxy'))} FROM {BOXES}
 UNION ALL SELECT 'n' || id, 0, {_e7('lon', 'a')}, {_e7('lat', 'b')}, {_e7('lon', 'c')}, {_e7('lat', 'd')} FROM {NODES}"""
ORACLE_SQL["written_lines"] = ORACLE_SQL["node_lines"]
ORACLE_SQL["merged_lines"] = f"SELECT s || ' ' || p || ' ' || o || ' .' AS line FROM ({ORACLE_SQL['node_type_triples']})"
ORACLE_SQL["event_windows"] = """SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS start, event_type, count(*) AS n FROM events GROUP BY ALL"""

assert CONFIG.output_format == FMT
