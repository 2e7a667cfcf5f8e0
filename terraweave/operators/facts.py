"""Objects to triples: one function per family, each a projection of its entity.

A family is a DataFrame (s, p, o) of strings. Families of one entity that come from
one row are built as an array and exploded once, so a table is read once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..config import Config
from ..functions import geometry as G
from ..functions import kernels, tags
from ..functions import text as T
from . import joins

TRIPLES = "array<struct<s: string, p: string, o: string>>"
#: A way's located reference and, if it is wanted, the next one.
WAY_ITEM = f"struct<p: {joins.PLACED}, q: {joins.PLACED}>"
#: A relation's member with its place.
RELATION_ITEM = "struct<at: int, type: string, ref: bigint, role: string, tagged: boolean>"


def triple(s: Column, p: Column, o: Column) -> Column:
    return F.struct(s.alias("s"), p.alias("p"), o.alias("o"))


def when_true(condition: Column, *rows: Column) -> Column:
    """The rows where the condition holds, else none."""
    return F.when(F.coalesce(condition, F.lit(False)), F.array(*rows)).otherwise(F.array().cast(TRIPLES))


def exploded(df: DataFrame, *parts: Column) -> DataFrame:
    """All triples of each row."""
    if not parts:
        return df.sparkSession.createDataFrame([], "s string, p string, o string")
    # made in a projection, whose code is compiled; a generator that holds a lambda is interpreted as a whole
    return _rows_of(df.select(_joined(parts).alias("rows")), F.col("rows"))


def _rows_of(df: DataFrame, triples: Column) -> DataFrame:
    """A row of each triple. An inner explode would have all triples made twice, as Spark filters
    by the arrays' sizes before it."""
    return df.select(F.explode_outer(triples).alias("t")).filter(F.col("t").isNotNull()).select("t.*")


def _joined(parts) -> Column:
    return F.concat(*(F.coalesce(p, F.array().cast(TRIPLES)) for p in parts))


def exploded_items(df: DataFrame, own: list[Column], items: Column, kind: str, s: Column, number: Column, one) -> DataFrame:
    """All triples of each row's `own` and, by one(s, number, item), of its items (structs of type `kind`).

    Items become rows before their triples are made, so the texts are made by compiled code; a
    row of an item carries the subject and nothing else of its entity. `own` and the rows are made
    in a projection, as in `exploded`.
    """
    row = f"array<struct<own: {TRIPLES}, item: {kind}>>"
    first = F.array(F.struct(_joined(own).alias("own"), F.lit(None).cast(kind).alias("item")))
    rest = F.arrays_zip(F.array().cast(f"array<{TRIPLES}>"), items)
    rows = df.select(s.alias("s"), number.alias("number"), F.concat(first.cast(row), rest.cast(row)).alias("rows"))
    # there is one row at least
    rows = rows.select("s", "number", F.explode_outer("rows").alias("row")).select("s", "number", "row.own", "row.item")
    return _rows_of(rows, F.coalesce("own", one(F.col("s"), F.col("number"), F.col("item"))))


class Facts:
    """The triple families under one configuration."""

    def __init__(self, config: Config, *, wrap_ids: bool = True):
        """With `wrap_ids` own ids of ways, relations and areas are 32 bits wide, as the output's
        readers expect; references to them stay as wide as they are."""
        self.wrap_ids = wrap_ids
        self.c = config.normalised()
        self.fmt = self.c.output_format
        self.names = V.DATASETS[self.c.dataset]
        self.digits = self.c.wkt_precision

    # -- names ----------------------------------------------------------------

    def _node_prefix(self, local: str) -> str:
        return f"{self.names['node']}{local}"

    def node_iri(self, number: Column, is_tagged: Column) -> Column:
        """A node's IRI; untagged nodes may have a namespace of their own."""
        if not self.c.separate_untagged:
            return T.id_iri(self.names["node"], number, self.fmt)
        return F.when(is_tagged, T.id_iri(self._node_prefix("_tagged"), number, self.fmt)).otherwise(
            self._untagged(number)
        )

    def _untagged(self, number: Column) -> Column:
        if self.fmt == "nt":
            return F.concat(F.lit(f"<{self.c.iri_prefix_for_untagged_nodes}"), number.cast("string"), F.lit(">"))
        return T.id_iri(self._node_prefix("_untagged"), number, self.fmt)

    def number(self, kind: str, column: str = "id") -> Column:
        """An entity's own number; of relations without a sign, of ways and relations of 32 bits."""
        number = F.abs(column) if kind == "relation" else F.col(column)
        return F.pmod(number, F.lit(1 << 32)) if self.wrap_ids and kind != "node" else number

    def subject(self, kind: str, column: str = "id") -> Column:
        """The subject of an entity row of this kind."""
        if kind == "node":
            return self.node_iri(F.col(column), F.size("tags") > 0)
        return T.id_iri(self.names[kind], self.number(kind, column), self.fmt)

    def named(self, df: DataFrame, kind: str) -> tuple[DataFrame, Column]:
        """`df` with its subjects in a column, as lambdas would make them anew each time, and that column."""
        return df.withColumn("_subject", self.subject(kind)), F.col("_subject")

    def geometry_iri(self, label: Column | str, number: Column) -> Column:
        local = F.concat(F.lit(self.names["id"]), F.lit(label) if isinstance(label, str) else label, number.cast("string"))
        if self.fmt == "nt":
            return F.concat(F.lit(f"<{V.PREFIXES[V.GEOM]}"), local, F.lit(">"))
        return F.concat(F.lit(f"{V.GEOM}:"), local)

    def term(self, value: tuple[str, str]) -> Column:
        return T.term(value, self.fmt)

    def wkt(self, text: Column) -> Column:
        return T.typed(text, "wktLiteral", self.fmt)

    # -- families of one row, as arrays ------------------------------------------

    def type_of(self, s: Column, kind: str) -> Column:
        return F.array(triple(s, self.term(V.TYPE), self.term((V.OBJECT, kind))))

    def meta(self, s: Column) -> Column:
        """Change set, time, user, uid, version and visibility, where they say something."""
        if self.c.no_osm_metadata:
            return F.array().cast(TRIPLES)
        m = lambda x: self.term((V.META, x))
        return F.concat(
            when_true(F.col("changeset") != 0, triple(s, m("changeset"), T.id_iri(self.names["changeset"], "changeset", self.fmt))),
            F.array(triple(s, m("timestamp"), T.date_time(F.coalesce("seconds", F.lit(0)), self.fmt))),
            when_true(F.col("user") != "", triple(s, m("user"), T.string_literal("user"))),
            when_true(F.col("uid") != 0, triple(s, m("uid"), T.integer("uid", self.fmt))),
            F.array(triple(s, m("version"), T.integer(F.coalesce("version", F.lit(0)), self.fmt))),
            when_true(~F.col("visible"), triple(s, m("visible"), T.boolean(F.lit(False), self.fmt))),
        )

    def tag_facts(self, s: Column) -> Column:
        """All triples of the column `tags`, without the count."""
        # keys are cleaned and classified once each
        clean = F.transform("tags", lambda t: F.struct(tags.clean_key(t["k"]).alias("k"), t["v"].alias("v")))
        told = F.transform(clean, lambda t: F.struct(t["k"].alias("k"), t["v"].alias("v"), T.key_class(t["k"]).alias("kind")))
        return F.flatten(F.transform(told, lambda t, i: self._tag(s, t["k"], t["v"], t["kind"], i)))

    def _tag(self, s: Column, key: Column, value: Column, kind: Column, at: Column) -> Column:
        fmt = self.fmt
        raw = F.transform(
            tags.pieces(key, value, list(self.c.split_tag_key_by_semicolon)),
            lambda v: triple(s, T.iri(V.KEY, key, fmt), T.string_literal(v)),
        )
        node = T.blank(F.lit("tag"), F.regexp_replace(s, r"[^A-Za-z0-9]+", ""), at)
        unnamed = F.array(
            triple(s, self.term(V.TAG), node),
            triple(node, self.term(V.KEY_OF_TAG), T.string_literal(key)),
            triple(node, self.term(V.VALUE_OF_TAG), T.string_literal(value)),
        )
        level = tags.admin_level(value)
        number = F.array(triple(s, T.iri(V.KEY, F.lit(tags.ADMIN_LEVEL), fmt), T.integer(level, fmt)))
        dates = tags.typed_date(value, fmt)
        date = triple(s, T.iri(V.KEYLINK, key, fmt), dates)
        out = [
            F.when((key == tags.ADMIN_LEVEL) & level.isNotNull(), number).when(kind == 2, unnamed).otherwise(raw)
        ]
        if not self.c.skip_wiki_links:
            link = T.iri(V.KEYLINK, key, fmt)
            data = triple(s, link, T.iri("wd", tags.wikidata_id(value), fmt))
            page = triple(s, link, tags.wikipedia_iri(value, fmt))
            out.append(when_true(tags.is_link_key(key, tags.WIKIDATA), data))
            out.append(when_true(tags.is_link_key(key, tags.WIKIPEDIA), page))
        out.append(when_true(key.isin(*tags.DATE_KEYS) & dates.isNotNull(), date))
        return F.concat(*out)

    def fact_count(self) -> Column:
        """Tag triples that count: pieces and links; dates do not, unnamed tags once."""

        def one(t: Column) -> Column:
            key, value, split = tags.clean_key(t["k"]), t["v"], list(self.c.split_tag_key_by_semicolon)
            n = F.lit(1)
            if split:
                whole = (T.key_class(key) == 2) | ((key == tags.ADMIN_LEVEL) & tags.admin_level(value).isNotNull())
                n = F.when(whole, 1).otherwise(F.size(tags.pieces(key, value, split)))
            if self.c.skip_wiki_links:
                return n
            linked = lambda kind: tags.is_link_key(key, kind).cast("int")
            return n + linked(tags.WIKIDATA) + linked(tags.WIKIPEDIA)

        return F.aggregate("tags", F.lit(0), lambda acc, t: acc + one(t))

    def facts(self, s: Column) -> Column:
        n = self.fact_count()
        rows = triple(s, self.term(V.FACTS), T.integer(n, self.fmt))
        return F.array(rows) if self.c.add_zero_fact_number else when_true(n > 0, rows)

    def object_facts(self, s: Column, kind: str) -> list[Column]:
        return [self.type_of(s, kind), self.meta(s), self.tag_facts(s), self.facts(s)]

    # -- nodes --------------------------------------------------------------------

    def node_geometry(self, s: Column) -> Column:
        """Geometry, centroid and the shapes that a point has, of located nodes."""
        p = F.struct(F.col("lon").alias("x"), F.col("lat").alias("y"))
        label = "node_"
        if self.c.separate_untagged:
            label = F.when(F.size("tags") > 0, "node_tagged_").otherwise("node_untagged_")
        shape = self.geometry_iri(label, F.col("id"))
        rows = [
            triple(s, self.term(V.HAS_GEOMETRY), shape),
            triple(shape, self.term(V.AS_WKT), self.wkt(G.point_wkt(p, self.digits))),
        ]
        if self.c.add_hascentroid:
            centre = self.geometry_iri("_node_centroid_", F.col("id"))
            rows += [
                triple(s, self.term(V.HAS_CENTROID), centre),
                triple(centre, self.term(V.AS_WKT), self.wkt(G.point_wkt(p, self.digits))),
            ]
        alone = self.wkt(G.polygon_wkt(F.array(F.array(p)), self.digits))
        if self.c.add_hasobb:
            rows.append(triple(s, self.term(V.OBB), alone))
        if self.c.add_hasconvexhull:
            rows.append(triple(s, self.term(V.CONVEX_HULL), alone))
        if self.c.add_hasenvelope:
            rows.append(triple(s, self.term(V.ENVELOPE), self.wkt(G.box_wkt(G.box(F.array(p)), self.digits))))
        return when_true(G.valid(F.col("lon"), F.col("lat")), *rows)

    def nodes(self, nodes: DataFrame) -> DataFrame:
        """All facts of nodes (id, lon, lat, tags, meta)."""
        kept = nodes.filter(F.size("tags") > 0) if self.c.no_untagged_nodes else nodes
        kept, s = self.named(kept, "node")
        return exploded(kept, *self.object_facts(s, "node"), self.node_geometry(s))

    # -- ways ---------------------------------------------------------------------

    def way_members(self, s: Column) -> Column:
        """Member nodes in order, with the next node and its distance if wanted."""
        if self.c.no_member_triples:
            return F.array().cast(TRIPLES)
        return F.flatten(F.transform(self._way_items(), lambda m: self._way_member(s, self.number("way"), m)))

    def _way_items(self) -> Column:
        """Located references, each beside the next one if that is wanted."""
        n = F.size("located") if self.c.add_way_node_spatial_metadata else F.lit(0)
        return F.arrays_zip(F.col("located"), F.slice("located", F.lit(2), n)).cast(f"array<{WAY_ITEM}>")

    def _way_member(self, s: Column, number: Column, m: Column) -> Column:
        p, q = m["p"], m["q"]
        node = T.blank(F.lit("way"), number, p["pos"])
        rows = [
            triple(s, self.term(V.WAY_MEMBER), node),
            triple(node, self.term(V.WAY_MEMBER_ID), self.node_iri(F.abs(p["ref"]), p["is_tagged"])),
            triple(node, self.term(V.WAY_MEMBER_POS), T.integer(p["pos"], self.fmt)),
        ]
        if not self.c.add_way_node_spatial_metadata:
            return F.array(*rows)
        far = G.next_distance(p, q)
        both = G.valid(p["x"], p["y"]) & G.valid(q["x"], q["y"])
        return F.concat(
            F.array(*rows),
            when_true(
                both,
                triple(node, self.term(V.NEXT_NODE), self.node_iri(F.abs(q["ref"]), q["is_tagged"])),
                triple(
                    node,
                    self.term(V.NEXT_NODE_DISTANCE),
                    T.typed(F.format_string("%.6f", far), "decimal", self.fmt),
                ),
            ),
        )

    def way_metadata(self, s: Column) -> Column:
        if not self.c.add_way_metadata:
            return F.array().cast(TRIPLES)
        return F.array(
            triple(s, self.term(V.IS_CLOSED), T.boolean(F.col("closed"), self.fmt)),
            triple(s, self.term(V.NODE_COUNT), T.integer(F.size("nds"), self.fmt)),
            triple(s, self.term(V.UNIQUE_NODE_COUNT), T.integer(F.size("points"), self.fmt)),
        )

    def way_length(self, s: Column) -> Column:
        metres = T.trimmed(G.length(F.col("points")), V.LENGTH_DIGITS)
        return F.array(triple(s, self.term(V.LENGTH), T.typed(metres, "double", self.fmt)))

    def way_geometry(self, s: Column, shown: str = "points", path: str | None = None) -> Column:
        """The line, unless the way is an area whose lines are not wanted; `path` holds its text
        where the line has no repeats."""
        shape = self.geometry_iri("way_", self.number("way"))
        text = G.line_wkt(F.col(shown), self.digits)
        if path:
            text = F.when(~F.col("repeats"), F.col(path)).otherwise(text)
        rows = (
            triple(s, self.term(V.HAS_GEOMETRY), shape),
            triple(shape, self.term(V.AS_WKT), self.wkt(text)),
        )
        return F.array(*rows) if self.c.add_area_way_linestrings else when_true(~F.col("is_area"), *rows)

    def shapes(self, s: Column, number: Column, kind: str) -> list[Column]:
        """Centroid, hull, envelope and oriented box from the columns made by with_shapes."""
        out = []
        if self.c.add_hascentroid:
            centre = self.geometry_iri(f"{V.GEOMETRY_KINDS[kind]}_centroid_", number)
            out.append(
                when_true(
                    F.size("centroid") > 0,
                    triple(s, self.term(V.HAS_CENTROID), centre),
                    triple(centre, self.term(V.AS_WKT), self.wkt(G.point_wkt(F.get("centroid", F.lit(0)), self.digits))),
                )
            )
        if self.c.add_hasconvexhull:
            out.append(F.array(triple(s, self.term(V.CONVEX_HULL), self.wkt(G.polygon_wkt(F.array("hull"), self.digits)))))
        if self.c.add_hasenvelope:
            out.append(
                when_true(F.size("outline") > 0, triple(s, self.term(V.ENVELOPE), self.wkt(G.box_wkt(G.box(F.col("outline")), self.digits))))
            )
        if self.c.add_hasobb:
            out.append(F.array(triple(s, self.term(V.OBB), self.wkt(G.polygon_wkt(F.array("obb"), self.digits)))))
        return out

    def with_shapes(self, df: DataFrame, polygons: bool = False) -> DataFrame:
        """`df` (outline, and polygons for areas) with the shapes that are switched on."""
        makers = []
        if self.c.add_hascentroid:
            makers.append(kernels.area_centroid_maker() if polygons else kernels.line_centroid_maker("outline"))
        if self.c.add_hasconvexhull:
            makers.append(kernels.hull_maker("outline", "hull", self.c.simplify_wkt, self.c.simplify_wkt_deviation))
        if self.c.add_hasobb:
            makers.append(kernels.oriented_box_maker("outline"))
        return kernels.with_lines(df, makers)

    def ways(self, shaped: DataFrame) -> DataFrame:
        """All facts of shaped ways (see joins.shape_ways)."""
        kept = shaped.filter(F.size("tags") > 0) if self.c.no_untagged_ways else shaped
        shown = "points"
        if self.c.simplify_wkt > 0:
            kept = kernels.with_simplified(kept, self.c.simplify_wkt, self.c.simplify_wkt_deviation)
            shown = "shown"
        kept = self.with_shapes(kept.withColumn("outline", F.col("points")))
        kept, s = self.named(kept, "way")
        # an area's shapes come from the area
        shapes = [F.when(~F.col("is_area"), x) for x in self.shapes(s, self.number("way"), "way")]
        path = "path" if shown == "points" and "path" in kept.columns else None
        own = [*self.object_facts(s, "way"), self.way_geometry(s, shown, path), *shapes, self.way_metadata(s), self.way_length(s)]
        if self.c.no_member_triples:
            return exploded(kept, *own)
        return exploded_items(kept, own, self._way_items(), WAY_ITEM, s, self.number("way"), self._way_member)

    # -- relations ------------------------------------------------------------------

    def relation_members(self, s: Column) -> Column:
        """Members in order; those of no known type take no position."""
        if self.c.no_member_triples:
            return F.array().cast(TRIPLES)
        return F.flatten(F.transform(self._relation_items(), lambda m: self._relation_member(s, self.number("relation"), m)))

    def _relation_items(self) -> Column:
        known = F.filter("members", lambda m: m["type"].isin("node", "way", "relation"))
        tagged = lambda n: F.coalesce(F.array_contains(F.col("tagged_members"), n), F.lit(False)) if self.c.separate_untagged else F.lit(True)
        return F.transform(
            known,
            lambda m, at: F.struct(at.alias("at"), m["type"].alias("type"), F.abs(m["ref"]).alias("ref"), m["role"].alias("role"), tagged(F.abs(m["ref"])).alias("tagged")),
        )

    def _relation_member(self, s: Column, number: Column, m: Column) -> Column:
        node = T.blank(F.lit("relation"), number, m["at"])
        target = (
            F.when(m["type"] == "node", self.node_iri(m["ref"], m["tagged"]))
            .when(m["type"] == "way", T.id_iri(self.names["way"], m["ref"], self.fmt))
            .otherwise(T.id_iri(self.names["relation"], m["ref"], self.fmt))
        )
        role = F.when(F.coalesce(m["role"], F.lit("")) == "", "member").otherwise(m["role"])
        return F.array(
            triple(s, self.term(V.REL_MEMBER), node),
            triple(node, self.term(V.REL_MEMBER_ID), target),
            triple(node, self.term(V.REL_MEMBER_ROLE), T.string_literal(role)),
            triple(node, self.term(V.REL_MEMBER_POS), T.integer(m["at"], self.fmt)),
        )

    @property
    def needs_lines(self) -> bool:
        """Whether facts of relations need the points of members, not only their texts."""
        c = self.c
        return bool(c.add_hascentroid or c.add_hasconvexhull or c.add_hasenvelope or c.add_hasobb or c.simplify_wkt > 0)

    def relation_geometry(self, s: Column, texts: bool = False) -> list[Column]:
        """The collection of member geometries, of their texts where they have them, and whether it is whole."""
        shape = self.geometry_iri("rel_", self.number("relation"))
        text = G.collection_wkt(F.col("parts.text")) if texts else joins.collection_wkt(self.digits)
        rows = when_true(
            F.size("parts") > 0,
            triple(s, self.term(V.HAS_GEOMETRY), shape),
            triple(shape, self.term(V.AS_WKT), self.wkt(text)),
            triple(s, self.term(V.COMPLETE), T.boolean(F.col("complete"), self.fmt)),
        )
        return [rows, *(F.when(F.size("parts") > 0, x) for x in self.shapes(s, self.number("relation"), "relation"))]

    def relations(self, relations: DataFrame, geometries: DataFrame, locations: DataFrame | None = None) -> DataFrame:
        """All facts of relations; geometries as of joins.relation_geometries, with points if they are needed."""
        kept = relations.filter(F.size("tags") > 0) if self.c.no_untagged_relations else relations
        if self.c.separate_untagged:
            if locations is None:
                raise ValueError("node namespaces need the node locations")
            refs = kept.select("id", F.explode("members").alias("m")).filter("m.type = 'node'").select("id", F.abs("m.ref").alias("ref"))
            tagged = refs.join(locations.filter("is_tagged").select("ref"), "ref").groupBy("id").agg(F.collect_set("ref").alias("tagged_members"))
            kept = kept.join(tagged, "id", "left")
        kept, s = self.named(kept, "relation")
        own = self.object_facts(s, "relation")
        if self.c.no_member_triples:
            plain = exploded(kept, *own)
        else:
            plain = exploded_items(kept, own, self._relation_items(), RELATION_ITEM, s, self.number("relation"), self._relation_member)
        shown = geometries.join(kept.select("id"), "id", "left_semi")
        texts = self.c.simplify_wkt == 0 and "text" in shown.schema["parts"].dataType.elementType.names
        if self.needs_lines:
            shown = self.with_shapes(shown.withColumn("outline", F.flatten(F.transform("parts", lambda p: p["points"]))))
        if self.c.simplify_wkt > 0:
            lines = shown.withColumn("lines", F.transform("parts", lambda p: p["points"]))
            lines = kernels.with_simplified_geometry(
                lines, self.c.simplify_wkt, self.c.simplify_wkt_deviation, "lines", "shown", closed=False
            )
            shown = lines.withColumn("parts", F.transform("parts", lambda p, k: p.withField("points", F.get("shown", k))))
        shown, s = self.named(shown, "relation")
        return plain.unionByName(exploded(shown, *self.relation_geometry(s, texts)))

    # -- areas ------------------------------------------------------------------------

    def areas(self, areas: DataFrame) -> DataFrame:
        """All facts of areas (area_id, obj_id, from_way, polygons)."""
        s = F.when(F.col("from_way"), self.subject("way", "obj_id")).otherwise(self.subject("relation", "obj_id"))
        number = self.number("way", "obj_id")
        shape = F.when(F.col("from_way"), self.geometry_iri("way_", number)).otherwise(self.geometry_iri("rel_", number))
        shown = self.with_shapes(areas.withColumn("outline", G.outer_points(F.col("polygons"))), polygons=True)
        polygons = "polygons"
        if self.c.simplify_wkt > 0:
            polygons = "shown"
            shown = kernels.with_simplified_geometry(
                shown, self.c.simplify_wkt, self.c.simplify_wkt_deviation, "polygons", polygons, closed=True
            )
        size = T.trimmed(G.multipolygon_area(F.col("polygons")), V.AREA_DIGITS)
        own = [
            F.array(
                triple(s, self.term(V.HAS_GEOMETRY), shape),
                triple(shape, self.term(V.AS_WKT), self.wkt(G.area_wkt(F.col(polygons), self.digits))),
                triple(s, self.term(V.AREA), T.typed(size, "double", self.fmt)),
            ),
            when_true(~F.col("from_way"), triple(s, self.term(V.COMPLETE), T.boolean(F.lit(True), self.fmt))),
        ]
        of_way = [F.when(F.col("from_way"), x) for x in self.shapes(s, number, "way")]
        of_relation = [F.when(~F.col("from_way"), x) for x in self.shapes(s, number, "relation")]
        return exploded(shown, *own, *of_way, *of_relation)


def all_of(parts: list[DataFrame]) -> DataFrame:
    """All families, as they are: nothing is compared or sorted."""
    return reduce(DataFrame.unionByName, parts)
