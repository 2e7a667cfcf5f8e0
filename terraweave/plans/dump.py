"""A whole run: entities to triples and spatial relations, as one logical plan."""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import Config, parse
from ..functions import geometry as G
from ..functions import text as T
from ..operators import areas, joins, spatial, stats
from ..operators.facts import Facts, all_of
from ..sinks import triples as sink
from ..sources import formats
from ..sources.stored import remove_stored, stored
from ..timing import Timings

#: Of the command line's runs in this process.
TIMINGS = Timings()


@dataclass
class Entities:
    """The three kinds, in the entity schema, and auxiliary geometries."""

    nodes: DataFrame
    ways: DataFrame
    relations: DataFrame
    auxiliary: DataFrame | None = None

    @property
    def locations(self) -> DataFrame:
        return formats.locations(self.nodes)


class Dump:
    """Plans of one run. Branches that are switched off are never built."""

    def __init__(self, entities: Entities, config: Config, dumped: datetime | None = None):
        self.e = entities
        self.dumped = dumped
        self.c = config.normalised()
        self.facts = Facts(self.c)
        self._observed: dict[tuple[str, str], Observation] = {}

    @cached_property
    def shaped(self) -> DataFrame:
        """Located ways, made once for ways, areas and the spatial join."""
        located = joins.locate_ways(self.e.ways, self.e.locations, self.c.store_locations, self.c.wkt_precision)
        return stored(joins.shape_ways(located).drop("raw"), "located-ways")

    def relation_shapes(self, *, texts: bool = True) -> DataFrame:
        """Geometries of relations, from the ways that are located anyway where facts of ways are wanted;
        without `texts` only which members have one."""
        shaped = None if self.c.no_way_facts and texts else self.shaped
        return joins.relation_geometries(
            self.e.relations, self.e.ways, self.e.locations, shaped,
            digits=self.c.wkt_precision if texts else None, lines=texts and self.facts.needs_lines,
        )

    def counters(self) -> DataFrame:
        """(kind, seen, dumped, geometries) of the four kinds."""
        own = {"node": self.e.nodes, "way": self.e.ways, "relation": self.e.relations}
        drop = {"node": self.c.no_untagged_nodes, "way": self.c.no_untagged_ways, "relation": self.c.no_untagged_relations}
        found = self.areas()
        # untagged areas are out of areas() already
        rows = stats.kind_counts({**{k: (df, drop[k]) for k, df in own.items()}, "area": (found.withColumn("tags", F.array()), False)})
        shapes = self.relation_shapes(texts=False)
        shaped = {
            "node": self.e.nodes.filter(G.valid(F.col("lon"), F.col("lat"))),
            "way": self.shaped.filter(F.size("points") > 0),
            "relation": shapes.filter(F.size("parts") > 0),
            "area": found,
        }
        return rows.join(stats.geometry_counts(shaped), "kind")

    @cached_property
    def built_areas(self) -> DataFrame:
        """Areas of ways and relations, made once for facts, counters and the spatial join."""
        return stored(self._areas(), "areas")

    def areas(self) -> DataFrame:
        return self.built_areas

    def _areas(self) -> DataFrame:
        found = areas.of_ways(self.shaped).unionByName(areas.of_relations(self.e.relations, self.shaped))
        if not self.c.no_untagged_areas:
            return found
        tagged = self.e.ways.select("id", F.lit(True).alias("from_way"), "tags").unionByName(
            self.e.relations.select("id", F.lit(False).alias("from_way"), "tags")
        ).filter(F.size("tags") > 0)
        return found.join(tagged.select(F.col("id").alias("obj_id"), "from_way"), ["obj_id", "from_way"], "left_semi")

    def fact_triples(self) -> DataFrame | None:
        parts = []
        if not self.c.no_node_facts:
            parts.append(self.facts.nodes(self.e.nodes))
        if not self.c.no_way_facts:
            parts.append(self.facts.ways(self.shaped))
        if not self.c.no_relation_facts:
            parts.append(self.facts.relations(self.e.relations, self.relation_shapes(), self.e.locations))
        if not self.c.no_area_facts:
            parts.append(self.facts.areas(self.areas()))
        return all_of(parts) if parts else None

    def _watched(self, df: DataFrame, kind: str, what: str, *counters: Column) -> DataFrame:
        """`df`, counted as it passes."""
        self._observed[kind, what] = Observation(f"{kind} {what}")
        return df.observe(self._observed[kind, what], *counters)

    def observed_facts(self) -> DataFrame | None:
        """As fact_triples, of entities that are counted on their way; once it is written, `told`
        has the counts."""
        count = lambda c: F.count_if(c).alias("n")
        every = F.lit(True)
        seen = lambda drop: [F.count("*").alias("seen"), F.count_if(F.size("tags") > 0 if drop else every).alias("dumped")]
        parts, c = [], self.c
        if not c.no_node_facts:
            valid = F.count_if(G.valid(F.col("lon"), F.col("lat"))).alias("geometries")
            parts.append(self.facts.nodes(self._watched(self.e.nodes, "node", "seen", *seen(c.no_untagged_nodes), valid)))
        if not c.no_way_facts:
            shaped = F.count_if(F.size("points") > 0).alias("geometries")
            parts.append(self.facts.ways(self._watched(self.shaped, "way", "seen", *seen(c.no_untagged_ways), shaped)))
        if not c.no_relation_facts:
            shapes = self._watched(self.relation_shapes(), "relation", "geometries", count(F.size("parts") > 0))
            rows = self._watched(self.e.relations, "relation", "seen", *seen(c.no_untagged_relations))
            parts.append(self.facts.relations(rows, shapes, self.e.locations))
        if not c.no_area_facts:
            parts.append(self.facts.areas(self._watched(self.areas(), "area", "geometries", count(every))))
        return all_of(parts) if parts else None

    def told(self) -> list[tuple[str, int, int, int]]:
        """(kind, seen, dumped, geometries) of the run that wrote observed_facts."""
        out = []
        for kind in ("node", "way", "relation", "area"):
            own: dict[str, int] = {}
            for (k, what), seen in self._observed.items():
                if k == kind:
                    own |= seen.get if what == "seen" else {"geometries": seen.get["n"]}
            if own:
                made = own["geometries"]
                out.append((kind, own.get("seen", made), own.get("dumped", made), made))
        return out

    def geometries(self) -> DataFrame | None:
        """(id, shape) of what takes part in the spatial join; ids are IRIs."""
        c, f = self.c, self.facts
        parts = []
        if not c.no_node_geometric_relations:
            nodes = self.e.nodes.filter(G.valid(F.col("lon"), F.col("lat")))
            if not c.add_untagged_nodes_geometric_relations:
                nodes = nodes.filter(F.size("tags") > 0)
            point = F.array(G.point("lon", "lat"))
            parts.append(nodes.select(f.subject("node").alias("id"), spatial.shape(points=point).alias("shape")))
        if not c.no_way_geometric_relations:
            lines = self.shaped.filter(~F.col("is_area") & (F.size("points") > 0))
            parts.append(lines.select(f.subject("way").alias("id"), spatial.shape(lines=F.array("points")).alias("shape")))
        if not c.no_area_geometric_relations:
            subject = F.when(F.col("from_way"), f.subject("way", "obj_id")).otherwise(f.subject("relation", "obj_id"))
            parts.append(self.areas().select(subject.alias("id"), spatial.shape(polygons=F.col("polygons")).alias("shape")))
        if self.e.auxiliary is not None and parts:
            parts.append(self.e.auxiliary)
        return all_of(parts) if parts else None

    def members(self) -> DataFrame:
        """(collection, member) IRIs of relations that are no areas."""
        own = self.e.relations.filter(~joins.is_area_relation()).select("id", F.explode("members").alias("m"))
        own = own.select("id", "m.type", F.abs("m.ref").alias("ref"))
        # members are met by the names that their shapes have
        node = T.id_iri(self.facts.names["node"], "ref", self.c.output_format)
        target = F.when(F.col("type") == "node", node).when(F.col("type") == "way", self.facts.subject("way", "ref"))
        return own.select(self.facts.subject("relation").alias("collection"), target.alias("member")).dropna()

    def spatial_triples(self) -> DataFrame | None:
        shapes = self.geometries()
        if shapes is None:
            return None
        if self.c.no_relation_geometric_relations:
            found = spatial.relations(shapes)
        else:
            found = spatial.with_collections(shapes, self.members())
        return spatial.triples(found, self.c.output_format)

    def triples(self) -> DataFrame:
        """Options, facts and spatial relations; without the header."""
        spark: SparkSession = self.e.nodes.sparkSession
        parts = [sink.metadata(spark, self.c, dumped=self.dumped), self.observed_facts(), self.spatial_triples()]
        return all_of([p for p in parts if p is not None])


def main(argv: list[str], spark: SparkSession | None = None) -> int:
    """The command line: read, plan, write; returns the exit code."""
    c = parse(argv)
    spark = spark or SparkSession.builder.appName("terraweave").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        return _run(spark, c)
    finally:
        remove_stored(spark)


def _run(spark: SparkSession, c: Config) -> int:
    # the dump is parsed once, into tables that all branches read
    with TIMINGS.of("read"):
        kinds = formats.to_bronze(spark, c.input).values()
    auxiliary = formats.read_wkt(spark, *c.aux_geo_files) if c.aux_geo_files else None
    dump = Dump(Entities(*kinds, auxiliary), c, datetime.now(timezone.utc)).triples()
    top = sink.header(spark, c.output_format, c)
    if not c.output:
        for row in (*sink.to_stdout(top), *sink.to_stdout(dump)):
            print(row)
        return 0
    target = sink.with_ending(c.output, c.output_compression)
    sink.write(top.coalesce(1), f"{target}.header", compression=c.output_compression)
    # lines are counted as they are written
    counted = Observation("output")
    with TIMINGS.of("write"):
        sink.write(dump.observe(counted, *stats.output_counters()), f"{target}.parts", compression=c.output_compression)
    if c.write_rdf_statistics:
        sink.write_statistics(spark, counted.get, c.output, 0 if c.output_format == "nt" else top.count())
    if c.output_merge == "none":
        sink.name_parts(spark, f"{target}.parts", os.path.basename(target), first=f"{target}.header")
    else:
        sink.merge(spark, f"{target}.parts", target, keep=c.output_keep_files, first=f"{target}.header")
    return 0
