"""Counts over entities and over the output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import registry

#: Unsigned widths an id may need, by the largest id.
WIDTHS = (("uint8", 2**8), ("uint16", 2**16), ("uint32", 2**32))


def id_width(largest: Column) -> Column:
    """The smallest unsigned type that holds an id; the largest of all otherwise."""
    out = F.lit("uint64")
    for name, limit in reversed(WIDTHS):
        out = F.when(largest < limit, name).otherwise(out)
    return out


def kind_counts(kinds: dict[str, tuple[DataFrame, bool]]) -> DataFrame:
    """(kind, seen, dumped) per kind: (table with tags, whether untagged ones are dropped)."""
    parts = [
        df.agg(
            F.count("*").alias("seen"),
            F.count_if((F.size("tags") > 0) if drop else F.lit(True)).alias("dumped"),
        ).select(F.lit(kind).alias("kind"), "seen", "dumped")
        for kind, (df, drop) in kinds.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def first_pass(nodes: DataFrame, ways: DataFrame, relations: DataFrame, *, tagged_only: bool = False) -> DataFrame:
    """One row: counts, least and largest node id, and weights of ways and relations.

    The ids count all nodes, tagged or not.
    """
    keep = ((F.size("tags") > 0) if tagged_only else F.lit(True)).alias("keep")
    every = (
        nodes.select(F.lit("node").alias("kind"), "id", F.lit(0).alias("weight"), keep)
        .unionByName(ways.select(F.lit("way").alias("kind"), "id", F.size("nds").alias("weight"), keep))
        .unionByName(relations.select(F.lit("relation").alias("kind"), "id", (F.size("members") * 2).alias("weight"), keep))
    )
    of = lambda kind: F.col("kind") == kind
    weight = lambda kind: F.coalesce(F.sum(F.when(of(kind) & F.col("keep"), F.col("weight"))), F.lit(0))
    return every.agg(
        F.count_if(of("node") & F.col("keep")).alias("nodes"),
        F.min(F.when(of("node"), F.col("id"))).alias("min_node"),
        F.max(F.when(of("node"), F.col("id"))).alias("max_node"),
        F.count_if(of("way") & F.col("keep")).alias("ways"),
        weight("way").alias("way_weight"),
        F.count_if(of("relation") & F.col("keep")).alias("relations"),
        weight("relation").alias("relation_weight"),
    )


def count_and_max(kinds: dict[str, DataFrame]) -> DataFrame:
    """(kind, count, max_id, width) per kind."""
    out = None
    for kind, df in kinds.items():
        row = df.agg(F.count("*").alias("count"), F.max("id").alias("max_id")).select(
            F.lit(kind).alias("kind"), "count", "max_id", id_width(F.col("max_id")).alias("width")
        )
        out = row if out is None else out.unionByName(row)
    return out


def geometry_counts(kinds: dict[str, DataFrame]) -> DataFrame:
    """(kind, geometries) per kind: tables of what has a geometry."""
    out = None
    for kind, df in kinds.items():
        row = df.agg(F.count("*").alias("geometries")).select(F.lit(kind).alias("kind"), "geometries")
        out = row if out is None else out.unionByName(row)
    return out


def required_ids(
    ways: DataFrame, relations: DataFrame, *, areas: DataFrame | None = None, exact: bool = True
) -> DataFrame:
    """(kind, required): distinct objects that others refer to.

    `areas` (nds) are references of rings: nodes that areas need beside the ways'.
    """
    members = relations.select(F.explode("members").alias("m")).select(F.col("m.type").alias("kind"), F.abs("m.ref").alias("ref"))
    refs = ways.select(F.lit("node").alias("kind"), F.explode("nds").alias("ref")).unionByName(members)
    if areas is not None:
        refs = refs.unionByName(areas.select(F.lit("node").alias("kind"), F.explode("nds").alias("ref")))
    if not exact:
        return refs.groupBy("kind").agg(F.approx_count_distinct("ref").alias("required"))
    # bitmaps are shuffled, not references
    return registry.counted(registry.registered(refs, "ref", "kind"), "kind").withColumnRenamed("n", "required")


def output_counters() -> list[Column]:
    """Counters of lines as they are written: blankNodes, triples. Every blank node is the object
    of one line, which makes it."""
    return [F.count_if(F.startswith("o", F.lit("_:"))).alias("blankNodes"), F.count("*").alias("triples")]


def output_statistics(lines: DataFrame, header: int = 0) -> DataFrame:
    """One row of the written (s, p, o): blankNodes, header, lines, triples."""
    told = lines.agg(*output_counters())
    return told.select("blankNodes", F.lit(header).cast("long").alias("header"), (F.col("triples") + header).alias("lines"), "triples")
