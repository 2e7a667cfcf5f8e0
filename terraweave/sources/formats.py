"""Entity tables from files: XML and line-based dumps, WKT lists, and their bronze form.

Compressed files (.bz2, .gz) are read by the codecs of Hadoop. The schema is given,
never inferred, so a file is parsed once for each kind; the bronze form keeps the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.wkt import parse_wkt
from .stored import bucketed
from .tables import TAGS

_META = (
    "_id BIGINT, _version INT, _changeset BIGINT, _timestamp STRING, _user STRING, _uid BIGINT, _visible BOOLEAN, "
    "tag ARRAY<STRUCT<_k: STRING, _v: STRING>>"
)
XML_SCHEMAS = {
    "node": f"{_META}, _lat DOUBLE, _lon DOUBLE",
    "way": f"{_META}, nd ARRAY<STRUCT<_ref: BIGINT>>",
    "relation": f"{_META}, member ARRAY<STRUCT<_type: STRING, _ref: BIGINT, _role: STRING>>",
}
MEMBERS = "array<struct<type: string, ref: bigint, role: string>>"


def _seconds(stamp: Column) -> Column:
    """Epoch seconds of an ISO time; 0 where there is none."""
    return F.coalesce(F.unix_timestamp(F.try_to_timestamp(F.regexp_replace(stamp, "Z$", "+00:00"))), F.lit(0)).cast("long")


def _meta() -> list[Column]:
    return [
        F.coalesce("_changeset", F.lit(0)).cast("long").alias("changeset"),
        _seconds(F.col("_timestamp")).alias("seconds"),
        F.coalesce("_user", F.lit("")).alias("user"),
        F.coalesce("_uid", F.lit(0)).cast("long").alias("uid"),
        F.coalesce("_version", F.lit(0)).cast("long").alias("version"),
        F.coalesce("_visible", F.lit(True)).alias("visible"),
    ]


def read_xml(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The objects of one kind from an XML dump, in the entity schema."""
    raw = (
        spark.read.format("xml")
        .schema(XML_SCHEMAS[kind])
        # values keep their blanks
        .options(rowTag=kind, ignoreSurroundingSpaces="false")
        .load(path)
    )
    tags = F.transform(F.coalesce("tag", F.array()), lambda t: F.struct(t["_k"].alias("k"), t["_v"].alias("v"))).cast(TAGS)
    own: list[Column] = []
    if kind == "node":
        own = [F.col("_lon").alias("lon"), F.col("_lat").alias("lat")]
    elif kind == "way":
        own = [F.transform(F.coalesce("nd", F.array()), lambda n: n["_ref"]).cast("array<bigint>").alias("nds")]
    else:
        own = [
            F.transform(
                F.coalesce("member", F.array()),
                lambda m: F.struct(m["_type"].alias("type"), m["_ref"].alias("ref"), m["_role"].alias("role")),
            ).cast(MEMBERS).alias("members")
        ]
    return raw.filter("_id is not null").select(F.col("_id").alias("id"), *own, tags.alias("tags"), *_meta())


def _unescaped(text: Column) -> Column:
    """%hex% escapes of the line format, by splitting at the percent signs."""
    parts = F.split(text, "%")
    return F.array_join(
        F.transform(
            parts,
            lambda p, i: F.when(i % 2 == 0, p).otherwise(
                F.decode(F.unhex(F.lpad(p, 8, "0")), "utf-32")
            ),
        ),
        "",
    )


def read_opl(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The objects of one kind from a line-based dump: one object a line, a letter a field."""
    letter = {"node": "n", "way": "w", "relation": "r"}[kind]
    lines = spark.read.text(path).filter(F.startswith("value", F.lit(letter)))
    cut = lines.select(F.split("value", " ").alias("f"))
    value = lambda c: F.substring(F.try_element_at(F.filter(F.slice("f", 2, 1 << 20), lambda x: F.startswith(x, F.lit(c))), F.lit(1)), 2, 1 << 30)
    listed = lambda c: F.filter(F.split(F.coalesce(value(c), F.lit("")), ","), lambda x: x != "")
    tags = F.transform(
        listed("T"),
        lambda t: F.struct(
            _unescaped(F.substring_index(t, "=", 1)).alias("k"),
            _unescaped(F.regexp_replace(t, "^[^=]*=", "")).alias("v"),
        ),
    ).cast(TAGS)
    if kind == "node":
        own = [value("x").try_cast("double").alias("lon"), value("y").try_cast("double").alias("lat")]
    elif kind == "way":
        own = [F.transform(listed("N"), lambda n: F.regexp_extract(n, r"^n(-?\d+)", 1).cast("bigint")).alias("nds")]
    else:
        names = F.create_map(*(F.lit(x) for x in ("n", "node", "w", "way", "r", "relation")))
        own = [
            F.transform(
                listed("M"),
                lambda m: F.struct(
                    F.try_element_at(names, F.substring(m, 1, 1)).alias("type"),
                    F.regexp_extract(m, r"^.(-?\d+)", 1).cast("bigint").alias("ref"),
                    _unescaped(F.regexp_extract(m, "^[^@]*@(.*)$", 1)).alias("role"),
                ),
            ).cast(MEMBERS).alias("members")
        ]
    number = lambda c: F.coalesce(value(c).try_cast("bigint"), F.lit(0).cast("long"))
    return cut.select(
        F.substring(F.get("f", F.lit(0)), 2, 40).cast("bigint").alias("id"),
        *own,
        tags.alias("tags"),
        number("c").alias("changeset"),
        _seconds(value("t")).alias("seconds"),
        _unescaped(F.coalesce(value("u"), F.lit(""))).alias("user"),
        number("i").alias("uid"),
        number("v").alias("version"),
        (F.coalesce(value("d"), F.lit("V")) != "D").alias("visible"),
    )


def read_entities(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Objects of one kind by the file's name: .osm or .xml, .opl, with .bz2 or .gz;
    .pbf and .o5m by the sources of those formats."""
    base = path.rstrip("/")
    for ending in (".bz2", ".gz"):
        base = base.removesuffix(ending)
    if base.endswith((".osm", ".xml")):
        return read_xml(spark, path, kind)
    if base.endswith(".opl"):
        return read_opl(spark, path, kind)
    if base.endswith(".pbf"):
        from .binary import PbfSource

        spark.dataSource.register(PbfSource)
        return spark.read.format("entity_pbf").option("path", path).option("kind", kind).load()
    if base.endswith(".o5m"):
        from .binary import O5mSource

        spark.dataSource.register(O5mSource)
        return spark.read.format("entity_o5m").option("path", path).option("kind", kind).load()
    raise ValueError(f"unknown file format: {path}")


def to_bronze(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The three kinds of a dump as Parquet tables in buckets of their ids: later reads prune columns,
    and joins on ids, of references with nodes above all, leave them where they are."""
    return {kind: bucketed(read_entities(spark, path, kind), f"{kind}s", "id") for kind in ("node", "way", "relation")}


def locations(nodes: DataFrame) -> DataFrame:
    """The node-location store: what joins need of nodes, and no more."""
    return nodes.select(F.col("id").alias("ref"), "lon", "lat", (F.size("tags") > 0).alias("is_tagged"))


def read_wkt(spark: SparkSession, *paths: str) -> DataFrame:
    """(id, shape) of auxiliary geometries: a line holds an id, a tab, and WKT.

    A missing file is an error; lines without a geometry are left out.
    """
    rows = spark.read.text(list(paths)).select(
        F.regexp_extract("value", r"^([^\t]*)\t", 1).alias("id"), F.regexp_replace("value", r"^[^\t]*\t", "").alias("wkt")
    )
    return parse_wkt(rows).filter("shape is not null").select("id", "shape")

