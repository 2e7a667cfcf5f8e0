"""Entity tables from the star-schema tables, one rule per entity.

nodes(id, lon, lat, tags, meta...), ways(id, nds, tags, meta...), relations(id,
members, tags, meta...), areas(area_id, obj_id, from_way, polygons).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TAGS = "array<struct<k: string, v: string>>"
META = ["changeset", "seconds", "user", "uid", "version", "visible"]
#: Ids of relations that come from regions, and of ways that come from suppliers.
REGION_BASE = 1_000_000_000
SUPPLIER_BASE = 500_000_000
#: Fixed value of the adapter: first time stamp.
FIRST_SECOND = 1_555_936_496


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """`df` in as many partitions as there are cores, where its scan has fewer: small files make few
    tasks, and facts and shapes are far more work than the rows that they are made of."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def tag_list(*pairs: tuple[str, Column]) -> Column:
    return F.array(*(F.struct(F.lit(k).alias("k"), v.cast("string").alias("v")) for k, v in pairs))


def no_tags() -> Column:
    return F.array().cast(TAGS)


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as nodes; every fifth has no tags."""
    k = F.col("p_partkey")
    x7 = F.pmod(k * 7919000, F.lit(3600000000)) - 1800000000
    y7 = F.pmod(k * 104729000, F.lit(1800000000)) - 900000000
    tags = tag_list(("name", F.col("p_name")), ("brand", F.col("p_brand")), ("type", F.col("p_type")), ("size", F.col("p_size")))
    return spread(table(spark, sf_dir, "part")).select(
        k.alias("id"),
        (x7 / 1e7).alias("lon"),
        (y7 / 1e7).alias("lat"),
        F.when(k % 5 == 0, no_tags()).otherwise(tags).alias("tags"),
        (k % 7).alias("changeset"),
        (k + FIRST_SECOND).alias("seconds"),
        F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("user"), (k % 10).cast("string"))).alias("user"),
        (k % 4).alias("uid"),
        (k % 9).alias("version"),
        (k % 11 != 0).alias("visible"),
    )


def located_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The node-location store: (ref, lon, lat, is_tagged); some nodes are missing."""
    return nodes(spark, sf_dir).filter("id % 17 <> 0").select(
        F.col("id").alias("ref"), "lon", "lat", (F.size("tags") > 0).alias("is_tagged")
    )


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ways whose references are the parts of their lines, in line order."""
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sort_array(F.collect_list(order))["l_partkey"].alias("nds"))
    )
    k = F.col("o_orderkey")
    tags = tag_list(("status", F.col("o_orderstatus")), ("priority", F.col("o_orderpriority")))
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
        .join(lines, "o_orderkey", "left")
        .select(
            k.alias("id"),
            F.coalesce("nds", F.array().cast("array<bigint>")).alias("nds"),
            F.when(k % 6 == 0, no_tags()).otherwise(tags).alias("tags"),
            k.alias("changeset"),
            F.unix_timestamp("o_orderdate").alias("seconds"),
            F.concat(F.lit("cust"), F.col("o_custkey").cast("string")).alias("user"),
            F.col("o_custkey").alias("uid"),
            F.lit(1).cast("long").alias("version"),
            F.lit(True).alias("visible"),
        )
    )


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as relations of their orders (ways) and nation (node), regions of nations."""
    orders = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("orders"))
    )
    k = F.col("c_custkey")
    member = "struct<type: string, ref: bigint, role: string>"
    own = F.transform(
        F.coalesce("orders", F.array().cast("array<struct<o_orderkey: bigint, o_orderstatus: string>>")),
        lambda o: F.struct(
            F.lit("way").alias("type"),
            o["o_orderkey"].alias("ref"),
            F.when(o["o_orderstatus"] == "O", "").otherwise(o["o_orderstatus"]).alias("role"),
        ),
    )
    nation = F.array(
        F.struct(F.lit("node").alias("type"), F.col("c_nationkey").cast("long").alias("ref"), F.lit("label").alias("role"))
    )
    kind = F.when(k % 3 == 0, "multipolygon").when(k % 3 == 1, "route").otherwise("site")
    of_customers = (
        table(spark, sf_dir, "customer")
        .join(orders, "c_custkey", "left")
        .select(
            k.alias("id"),
            F.concat(own, nation).cast(f"array<{member}>").alias("members"),
            tag_list(("segment", F.col("c_mktsegment")), ("type", kind)).alias("tags"),
        )
    )
    nations = (
        table(spark, sf_dir, "nation")
        .groupBy(F.col("n_regionkey").alias("r_regionkey"))
        .agg(F.array_sort(F.collect_list(F.col("n_nationkey").cast("long"))).alias("nations"))
    )
    r = F.col("r_regionkey").cast("long")
    of_regions = (
        table(spark, sf_dir, "region")
        .join(nations, "r_regionkey", "left")
        .select(
            (r + REGION_BASE).alias("id"),
            F.transform(
                "nations", lambda n: F.struct(F.lit("relation").alias("type"), n.alias("ref"), F.lit("").alias("role"))
            ).cast(f"array<{member}>").alias("members"),
            tag_list(("name", F.col("r_name")), ("type", F.lit("collection"))).alias("tags"),
        )
    )
    return of_customers.unionByName(of_regions).select(
        "*",
        F.lit(0).cast("long").alias("changeset"),
        F.lit(0).cast("long").alias("seconds"),
        F.lit("").alias("user"),
        F.lit(0).cast("long").alias("uid"),
        F.lit(1).cast("long").alias("version"),
        F.lit(True).alias("visible"),
    )


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as boxes: closed ways, every fourth one a relation's area."""
    k = F.col("s_suppkey")
    x, y = (F.pmod(k * 37, F.lit(340)) - 170).cast("double"), (F.pmod(k * 53, F.lit(160)) - 80).cast("double")
    w, h = (k % 7 + 1).cast("double"), (k % 5 + 1).cast("double")
    corners = ((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))
    ring = F.array(*(F.struct(a.alias("x"), b.alias("y")) for a, b in corners))
    obj = k + SUPPLIER_BASE
    from_way = k % 4 != 0
    return spread(table(spark, sf_dir, "supplier")).select(
        F.when(from_way, obj * 2).otherwise(obj * 2 + 1).alias("area_id"),
        obj.alias("obj_id"),
        from_way.alias("from_way"),
        F.array(F.array(ring)).alias("polygons"),
    )
