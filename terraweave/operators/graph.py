"""Directed graphs as edge tables (src, dst); edges may repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stored import stored


def add_edges(edges: DataFrame, *more: tuple[int, int]) -> DataFrame:
    new = edges.sparkSession.createDataFrame(list(more), "src long, dst long")
    return edges.select("src", "dst").unionByName(new)


def closure(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(src, dst) of every path, each pair once.

    A round joins the pairs that the last one found with all that are known, so paths
    double in length and a graph of depth d takes log2(d) rounds; no pair is found
    from two old ones again. Each round is a written table, so no lineage builds up.
    """
    known = new = stored(edges.select("src", "dst").distinct(), "closure")
    for _ in range(most_rounds):
        further = new.alias("a").join(known.alias("b"), F.col("a.dst") == F.col("b.src")).select(
            F.col("a.src").alias("src"), F.col("b.dst").alias("dst")
        )
        new = stored(further.distinct().join(known, ["src", "dst"], "left_anti"), "closure")
        if new.limit(1).count() == 0:
            return known
        known = known.unionByName(new)
    raise RuntimeError("closure did not settle")


class Successors:
    """The closure kept for many questions."""

    def __init__(self, edges: DataFrame):
        self._edges = edges
        self._paths: DataFrame | None = None

    def prepare(self) -> Successors:
        self._paths = closure(self._edges)
        return self

    def of(self, source: int) -> list[int]:
        """All that can be reached from `source`, without it, in ascending order."""
        return [r.dst for r in self.rows(source).orderBy("dst").toLocalIterator()]

    def rows(self, source: int) -> DataFrame:
        """The same as a table (dst), for sources that reach many."""
        if self._paths is None:
            raise RuntimeError("prepare() first")
        return self._paths.filter((F.col("src") == source) & (F.col("dst") != source)).select("dst")


def successors(edges: DataFrame) -> DataFrame:
    """(src, dst): whom each vertex reaches, itself left out even on a cycle."""
    return closure(edges).filter("src <> dst")


def reached(edges: DataFrame, sources: DataFrame, most_rounds: int = 100_000) -> DataFrame:
    """(word, vertex, mask): whom numbered sources reach, themselves left out even on a cycle.

    `sources` is (number, vertex). Sixty-four sources are the bits of one number, `word` is a
    number's sixty-fourth part. A round moves only bits that a vertex has not had before along
    the edges, so paths between vertices that no source reaches are never looked at.
    """
    steps = stored(edges.select("src", "dst").distinct(), "edges")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("number", F.lit(64)).cast("int"))
    told = sources.select(F.floor(F.col("number") / 64).alias("word"), "vertex", bit.alias("mask"))
    own = stored(told.groupBy("word", "vertex").agg(F.bit_or("mask").alias("mask")), "sources")
    front, known = own, None
    for _ in range(most_rounds):
        moved = front.join(steps, front.vertex == steps.src).groupBy("word", F.col("dst").alias("vertex")).agg(F.bit_or("mask").alias("new"))
        had = own.withColumnRenamed("mask", "had")
        if known is not None:
            had = had.unionByName(known.withColumnRenamed("mask", "had")).groupBy("word", "vertex").agg(F.bit_or("had").alias("had"))
        fresh = moved.join(had, ["word", "vertex"], "left").select("word", "vertex", F.col("new").bitwiseAND(F.bitwise_not(F.coalesce("had", F.lit(0).cast("long")))).alias("mask"))
        front = stored(fresh.filter("mask <> 0"), "front")
        if front.isEmpty():
            return own.limit(0) if known is None else known
        known = stored(front if known is None else known.unionByName(front).groupBy("word", "vertex").agg(F.bit_or("mask").alias("mask")), "reached")
    raise RuntimeError("the search did not end")


def successors_of(edges: DataFrame, sources: list[int]) -> DataFrame:
    """(src, dst): whom each of some vertices reaches, without the closure of all."""
    spark: SparkSession = edges.sparkSession
    own = sorted(set(sources))
    numbered = spark.createDataFrame(list(enumerate(own)), "number long, vertex long")
    found = reached(edges, numbered)
    set_bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda k: F.call_function("shiftright", F.col("mask"), k).bitwiseAND(F.lit(1).cast("long")) != 0)
    each = found.select(F.col("vertex").alias("dst"), "word", F.explode(set_bits).alias("bit"))
    named = each.select((F.col("word") * 64 + F.col("bit")).alias("number"), "dst")
    return named.join(numbered.withColumnRenamed("vertex", "src"), "number").select("src", "dst")


def levels(edges: DataFrame) -> DataFrame:
    """(vertex, level): the longest path that leads to each vertex. A cycle raises.

    A round takes away the vertices that nothing leads to any more; if there is none while
    edges are left, they go round.
    """
    left = stored(edges.select("src", "dst").distinct(), "edges")
    remaining = stored(vertices(left), "vertices")
    found, level = None, 0
    while not remaining.isEmpty():
        first = stored(remaining.join(left.select(F.col("dst").alias("vertex")), "vertex", "left_anti"), "level")
        if first.isEmpty():
            raise RuntimeError("the graph has a cycle")
        told = first.withColumn("level", F.lit(level))
        found = told if found is None else found.unionByName(told)
        remaining = stored(remaining.join(first, "vertex", "left_anti"), "vertices")
        left = stored(left.join(first.withColumnRenamed("vertex", "src"), "src", "left_anti").select("src", "dst"), "edges")
        level += 1
    return vertices(edges).withColumn("level", F.lit(0)) if found is None else found


def vertices(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("vertex")).union(edges.select("dst")).distinct()


def counts(edges: DataFrame) -> DataFrame:
    """(num_edges, num_vertices): edges with their multiplicity."""
    both = edges.select(F.lit(True).alias("edge")).unionByName(vertices(edges).select(F.lit(False).alias("edge")))
    return both.agg(F.count_if("edge").alias("num_edges"), F.count_if(~F.col("edge")).alias("num_vertices"))


def reduce_dag(edges: DataFrame) -> DataFrame:
    """The transitive reduction: of each vertex the successors that no other gives. A cycle raises.

    An edge goes if another successor of its source reaches its target. Only those successors
    are searched from, sixty-four at a time as bits, whose source has several; only targets
    with several edges are asked for, and only edges that span more than one level.
    """
    own = stored(edges.select("src", "dst").distinct(), "edges")
    placed = stored(levels(own), "levels")
    level = lambda c: placed.select(F.col("vertex").alias(c), F.col("level").alias(f"{c}_level"))
    spans = own.join(level("src"), "src").join(level("dst"), "dst").filter("dst_level - src_level > 1").select("src", "dst")
    asked = stored(spans, "long-edges")
    others = own.join(asked.select("src").distinct(), "src", "left_semi")
    starts = stored(others.select(F.col("dst").alias("vertex")).distinct().withColumn("number", F.monotonically_increasing_id()), "starts")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("number", F.lit(64)).cast("int"))
    given = others.join(starts.withColumnRenamed("vertex", "dst"), "dst").groupBy("src", F.floor(F.col("number") / 64).alias("word")).agg(F.bit_or(bit).alias("given"))
    found = reached(own, starts).withColumnRenamed("vertex", "dst")
    # a vertex does not reach itself, so the edge's own target is no other way
    meet = asked.join(given, "src").join(found, ["dst", "word"]).filter(F.col("given").bitwiseAND(F.col("mask")) != 0)
    return own.join(meet.select("src", "dst").distinct(), ["src", "dst"], "left_anti")


def reduce_closed_dag(edges: DataFrame) -> DataFrame:
    """As reduce_dag, for edges that are their own closure already."""
    own = edges.select("src", "dst").distinct()
    return _direct(own, own)


def _direct(paths: DataFrame, steps: DataFrame) -> DataFrame:
    longer = paths.alias("a").join(steps.alias("b"), F.col("a.dst") == F.col("b.src")).select(
        F.col("a.src").alias("src"), F.col("b.dst").alias("dst")
    )
    return paths.join(longer, ["src", "dst"], "left_anti").select("src", "dst")


def dot(edges: DataFrame, *, object_ids: bool = False, name: str = "G") -> DataFrame:
    """(at, line): the graph in DOT. With object ids odd vertices are ellipses and
    every vertex shows half its number."""
    spark: SparkSession = edges.sparkSession
    label = lambda c: F.col(c).cast("string")
    rows = edges.select(F.lit(2).alias("at"), F.concat(F.lit("  "), label("src"), F.lit(" -> "), label("dst"), F.lit(";")).alias("line"))
    if object_ids:
        shape = F.when(F.col("vertex") % 2 == 1, "ellipse").otherwise("box")
        half = F.floor(F.col("vertex") / 2).cast("string")
        nodes = vertices(edges).select(
            F.lit(1).alias("at"),
            F.concat(F.lit("  "), label("vertex"), F.lit(' [label="'), half, F.lit('", shape='), shape, F.lit("];")).alias("line"),
        )
        rows = nodes.unionByName(rows)
    ends = spark.createDataFrame([(0, f"digraph {name} {{"), (3, "}")], "at int, line string")
    return ends.unionByName(rows)
