"""Areas from closed ways and from relations whose member ways close to rings.

A relation's lines are rows of segments, never one row of all its lines. Segments that
occur twice cancel out by an aggregate; what is left falls into chains, which end where
more or fewer than two segments meet. Each chain is walked in both directions, and pointer
jumping over these walks names each ring by its least walk and tells every walk's place
in it, in as many rounds as the logarithm of a ring's chains. Crossings are found in grid
cells, and how rings lie in each other by what they cross on strips of the relation. Only
the finished geometry is one value again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stored import stored_apart
from . import matrix as M
from .joins import is_area_relation


def of_ways(shaped: DataFrame) -> DataFrame:
    """(area_id, obj_id, from_way, polygons) of the ways that are areas: a projection.

    A ring of fewer than four points after the removal of repeats makes no area.
    """
    return shaped.filter(F.col("is_area") & (F.size("points") >= 4)).select(
        (F.col("id") * 2).alias("area_id"),
        F.col("id").alias("obj_id"),
        F.lit(True).alias("from_way"),
        F.array(F.array("points")).alias("polygons"),
    )


def _pairs(points: Column) -> Column:
    n = F.size(points)
    return F.zip_with(F.slice(points, F.lit(1), n - 1), F.slice(points, F.lit(2), n - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))


def segments_of(lines: DataFrame) -> DataFrame:
    """(id, line, at, p, q): of (id, line, points) the segments that occur an odd number of times, once
    each. Relations where an odd number of them meet are left out: their rings are open."""
    cut = lines.filter(F.size("points") > 1).select("id", "line", F.posexplode(_pairs(F.col("points"))).alias("at", "s"))
    cut = cut.select("id", "line", "at", "s.p", "s.q").filter("p <> q")
    same = Window.partitionBy("id", F.least("p", "q"), F.greatest("p", "q"))
    numbered = cut.withColumn("times", F.count("*").over(same)).withColumn("turn", F.row_number().over(same.orderBy("line", "at")))
    segments = stored_apart(numbered.filter("times % 2 = 1 and turn = 1").select("id", "line", "at", "p", "q"), "ring-segments")
    return segments.join(_degrees(segments).filter("degree % 2 = 1").select("id").distinct(), "id", "left_anti")


def _degrees(segments: DataFrame) -> DataFrame:
    """(id, v, degree) of the points where other than two segments meet."""
    ends = segments.select("id", F.col("p").alias("v")).unionByName(segments.select("id", F.col("q").alias("v")))
    return ends.groupBy("id", "v").agg(F.count("*").alias("degree")).filter("degree <> 2")


def chains_of(segments: DataFrame) -> DataFrame:
    """(id, chain, points): stretches of lines between points where other than two segments meet.

    `chain` is unique within an id.
    """
    degrees = _degrees(segments).select("id", F.col("v").alias("p"), "degree")
    along = Window.partitionBy("id", "line").orderBy("at")
    begins = F.col("degree").isNotNull() | F.coalesce(F.lag("q").over(along) != F.col("p"), F.lit(True))
    placed = segments.join(degrees, ["id", "p"], "left").withColumn("begins", begins.cast("int")).withColumn("run", F.sum("begins").over(along))
    chains = placed.groupBy("id", "line", "run").agg(F.array_sort(F.collect_list(F.struct("at", "p", "q"))).alias("own"))
    points = F.concat(F.col("own.p"), F.array(F.element_at("own.q", -1)))
    return chains.select("id", F.struct("line", "run").alias("chain"), points.alias("points"))


def _strips(segments: DataFrame) -> DataFrame:
    """(id, strips): horizontal strips of a relation, in which its segments lie about evenly."""
    rise = F.sum(F.abs(F.col("y2") - F.col("y1")))
    low, height = F.min(F.least("y1", "y2")), F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2"))
    count = F.greatest(F.lit(1.0), F.least(F.count("*").cast("double"), F.floor(2 * F.count("*") * height / rise)))
    return segments.groupBy("id").agg(F.struct(low.alias("y"), height.alias("h"), count.cast("int").alias("n")).alias("strips"))


def _to_the_right(asked: DataFrame, segments: DataFrame) -> DataFrame:
    """`asked` (id, x, y, ...) with each segment of its relation that lies to the right of it."""
    strips = _strips(segments)
    placed = asked.join(strips, "id").withColumn("strip", M.strip(F.col("y"), F.col("strips"))).drop("strips")
    walls = segments.filter("y1 <> y2").join(strips, "id")
    lowest, highest = (M.strip(f("y1", "y2"), F.col("strips")) for f in (F.least, F.greatest))
    walls = walls.withColumn("strip", F.explode(F.sequence(lowest, highest))).drop("strips")
    return placed.join(walls.hint("merge"), ["id", "strip"]).filter(M.to_the_right())


def _inward(segments: DataFrame) -> DataFrame:
    """(id, v, inward): of the points where more than two segments meet, whether the surface lies
    in the corner that a look to the right, and a little up, falls into."""
    crowded = _degrees(segments).select("id", "v", F.col("v.x").alias("x"), F.col("v.y").alias("y"))
    others = segments.select("id", "p", "q", F.col("p.x").alias("x1"), F.col("p.y").alias("y1"), F.col("q.x").alias("x2"), F.col("q.y").alias("y2"))
    right = _to_the_right(crowded, others).filter("p <> v and q <> v").groupBy("id", "v").agg((F.count("*") % 2 == 1).alias("inward"))
    return crowded.select("id", "v").join(right, ["id", "v"], "left").select("id", "v", F.coalesce("inward", F.lit(False)).alias("inward"))


def _walks(chains: DataFrame) -> DataFrame:
    """(id, walk, back, first, last, lead, tail): every chain in both directions; `walk` is (line, run,
    direction), lead and tail are the points next to its ends."""
    p = lambda k: F.element_at("points", F.lit(k))
    walk = lambda d: F.struct("chain.line", "chain.run", F.lit(d).alias("way"))
    forth = chains.select("id", walk(0).alias("walk"), walk(1).alias("back"), p(1).alias("first"), p(-1).alias("last"), p(2).alias("lead"), p(-2).alias("tail"))
    back = chains.select("id", walk(1).alias("walk"), walk(0).alias("back"), p(-1).alias("first"), p(1).alias("last"), p(-2).alias("lead"), p(2).alias("tail"))
    return forth.unionByName(back)


def _followed(walks: DataFrame, inward: DataFrame) -> DataFrame:
    """(id, walk, next): at each point the ends of chains are paired, neighbours with neighbours by
    their angles, those with the surface between them: so rings that touch do not cross there,
    and a ring that passes a point again does so on the same side everywhere."""
    angle = F.atan2(F.col("lead.y") - F.col("first.y"), F.col("lead.x") - F.col("first.x"))
    ends = walks.select("id", "walk", "back", F.col("first").alias("v"), F.when(angle > 0, angle).otherwise(angle + 2 * math.pi).alias("angle"))
    at = Window.partitionBy("id", "v")
    numbered = ends.withColumn("n", F.row_number().over(at.orderBy("angle", "walk")) - 1).withColumn("of", F.count("*").over(at))
    placed = numbered.join(inward, ["id", "v"], "left")
    n = F.col("n")
    # the look falls between the last one and the first
    wrapped = F.pmod(F.when(n % 2 == 1, n + 1).otherwise(n - 1), F.col("of"))
    mate = F.when(F.coalesce("inward", F.lit(False)), wrapped).otherwise(n.bitwiseXOR(F.lit(1)))
    # who leaves by one end of a pair was reached by the other's way back
    other = numbered.select("id", "v", F.col("n").cast("long").alias("m"), F.col("walk").alias("next"))
    return placed.withColumn("m", mate.cast("long")).join(other, ["id", "v", "m"]).select("id", F.col("back").alias("walk"), "next")


def _ringed(followed: DataFrame, most_rounds: int = 48) -> DataFrame:
    """(id, walk, ring, left): the least walk of each walk's ring, and how many steps it is away.

    A round looks twice as far as the one before; it ends when nobody looks at another name.
    """
    told = followed.select("id", "walk", F.col("next").alias("to"), F.lit(1).cast("long").alias("far"), F.col("walk").alias("ring"), F.lit(0).cast("long").alias("left"))
    for _ in range(most_rounds):
        told = stored_apart(told, "walks")
        seen = told.select("id", F.col("walk").alias("to"), F.col("to").alias("to2"), F.col("far").alias("far2"), F.col("ring").alias("ring2"), F.col("left").alias("left2"))
        looked = told.join(seen, ["id", "to"])
        better = F.col("ring2") < F.col("ring")
        if looked.filter("ring2 <> ring").isEmpty():
            return told.select("id", "walk", "ring", "left")
        told = looked.select(
            "id", "walk", F.col("to2").alias("to"), (F.col("far") + F.col("far2")).alias("far"), F.least("ring", "ring2").alias("ring"),
            F.when(better, F.col("far") + F.col("left2")).otherwise(F.col("left")).alias("left"),
        )
    raise RuntimeError("rings did not close")


def _simple(walks: DataFrame, followed: DataFrame, ringed: DataFrame) -> DataFrame:
    """(id, walk, next) with rings that pass a point more than once parted there: who comes to
    the point goes on as the one did who came before."""
    starts = walks.select("id", "walk", F.col("first").alias("v"))
    passed = followed.join(ringed, ["id", "walk"]).join(starts.withColumnRenamed("walk", "next"), ["id", "next"])
    # from the ring's least walk on: it is the last one, as it is left by its own name
    visits = Window.partitionBy("id", "ring", "v")
    ordered = visits.orderBy(F.desc("left"))
    again = passed.withColumn("times", F.count("*").over(visits))
    last = F.last("next").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    turned = F.when(F.col("times") == 1, F.col("next")).otherwise(F.coalesce(F.lag("next").over(ordered), last))
    return again.withColumn("turned", turned).select("id", "walk", F.col("turned").alias("next"))


def rings_of(lines: DataFrame) -> DataFrame:
    """(id, ring, points): the closed rings of (id, line, points), each once, of four points or more."""
    segments = stored_apart(segments_of(lines), "closed-segments")
    chains = stored_apart(chains_of(segments), "chains")
    walks = stored_apart(_walks(chains), "chain-ends")
    followed = stored_apart(_followed(walks, _inward(segments)), "followed")
    ringed = _ringed(followed)
    starts = walks.select("id", "walk", "first")
    twice = ringed.join(starts, ["id", "walk"]).groupBy("id", "ring", "first").count().filter("count > 1")
    if not twice.isEmpty():
        ringed = _ringed(_simple(walks, followed, ringed))
    # of a ring and the same one backwards, the one of the lesser name
    backwards = ringed.join(walks.select("id", "walk", "back"), ["id", "walk"]).select("id", F.col("back").alias("walk"), F.col("ring").alias("mirror"))
    own = ringed.join(backwards, ["id", "walk"]).filter("ring < mirror")
    beside = own.withColumn("chain", F.struct("walk.line", "walk.run")).join(chains, ["id", "chain"])
    points = F.when(F.col("walk.way") == 0, F.col("points")).otherwise(F.reverse("points"))
    # the least walk has nothing left and comes first
    order = F.when(F.col("left") == 0, F.lit(-(2**62))).otherwise(-F.col("left"))
    part = F.struct(order.alias("order"), F.slice(points, F.lit(1), F.size("points") - 1).alias("points"))
    gathered = beside.groupBy("id", "ring").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    ring = F.flatten("parts.points")
    closed = gathered.select("id", "ring", F.concat(ring, F.slice(ring, F.lit(1), F.lit(1))).alias("points"))
    return closed.filter(F.size("points") >= 4)


def _crossed(segments: DataFrame) -> DataFrame:
    """(id): relations of which two segments cross, or lie on each other in part.

    `segments` has (id, ring, k, x1, y1, x2, y2).
    """
    leveled = M.leveled(segments, long=True)
    levels = sorted(r.level for r in leveled.select("level").distinct().collect()) or [0]  # nine at most
    fine = M.in_cells(leveled.withColumn("at", F.explode(F.array(*map(F.lit, levels)))).filter("at >= level"))
    coarse = M.in_cells(leveled.withColumn("at", F.col("level")))
    own = ("ring", "k", "level", "x1", "y1", "x2", "y2")
    a, b = (df.select("id", "at", "cx", "cy", *(F.col(c).alias(f"{s}_{c}") for c in own)) for df, s in ((fine, "a"), (coarse, "b")))
    name = lambda s: F.struct(f"{s}_ring", f"{s}_k")
    once = (F.col("a_level") < F.col("b_level")) | (name("a") < name("b"))
    pairs = a.join(b, ["id", "at", "cx", "cy"]).filter(once & (name("a") != name("b")))
    return pairs.filter(M.crossing()).select("id").distinct()


def polygons_of(rings: DataFrame) -> DataFrame:
    """(id, polygons): outer rings with the inner rings they hold, told apart by how deep they lie.

    A ring that two of the same relation's segments cross spoils the relation, which is left out.
    """
    cut = rings.select("id", "ring", F.posexplode(_pairs(F.col("points"))).alias("k", "s"))
    segments = stored_apart(
        cut.select("id", "ring", "k", F.col("s.p.x").alias("x1"), F.col("s.p.y").alias("y1"), F.col("s.q.x").alias("x2"), F.col("s.q.y").alias("y2")), "rings"
    )
    whole = rings.join(_crossed(segments), "id", "left_anti")
    first, second = F.get("points", F.lit(0)), F.get("points", F.lit(1))
    asked = whole.select("id", "ring", ((first["x"] + second["x"]) / 2).alias("x"), ((first["y"] + second["y"]) / 2).alias("y"))
    met = _to_the_right(asked, segments.withColumnRenamed("ring", "holder")).filter("ring <> holder")
    held = met.groupBy("id", "ring", "holder").agg(F.count("*").alias("n")).filter("n % 2 = 1").select("id", "ring", "holder")
    depth = held.groupBy("id", "ring").agg(F.count("*").alias("depth"))
    placed = whole.join(depth.hint("merge"), ["id", "ring"], "left").withColumn("outer", F.coalesce("depth", F.lit(0)) % 2 == 0)
    surface = F.abs(M.turn_of(F.col("points")))
    outers = placed.filter("outer").select("id", F.col("ring").alias("holder"), surface.alias("surface"))
    inner = placed.filter("not outer").select("id", "ring").join(held.hint("merge"), ["id", "ring"]).join(outers.hint("merge"), ["id", "holder"])
    # the smallest outer ring around it
    owner = inner.groupBy("id", "ring").agg(F.min(F.struct("surface", "holder")).alias("own")).select("id", "ring", F.col("own.holder").alias("owner"))
    owned = placed.join(owner.hint("merge"), ["id", "ring"], "left").filter("outer or owner is not null")
    member = F.struct((~F.col("outer")).cast("int").alias("inner"), F.array_min("points").alias("least"), "points")
    grouped = owned.groupBy("id", F.coalesce("owner", "ring").alias("holder")).agg(F.array_sort(F.collect_list(member)).alias("rings"))
    polygon = F.struct(F.get("rings.least", F.lit(0)).alias("least"), F.col("rings.points").alias("rings"))
    return grouped.groupBy("id").agg(F.array_sort(F.collect_list(polygon)).alias("all")).select("id", F.col("all.rings").alias("polygons"))


def assembled(lines: DataFrame) -> DataFrame:
    """(id, polygons) of (id, line, points); relations of broken rings give no row."""
    return polygons_of(stored_apart(rings_of(lines), "closed-rings"))


def of_relations(relations: DataFrame, shaped: DataFrame) -> DataFrame:
    """As of_ways, of the relations that are areas; broken rings give no row.

    Ways without a location, and ways that are missing, leave the rings open; a way that a
    relation names twice cancels itself out.
    """
    members = (
        relations.filter(is_area_relation())
        .select("id", F.posexplode("members").alias("line", "m"))
        .filter("m.type = 'way'")
        .select("id", "line", F.abs("m.ref").alias("ref"))
    )
    lines = members.join(shaped.select(F.col("id").alias("ref"), "points").hint("merge"), "ref", "left")
    broken = lines.filter("points is null").select("id").distinct()
    built = assembled(lines.join(broken, "id", "left_anti").select("id", "line", "points"))
    return built.select((F.col("id") * 2 + 1).alias("area_id"), F.col("id").alias("obj_id"), F.lit(False).alias("from_way"), "polygons")
