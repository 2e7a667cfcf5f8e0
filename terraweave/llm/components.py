"""Connected components of an edge table, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import remove_table, stored

#: Rounds end by themselves when no label moves; more than this means a fault.
MOST_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in `edges` (a, b); component is the least id.

    Each round takes the least label among a node and its neighbours, then follows
    that label's own label (pointer jumping), so the rounds grow with the logarithm
    of a component's width. Rows with a null end are left out, loops and repeated
    edges change nothing, and an empty table gives an empty result.
    """
    known = edges.select("a", "b").dropna()
    both = stored(known.union(known.select("b", "a")).distinct(), "edges")
    labels = stored(
        both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels"
    )
    for _ in range(MOST_ROUNDS):
        near = (
            both.join(labels, both.b == labels.id)
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        least = labels.join(near, labels.id == near.a).select(
            "id", F.col("component").alias("was"), F.least("component", "near").alias("component")
        )
        over = least.select(F.col("id").alias("at"), F.col("component").alias("further"))
        moved = stored(
            least.join(over, least.component == over.at).select(
                "id", "was", F.least("component", "further").alias("component")
            ),
            "labels",
        )
        settled = moved.filter("was <> component").limit(1).count() == 0
        # this round's table holds all that the next one reads
        remove_table(labels)
        labels = moved.select("id", "component")
        if settled:
            remove_table(both)
            return labels
    raise RuntimeError("components did not settle")
