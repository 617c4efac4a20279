"""Connected components of a graph held as a table of edges.

Alternates two steps until nothing changes: every node takes the smallest label among
itself and its neighbours (an aggregation with map-side minimum, so a hub costs one row
per task), then labels are followed to their own label (pointer jumping). Labels, edges and
components stay in written tables; only counters reach the driver. Long chains halve with
every round, so rounds grow with the logarithm of a component's diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.llm.store import written


def _lowest(rows: DataFrame) -> DataFrame:
    """(node, component, low): a node's label, which one of its rows holds, and the least one told."""
    return rows.groupBy("node").agg(F.max("component").alias("component"), F.min("low").alias("low"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    Edges with a null end, loops and repeated edges are allowed and change nothing.
    An empty edge table gives an empty result.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter(
        F.col("u").isNotNull() & F.col("v").isNotNull()
    )
    both = written(
        pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(),
        "edges",
    )
    labels = written(
        both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select(
            "node", F.least("node", "m").alias("component")
        ),
        "labels",
    )
    unknown = F.lit(None).cast(labels.schema["component"].dataType).alias("component")
    while True:
        # Unions instead of joins: a node's own row and what it is told meet in one aggregation, so a
        # round is two joins and a short plan (the driver holds the plans of all rounds).
        seen = labels.select(F.col("node").alias("v"), F.col("component").alias("low"))
        told = both.join(seen, "v").select(F.col("u").alias("node"), unknown, "low")
        step = _lowest(labels.select("node", "component", F.col("component").alias("low")).unionByName(told))
        # What a node has learnt also holds for the node that its old label names.
        best = _lowest(step.unionByName(step.select(F.col("component").alias("node"), unknown, "low")))
        jump = best.select(F.col("node").alias("low"), F.col("low").alias("root"))
        new = written(
            best.join(jump, "low", "left").select(
                "node",
                F.least("low", F.coalesce("root", "low")).alias("component"),
                (F.least("low", F.coalesce("root", "low")) != F.col("component")).alias("moved"),
            ),
            "labels",
        )
        moved = new.agg(F.max("moved")).first()[0]
        labels = new.select("node", "component")
        if not moved:
            return labels
