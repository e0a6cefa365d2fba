"""Connected components of a graph given as an edge table, by min-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.session import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge.

    Every round takes the least label among a node and its neighbours (a grouped
    minimum, summed up before the shuffle, so a node with very many edges is no
    hot spot) and then the label's own label, which halves the distances left. It
    ends when nothing changes. Nothing but that flag comes to the driver.
    """
    both = materialize(edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
                       .unionAll(edges.select(F.col(b).alias("node"), F.col(a).alias("other")))
                       .where("node != other").distinct(), "edges")
    labels = materialize(both.groupBy("node").agg(F.least(F.first("node"), F.min("other")).alias("component")), "labels")
    while True:
        near = (both.join(labels.withColumnsRenamed({"node": "other"}), "other").groupBy("node")
                .agg(F.min("component").alias("near")))
        better = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        fresh = materialize(better.join(jump, "next", "left")
                            .select("node", F.least("next", F.coalesce("far", "next")).alias("component"),
                                    (F.least("next", F.coalesce("far", "next")) != F.col("component")).alias("changed")), "labels")
        done = not fresh.where("changed").limit(1).count()
        labels = fresh.drop("changed")
        if done:
            return labels
