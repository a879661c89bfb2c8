"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vehicle_metrics.llm.common import heavy_keys, look_up, sorted_join
from vehicle_metrics.storage import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns src, dst).

    ``component`` is the smallest node reachable. Each round gives a node the
    smallest label among its own, its neighbours' and its label's own label
    (pointer jumping), so long chains shrink geometrically. Labels are
    written to the shared folder between rounds. Nothing is gathered per node:
    minima are partial aggregates, and a node with very many neighbours, or a
    label with very many nodes, is looked up by a broadcast of the at most
    1000 heavy keys, so that its rows stay spread over the tasks; nothing else
    goes through the driver. Empty input gives an empty result; loops, repeated
    edges and NULL ends change nothing.
    """
    both = edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = materialize(both.where("src IS NOT NULL AND dst IS NOT NULL").distinct(), "edges")
    labels = materialize(
        both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low"))
        .selectExpr("node", "least(node, low) AS label"), "labels")
    n_edges, n_nodes = both.count(), labels.count()
    hubs = materialize(heavy_keys(both, "dst", n_edges), "hubs")

    while True:
        near = (look_up(both, hubs, labels.withColumnRenamed("node", "dst").hint("merge"), "dst")
                .groupBy(F.col("src").alias("node")).agg(F.min("label").alias("near")))
        above = labels.selectExpr("node AS label", "label AS next").hint("merge")
        jumped = look_up(labels, heavy_keys(labels, "label", n_nodes), above, "label")
        step = materialize(
            sorted_join(jumped, near, "node").selectExpr("node", "label AS old", "least(label, near, next) AS label"), "labels")
        labels = step.select("node", "label")
        if not step.where("label <> old").limit(1).count():
            return labels.withColumnRenamed("label", "component")
