"""Connected components of a graph given as edge rows, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kassa.llm.common import stash


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for every node of ``edges`` (a, b); ``comp`` is the component's least node.

    Each round takes the least label among a node's neighbours and then the
    label of that label (which halves the remaining distance), until nothing
    changes. Minima combine map-side, so a node with very many neighbours is
    no hot key; every round is a table of its own.
    """
    both = stash(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = stash(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("comp")))
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("low"))
        lower = labels.join(seen, "node").select("node", F.col("comp").alias("old"), F.least("comp", "low").alias("mid"))
        root = labels.select(F.col("node").alias("mid"), F.col("comp").alias("far"))
        step = stash(lower.join(root, "mid", "left").select("node", "old", F.coalesce(F.least("mid", "far"), F.col("mid")).alias("comp")))
        labels = step.select("node", "comp")
        if step.where("old <> comp").isEmpty():
            return labels
