"""Connected components of a links table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.common import materialize


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """node, label: the smallest node connected to each node of ``links`` (a, b).

    Each round takes the smallest label among a node and its neighbours, then
    the label's own label (path halving), so rounds grow with the logarithm
    of the longest path. Every round is a written table.
    """
    edges = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = materialize(spark, edges, "cc-edges")
    labels = materialize(spark, edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "cc-labels")
    while True:
        seen = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        new = labels.join(seen, labels["node"] == seen["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        new = materialize(spark, new, "cc-round")
        up = new.select(F.col("node").alias("at"), F.col("label").alias("further"))
        new = new.join(up, new["label"] == up["at"]).select("node", "old", F.least("label", "further").alias("label"))
        new = materialize(spark, new, "cc-jump")
        if new.where("old <> label").limit(1).count() == 0:
            return new.select("node", "label")
        labels = new.select("node", "label")
