"""Connected components of links between integer ids, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``id, label`` (smallest id reachable) for every id of ``links`` (``a, b``).

    Each round gives an id the smallest label among its neighbours and then the
    label of that label. Rounds end when nothing changes. Labels are stored
    every round, so both sides of a join are plain shuffles whose hot keys AQE
    splits, and minima are combined before they are shuffled.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = stored(both, "edges")
    labels = stored(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label")), "labels")
    while True:
        offers = edges.join(labels, edges["a"] == labels["id"]).select(F.col("b").alias("id"), "label")
        nearer = stored(labels.union(offers).groupBy("id").agg(F.min("label").alias("label")), "labels")
        over = nearer.select(F.col("id").alias("label"), F.col("label").alias("next"))
        new = stored(nearer.join(over, "label").select("id", F.col("next").alias("label")), "labels")
        moved = new.join(labels.withColumnRenamed("label", "old"), "id").where("label <> old").limit(1).count()
        labels = new
        if not moved:
            return labels
