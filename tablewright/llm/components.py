"""Connected components of an edge table by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import drop_tables, parquet_table


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of the undirected ``edges``.

    Each round every node takes the smallest label among its neighbours and
    then the label of that label, so long chains shrink by doubling.  Minima
    are partial aggregates; labels are stored between rounds, and those of the
    round before deleted.
    """
    both = parquet_table(edges.select(F.col(a).alias("src"), F.col(b).alias("dst"))
                         .unionByName(edges.select(F.col(b).alias("src"), F.col(a).alias("dst"))).distinct(), "edges")
    labels = parquet_table(both.groupBy("src").agg(F.min("dst").alias("near"))
                           .select(F.col("src").alias("node"), F.least("src", "near").alias("label")), "labels")
    while True:
        offered = (both.join(labels, both["dst"] == labels["node"]).groupBy("src").agg(F.min("label").alias("offer")))
        lower = labels.join(offered, labels["node"] == offered["src"], "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("offer", "label")).alias("label"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("jump"))
        stepped = parquet_table(lower.join(jump, lower["label"] == jump["at"], "left").select(
            "node", "old", F.least("label", F.coalesce("jump", "label")).alias("label")), "labels")
        done = not stepped.where("old <> label").limit(1).count()
        drop_tables(labels)
        if done:
            drop_tables(both)
            return stepped.select("node", F.col("label").alias("component"))
        labels = stepped.select("node", "label")
