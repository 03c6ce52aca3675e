"""Connected components of a link table by least labels and pointer jumping, in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, label``: the least node that each node of a link can reach.

    Every round a node takes the least label around it and then the label of that label, so long
    chains halve. Both steps are joins on node keys with partial minima; a node of very many
    links is one key of a join whose other side has one row for it. No links give no rows.
    """
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = checkpointed(both.union(both.select("v", "u")).distinct())
    labels = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
    labels = checkpointed(labels.select("node", F.least("node", "least").alias("label")))
    while True:
        around = (both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("label").alias("near")))
        met = labels.join(around, labels.node == around.u, "left").select(
            "node", "label", F.least("label", "near").alias("next"))
        step = met.select("node", "label", "next")
        jump = step.select(F.col("node").alias("at"), F.col("next").alias("far"))
        new = step.join(jump, step.next == jump["at"], "left").select(
            "node", F.least("next", "far").alias("next"), "label")
        new = checkpointed(new)
        changed = new.where("next <> label").limit(1).count()
        labels = new.select("node", F.col("next").alias("label"))
        if not changed:
            return labels
