"""Connected components of an edge table, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktlens.llm.common import checkpointed


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, comp) for every end of ``edges`` (a, b); comp is the smallest
    node reachable.

    Each round takes the smallest label among neighbours, hands it to the
    label's own node too, and then jumps to the label's label, so long chains
    shrink geometrically.  Only the number of changed labels reaches the
    driver; every round cuts its lineage with a checkpoint.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = checkpointed(both.where(F.col("a") != F.col("b")).distinct())
    labels = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("comp")))
    for _ in range(max_rounds):
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("near"))
        seen = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("comp").alias("old"), F.least("comp", "near").alias("low"))
        hooks = seen.select(F.col("node"), "low").union(seen.select(F.col("old").alias("node"), "low"))
        hooked = hooks.groupBy("node").agg(F.min("low").alias("low"))
        jump = hooked.select(F.col("node").alias("low"), F.col("low").alias("next"))
        new = checkpointed(
            hooked.join(jump, "low").join(labels, "node")
            .select("node", F.least("low", "next").alias("now"), "comp"))
        changed = new.where(F.col("now") < F.col("comp")).count()
        labels = new.select("node", F.col("now").alias("comp"))
        if not changed:
            return labels
    raise RuntimeError("components did not settle")
