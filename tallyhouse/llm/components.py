"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.work_tables import WorkTables


def components(links: DataFrame, work: WorkTables, name: str) -> DataFrame:
    """(node, label) for every node of links (a, b); nodes of a component share the smallest of them.

    Each round every node takes the smallest label among itself and its neighbours, then that label's own
    label, so chains shorten by halves. Links inside one label are dropped as they arise; the driver sees
    only whether any are left.
    """
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = work.keep(nodes.withColumn("label", F.col("node")), f"{name}-labels-0")
    left = work.keep(links.select("a", "b").where("a <> b").distinct(), f"{name}-links-0")
    step = 0
    while not left.isEmpty():
        step += 1
        both = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).where(F.col("low") < F.col("a"))
        # A root hooks onto its smallest neighbour; links only go to smaller labels, so no cycle arises
        hooks = work.keep(lowest.select(F.col("a").alias("root"), F.col("low").alias("onto")), f"{name}-hooks-{step}")
        onto = hooks.select(F.col("root").alias("onto"), F.col("onto").alias("further"))
        hooks = hooks.join(onto, "onto", "left").select(
            "root", F.coalesce("further", "onto").alias("onto")
        )
        hooks = work.keep(hooks, f"{name}-short-{step}")
        labels = work.keep(
            labels.join(hooks, labels["label"] == hooks["root"], "left").select(
                "node", F.coalesce("onto", "label").alias("label")
            ),
            f"{name}-labels-{step}",
        )
        moved_a = hooks.select(F.col("root").alias("a"), F.col("onto").alias("new_a"))
        moved_b = hooks.select(F.col("root").alias("b"), F.col("onto").alias("new_b"))
        left = work.keep(
            left.join(moved_a, "a", "left")
            .join(moved_b, "b", "left")
            .select(F.coalesce("new_a", "a").alias("a"), F.coalesce("new_b", "b").alias("b"))
            .where("a <> b")
            .distinct(),
            f"{name}-links-{step}",
        )
        work.drop(
            f"{name}-labels-{step - 1}", f"{name}-links-{step - 1}", f"{name}-hooks-{step}", f"{name}-short-{step}"
        )
    return labels
