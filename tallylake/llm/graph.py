"""Connected components of links between long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.llm.staging import staged


def tree(members: list[int]) -> list[tuple[int, int]]:
    """Links that connect all members: each to one of half its rank. No member has more than three."""
    return [(members[(i - 1) // 2], members[i]) for i in range(1, len(members))]


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, root): each node of `links` (a, b) with the smallest node it can reach.

    Each round every node takes the smallest label among its own and its neighbours', then the label of that label,
    so chains shrink by doubling. A round is written to the shared folder; only the number of changes reaches the
    driver. Links to a common label are never joined by it without the aggregate that comes first.
    """
    both = staged(links.union(links.select("b", "a")).distinct(), "links-both-ways")
    labels = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        seen = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy("a").agg(F.min("root").alias("near"))
        )
        lower = labels.join(seen, labels.node == seen.a).select(
            "node", F.col("root").alias("was"), F.least("root", "near").alias("to"))
        lower = staged(lower, "labels-near")
        jump = lower.select(F.col("node").alias("to"), F.col("to").alias("far"))
        after = staged(
            lower.join(jump, "to", "left").select("node", "was", F.coalesce("far", "to").alias("root")), "labels")
        changed = after.where("root != was").limit(1).count()
        labels = after.select("node", "root")
        if not changed:
            return labels
