"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.sources.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """node and label (the least node of its component) for every node in ``edges`` (a, b).

    Each round hooks every node to its least neighbour, follows that link once
    more, and contracts the graph: edges then join labels, and those inside one
    label are gone. Rounds work on what is left, so their sizes fall quickly.
    """
    left = stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    result = None
    while True:
        # The first round keeps loops, so that every node gets a label.
        near = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = stage(near.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("up")), "hooks")
        above = hook.select(F.col("node").alias("up"), F.col("up").alias("label"))
        labels = stage(hook.join(above, "up").select("node", "label"), "labels")
        if result is None:
            result = labels
        else:
            further = labels.select(F.col("node").alias("label"), F.col("label").alias("_next"))
            result = stage(
                result.join(further, "label", "left").select("node", F.coalesce("_next", "label").alias("label")),
                "labels",
            )
        of = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"_{side}"))
        moved = left.join(of("a"), "a").join(of("b"), "b").filter("_a <> _b")
        left = stage(
            moved.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "edges"
        )
        if left.isEmpty():
            return result
