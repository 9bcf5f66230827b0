"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for each node of the (a, b) links: the smallest node it is linked with over any
    number of links.

    Each round a node takes the smallest label among its neighbours, then its label's own label, so
    the rounds grow with the logarithm of the longest path. Labels are written between rounds. The
    neighbours' labels are combined before the shuffle, so a node with very many links is no burden.
    """
    both = saved(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp"))
    labels = saved(labels.select("node", F.least("node", "comp").alias("comp")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("a"), "comp").hint("merge"), "a")
            .groupBy(F.col("b").alias("node")).agg(F.min("comp").alias("_near"))
        )
        lower = labels.join(near.hint("merge"), "node").select(
            "node", F.col("comp").alias("_old"), F.least("comp", "_near").alias("_comp")
        )
        jump = labels.select(F.col("node").alias("_comp"), F.col("comp").alias("_next"))
        after = saved(
            lower.join(jump.hint("merge"), "_comp", "left")
            .select("node", "_old", F.least("_comp", F.coalesce("_next", "_comp")).alias("comp")),
            "labels",
        )
        labels = after.select("node", "comp")
        if after.where("_old <> comp").isEmpty():
            return labels
