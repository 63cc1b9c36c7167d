"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import stored


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of numbered nodes to rows (node, root): root is the smallest node that can be reached.

    Each round takes the smallest root among a node's neighbours, then the root of that root, so that long chains
    close in about as many rounds as the logarithm of their length. Rounds are written to the shared folder.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = roots.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = roots.select(F.col("node").alias("root"), F.col("root").alias("far"))
        moved = stored(step.join(jump, "root", "left").select("node", "old", F.least("root", "far").alias("root")), "roots")
        done = moved.where("root <> old").limit(1).count() == 0
        roots = moved.select("node", "root")
        if done:
            return roots
