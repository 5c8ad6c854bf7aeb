"""Connected components of a link table, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm import common


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each end of a link reaches.

    ``links`` has columns a and b of one orderable type; direction, repeats and
    self links don't matter, links with a null end are ignored. Each round takes
    the smallest root of a node and its neighbours and then the root of that root,
    so paths shorten to half or less; it ends when no root changes. Every round is
    stored, and only the count of changed roots comes to the driver. A node with
    very many links is a skewed join key, which adaptive execution splits, and
    minima are combined before they are shuffled.
    """
    both = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    both = common.materialise(
        both.select("a", "b").union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    roots = common.materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), F.col("root").alias("reached")), "b")
        lowest = near.groupBy(F.col("a").alias("node")).agg(F.min("reached").alias("reached"))
        stepped = roots.join(lowest, "node").select(
            "node", F.col("root").alias("was"), F.least("root", "reached").alias("via"))
        jump = roots.select(F.col("node").alias("via"), F.col("root").alias("beyond"))
        moved = stepped.join(jump, "via").select("node", "was", F.least("via", "beyond").alias("root"))
        moved = common.materialise(moved, "roots")
        if moved.filter(F.col("root") != F.col("was")).isEmpty():
            return moved.select("node", "root")
        roots = moved.select("node", "root")
