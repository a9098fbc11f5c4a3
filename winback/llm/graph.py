"""Connected components of a link table, by joins of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.llm.common import release, stored


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b): comp is the smallest node
    reachable, a stored table. Each round takes the smallest label among neighbours and then the
    label's own label, so the rounds grow with the logarithm of path lengths.
    Sums and minima are combined before each shuffle: a node with many links is
    never one task."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    label = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("comp"))
    label = stored(label, "labels")
    while True:
        near = (both.join(label.select(F.col("node").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("_near")))
        own = label.join(near, "node").select("node", "comp", F.least("comp", "_near").alias("_new"))
        up = label.select(F.col("node").alias("_new"), F.col("comp").alias("_up"))
        nxt = stored(own.join(up, "_new").select("node", F.least("_new", "_up").alias("comp"),
                                                 (F.least("_new", "_up") != F.col("comp")).alias("_moved")), "labels")
        release(label)
        label = nxt
        if not nxt.where("_moved").limit(1).count():
            release(both)
            return label
