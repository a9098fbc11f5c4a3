"""Exact ranks and n-tiles inside groups without a per-group window.

A window ``PARTITION BY g ORDER BY o`` sorts each whole group in one task; a
group holding a third of the table would be a third of the table in one task.
Here rows are range-partitioned on (group, order) so a big group spans many
tasks, numbered inside each sorted partition, and given an offset from a small
(partition x group) count table. The numbering is made stable under task
retries by cutting the lineage with ``checkpoint()`` into the shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winback.functions.numeric import present, quoted
from winback.session import ensure_checkpoint_dir

# Count rows that are broadcast; range partitions hold at most one row per
# partition and per group, so more means that many groups, which are joined.
STATS_MAX_ROWS = 1_000_000


def rank_within_group(df: DataFrame, group: str, order_cols: Sequence[str],
                      num_partitions: int | None = None) -> DataFrame:
    """Adds ``group_rank`` (1-based, by ``order_cols``, which must be unique
    inside a group) and ``group_size``."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # Without an explicit count AQE sizes the range shuffle from the data
    # (coalescing to the advisory partition size); ids are read after it.
    parted = (df.repartitionByRange(num_partitions, group, *order_cols) if num_partitions
              else df.repartitionByRange(group, *order_cols))
    s = (parted
         .sortWithinPartitions(group, *order_cols)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint(eager=True))
    stats = s.groupBy("_pid", group).agg(F.count(F.lit(1)).alias("_n"),
                                         F.min("_mid").alias("_first"))
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select("_pid", group, "_first",
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
                         F.sum("_n").over(Window.partitionBy(group)).alias("group_size"))
    # counted on the checkpointed rows' small aggregate; the broadcast keeps the
    # rows where they are (AQE alone would shuffle them before it knew the size)
    if stats.limit(STATS_MAX_ROWS + 1).count() <= STATS_MAX_ROWS:
        stats = F.broadcast(stats)
    j = s.join(stats, ["_pid", group])
    return j.select(*[quoted(c) for c in df.columns], (F.col("_offset") + F.col("_mid") - F.col("_first") + 1)
                    .alias("group_rank"), "group_size")


def ntile_within_group(df: DataFrame, group: str, order_cols: Sequence[str], buckets: int,
                       out: str = "ntile") -> DataFrame:
    """``ntile(buckets) OVER (PARTITION BY group ORDER BY order_cols)`` with
    the same bucket sizes (the first ``size % buckets`` buckets one row
    larger), computed from the distributed rank."""
    r = rank_within_group(df, group, order_cols)
    k, size = F.col("group_rank"), F.col("group_size")
    q = F.floor(size / buckets)          # exact: integers well below 2^53
    rem = size - q * buckets
    big = rem * (q + 1)                  # rows in the larger buckets
    tile = F.when(k <= big, F.floor((k - 1) / (q + 1)) + 1).otherwise(
        rem + F.floor((k - big - 1) / F.greatest(q, F.lit(1))) + 1)
    return r.select(*[quoted(c) for c in df.columns], tile.cast("int").alias(out))
