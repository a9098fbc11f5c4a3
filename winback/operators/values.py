"""Value table of a wide table: (column, value, row count), and what is read from it:
distinct counts, exact quantiles, modes, frequent values (AGG-5, AGG-7, AGG-9, AGG-10).

One pass makes a struct per cell and counts equal ones before the shuffle, so a column
costs its distinct values and not its rows, and no row is expanded once per distinct
aggregate. Quantiles need running counts over a column's sorted values: the table is
range-partitioned on (column, value) and stored, a small table of counts per (range
partition, column) says in which partition a rank lies, and only those partitions'
values are summed up. No column is ever sorted in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winback.functions.numeric import present
from winback.sources.io import materialize

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, _NUMERIC)


def value_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, number, text, value_count): every distinct value of every column,
    missing ones left out, stored in the order (column, number, text) with its range
    partition ``part``. ``number`` is the value as a double (NULL for other columns);
    ``text`` tells values apart that are equal as doubles (NULL for floats)."""
    cells = []
    for c in columns if columns is not None else df.columns:
        v, kind = present(df, c), df.schema[c].dataType
        floating = isinstance(kind, (T.FloatType, T.DoubleType))
        cells.append(F.struct(F.lit(c).alias("column_name"),
                              (v.cast("double") if is_numeric(df, c) else F.lit(None).cast("double")).alias("number"),
                              (F.lit(None).cast("string") if floating else v.cast("string")).alias("text")))
    key = ["column_name", "number", "text"]
    long = df.select(F.explode(F.array(*cells)).alias("s")).select("s.*")
    counts = (long.where(F.col("number").isNotNull() | F.col("text").isNotNull())
              .groupBy(*key).agg(F.count(F.lit(1)).alias("value_count")))
    return materialize(counts.repartitionByRange(*key).sortWithinPartitions(*key)
                       .withColumn("part", F.spark_partition_id()), "values")


def distinct_counts(values: DataFrame) -> DataFrame:
    """(column_name, distinct_count)."""
    return values.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count"))


def modes(values: DataFrame) -> DataFrame:
    """(column_name, number, text, value_count): the most frequent value, the smallest of
    equally frequent ones; a hash aggregate, no sort."""
    best = F.min(F.struct((-F.col("value_count")).alias("n"), "number", "text")).alias("m")
    return values.groupBy("column_name").agg(best).select(
        "column_name", "m.number", "m.text", (-F.col("m.n")).alias("value_count"))


def quantiles(values: DataFrame, at: Sequence[float] = (0.5,)) -> DataFrame:
    """(column_name, quantile, value) of the numeric columns of a ``value_table``, exact,
    interpolated between neighbours (0.5 is the median)."""
    v = values.where(F.col("number").isNotNull())
    # at most (range partitions + columns) rows: a range partition that holds several columns
    # holds all but its first and last of them whole
    counts: dict[str, list] = {}
    for c, part, m in sorted(v.groupBy("column_name", "part").agg(F.sum("value_count")).collect()):
        counts.setdefault(c, []).append((part, m))
    targets = []
    for c, parts in counts.items():
        total = sum(m for _, m in parts)
        for q in at:
            h = (total - 1) * float(q)
            low, high = math.floor(h), math.ceil(h)
            for rank, share in {low: 1.0 - (h - low), high: h - low or 1.0}.items():
                before = 0
                for part, m in parts:
                    if rank < before + m:
                        targets.append((c, part, float(q), rank, before, share))
                        break
                    before += m
    spark = values.sparkSession
    t = spark.createDataFrame(targets, "column_name string, part int, quantile double, rank long, before long, share double")
    # a rank's partition only: its values from below until they reach the rank
    key = ["column_name", "quantile", "rank", "share"]
    w = Window.partitionBy(*key).orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    reached = (v.join(F.broadcast(t), ["column_name", "part"])
               .withColumn("upto", F.col("before") + F.sum("value_count").over(w))
               .where(F.col("upto") > F.col("rank")))
    hit = reached.groupBy(*key).agg(F.min("number").alias("number"))
    return hit.groupBy("column_name", "quantile").agg(F.sum(F.col("number") * F.col("share")).alias("value"))


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, median) of numeric columns, exact."""
    return quantiles(value_table(df, columns)).select("column_name", F.col("value").alias("median"))
