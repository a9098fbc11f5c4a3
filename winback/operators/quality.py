"""Data-quality operators over wide attribute tables.

AGG-4..AGG-9, DQ-1..DQ-4, DEDUP-1, TOP-2, PRJ-3, PRJ-5, SNK-3.

Every report is computed in a single aggregate pass over the table for all
columns at once (the original loops over columns, one scan each); the exact profile
adds one pass for the table of distinct values. Results are
small (one row per column, or per column and bin / value) and stay
DataFrames; a driver collect happens only where a small report decides the
next plan (which columns to drop, histogram ranges).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winback.functions.numeric import coverage_percent, present, quoted
from winback.operators.values import distinct_counts, quantiles, value_table

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    """PRJ-5: numeric columns by schema (driver side, no data pass)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def categorical_columns(df: DataFrame) -> list[str]:
    """PRJ-5: text columns (pandas dtype object)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _missing(df: DataFrame, c: str):
    """pandas ``isnull``: NULL, and NaN for floating columns."""
    return present(df, c).isNull()


def _long(agg: DataFrame, names: list[str], fields: dict[str, str]) -> DataFrame:
    """Turn one wide aggregate row into one row per column name."""
    structs = [F.struct(F.lit(n).alias("column_name"),
                        *[F.col(f"{k}__{i}").alias(k) for k in fields])
               for i, n in enumerate(names)]
    rows = agg.select(F.col("row_count"), F.explode(F.array(*structs)).alias("s"))
    return rows.select("s.column_name", *[F.col(f"s.{k}").cast(t).alias(k)
                                          for k, t in fields.items()], "row_count")


def null_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """AGG-4 / AGG-6: (column_name, null_count, row_count), one pass."""
    cols = list(columns or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("row_count"),
                 *[F.count_if(_missing(df, c)).alias(f"null_count__{i}")
                   for i, c in enumerate(cols)])
    return _long(agg, cols, {"null_count": "bigint"})


def coverage(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """DQ-2: coverage percent as the original computes it
    (``int(round(1 - nulls/rows, 2) * 100)``) plus the exact ratio."""
    r = null_report(df, columns)
    return r.select("column_name", "null_count", "row_count",
                    (F.lit(1.0) - F.col("null_count") / F.col("row_count")).alias("coverage_ratio"),
                    coverage_percent("null_count", "row_count").alias("coverage_pct"))


def low_coverage_columns(df: DataFrame, min_pct: int = 60) -> list[str]:
    """Columns whose coverage percent is below ``min_pct`` (one small job;
    the collected report has one row per column)."""
    rows = coverage(df).where(F.col("coverage_pct") < min_pct).select("column_name").collect()
    return [r[0] for r in rows]


def drop_low_coverage(df: DataFrame, min_pct: int = 60) -> DataFrame:
    """DQ-3: drop columns with coverage below ``min_pct`` (0.595 rounds to
    0.6 and is kept)."""
    return df.drop(*low_coverage_columns(df, min_pct))


def drop_columns(df: DataFrame, *cols: str, strict: bool = False) -> DataFrame:
    """PRJ-3: Spark's drop ignores missing names; ``strict`` raises like pandas."""
    if strict:
        missing = [c for c in cols if c not in df.columns]
        if missing:
            raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """DQ-1 / AGG-5 / AGG-10: per column rows, nulls, distinct count (nulls and
    NaN ignored) and, for numeric columns, min / max / mean / sample std / median.

    Counts and moments are one aggregate; distinct counts and medians come from the
    value table (``values``), which holds each distinct value once. ``exact=False`` asks
    for HyperLogLog++ distinct counts and approximate medians (bounded sketches) in the
    same aggregate."""
    cols, nums = list(df.columns), set(numeric_columns(df))
    aggs = [F.count(F.lit(1)).alias("row_count")]
    fields = {"null_count": "bigint", "min_value": "double", "max_value": "double", "mean": "double", "std": "double",
              "is_numeric": "int"}
    if not exact:
        fields |= {"distinct_count": "bigint", "median": "double"}
    for i, c in enumerate(cols):
        col, num = present(df, c), c in nums
        d = col.cast("double") if num else F.lit(None).cast("double")
        made = {"null_count": F.count_if(_missing(df, c)), "min_value": F.min(d), "max_value": F.max(d),
                "mean": F.avg(d), "std": F.stddev_samp(d), "is_numeric": F.lit(int(num))}
        if not num:
            made |= {k: F.lit(None).cast("double") for k in ("min_value", "max_value", "mean", "std")}
        if not exact:
            made |= {"distinct_count": F.approx_count_distinct(col),
                     "median": F.percentile_approx(d, 0.5).cast("double") if num else F.lit(None).cast("double")}
        aggs += [e.alias(f"{k}__{i}") for k, e in made.items()]
    out = _long(df.agg(*aggs), cols, fields)
    if exact:
        v = value_table(df)
        # both have at most one row per column
        out = (out.join(F.broadcast(distinct_counts(v)), "column_name", "left")
               .join(F.broadcast(quantiles(v).select("column_name", F.col("value").alias("median"))), "column_name", "left"))
    return out.select("column_name", "row_count", "null_count",
                      F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"), "is_numeric",
                      "min_value", "max_value", F.round("mean", 6).alias("mean"),
                      F.round("std", 6).alias("std"), "median")


def top_values(df: DataFrame, columns: list[str] | None = None, k: int = 20) -> DataFrame:
    """AGG-7 / TOP-2: the ``k`` most frequent values per text column (NULLs
    ignored), ties broken by value. Counting is a (column, value) hash
    aggregate; the per-column limit is planned as a WindowGroupLimit, which
    keeps at most ``k`` rows per column in each task before the shuffle, so no
    column's full value list ever meets in one task."""
    cols = list(columns or categorical_columns(df))
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), present(df, c).cast("string").alias("value"))
        for c in cols])).alias("s")).select("s.*").where(F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("value_count"))
    w = Window.partitionBy("column_name").orderBy(F.col("value_count").desc(), F.col("value"))
    return (counts.withColumn("value_rank", F.row_number().over(w))
            .where(F.col("value_rank") <= k))


def histogram(df: DataFrame, columns: list[str] | None = None, bins: int = 50) -> DataFrame:
    """DQ-4: equal-width histogram per numeric column as a table
    (column_name, bin 1..bins, bin_lo, bin_hi, bin_count; empty bins omitted).

    One small job fetches min/max of every column; the binning is then a
    single (column, bin) hash aggregate. The maximum falls in the last bin
    (unlike ``width_bucket``); a constant column puts everything in bin 1."""
    cols = list(columns or numeric_columns(df))
    mm = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.min(present(df, c).cast("double")).alias(f"lo{i}"),
        F.max(present(df, c).cast("double")).alias(f"hi{i}"))]).first()
    parts = []
    for i, c in enumerate(cols):
        lo, hi = mm[f"lo{i}"], mm[f"hi{i}"]
        if lo is None:
            continue
        w = (hi - lo) / bins
        x = present(df, c).cast("double")
        b = (F.lit(1) if w == 0 else
             F.least(F.lit(bins), (F.floor((x - F.lit(lo)) / F.lit(w)) + 1).cast("int")))
        parts.append(F.when(x.isNotNull(), F.struct(F.lit(c).alias("column_name"),
                                                    b.cast("int").alias("bin"),
                                                    F.lit(lo).alias("lo"), F.lit(w).alias("w"))))
    long = (df.select(F.explode(F.array(*parts)).alias("s"))
            .where(F.col("s").isNotNull()).select("s.*"))
    g = long.groupBy("column_name", "bin", "lo", "w").agg(F.count(F.lit(1)).alias("bin_count"))
    return g.select("column_name", "bin",
                    (F.col("lo") + (F.col("bin") - 1) * F.col("w")).alias("bin_lo"),
                    (F.col("lo") + F.col("bin") * F.col("w")).alias("bin_hi"), "bin_count")


def drop_duplicates(df: DataFrame, subset: list[str], order_by: list[str]) -> DataFrame:
    """DEDUP-1: keep the first row of each ``subset`` group by ``order_by``
    (then by the remaining columns, so the pick is deterministic).

    Planned as a hash aggregate of ``min(struct(order, rest))``: map-side
    partial aggregation leaves one row per group per task before the shuffle,
    so a group holding a third of all rows costs no more than a small one. A
    ``row_number`` window would sort that whole group in one task."""
    rest = [c for c in df.columns if c not in subset and c not in order_by]
    packed = F.min(F.struct(*[quoted(c) for c in order_by + rest])).alias("_first")
    g = df.groupBy(*[quoted(c) for c in subset]).agg(packed)
    return g.select(*[quoted(c) if c in subset else F.col("_first").getField(c).alias(c)
                      for c in df.columns])


def duplicate_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Before / after / removed row counts of a de-duplication, one row."""
    tagged = (before.select(F.lit(1).alias("_b"), F.lit(0).alias("_a"))
              .unionByName(after.select(F.lit(0).alias("_b"), F.lit(1).alias("_a"))))
    c = tagged.agg(F.sum("_b").cast("bigint").alias("rows_before"),
                   F.sum("_a").cast("bigint").alias("rows_after"))
    return c.select(F.coalesce("rows_before", F.lit(0)).alias("rows_before"),
                    F.coalesce("rows_after", F.lit(0)).alias("rows_after"),
                    F.coalesce(F.col("rows_before") - F.col("rows_after"), F.lit(0))
                    .alias("rows_removed"))
