"""Reading source tables (SRC-1, SRC-2, SRC-3, SRC-4)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Full table scan (SRC-1). Column pruning and filters applied later are
    pushed into the Parquet reader by Catalyst."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_query(spark: SparkSession, query: str) -> DataFrame:
    """Any SQL query as a frame (SRC-2)."""
    return spark.sql(query)


def projected_scan(df: DataFrame, columns, condition=None) -> DataFrame:
    """Projection with a pre-filter over any of the table's columns (SRC-3); both reach
    the scan."""
    out = df.where(condition) if condition is not None else df
    return out.select(*columns)


def limited_scan(df: DataFrame, n: int, order_by) -> DataFrame:
    """Row-limited scan (SRC-4, LIM-1). The reference limits without ORDER BY;
    the order key makes the chosen rows repeatable. Planned as
    TakeOrderedAndProject: each task keeps its own top ``n`` before the single
    merge, so no task sees more than ``n`` rows per input partition."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    return df.orderBy(*cols).limit(n)
