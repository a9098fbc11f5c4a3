"""Inner join with keys that hold a large share of the left rows (JOIN-2).

An equi join sends all rows of a key to one task; AQE splits a large partition only by
what it sees after the shuffle, and not below its size thresholds. Here the heavy keys are
counted first: a key with more than ``share`` of the left rows is heavy, so there are
fewer than ``1 / share`` of them whatever the table's size. Their left rows get one of
``salts`` numbers, and the right side's rows of those few keys one copy for each, so a heavy key is
``salts`` join keys. Other keys get salt 0 on both sides: one join, each match once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

SHARE = 0.01
SALTS = 64


def heavy_keys(left: DataFrame, key: str, share: float = SHARE) -> list:
    """Keys of more than ``share`` of the left rows, exactly counted in one job: the
    ``1 / share`` most frequent keys and, on the way, the number of rows."""
    seen = Observation()
    counts = (left.select(key).observe(seen, F.count(F.lit(1)).alias("rows"))
              .where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")))
    most = counts.orderBy(F.desc("n"), key).limit(int(1 / share) + 1).collect()
    return [r[0] for r in most if r.n > share * seen.get["rows"]]


def skewed_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, share: float = SHARE,
                salts: int = SALTS) -> DataFrame:
    """``left`` inner join ``right`` on one key; all columns of both (their names differ)."""
    heavy = heavy_keys(left, left_key, share)
    if not heavy:
        return left.join(right, F.col(left_key) == F.col(right_key))
    zero = F.lit(0).cast("long")
    # a row's salt follows from the row, so a task that is run again deals it the same way
    spread = F.pmod(F.xxhash64(*left.columns, F.monotonically_increasing_id()), F.lit(salts))
    a = left.withColumn("_salt", F.when(F.col(left_key).isin(heavy), spread).otherwise(zero))
    every = F.sequence(zero, F.lit(salts - 1).cast("long"))
    b = right.withColumn("_copy", F.explode(F.when(F.col(right_key).isin(heavy), every).otherwise(F.array(zero))))
    return (a.join(b, (F.col(left_key) == F.col(right_key)) & (F.col("_salt") == F.col("_copy")))
            .drop("_salt", "_copy"))
