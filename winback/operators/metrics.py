"""Classification metrics as DataFrames (ML-8).

Everything derives from one (label, prediction) count table, whose size is
classes squared, so the metric frames never touch the scored rows twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion(df: DataFrame, label_col: str = "label",
              pred_col: str = "prediction") -> DataFrame:
    """Confusion matrix in long form: (label, prediction, n)."""
    return (df.groupBy(F.col(label_col).alias("label"), F.col(pred_col).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def class_report(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                 digits: int = 6) -> DataFrame:
    """Per-class precision / recall / F1 / support plus 'accuracy',
    'macro avg' and 'weighted avg' rows (sklearn's report layout; an
    undefined ratio is 0). Accuracy equals micro-F1 for single-label data."""
    cm = confusion(df, label_col, pred_col)
    tp = (cm.where(F.col("label") == F.col("prediction"))
          .select(F.col("label").alias("k"), F.col("n").alias("tp")))
    sup = cm.groupBy(F.col("label").alias("k")).agg(F.sum("n").alias("support"))
    prd = cm.groupBy(F.col("prediction").alias("k")).agg(F.sum("n").alias("predicted"))
    per = (sup.join(prd, "k", "full").join(tp, "k", "left")
           .select("k", F.coalesce("support", F.lit(0)).alias("support"),
                   F.coalesce("predicted", F.lit(0)).alias("predicted"),
                   F.coalesce("tp", F.lit(0)).alias("tp")))
    safe = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    p = safe(F.col("tp").cast("double"), F.col("predicted"))
    r = safe(F.col("tp").cast("double"), F.col("support"))
    per = per.select(F.col("k").cast("string").alias("class_name"), "support", "tp",
                     p.alias("precision"), r.alias("recall"))
    per = per.withColumn("f1", safe(2 * F.col("precision") * F.col("recall"),
                                    F.col("precision") + F.col("recall")))
    all_ = Window.partitionBy()
    tot = F.sum("support").over(all_)
    acc = F.sum("tp").over(all_) / tot
    w = F.col("support") / tot
    summary = per.select(
        F.avg("precision").over(all_).alias("mp"), F.avg("recall").over(all_).alias("mr"),
        F.avg("f1").over(all_).alias("mf"), F.sum(F.col("precision") * w).over(all_).alias("wp"),
        F.sum(F.col("recall") * w).over(all_).alias("wr"),
        F.sum(F.col("f1") * w).over(all_).alias("wf"), acc.alias("acc"),
        tot.alias("tot")).limit(1)
    def row(name, p_, r_, f_):
        return F.struct(F.lit(name).alias("class_name"), p_.cast("double").alias("precision"),
                        r_.cast("double").alias("recall"), f_.cast("double").alias("f1"),
                        F.col("tot").alias("support"))
    none = F.lit(None)
    rows = summary.select(F.explode(F.array(
        row("accuracy", none, none, F.col("acc")),
        row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        row("weighted avg", F.col("wp"), F.col("wr"), F.col("wf")),
    )).alias("s")).select("s.*")
    cols = ["class_name", "precision", "recall", "f1", "support"]
    out = per.select(*cols).unionByName(rows.select(*cols))
    return out.select("class_name", *[F.round(c, digits).alias(c)
                                      for c in ("precision", "recall", "f1")],
                      F.col("support").cast("bigint").alias("support"))


def accuracy(df: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> float:
    row = df.agg(F.avg((F.col(label_col) == F.col(pred_col)).cast("double")).alias("a")).first()
    return float(row["a"]) if row["a"] is not None else 0.0
