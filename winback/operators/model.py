"""Channel classifier: fit, feature importance, narrowing, parameter search
(ML-3..ML-7, TOP-1, PRJ-4).

All fitting is distributed ``pyspark.ml``. No boosting library exists in the
image, so the multiclass model is a RandomForestClassifier with row weights;
boosted trees, one model per class, are in ``boosting``. Frames carry one
``features`` vector whose metadata names its columns, so narrowing to the best
features is a ``VectorSlicer`` by name. Rows are ``dealt`` to all cores before a fit. Small driver-side state only: importances
(one number per feature), trial parameters and scores.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winback.operators.metrics import accuracy

# --- fixed values: search space of the original tuning (ranges) -------------
SEARCH_SPACE = {
    "max_depth": (3, 18),            # integer draws
    "colsample_bytree": (0.5, 1.0),  # feature fraction per tree
    "min_child_weight": (0, 10),     # integer draws; Spark needs >= 1 row per node
    "gamma": (1.0, 9.0),             # min loss reduction of a split, summed over the rows
}
N_TREES = 180
TRIALS = 3
TOP_FEATURES = 30
# -----------------------------------------------------------------------------

TASK_ROWS = 10_000          # rows that are worth a task of their own
MOST_ROWS = 500_000         # rows of a task at most, whatever the number of cores


def dealt(df: DataFrame, key: str = "customer_id", task_rows: int = TASK_ROWS, most_rows: int = MOST_ROWS) -> DataFrame:
    """All rows of ``df`` in a partition per core of the session, of ``task_rows`` rows or
    more and ``most_rows`` or less. Every pass of a fit is one task a partition, and a
    stored frame of few files is read by few tasks, however many rows they hold. Dealt and
    sorted by ``key``; a frame of few rows is returned as it is."""
    rows = df.count()
    tasks = min(rows // task_rows, max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // most_rows)))
    return df.repartition(tasks, key).sortWithinPartitions(key) if tasks > 1 else df


def with_features(df: DataFrame, features: Sequence[str], keep: Sequence[str], out: str = "features") -> DataFrame:
    """``keep`` plus one vector column at the model boundary; inputs must be imputed
    (NULL raises, as ``handleInvalid='error'``)."""
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df).select(*keep, out)


def feature_names(df: DataFrame, vector: str = "features") -> list[str]:
    """Names of a vector column's entries, from its metadata."""
    attrs = df.schema[vector].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted((a for kind in attrs.values() for a in kind), key=lambda a: a["idx"])]


def narrowed(df: DataFrame, names: Sequence[str], vector: str = "features") -> DataFrame:
    """ML-4 / PRJ-4: the vector cut to the named entries, in that order."""
    keep = [c for c in df.columns if c != vector]
    cut = VectorSlicer(inputCol=vector, outputCol="_cut", names=list(names)).transform(df)
    return cut.select(*keep, F.col("_cut").alias(vector, metadata=cut.schema["_cut"].metadata))


def forest(label: str = "label", weight: str | None = "sample_weight", num_trees: int = N_TREES,
           max_depth: int = 6, subset: str = "auto", min_instances: int = 1,
           min_info_gain: float = 0.0, seed: int = 0) -> RandomForestClassifier:
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees,
                                maxDepth=max_depth, featureSubsetStrategy=subset,
                                minInstancesPerNode=min_instances, minInfoGain=min_info_gain,
                                seed=seed)
    if weight:
        rf.setWeightCol(weight)
    return rf


def predict(model, df: DataFrame) -> DataFrame:
    """ML-7: predictions keep every input column (the customer key included),
    so no positional re-join is needed."""
    return model.transform(df)


def feature_importance(model: RandomForestClassificationModel, features: Sequence[str], spark: SparkSession,
                       k: int = TOP_FEATURES) -> DataFrame:
    """ML-4 / TOP-1: the ``k`` most important features as a table
    (feature, importance, importance_rank). The input is one number per
    feature, so the unpartitioned rank window sees at most that many rows."""
    imp = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)],
                               "feature string, importance double")
    order = [F.col("importance").desc(), F.col("feature")]
    return (df.withColumn("importance_rank", F.row_number().over(Window.orderBy(*order)))
            .where(F.col("importance_rank") <= k))


def draw_params(n: int = TRIALS, seed: int = 0, space=SEARCH_SPACE) -> list[dict]:
    """ML-5: seeded random draws from the search space (the Bayesian sampler
    of the original is a single-machine tool; with three trials a random
    draw is the honest equivalent)."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        out.append({
            "max_depth": rng.randint(*space["max_depth"]),
            "colsample_bytree": rng.uniform(*space["colsample_bytree"]),
            "min_child_weight": rng.randint(*space["min_child_weight"]),
            "gamma": rng.uniform(*space["gamma"]),
        })
    return out


def forest_of(params: dict, rows: int, label: str = "label", weight: str | None = "sample_weight",
              seed: int = 0) -> RandomForestClassifier:
    """The forest of one parameter row. ``gamma`` asks for a loss reduction summed over a
    node's rows, Spark for one per row: it is spread over the ``rows`` of the root."""
    return forest(label, weight, num_trees=params["n_estimators"], max_depth=params["max_depth"],
                  subset=f"{params['colsample_bytree']:.4f}", min_instances=max(1, params["min_child_weight"]),
                  min_info_gain=params["gamma"] / max(1, rows), seed=seed)


def random_search(train: DataFrame, valid: DataFrame, label: str = "label", weight: str | None = "sample_weight",
                  trials: int = TRIALS, num_trees: int = N_TREES, seed: int = 0) -> DataFrame:
    """ML-5 / ML-6: fit one weighted forest per drawn parameter set over frames with a
    ``features`` vector (store them first), score accuracy on the given validation rows,
    return the trials as a table: the parameter table that ``best_params`` reads."""
    n, rows = train.count(), []
    for i, p in enumerate(draw_params(trials, seed)):
        p["n_estimators"] = num_trees
        m = forest_of(p, n, label, weight, seed).fit(train)
        acc = accuracy(predict(m, valid), label, "prediction")
        rows.append((i, p["max_depth"], float(p["colsample_bytree"]), p["min_child_weight"],
                     float(p["gamma"]), num_trees, acc))
    return train.sparkSession.createDataFrame(
        rows, "trial int, max_depth int, colsample_bytree double, min_child_weight int, gamma double, "
              "n_estimators int, val_accuracy double")


def best_params(trials: DataFrame) -> dict:
    """The parameters of the best trial, the first of equal ones."""
    return trials.orderBy(F.col("val_accuracy").desc(), F.col("trial")).first().asDict()


def save_model(model, path: str) -> str:
    """ML-6: persist a fitted model (overwrite; a path in the shared folder)."""
    model.write().overwrite().save(path)
    return path


def load_forest(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)
