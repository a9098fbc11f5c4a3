"""Boosted trees: validation loss per round, patience, one model per class,
fits side by side (ML-3, ML-13).

``GBTClassifier`` is binary and its own early stopping gives up at the first round
that does not improve. Here a short model is fitted, and one of all rounds where
that one's loss still falls; the loss on the validation rows is read for every round
(``evaluateEachIteration``), and the rounds after the best one are cut once
``patience`` rounds brought nothing. Boosting is sequential and seeded, so a shorter
fit is the beginning of a longer one: a model of its first trees is a fit of that many
rounds, and nothing is fitted again for the cut.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Mapping, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.session import ensure_checkpoint_dir

# --- fixed values: rounds and patience of the original tuning ----------------
MAX_ROUNDS = 180
PATIENCE = 10
# -----------------------------------------------------------------------------
FIRST_LENGTH = 45           # rounds of the first fit and look; looks double while the loss still falls
CHECKPOINT_ROUNDS = 10      # rounds after which the residuals' lineage is cut
WORKERS = 6                 # fits at a time


def side_by_side(spark: SparkSession, jobs: Mapping[Hashable, Callable[[], object]],
                 workers: int = WORKERS, pool: str = "fits") -> dict:
    """Run driver-side functions (each a chain of Spark jobs) in at most ``workers``
    threads, each in a scheduler pool of its own, so that their small stages share
    the executors under fair scheduling. The first error stops what has not begun
    and is raised."""
    def run(name, job):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{pool}-{name}")
        try:
            return job()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, min(workers, len(jobs) or 1))) as ex:
        futures = {k: ex.submit(inheritable_thread_target(spark)(run), k, job) for k, job in jobs.items()}
        done, _ = wait(futures.values(), return_when=FIRST_EXCEPTION)
        if any(f.exception() for f in done):
            for f in futures.values():
                f.cancel()
        return {k: f.result() for k, f in futures.items()}


def boosted(label: str, rounds: int, max_depth: int = 5, step: float = 0.1, weight: str | None = None,
            subsample: float = 1.0, subset: str = "all", min_instances: int = 1, min_info_gain: float = 0.0,
            seed: int = 0) -> GBTClassifier:
    gbt = GBTClassifier(labelCol=label, featuresCol="features", maxIter=rounds, maxDepth=max_depth, stepSize=step,
                        subsamplingRate=subsample, featureSubsetStrategy=subset, minInstancesPerNode=min_instances,
                        minInfoGain=min_info_gain, checkpointInterval=CHECKPOINT_ROUNDS, seed=seed)
    return gbt.setWeightCol(weight) if weight else gbt


def loss_curve(model: GBTClassificationModel, rows: DataFrame) -> list[float]:
    """Mean loss on ``rows`` after each round."""
    return [float(x) for x in model.evaluateEachIteration(rows)]


def patient_round(curve: Sequence[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """(rounds to keep, whether patience ran out): the round of least loss among those
    before ``patience`` rounds in a row brought no lower one; the first of equal ones."""
    best, at = float("inf"), 0
    for i, loss in enumerate(curve, 1):
        if loss < best:
            best, at = loss, i
        elif i - at >= patience:
            return at, True
    return at, False


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first ``rounds`` rounds of ``model``, its parameters kept."""
    sc, own = SparkSession.active().sparkContext, model._java_obj
    kind = sc._jvm.org.apache.spark.ml
    trees = sc._gateway.new_array(kind.regression.DecisionTreeRegressionModel, rounds)
    weights = sc._gateway.new_array(sc._jvm.double, rounds)
    all_trees, all_weights = own.trees(), own.treeWeights()
    for i in range(rounds):
        trees[i], weights[i] = all_trees[i], all_weights[i]
    cut = kind.classification.GBTClassificationModel(own.uid(), trees, weights)
    return GBTClassificationModel(own.copyValues(cut, kind.param.ParamMap()))


@dataclass
class PatientFit:
    model: GBTClassificationModel
    rounds: int             # rounds kept
    curve: list[float]      # validation loss of all rounds looked at
    stopped: bool           # patience ran out before the last round


def fit_patient(train: DataFrame, valid: DataFrame, make: Callable[[int], GBTClassifier],
                max_rounds: int = MAX_ROUNDS, patience: int = PATIENCE, first: int = FIRST_LENGTH) -> PatientFit:
    """ML-13: ``make(rounds)`` gives the estimator. With no validation rows all rounds stay."""
    ensure_checkpoint_dir(train.sparkSession)
    if valid.isEmpty():
        return PatientFit(make(max_rounds).fit(train), max_rounds, [], False)
    length = min(first, max_rounds)
    model = make(length).fit(train)
    losses = loss_curve(model, valid)
    while True:
        curve = losses[:length]
        rounds, stopped = patient_round(curve, patience)
        if stopped or length >= max_rounds:
            break
        if len(losses) < max_rounds:
            model = make(max_rounds).fit(train)
            losses = loss_curve(model, valid)
        length = min(2 * length, max_rounds)
    if rounds < model.getNumTrees:
        model = first_rounds(model, rounds)
    return PatientFit(model, rounds, curve, stopped)


@dataclass
class BoostedClasses:
    """One binary model per class; the class of the largest margin is predicted."""
    models: dict[int, GBTClassificationModel]
    fits: dict[int, PatientFit]

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` (with a ``features`` vector) plus the predicted class; margins are
        compared by built-in expressions, equal ones go to the smaller class."""
        x, names = df, []
        for c, m in sorted(self.models.items()):
            m = m.copy().setRawPredictionCol(f"_raw_{c}").setProbabilityCol(f"_prob_{c}").setPredictionCol(f"_pred_{c}")
            x = m.transform(x)
            names.append((c, f"_raw_{c}"))
        best = F.array_max(F.array(*[F.struct(vector_to_array(raw)[1].alias("margin"), F.lit(-c).alias("c"))
                                     for c, raw in names]))
        return x.select(*[F.col(f"`{c}`") for c in df.columns], (-best["c"]).cast("double").alias(out))

    def rounds_table(self, spark: SparkSession) -> DataFrame:
        """(label, rounds, looked_at, stopped, best_loss), one row per class."""
        return spark.createDataFrame(
            [(c, f.rounds, len(f.curve), f.stopped, float(min(f.curve, default=float("nan"))))
             for c, f in sorted(self.fits.items())],
            "label int, rounds int, looked_at int, stopped boolean, best_loss double")

    def save(self, base: str) -> str:
        for c, m in self.models.items():
            m.write().overwrite().save(f"{base}/class_{c}")
        return base

    @classmethod
    def load(cls, base: str, classes: Sequence[int]) -> "BoostedClasses":
        return cls({c: GBTClassificationModel.load(f"{base}/class_{c}") for c in classes}, {})


def fit_classes(train: DataFrame, valid: DataFrame, classes: Sequence[int], label: str = "label",
                weight: str | None = "sample_weight", max_rounds: int = MAX_ROUNDS, patience: int = PATIENCE,
                max_depth: int = 5, step: float = 0.1, workers: int = WORKERS, **more) -> BoostedClasses:
    """ML-3 / ML-13: one model per class against the rest, each with its own number of
    rounds, fitted side by side. Both frames hold a ``features`` vector; store them first,
    they are read in every round."""
    def job(c):
        def fit():
            own = (F.col(label) == c).cast("double").alias("_own")
            cols = ["features", *([weight] if weight else [])]
            return fit_patient(train.select(*cols, own), valid.select(*cols, own),
                               lambda n: boosted("_own", n, max_depth, step, weight, **more), max_rounds, patience)
        return fit

    fits = side_by_side(train.sparkSession, {int(c): job(c) for c in classes}, workers)
    return BoostedClasses({c: f.model for c, f in fits.items()}, fits)
