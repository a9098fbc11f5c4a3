"""Model operators: behaviour on separable tables, repeatability, patience, narrowing,
calibrated product scores, the recorded and restarted jobs."""

import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from winback.operators import boosting, product_trees
from winback.operators import model as mdl
from winback.operators import propensity as prop
from winback.plans import jobs
from winback.session import scratch_path
from winback.sources import io
from winback.sources.fixtures import Fixtures
from winback.sources.manifest import RunManifest

SMALL = {"rounds": 12, "depth": 3, "rate": 0.3, "subsample": 0.9, "colsample": 0.6}


def _separable(spark, n=300):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        y = i % 3
        rows.append((i, y, y * 10 + rng.random(), rng.random(), 1.0))
    df = spark.createDataFrame(rows, "customer_id bigint, label int, f1 double, f2 double, sample_weight double")
    return mdl.with_features(df, ["f2", "f1"], ["customer_id", "label", "sample_weight"])


def _base(spark):
    return scratch_path(spark, f"test_{uuid.uuid4().hex[:12]}")


def test_forest_beats_majority_and_is_repeatable(spark):
    df = _separable(spark)
    m1 = mdl.forest(num_trees=10, max_depth=3).fit(df)
    acc = (mdl.predict(m1, df).select(F.avg((F.col("prediction") == F.col("label"))
                                            .cast("double"))).first()[0])
    assert acc > 0.9
    m2 = mdl.forest(num_trees=10, max_depth=3).fit(df)
    p1 = [r.prediction for r in mdl.predict(m1, df).orderBy("customer_id").collect()]
    p2 = [r.prediction for r in mdl.predict(m2, df).orderBy("customer_id").collect()]
    assert p1 == p2
    imp = mdl.feature_importance(m1, mdl.feature_names(df), spark, k=1).collect()
    assert imp[0].feature == "f1"


def test_narrowing_by_name_survives_a_stored_frame(spark):
    df = io.materialize(_separable(spark, 30))
    assert mdl.feature_names(df) == ["f2", "f1"]
    cut = mdl.narrowed(df, ["f1"])
    assert mdl.feature_names(cut) == ["f1"] and cut.columns == df.columns
    whole = {r.customer_id: r.features[1] for r in df.collect()}
    assert {r.customer_id: r.features[0] for r in cut.collect()} == whole


def test_random_search_returns_one_row_per_trial(spark):
    df = _separable(spark, 150)
    t = mdl.random_search(df, df, trials=2, num_trees=5)
    assert t.count() == 2
    best = mdl.best_params(t)
    assert best["val_accuracy"] == max(r.val_accuracy for r in t.collect())
    assert mdl.forest_of(best, 150).getNumTrees() == 5


def test_patience():
    falls_then_rises = [5, 4, 3, 2, 2.5, 2.4, 2.3, 2.2, 1]
    assert boosting.patient_round(falls_then_rises, 3) == (4, True)
    assert boosting.patient_round(falls_then_rises, 4) == (4, True)
    assert boosting.patient_round(falls_then_rises, 5) == (9, False)
    assert boosting.patient_round([2, 2, 2, 2], 3) == (1, True)         # equal is not lower
    assert boosting.patient_round([3, 2, 1], 1) == (3, False)
    assert boosting.patient_round([1, 2], 1) == (1, True) and boosting.patient_round([], 3) == (0, False)


def test_rounds_after_the_best_are_cut(spark):
    # validation labels disagree with the noise that late rounds learn: the loss rises again
    rng = random.Random(3)
    def rows(n, noise):
        out = []
        for i in range(n):
            x = rng.random()
            out.append((float((x > 0.5) != (rng.random() < noise)), x, rng.random()))
        return mdl.with_features(spark.createDataFrame(out, "y double, a double, b double"), ["a", "b"], ["y"])
    train, valid = io.materialize(rows(200, 0.25).coalesce(1)), io.materialize(rows(200, 0.25).coalesce(1))
    make = lambda n: boosting.boosted("y", n, max_depth=5, step=0.5)
    fit = boosting.fit_patient(train, valid, make, max_rounds=24, patience=5, first=6)
    assert fit.stopped and 1 <= fit.rounds < len(fit.curve)
    assert fit.curve[fit.rounds - 1] == min(fit.curve) < fit.curve[-1]
    assert fit.model.getNumTrees == fit.rounds
    # the shorter fit is the beginning of the longer one
    again = boosting.loss_curve(fit.model, valid)
    assert again == pytest.approx(fit.curve[:fit.rounds], abs=1e-9)
    none = boosting.fit_patient(train, valid.limit(0), make, max_rounds=2)
    assert none.rounds == 2 and not none.stopped


def test_boosted_classes_save_and_reload(spark):
    df = io.materialize(_separable(spark, 150).coalesce(1))
    fit = boosting.fit_classes(df, df, [0, 1, 2], max_rounds=3, max_depth=2)
    again = boosting.BoostedClasses.load(fit.save(_base(spark)), [0, 1, 2])
    got = again.transform(df)
    assert got.columns == [*df.columns, "prediction"]
    assert got.where("prediction = label").count() > 140
    assert [r.label for r in fit.rounds_table(spark).orderBy("label").collect()] == [0, 1, 2]


def test_side_by_side_raises_the_first_error(spark):
    assert boosting.side_by_side(spark, {1: lambda: spark.range(3).count(), 2: lambda: 5}) == {1: 3, 2: 5}
    with pytest.raises(ZeroDivisionError):
        boosting.side_by_side(spark, {i: (lambda i=i: 1 // i) for i in (1, 0)})
    assert boosting.side_by_side(spark, {}) == {}


def test_product_trees_against_a_plain_boosting():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 6, (80, 3)).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 3)).astype(float)
    m = product_trees.fit(x, y, rounds=4, depth=2, rate=0.5, subsample=1.0, colsample=1.0)

    def grow(rows, g, h, depth):
        lam = product_trees.LAMBDA
        best = (1e-9, None)
        for f in range(3) if depth else ():
            for cut in np.unique(x[:, f])[:-1]:
                lo, hi = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(h[lo].sum(), h[hi].sum()) < product_trees.MIN_CHILD_WEIGHT:
                    continue
                gain = sum(g[r].sum() ** 2 / (h[r].sum() + lam) for r in (lo, hi)) - g[rows].sum() ** 2 / (h[rows].sum() + lam)
                if gain > best[0] + 1e-12:
                    best = (gain, lo, hi)
        if best[1] is None:
            return [(rows, -0.5 * g[rows].sum() / (h[rows].sum() + lam))]
        return grow(best[1], g, h, depth - 1) + grow(best[2], g, h, depth - 1)

    margin = np.full(80, np.log(y.mean() / (1 - y.mean())))
    for _ in range(4):
        p = 1 / (1 + np.exp(-margin))
        step = np.zeros(80)
        for rows, v in grow(np.arange(80), p - y, p * (1 - p), 2):
            step[rows] = v
        margin = margin + step
    assert product_trees.margins(m, x) == pytest.approx(margin)
    again = product_trees.unpacked(product_trees.packed(m))
    assert product_trees.margins(again, x).tolist() == product_trees.margins(m, x).tolist()
    none = product_trees.fit(np.empty((0, 3)), np.empty(0), rounds=2)
    assert np.isfinite(product_trees.margins(none, x)).all()


def test_isotonic_against_all_steps():
    rng = np.random.default_rng(1)
    s, y = rng.integers(0, 12, 60) / 12, rng.integers(0, 2, 60).astype(float)
    b, p = product_trees.isotonic(s, y)
    assert (np.diff(b) > 0).all() and (np.diff(p) >= 0).all()
    u = np.unique(s)
    mean = lambda i, j: y[(s >= u[i]) & (s <= u[j])].mean()
    want = [max(min(mean(i, j) for j in range(k, len(u))) for i in range(k + 1)) for k in range(len(u))]
    assert np.interp(u, b, p) == pytest.approx(want)


def test_product_scores(spark, sf_dir):
    tr = Fixtures(spark, sf_dir).propensity_training()
    frame = io.materialize(prop.training_frame(tr))
    models = io.materialize(prop.fit_product_models(frame, [1, 2], params=SMALL))
    again = {r.product: bytes(r.model) for r in prop.fit_product_models(frame, [1, 2], params=SMALL).collect()}
    assert {r.product: bytes(r.model) for r in models.collect()} == again
    score = tr.drop("pdm_prod_type_id").distinct()
    long = prop.score_long(score, models, [1, 2], batch=1)
    n = score.count()
    assert long.count() == 2 * n and long.where("p is null or p < 0 or p > 1").count() == 0
    wide = prop.score_wide(long, [1, 2])
    assert wide.count() == n and wide.columns == ["customer_id", "p1", "p2"]
    sample = prop.training_frame(tr, max_rows=100)
    assert 20 < sample.count() <= 100


def test_many_products_plan_in_batches(spark, sf_dir):
    """100 products: every batch is a plan of its own, the last no larger than the first."""
    tr = Fixtures(spark, sf_dir).propensity_training()
    frame = io.materialize(prop.training_frame(tr))
    one = prop.fit_product_models(frame, [1], params=SMALL | {"rounds": 2}).first()
    models = io.materialize(spark.createDataFrame(
        [(p, one.fit_rows, one.held_rows, bytes(one.model)) for p in range(100)],
        "product int, fit_rows long, held_rows long, model binary"))
    score = io.materialize(prop.score_frame(tr.drop("pdm_prod_type_id").distinct()))
    batches = prop.batches_of(list(range(100)))
    plans = [prop.score_batch(score, models, b)._jdf.queryExecution().optimizedPlan().toString() for b in (batches[0], batches[-1])]
    assert len(plans[0].splitlines()) == len(plans[1].splitlines()) < 6
    long = prop.score_long(tr.drop("pdm_prod_type_id").distinct(), models, list(range(100)))
    wide = prop.score_wide(long, list(range(100)))
    assert len(wide.columns) == 101 and wide.count() == score.count()


def test_scoring_job_goes_on_behind_its_last_stage(spark, sf_dir, monkeypatch):
    fx, base, fits = Fixtures(spark, sf_dir), _base(spark), []
    fit = prop.fit_product_models
    monkeypatch.setattr(prop, "fit_product_models", lambda *a, **k: fits.append(1) or fit(*a, **k))
    score = prop.score_batch

    def killed(*a, **k):
        raise KeyboardInterrupt
    monkeypatch.setattr(prop, "score_batch", killed)
    with pytest.raises(KeyboardInterrupt):
        jobs.run_scoring_job(fx, base, SMALL, batch=4)
    assert len(fits) == 1
    monkeypatch.setattr(prop, "score_batch", score)
    out = f"{base}/out"
    paths = jobs.run_scoring_job(fx, base, SMALL, out, batch=4)
    assert len(fits) == 2                           # the second batch of products only
    wide = sorted(map(tuple, io.read_table(spark, out).collect()))
    assert len(wide) == 150 and len(paths["long"]) == 2
    monkeypatch.setattr(prop, "score_batch", killed)            # nothing is left to do
    again = jobs.run_scoring_job(fx, base, SMALL, out, batch=4)
    assert sorted(map(tuple, io.read_table(spark, again["wide"]).collect())) == wide
    with pytest.raises(KeyboardInterrupt):          # other parameters are other stages
        jobs.run_scoring_job(fx, base, SMALL | {"rate": 0.2}, batch=4)


def test_channel_job_reads_its_tables(spark, sf_dir):
    fx, base = Fixtures(spark, sf_dir), _base(spark)
    paths = jobs.run_channel_job(fx, base, k=5, trials=2, num_trees=4)
    best = [r.feature for r in spark.read.parquet(paths["importance"]).orderBy("importance_rank").collect()]
    assert len(best) == 5
    m, params = mdl.load_forest(paths["model"]), mdl.best_params(spark.read.parquet(paths["trials"]))
    assert m.numFeatures == 5 and m.getNumTrees == 4 and m.getMaxDepth() == params["max_depth"]
    r = spark.read.parquet(paths["reports"])
    assert {(x.split, x.class_name) for x in r.collect()} >= {("train", "accuracy"), ("test", "accuracy")}
    names = {s["stage"] for s in RunManifest(spark, base).stages()}
    assert names == {f"channel_{n}" for n in ("frame", "importance", "trials", "model", "reports")}


@pytest.mark.parametrize("depth", [1, 3, 5, 6])
def test_scorer_takes_the_leaves_of_the_walk(depth):
    rng = np.random.default_rng(depth)
    x = np.round(rng.normal(size=(1500, 7)), 1)
    y = ((x[:, 0] * x[:, 1] > 0.1) ^ (rng.random(1500) < 0.1)).astype(float)
    m = product_trees.fit(x, y, rounds=25, depth=depth, rate=0.3)
    odd = np.vstack([x, np.full((1, 7), np.inf), np.full((1, 7), -np.inf), np.full((1, 7), np.nan)])
    assert (product_trees.scorer(m)(odd) == product_trees.walked(m, odd)).all()
    assert len(product_trees.scorer(m)(odd[:0])) == 0


def test_cut_model_is_the_shorter_fit_and_is_not_fitted_again(spark):
    rng = random.Random(5)
    rows = [(float((rng.random() < 0.3) != (x > 0.5)), x, rng.random()) for x in (rng.random() for _ in range(300))]
    df = mdl.with_features(spark.createDataFrame(rows, "y double, a double, b double"), ["a", "b"], ["y"])
    train, valid = (io.materialize(d.coalesce(1)) for d in df.randomSplit([0.5, 0.5], seed=1))
    lengths = []

    def make(n):
        lengths.append(n)
        return boosting.boosted("y", n, max_depth=5, step=0.5)

    fit = boosting.fit_patient(train, valid, make, max_rounds=30, patience=9, first=4)
    assert fit.stopped and lengths == [4, 30] and len(fit.curve) < 30
    want, path = make(fit.rounds).fit(train), _base(spark)
    fit.model.write().overwrite().save(path)
    for m in (fit.model, boosting.GBTClassificationModel.load(path)):
        assert m.getNumTrees == fit.rounds and m.getMaxDepth() == 5 and m.treeWeights == want.treeWeights
        assert m.toDebugString.split("\n")[1:] == want.toDebugString.split("\n")[1:]
        assert m.transform(valid).collect() == want.transform(valid).collect()


def test_rows_of_one_file_are_dealt_to_all_cores(spark):
    df = spark.range(4 * mdl.TASK_ROWS, numPartitions=1).select(F.col("id").alias("customer_id"), F.lit(1.0).alias("x"))
    many = mdl.dealt(df)
    sizes = many.groupBy(F.spark_partition_id()).count().collect()
    assert many.rdd.getNumPartitions() == min(4, spark.sparkContext.defaultParallelism)
    assert sum(r["count"] for r in sizes) == 4 * mdl.TASK_ROWS == many.select("customer_id").distinct().count()
    assert max(r["count"] for r in sizes) < 1.2 * min(r["count"] for r in sizes)
    assert mdl.dealt(df, most_rows=mdl.TASK_ROWS // 2, task_rows=2_000).rdd.getNumPartitions() >= 8
    few = df.limit(mdl.TASK_ROWS)
    assert mdl.dealt(few) is few


FEATURES = ["a", "b", "c", "d"]


def _labelled(spark, n, parts=6):
    """Rows of customers with up to three products, some without any, and columns of many, few
    and heavy values."""
    k = F.col("id")
    noise = lambda seed: F.pmod(F.xxhash64(F.lit(seed), k), F.lit(1_000_003)) / 1_000_003
    return spark.range(0, n, 1, parts).select(
        F.floor(k / 3).alias("customer_id"),
        F.when(k % 50 > 0, (noise(1) * 2 + F.round(noise(3)) + 1).cast("int")).alias("pdm_prod_type_id"),
        noise(2).alias("a"), F.floor(noise(3) * 9).cast("int").alias("b"),
        F.when(noise(4) < 0.7, 0.5).otherwise(noise(5)).alias("c"), F.lit("x").alias("d"))


def test_models_are_fitted_on_all_labelled_rows(spark):
    """A table beyond the rows that every task gets was cut to a sample of them."""
    n = prop.ONE_PIECE_ROWS + 20_000
    frame = io.materialize(prop.training_frame(_labelled(spark, n), FEATURES))
    held = frame.where("held_out").count()
    assert frame.count() == n and 0.15 * n < held < 0.25 * n
    models = prop.fit_product_models(frame, [1, 2, 7], params=SMALL | {"rounds": 3}).orderBy("product").collect()
    assert [(r.product, r.fit_rows, r.held_rows) for r in models] == [(p, n - held, held) for p in (1, 2, 7)]
    rows = frame.where("not held_out").groupBy("pdm_prod_type_id").count().collect()
    shares = {r.pdm_prod_type_id: r["count"] / (n - held) for r in rows}
    for r in models:
        share = shares.get(r.product, 1e-6)
        assert product_trees.unpacked(bytes(r.model))["start"][0] == pytest.approx(np.log(share / (1 - share)))


def test_rows_in_blocks_give_the_trees_of_one_table(spark, monkeypatch):
    frame = io.materialize(prop.training_frame(_labelled(spark, 6000), FEATURES))
    x = np.array([r.features for r in frame.orderBy("place").collect()])
    some, kinds = SMALL | {"rounds": 7}, {}
    kinds["table"] = prop.fit_product_models(frame, [1, 2, 7], params=some).collect()
    monkeypatch.setattr(prop, "ONE_PIECE_ROWS", 0)
    monkeypatch.setattr(prop, "CHECKPOINT_ROUNDS", 3)
    monkeypatch.setattr(prop, "SPREAD_CHUNK_ROWS", 500)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        binned = io.materialize(prop.binned_frame(frame))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert binned.count() > 6
    kinds["here"] = prop.fit_product_models(frame, [1, 2, 7], params=some, binned=binned).collect()
    monkeypatch.setattr(prop, "TASK_ROWS", 0)
    kinds["spread"] = prop.fit_product_models(frame, [1, 2, 7], params=some, binned=binned).collect()
    rows = {k: {r.product: (r.fit_rows, r.held_rows, bytes(r.model)) for r in v} for k, v in kinds.items()}
    assert rows["here"] == rows["spread"]                       # to the last bit
    for p, (fit_rows, held_rows, model) in rows["table"].items():
        assert rows["here"][p][:2] == (fit_rows, held_rows)
        want, got = product_trees.unpacked(model), product_trees.unpacked(rows["here"][p][2])
        assert (want["feature"] == got["feature"]).all() and (want["threshold"] == got["threshold"]).all()
        assert product_trees.margins(got, x) == pytest.approx(product_trees.margins(want, x))
        assert product_trees.probability(got, x) == pytest.approx(product_trees.probability(want, x))


def test_edges_of_a_large_table(spark):
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.normal(size=900), rng.integers(0, 64, 900), rng.integers(0, 65, 900),
                         np.where(rng.random(900) < 0.9, 1.5, rng.random(900)), np.full(900, 3.0)])
    x[5, 0], x[6, 0] = np.inf, -np.inf
    df = spark.createDataFrame([(r.tolist(),) for r in x], "features array<double>").repartition(5)
    for got, want in zip(prop.quantile_edges(df, 5), product_trees.bin_edges(x), strict=True):
        assert got.tolist() == want.tolist()
    assert [len(e) for e in prop.quantile_edges(df.limit(0), 5)] == [0] * 5


def test_calibration_in_pieces(spark):
    rng = np.random.default_rng(4)
    rows = [(p, float(s), int(rng.random() < s), 1) for p in (1, 2, 5) for s in rng.integers(0, 400, 3000) / 400]
    df = spark.createDataFrame(rows, "product int, raw double, positives long, weight long").repartition(7)
    got = prop.calibration(df)
    assert sorted(got) == [1, 2, 5]
    for p, blocks in got.items():
        s, y = (np.array([r[i] for r in rows if r[0] == p], float) for i in (1, 2))
        for a, b in zip(product_trees.steps(blocks), product_trees.isotonic(s, y), strict=True):
            assert a.tolist() == b.tolist()
    assert prop.calibration(df.limit(0)) == {}


def test_scoring_job_of_a_large_table(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(prop, "ONE_PIECE_ROWS", 0)
    fx, base = Fixtures(spark, sf_dir), _base(spark)
    paths = jobs.run_scoring_job(fx, base, SMALL, batch=4)
    rows = fx.propensity_training().count()
    for m in paths["models"]:
        assert {r.fit_rows + r.held_rows for r in spark.read.parquet(m).collect()} == {rows}
    assert {s["stage"] for s in RunManifest(spark, base).stages()} >= {"frame", "binned"}
    wide = io.read_table(spark, paths["wide"])
    assert wide.count() == 150 and wide.columns == ["customer_id", *(f"p{p}" for p in paths["products"])]
