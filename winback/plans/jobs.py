"""The warehouse script as chained DataFrame stages.

Each stage is a function of the fixture views (or of real tables with the same
schema) and returns a lazy DataFrame; stages compose without materialising,
so predicates and column pruning cross the old statement borders. ``persist``
writes a stage to a table when it is reused by several jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from winback.operators.attribution import channel_attribution
from winback.operators.attributes import SNAPSHOT_ALIASES, customer_attributes
from winback.operators.exposure import campaign_exposures, direct_mail_events
from winback.operators.reactivation import clean_transactions, reactivations
from winback.operators.segments import segment_link, segment_population
from winback.sources.fixtures import Fixtures


def stage_transactions(fx: Fixtures) -> DataFrame:
    return clean_transactions(fx.txn(), fx.txn_xref())


def stage_reactivation(fx: Fixtures) -> DataFrame:
    """Statement 1 (LR_Reactive)."""
    return reactivations(stage_transactions(fx), fx.as_of)


def stage_exposures(fx: Fixtures) -> DataFrame:
    dm = direct_mail_events(fx.coupon_event(), fx.as_of)
    return campaign_exposures(fx.campaign_hist(), dm, fx.cust_skid())


def stage_channel(fx: Fixtures, lr: DataFrame | None = None) -> DataFrame:
    """Statement 2 (Reactive)."""
    lr = stage_reactivation(fx) if lr is None else lr
    return channel_attribution(lr, stage_exposures(fx), fx.time_dim(), fx.customer_curr(),
                               web_touch=fx.web_touch())


def snapshot_tables(fx: Fixtures) -> dict:
    return {a: fx.feature_table(a) for a in SNAPSHOT_ALIASES}


def stage_attributes(fx: Fixtures, reactive: DataFrame | None = None) -> DataFrame:
    """Statement 3 (customer attributes, 161 columns); ``reactive``: stored rows of the
    second statement."""
    stored = reactive is not None
    reactive = reactive if stored else stage_channel(fx)
    return customer_attributes(
        reactive, cdg_info=fx.cdg_info(), demo=fx.demo_individual(),
        income_lookup=fx.income_lookup(), snapshots=snapshot_tables(fx),
        persona_hist=fx.persona_hist(), customer_address=fx.customer_address(),
        address_mstr=fx.address_mstr(), mailing_address=fx.mailing_address(), stored=stored)


def stage_segment_link(fx: Fixtures, attrs: DataFrame | None = None) -> DataFrame:
    """Statement 4 (ME_CUST)."""
    attrs = stage_attributes(fx) if attrs is None else attrs
    return segment_link(attrs, fx.customer_curr(), fx.address_segments())


def stage_population(fx: Fixtures, master: DataFrame, link: DataFrame | None = None) -> DataFrame:
    """Statement 5 (ME_CUST_POP); the master table is a parameter."""
    link = stage_segment_link(fx) if link is None else link
    return segment_population(master, link)


# ---- notebook chain ---------------------------------------------------------------

def stage_prepared(fx: Fixtures) -> DataFrame:
    """Coverage drop -> imputation -> derived labels -> drop source flags ->
    one-hot encoding of the six categoricals (the training notebook's
    cleaning steps, in an order where each column exists when it is used)."""
    from winback.operators import prep, quality
    w = quality.drop_low_coverage(fx.prep_wide())
    w = prep.impute(w)
    w = prep.with_buying_channel(w)
    w = prep.with_clean_gender(w)
    w = quality.drop_columns(w, "pre_src_order", "pre_coupon_flag", strict=True)
    return prep.one_hot(w)


def stage_labelled(fx: Fixtures) -> DataFrame:
    from winback.operators import prep
    return prep.label_index(fx.prep_wide())


def stage_split(fx: Fixtures) -> DataFrame:
    """(customer_id, label, split): exact stratified 65/17.5/17.5 by id."""
    from winback.operators import prep
    lab = stage_labelled(fx).select("customer_id", "label")
    return prep.stratified_split(lab, "label", ["customer_id"])


FRAME_COLUMNS = ["customer_id", "label", "split", "sample_weight"]


def stage_model_frame(fx: Fixtures):
    """Training frame of the channel classifier: prepared + recast + label + split,
    remaining NULL features set to 0, scaled with train statistics, balanced sample
    weights on train rows (1 on the others), in one pass over the joined rows:
    customer_id, label, split, sample_weight and the ``features`` vector, whose
    metadata names its entries."""
    from pyspark.sql import functions as F
    from winback.operators import model, prep, quality, weights
    w = prep.recast(stage_prepared(fx))
    split = stage_split(fx).select(F.col("customer_id").alias("_sid"), "label", "split")
    w = w.join(split, w.customer_id == split._sid).drop("_sid")
    feats = [c for c in quality.numeric_columns(w) if c not in ("customer_id", "label")]
    w = w.na.fill(0.0, subset=feats)
    train = F.col("split") == "train"
    stats = prep.fit_standard_scaler(w.where(train), feats)
    w = prep.apply_standard_scaler(w, stats)
    coef = weights.max_class_share(split, "label")
    table = weights.weight_table(split.where(train), coef, "label")
    table = table.select(F.col("label").alias("_class"), F.col("class_weight").alias("_weight"))
    w = w.join(table, F.col("label") == F.col("_class"), "left").withColumn(
        "sample_weight", F.when(train, F.col("_weight")).otherwise(1.0))
    return model.with_features(w, feats, FRAME_COLUMNS)


def run_channel_job(fx: Fixtures, base: str, upto: str = "reports", k: int | None = None,
                    trials: int | None = None, num_trees: int | None = None) -> dict:
    """The training flow of the channel classifier: frame -> first fit and feature
    importances -> frames narrowed to the ``k`` best features -> parameter search on the
    validation rows -> final fit with the saved best parameters -> classification reports
    of train and test rows (ML-3..ML-8, PRJ-4, TOP-1).

    Every stage's output is a table or a saved model recorded in a run manifest under
    ``base``; the search and the final fit read the stored importances and the stored
    trials. Stages after ``upto`` (frame, importance, trials, model, reports) are not run.
    Returns name -> path."""
    from pyspark.sql import functions as F
    from winback.operators import metrics
    from winback.operators import model as mdl
    from winback.session import ensure_checkpoint_dir
    from winback.sources.manifest import RunManifest
    spark = fx.spark
    ensure_checkpoint_dir(spark)
    k, trials, num_trees = k or mdl.TOP_FEATURES, trials or mdl.TRIALS, num_trees or mdl.N_TREES
    run, paths = RunManifest(spark, base), {}
    source = run.inputs([f"{fx.sf_dir}/customer.parquet"])

    def store(df):
        return lambda path: df().write.mode("overwrite").parquet(path)

    def read(name):
        return spark.read.parquet(paths[name])

    def rows(split, narrow=True):
        f = mdl.dealt(read("frame").where(F.col("split") == split))
        if not narrow:
            return f
        best = [r.feature for r in read("importance").orderBy("importance_rank").collect()]
        return mdl.narrowed(f, best)

    def final_model(path):
        train = rows("train")
        mdl.save_model(mdl.forest_of(mdl.best_params(read("trials")), train.count()).fit(train), path)

    def importance():
        m = mdl.forest(num_trees=num_trees, max_depth=6).fit(rows("train", narrow=False))
        return mdl.feature_importance(m, mdl.feature_names(read("frame")), spark, k)

    def reports():
        m, out = mdl.load_forest(paths["model"]), []
        for split in ("train", "test"):
            pred = mdl.predict(m, rows(split)).withColumn("prediction", F.col("prediction").cast("int"))
            out.append(metrics.class_report(pred, "label", "prediction").select(F.lit(split).alias("split"), "*"))
        return out[0].unionByName(out[1])

    stages = [("frame", {}, store(lambda: stage_model_frame(fx))),
              ("importance", {"k": k, "trees": num_trees}, store(importance)),
              ("trials", {"trials": trials, "trees": num_trees},
               store(lambda: mdl.random_search(rows("train"), rows("valid"), trials=trials, num_trees=num_trees))),
              ("model", {}, final_model),
              ("reports", {}, store(reports))]
    after = source
    for name, params, make in stages:
        paths[name], after = run.stage(f"channel_{name}", params, (after,), make)
        if name == upto:
            break
    return paths


def run_boosted_job(fx: Fixtures, base: str, max_rounds: int | None = None, patience: int | None = None,
                    max_depth: int = 4) -> dict:
    """Boosted trees per class with patience on the validation rows (ML-3, ML-13): frame
    and models as recorded stages, the rounds of every class as a table. Returns paths."""
    from pyspark.sql import functions as F
    from winback.operators import boosting
    from winback.operators import model as mdl
    from winback.sources.manifest import RunManifest
    max_rounds, patience = max_rounds or boosting.MAX_ROUNDS, patience or boosting.PATIENCE
    paths = run_channel_job(fx, base, "frame")
    run = RunManifest(fx.spark, base)

    def make(path):
        frame = fx.spark.read.parquet(paths["frame"])
        # few rows a partition are many empty tasks a round
        train, valid = (mdl.dealt(frame.where(F.col("split") == s).coalesce(
            max(1, min(frame.rdd.getNumPartitions(), frame.count() // 25_000)))) for s in ("train", "valid"))
        classes = [r.label for r in frame.select("label").distinct().orderBy("label").collect()]
        fit = boosting.fit_classes(train, valid, classes, max_rounds=max_rounds, patience=patience, max_depth=max_depth)
        fit.save(path)
        fit.rounds_table(fx.spark).write.mode("overwrite").parquet(f"{path}/rounds")

    paths["boosted"], _ = run.stage("channel_boosted", {"rounds": max_rounds, "patience": patience, "depth": max_depth},
                                    (paths["frame"],), make)
    return paths


def run_scoring_job(fx: Fixtures, base: str, params: dict | None = None, out: str | None = None,
                    batch: int | None = None) -> dict:
    """ML-14: the end-to-end product scoring job: store the training frame (a large one
    also as blocks of bin numbers), fit one calibrated model per product, score every
    customer to the long table by batches of products, pivot, and replace the wide table
    ``out`` (SNK-2).

    Stages are recorded in a manifest under ``base``: a job that is started again with
    the same parameters over the same input files goes on behind its last complete
    stage, batches of products one by one. Returns the paths of the models, the long and
    the wide table and the product list."""
    from winback.operators import propensity as prop
    from winback.session import ensure_checkpoint_dir
    from winback.sources import io
    from winback.sources.manifest import RunManifest
    spark = fx.spark
    ensure_checkpoint_dir(spark)
    run = RunManifest(spark, base)
    params, batch = dict(prop.PRODUCT_MODEL if params is None else params), batch or prop.PRODUCTS_PER_BATCH
    products = prop.product_ids(fx.product_types())
    source = run.inputs([f"{fx.sf_dir}/{t}.parquet" for t in ("lineitem", "orders", "part", "customer")])

    def store(df):
        return lambda path: df().write.mode("overwrite").parquet(path)

    frame, framed = run.stage("frame", {}, (source,), store(lambda: prop.training_frame(fx.propensity_training())))
    more = {}
    if not prop.in_one_piece(spark.read.parquet(frame)):
        binned, framed = run.stage("binned", {}, (framed,), store(lambda: prop.binned_frame(spark.read.parquet(frame))))
        more["binned"] = spark.read.parquet(binned)
    customers, scored = run.stage("customers", {}, (source,), store(
        lambda: prop.score_frame(fx.propensity_training().drop("pdm_prod_type_id").distinct())))
    paths: dict = {"models": [], "long": [], "out": out, "products": products}
    after = []
    for i, some in enumerate(prop.batches_of(products, batch)):
        models, fitted = run.stage(f"models_{i}", [params, some], (framed,), store(
            lambda: prop.fit_product_models(spark.read.parquet(frame), some, params=params, **more)))
        long, key = run.stage(f"scores_{i}", some, (scored, fitted), store(
            lambda: prop.score_batch(spark.read.parquet(customers), spark.read.parquet(models), some)))
        paths["models"].append(models)
        paths["long"].append(long)
        after.append(key)
    paths["wide"], _ = run.stage("wide", products, tuple(after), lambda path: io.write_table(
        prop.score_wide(spark.read.parquet(*paths["long"]), products), path))
    if out:
        io.write_table(io.read_table(spark, paths["wide"]), out)
    return paths


SCRIPT_TABLES = ["reactivation", "channel_attribution", "customer_attributes",
                 "segment_link", "segment_population"]


def run_script(fx: Fixtures, base: str | None = None, master: DataFrame | None = None) -> dict:
    """The five statements as a batch job, each replacing a table that the
    next statement reads (the original's CREATE OR REPLACE chain). Tables go
    under ``base`` (default: the session's shared folder); the population's
    master table defaults to the attributes table. Returns name -> path."""
    from winback.operators.attribution import sorted_for_sink
    from winback.session import scratch_path
    from winback.sources.io import read_table, write_table
    spark = fx.spark

    def put(name: str, df: DataFrame, **kw) -> DataFrame:
        path = f"{base}/{name}" if base else scratch_path(spark, name)
        paths[name] = write_table(df, path, **kw)
        return read_table(spark, path)

    paths: dict[str, str] = {}
    lr = put("reactivation", stage_reactivation(fx))
    reactive = put("channel_attribution", sorted_for_sink(stage_channel(fx, lr)))
    attrs = put("customer_attributes", stage_attributes(fx, reactive))
    link = put("segment_link", stage_segment_link(fx, attrs))
    put("segment_population", stage_population(fx, attrs if master is None else master, link))
    return paths
