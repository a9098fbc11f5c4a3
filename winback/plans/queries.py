"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the survey inventory. Every query reads the test tables (through
the fixture views) and processes them whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.functions import rules
from winback.operators import attributes as attr
from winback.operators import boosting, metrics, prep, quality, weights
from winback.operators import model as mdl
from winback.operators import propensity as prop
from winback.operators.exposure import window_join
from winback.plans import jobs
from winback.session import shared_path
from winback.sources import io as sink
from winback.sources.fixtures import Fixtures
from winback.sources.tables import limited_scan

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

KEYS = ["customer_id", "transaction_guid", "previous_trans_id", "address_id", "previous_buy"]


def _unique(name: str) -> str:
    """A per-call table name under the shared folder (calls never collide)."""
    import uuid
    return f"{name}_{uuid.uuid4().hex[:12]}"


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ---- SQL script ---------------------------------------------------------------

@query("reactivation")
def q_reactivation(spark, sf_dir):
    return jobs.stage_reactivation(Fixtures(spark, sf_dir))


@query("campaign_exposure")
def q_campaign_exposure(spark, sf_dir):
    return jobs.stage_exposures(Fixtures(spark, sf_dir))


@query("exposure_window_join")
def q_exposure_window_join(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    lr = jobs.stage_reactivation(fx).select("customer_id", "transaction_guid",
                                            "transaction_booked_date", "previous_trans_id")
    exp = jobs.stage_exposures(fx).select(F.col("customer_id").alias("d_customer"),
                                          "COUPON_BARCODE1", "IN_HOME_DT")
    j = window_join(lr, exp, left_key="customer_id", right_key="d_customer",
                    left_date="transaction_booked_date", right_start="IN_HOME_DT",
                    days=14, how="left")
    return j.drop("d_customer")


@query("channel_attribution")
def q_channel_attribution(spark, sf_dir):
    return jobs.stage_channel(Fixtures(spark, sf_dir))


@query("demographics")
def q_demographics(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    out = attr.with_demographics(jobs.stage_channel(fx), fx.cdg_info(), fx.demo_individual(),
                                 fx.income_lookup())
    return out.select(*KEYS, "gender", "age_bucket", "ethnicity", "INCOME")


@query("region_division")
def q_region_division(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    terr = attr.territory_source(fx.customer_address(), fx.address_mstr(), fx.mailing_address())
    return attr.with_region(jobs.stage_channel(fx), terr).select(*KEYS, "State_Division")


@query("pit_features")
def q_pit_features(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    keep = KEYS + ["FISCAL_PERIOD_ID", "PRE_FISCAL_PERIOD_ID"]
    return attr.with_snapshots(jobs.stage_channel(fx), jobs.snapshot_tables(fx), keep=keep)


@query("latest_persona")
def q_latest_persona(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return attr.latest_per_key(fx.persona_hist(), "customer_id", "scoring_year_and_period")


@query("customer_attributes")
def q_customer_attributes(spark, sf_dir):
    return jobs.stage_attributes(Fixtures(spark, sf_dir))


@query("segment_link")
def q_segment_link(spark, sf_dir):
    return jobs.stage_segment_link(Fixtures(spark, sf_dir))


@query("segment_flags")
def q_segment_flags(spark, sf_dir):
    from winback.operators.segments import segment_flags
    fx = Fixtures(spark, sf_dir)
    return segment_flags(jobs.stage_attributes(fx), fx.customer_curr(), fx.address_segments())


@query("segment_population")
def q_segment_population(spark, sf_dir):
    """The attributes are read twice, for the link and as the master. What is stored once is
    their narrow base (the script's Reactive): of the 161 columns the link needs the customer
    only, and the master only the linked customers' rows."""
    from winback.sources.io import materialize
    fx = Fixtures(spark, sf_dir)
    attrs = jobs.stage_attributes(fx, materialize(jobs.stage_channel(fx), "channel_attribution"))
    link = jobs.stage_segment_link(fx, attrs)
    return jobs.stage_population(fx, attrs, link)


# ---- data quality -------------------------------------------------------------------


@query("null_report")
def q_null_report(spark, sf_dir):
    return quality.null_report(Fixtures(spark, sf_dir).prep_wide())


@query("coverage")
def q_coverage(spark, sf_dir):
    return quality.coverage(Fixtures(spark, sf_dir).prep_wide())


@query("drop_low_coverage")
def q_drop_low_coverage(spark, sf_dir):
    return quality.drop_low_coverage(Fixtures(spark, sf_dir).prep_wide())


@query("profile")
def q_profile(spark, sf_dir):
    return quality.profile(Fixtures(spark, sf_dir).prep_wide(), exact=True)


@query("top_values")
def q_top_values(spark, sf_dir):
    return quality.top_values(Fixtures(spark, sf_dir).prep_wide(), k=20)


@query("histogram")
def q_histogram(spark, sf_dir):
    return quality.histogram(Fixtures(spark, sf_dir).prep_wide(), bins=50)


@query("dedup")
def q_dedup(spark, sf_dir):
    trans = jobs.stage_transactions(Fixtures(spark, sf_dir))
    return quality.drop_duplicates(trans, ["customer_id", "transaction_booked_date"],
                                   ["transaction_guid"])


@query("dedup_report")
def q_dedup_report(spark, sf_dir):
    trans = jobs.stage_transactions(Fixtures(spark, sf_dir))
    after = quality.drop_duplicates(trans, ["customer_id", "transaction_booked_date"],
                                    ["transaction_guid"])
    return quality.duplicate_report(trans, after)


# ---- preparation --------------------------------------------------------------------

@query("recast")
def q_recast(spark, sf_dir):
    return prep.recast(Fixtures(spark, sf_dir).prep_wide())


@query("impute")
def q_impute(spark, sf_dir):
    return prep.impute(Fixtures(spark, sf_dir).prep_wide())


@query("impute_scoring")
def q_impute_scoring(spark, sf_dir):
    return prep.impute_scoring(Fixtures(spark, sf_dir).propensity_training(),
                               keep=("customer_id", "pdm_prod_type_id"))


@query("buying_channel")
def q_buying_channel(spark, sf_dir):
    w = Fixtures(spark, sf_dir).prep_wide().select("customer_id", "pre_src_order")
    return prep.with_buying_channel(w)


@query("gender_clean")
def q_gender_clean(spark, sf_dir):
    w = Fixtures(spark, sf_dir).prep_wide()
    return w.select("customer_id", F.col("gender").alias("gender_raw"),
                    rules.clean_gender("gender").alias("gender"))


@query("one_hot")
def q_one_hot(spark, sf_dir):
    return jobs.stage_prepared(Fixtures(spark, sf_dir))


@query("label_index")
def q_label_index(spark, sf_dir):
    return jobs.stage_labelled(Fixtures(spark, sf_dir)).select(
        "customer_id", "reactivation_channel", "label")


@query("split_counts")
def q_split_counts(spark, sf_dir):
    s = jobs.stage_split(Fixtures(spark, sf_dir))
    return weights.class_counts(s, "label", by="split")


SCALE_COLS = ["time_interval", "BUYS_Q_01", "COUPON_Q_01", "BBB_R_2Y", "X_DECILE",
              "PH_DM_RECENCY"]


@query("standard_scale")
def q_standard_scale(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    data = prep.impute(fx.prep_wide()).select("customer_id", *SCALE_COLS)
    s = jobs.stage_split(fx).select("customer_id", "split")
    j = data.join(s, "customer_id")
    stats = prep.fit_standard_scaler(j.where(F.col("split") == "train"), SCALE_COLS)
    return prep.apply_standard_scaler(j, stats, digits=6)


@query("class_weights")
def q_class_weights(spark, sf_dir):
    return weights.class_weights(jobs.stage_labelled(Fixtures(spark, sf_dir)), "label")


@query("sample_weights")
def q_sample_weights(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    s = jobs.stage_split(fx)
    coef = weights.max_class_share(s, "label")
    train = s.where(F.col("split") == "train").select("customer_id", "label")
    return weights.sample_weights(train, coef, "label")


# ---- metrics ------------------------------------------------------------------------

@query("confusion")
def q_confusion(spark, sf_dir):
    return metrics.confusion(Fixtures(spark, sf_dir).predictions())


@query("class_report")
def q_class_report(spark, sf_dir):
    return metrics.class_report(Fixtures(spark, sf_dir).predictions())


# ---- models -------------------------------------------------------------------------


def _runs(spark) -> str:
    """Where the model jobs of the registered queries keep their stages: the queries of
    one job share them, and a query that was cut off goes on behind the last one."""
    return shared_path(spark, "model_runs")


@query("feature_importance_topk")
def q_feature_importance_topk(spark, sf_dir):
    return spark.read.parquet(jobs.run_channel_job(Fixtures(spark, sf_dir), _runs(spark), "importance")["importance"])


@query("importance_checks")
def q_importance_checks(spark, sf_dir):
    t = q_feature_importance_topk(spark, sf_dir)
    return t.agg(F.count(F.lit(1)).alias("features"), F.count_distinct("feature").alias("names"),
                 F.max("importance_rank").cast("bigint").alias("last_rank"),
                 F.count_if((F.col("importance") < 0) | F.col("importance").isNull()).alias("negative"),
                 F.round(F.sum("importance"), 6).alias("total_importance"))


@query("tuning_trials")
def q_tuning_trials(spark, sf_dir):
    return spark.read.parquet(jobs.run_channel_job(Fixtures(spark, sf_dir), _runs(spark), "trials")["trials"])


@query("tuning_checks")
def q_tuning_checks(spark, sf_dir):
    """What the trials must satisfy: drawn inside the space, the best one better than
    always naming the largest class of the validation rows."""
    fx = Fixtures(spark, sf_dir)
    t = spark.read.parquet(jobs.run_channel_job(fx, _runs(spark), "trials")["trials"])
    valid = jobs.stage_split(fx).where(F.col("split") == "valid")
    share = weights.max_class_share(valid, "label")
    lo_hi = [F.col(c).between(*mdl.SEARCH_SPACE[c]) for c in mdl.SEARCH_SPACE]
    inside = lo_hi[0] & lo_hi[1] & lo_hi[2] & lo_hi[3]
    return t.agg(F.count(F.lit(1)).alias("trials"), F.min("n_estimators").cast("bigint").alias("trees"),
                 F.count_if(inside).alias("inside"), F.count_distinct("colsample_bytree").alias("draws"),
                 (F.max("val_accuracy") >= F.lit(share)).alias("beats_largest_class"))


def _reports(spark, sf_dir):
    return spark.read.parquet(jobs.run_channel_job(Fixtures(spark, sf_dir), _runs(spark))["reports"])


@query("channel_model_final")
def q_channel_model_final(spark, sf_dir):
    """The whole training flow: the 30 best features, the best trial's parameters, reports
    of train and test rows."""
    return _reports(spark, sf_dir)


@query("channel_model_report")
def q_channel_model_report(spark, sf_dir):
    """The final model's classification report on test rows."""
    return _reports(spark, sf_dir).where(F.col("split") == "test").drop("split")


@query("model_report_checks")
def q_model_report_checks(spark, sf_dir):
    """Rows of every class and split in the reports, and whether their ratios are ratios and
    the split's accuracy is that of the weighted recall."""
    r = _reports(spark, sf_dir)
    ok = lambda c: F.coalesce(F.col(c).between(0.0, 1.0), F.lit(True))
    named = F.max(F.when(F.col("class_name") == "weighted avg", F.col("recall")))
    acc = r.groupBy("split").agg((F.abs(named - F.max(F.when(F.col("class_name") == "accuracy", F.col("f1")))) < 2e-6)
                                 .alias("accuracy_agrees"))
    per = r.where(~F.col("class_name").isin("accuracy", "macro avg", "weighted avg"))
    return per.join(acc, "split").select("split", F.col("class_name").cast("int").alias("label"), "support",
                                         (ok("precision") & ok("recall") & ok("f1")).alias("ratios"), "accuracy_agrees")


@query("product_targets")
def q_product_targets(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    t = fx.propensity_training().select("customer_id", "pdm_prod_type_id")
    return prop.product_targets(t, prop.product_ids(fx.product_types()))


def _scored(spark, sf_dir, out=None):
    return jobs.run_scoring_job(Fixtures(spark, sf_dir), _runs(spark), out=out)


@query("propensity_long")
def q_propensity_long(spark, sf_dir):
    return spark.read.parquet(*_scored(spark, sf_dir)["long"])


@query("propensity_wide")
def q_propensity_wide(spark, sf_dir):
    return sink.read_table(spark, _scored(spark, sf_dir)["wide"])


@query("propensity_checks")
def q_propensity_checks(spark, sf_dir):
    """Per product: customers scored, scores outside of 0..1 or missing, and whether the
    mean calibrated score is within 0.1 of the product's share of the training rows."""
    fx = Fixtures(spark, sf_dir)
    long = q_propensity_long(spark, sf_dir)
    training = fx.propensity_training()
    base = training.groupBy("pdm_prod_type_id").agg((F.count(F.lit(1)) / F.lit(training.count())).alias("share"))
    got = long.groupBy("pdm_prod_type_id").agg(
        F.count_distinct("customer_id").alias("customers"), F.count(F.lit(1)).alias("scores"),
        F.count_if(F.col("p").isNull() | ~F.col("p").between(0.0, 1.0)).alias("outside"), F.avg("p").alias("mean"))
    return got.join(base, "pdm_prod_type_id").select(
        "pdm_prod_type_id", "customers", "scores", "outside",
        (F.abs(F.col("mean") - F.col("share")) < 0.1).alias("mean_agrees"))


@query("pivot_wide")
def q_pivot_wide(spark, sf_dir):
    """Long (customer, product, line count) -> one column per product."""
    fx = Fixtures(spark, sf_dir)
    li = fx.t("lineitem").select("l_orderkey", "l_partkey")
    o = fx.t("orders").select("o_orderkey", "o_custkey")
    p = fx.t("part").select("p_partkey", "p_type")
    long = (li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
            .join(fx.product_types(), "p_type")
            .groupBy(F.col("o_custkey").alias("customer_id"), "pdm_prod_type_id")
            .agg(F.count(F.lit(1)).alias("lines")))
    return prop.pivot_wide(long, "customer_id", "pdm_prod_type_id", "lines",
                           prop.product_ids(fx.product_types()))


# ---- scans, sorts, sinks --------------------------------------------------------------

@query("sample_limit")
def q_sample_limit(spark, sf_dir):
    t = Fixtures(spark, sf_dir).propensity_training()
    return limited_scan(t, 1000, ["customer_id", "pdm_prod_type_id"])


@query("sample_fraction")
def q_sample_fraction(spark, sf_dir):
    return prep.sample_rows(Fixtures(spark, sf_dir).propensity_training(), 0.6,
                            keys=["customer_id", "pdm_prod_type_id"])


@query("sort_mixed")
def q_sort_mixed(spark, sf_dir):
    from winback.operators.attribution import sorted_globally
    return sorted_globally(jobs.stage_channel(Fixtures(spark, sf_dir)))


@query("roundtrip_table")
def q_roundtrip_table(spark, sf_dir):
    from winback.operators.attribution import sorted_for_sink
    df = jobs.stage_channel(Fixtures(spark, sf_dir))
    path = sink.scratch_path(spark, _unique("reactive"))
    sink.write_table(df.limit(0), path)             # the table that is replaced
    return sink.read_table(spark, sink.write_table(sorted_for_sink(df), path))


@query("roundtrip_csv")
def q_roundtrip_csv(spark, sf_dir):
    rep = quality.null_report(Fixtures(spark, sf_dir).prep_wide())
    path = sink.scratch_path(spark, _unique("null_report_csv"))
    sink.write_csv(rep.coalesce(1), path)
    return sink.read_csv(spark, path, "column_name string, null_count bigint, row_count bigint")


@query("scoring_job")
def q_scoring_job(spark, sf_dir):
    """Fit, save, reload, score, pivot and replace the wide output table; the query
    returns the replaced table."""
    out = sink.output_path(spark, "prod_type_cluster_data")
    return sink.read_table(spark, _scored(spark, sf_dir, out)["out"])


def _boosted(spark, sf_dir):
    paths = jobs.run_boosted_job(Fixtures(spark, sf_dir), _runs(spark))
    return paths, spark.read.parquet(f"{paths['boosted']}/rounds")


@query("channel_model_rounds")
def q_channel_model_rounds(spark, sf_dir):
    """ML-13: rounds kept, rounds looked at and whether patience ran out, per class."""
    return _boosted(spark, sf_dir)[1]


@query("channel_model_ovr")
def q_channel_model_ovr(spark, sf_dir):
    """Boosted trees per class, up to 180 rounds with a patience of 10 on the validation
    rows (ML-13); the saved models are reloaded (ML-6) and evaluated on test rows."""
    paths, rounds = _boosted(spark, sf_dir)
    m = boosting.BoostedClasses.load(paths["boosted"], [r.label for r in rounds.select("label").collect()])
    test = mdl.dealt(spark.read.parquet(paths["frame"]).where(F.col("split") == "test"))
    pred = m.transform(test).withColumn("prediction", F.col("prediction").cast("int"))
    return metrics.class_report(pred, "label", "prediction")


@query("boosted_checks")
def q_boosted_checks(spark, sf_dir):
    """Per class: a model with rounds in bounds that patience explains, and the class's
    test rows in the report."""
    rounds = _boosted(spark, sf_dir)[1]
    support = q_channel_model_ovr(spark, sf_dir).select("class_name", "support")
    kept = F.col("rounds").between(1, boosting.MAX_ROUNDS) & (F.col("looked_at") <= boosting.MAX_ROUNDS)
    why = (F.col("stopped") & (F.col("looked_at") >= F.col("rounds") + boosting.PATIENCE)) | \
          (~F.col("stopped") & (F.col("looked_at") == boosting.MAX_ROUNDS))
    return rounds.join(support, F.col("label").cast("string") == F.col("class_name")).select(
        "label", "support", kept.alias("in_bounds"), why.alias("explained"))


@query("attributes_coverage")
def q_attributes_coverage(spark, sf_dir):
    """End to end: coverage report of the 161-column attributes table (the
    notebook's input), one aggregate pass over all columns. The narrow base is stored, so
    that the snapshots are cut to the keys it reads before they are shuffled."""
    from winback.sources.io import materialize
    fx = Fixtures(spark, sf_dir)
    return quality.coverage(jobs.stage_attributes(fx, materialize(jobs.stage_channel(fx), "channel_attribution")))


@query("score_frame_sql")
def q_score_frame_sql(spark, sf_dir):
    """SRC-2 / AGG-1 in SQL text: the distinct per-customer score frame,
    grouped by ordinals over a registered view (whole table, no row cap)."""
    import uuid

    from winback.sources.tables import read_query
    view = f"propensity_training_{uuid.uuid4().hex[:12]}"
    Fixtures(spark, sf_dir).propensity_training().createOrReplaceTempView(view)
    cols = ", ".join(["customer_id"] + prep.SCORING_FEATURES)
    ordinals = ", ".join(str(i) for i in range(1, len(prep.SCORING_FEATURES) + 2))
    try:
        # analysed here, so the frame keeps the view's plan after the drop
        return read_query(spark, f"SELECT {cols} FROM {view} GROUP BY {ordinals}")
    finally:
        spark.catalog.dropTempView(view)
