"""Plan shape checks and invariants of the preparation / weight operators."""

from pyspark.sql import functions as F

from winback.plans import jobs, queries
from winback.sources.fixtures import Fixtures


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reactivation_has_one_window_over_day_rows(spark, sf_dir):
    plan = _plan(jobs.stage_reactivation(Fixtures(spark, sf_dir)))
    assert plan.count("Window [") + plan.count("Window [lag") <= 2
    assert "lag(" in plan


def test_segment_population_is_a_semi_join(spark, sf_dir):
    plan = _plan(queries.REGISTRY["segment_population"](spark, sf_dir))
    assert "LeftSemi" in plan


def test_no_python_udfs_in_any_sql_plan(spark, sf_dir):
    for name in ["reactivation", "channel_attribution", "customer_attributes", "profile",
                 "histogram", "top_values", "one_hot", "standard_scale", "class_report"]:
        plan = _plan(queries.REGISTRY[name](spark, sf_dir))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_filters_reach_the_scan(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    plan = jobs.stage_reactivation(fx)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan


def test_split_partitions_rows_with_exact_shares(spark, sf_dir):
    s = jobs.stage_split(Fixtures(spark, sf_dir))
    rows = s.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("split") == "train").cast("int")).alias("tr"),
        F.sum((F.col("split") == "valid").cast("int")).alias("va"),
        F.countDistinct("customer_id").alias("ids")).collect()
    for r in rows:
        assert r.ids == r.n
        assert abs(r.tr - r.n * 0.65) <= 1
        assert abs(r.va - r.n * 0.175) <= 1


def test_scaled_train_has_mean_zero_std_one(spark, sf_dir):
    df = queries.REGISTRY["standard_scale"](spark, sf_dir).where(F.col("split") == "train")
    row = df.agg(F.avg("BBB_R_2Y").alias("m"), F.stddev_pop("BBB_R_2Y").alias("s")).first()
    assert abs(row.m) < 1e-5 and abs(row.s - 1) < 1e-5


def test_class_weights_sum_to_rows(spark, sf_dir):
    w = queries.REGISTRY["class_weights"](spark, sf_dir)
    total = w.agg(F.sum(F.col("class_weight") * F.col("class_count"))).first()[0]
    rows = w.agg(F.sum("class_count")).first()[0]
    assert abs(total - rows) < 1e-6


def test_one_hot_rows_sum_to_at_most_one_per_column(spark, sf_dir):
    df = queries.REGISTRY["one_hot"](spark, sf_dir)
    enc = [c for c in df.columns if c.startswith("State_Division_")]
    assert df.where(sum(F.col(c) for c in enc) > 1).count() == 0


def test_confusion_total_and_accuracy_equals_micro_f1(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    n = fx.predictions().count()
    cm = queries.REGISTRY["confusion"](spark, sf_dir)
    assert cm.agg(F.sum("n")).first()[0] == n
    rep = {r.class_name: r for r in queries.REGISTRY["class_report"](spark, sf_dir).collect()}
    assert rep["accuracy"].support == n


def test_pivot_rows_are_distinct_customers(spark, sf_dir):
    df = queries.REGISTRY["pivot_wide"](spark, sf_dir)
    assert df.count() == df.select("customer_id").distinct().count()


def test_script_tables_equal_lazy_stages(spark, sf_dir):
    import uuid
    from winback.session import scratch_path
    from winback.sources.io import read_table
    fx = Fixtures(spark, sf_dir)
    paths = jobs.run_script(fx, base=scratch_path(spark, f"script_{uuid.uuid4().hex[:8]}"))
    assert list(paths) == jobs.SCRIPT_TABLES
    lazy = {"reactivation": jobs.stage_reactivation(fx),
            "channel_attribution": jobs.stage_channel(fx),
            "segment_link": jobs.stage_segment_link(fx)}
    for name, df in lazy.items():
        written = read_table(spark, paths[name])
        assert written.exceptAll(df).count() == 0 and df.exceptAll(written).count() == 0, name
