"""Rule edges on hand-made rows (5-10 rows each)."""

import datetime as dt

from pyspark.sql import functions as F

from winback.functions import rules
from winback.functions.dates import month_boundaries, trailing_window
from winback.functions.numeric import coverage_percent, np_round
from winback.operators.exposure import window_join
from winback.operators.reactivation import reactivations

D = dt.date


def test_month_boundaries_count_calendar_months(spark):
    df = spark.createDataFrame([(D(2024, 1, 31), D(2024, 7, 1)), (D(2024, 1, 1), D(2024, 1, 31)),
                                (D(2023, 12, 31), D(2024, 1, 1))], "a date, b date")
    got = [r[0] for r in df.select(month_boundaries("a", "b")).collect()]
    assert got == [6, 0, 1]


def test_trailing_window_is_inclusive_and_leap_safe(spark):
    df = spark.createDataFrame([(D(2022, 2, 28),), (D(2022, 2, 27),), (D(2024, 2, 29),)], "d date")
    got = [r[0] for r in df.select(trailing_window("d", "2024-02-29", 24)).collect()]
    assert got == [True, False, True]


def _trans(spark, rows):
    return spark.createDataFrame(rows, "customer_id bigint, transaction_booked_date date, "
                                       "src_atg_ecom_order_id bigint, coupon_flag string, "
                                       "same_day_delivery_line_indicator string, "
                                       "ecom_order_source_code string, transaction_guid bigint")


def test_reactivation_ties_and_fan_out(spark):
    rows = [
        (1, D(2023, 1, 5), None, "N", "N", "U", 10),
        (1, D(2023, 1, 5), 11, "Y", "N", "W", 11),      # same previous day: fan-out
        (1, D(2023, 7, 1), 12, "N", "N", None, 13),     # 6 boundaries later, first of day
        (1, D(2023, 7, 1), 14, "N", "N", None, 12),     # lower guid: this one carries the gap
        (2, D(2023, 1, 31), 20, "N", "N", "W", 20),
        (2, D(2023, 6, 30), 21, "N", "N", "W", 21),     # only 5 boundaries
        (3, D(2020, 1, 1), 30, "N", "N", "W", 30),      # outside the window
        (3, D(2023, 9, 1), 31, "N", "N", "W", 31),      # first in window: no predecessor
    ]
    out = reactivations(_trans(spark, rows), "2024-01-01").collect()
    assert len(out) == 2
    assert {r.transaction_guid for r in out} == {12}
    assert {r.previous_trans_id for r in out} == {10, 11}
    assert all(r.month_interval == 6 and r.time_interval == 177 for r in out)


def test_window_join_edges(spark):
    left = spark.createDataFrame([(1, D(2023, 3, d)) for d in (1, 14, 15, 16, 28)],
                                 "k bigint, d date")
    right = spark.createDataFrame([(1, D(2023, 3, 1)), (1, D(2023, 3, 2)), (2, D(2023, 3, 1))],
                                  "rk bigint, start date")
    got = sorted((r.d.day, r.start.day if r.start else None) for r in window_join(
        left, right, left_key="k", right_key="rk", left_date="d", right_start="start",
        days=14, how="left").collect())
    # offsets 0 and 14 inclusive (Mar 1 -> Mar 1..15), 15 outside (Mar 16 vs
    # Mar 1), -1 never (Mar 1 vs Mar 2), unmatched left row kept once
    assert got == [(1, 1), (14, 1), (14, 2), (15, 1), (15, 2), (16, 2), (28, None)]


def test_channel_rules(spark):
    df = spark.createDataFrame([
        ("Social Networks", 1), (None, 1), ("None", 1), ("Paid Search", 0), (None, 0),
        ("Email", 1), ("Email", 0)], "last_touch_channel string, DM_Flag int")
    got = [r[0] for r in df.select(rules.reactivation_channel()).collect()]
    assert got == ["Social", "DM", "DM", "Others", "UNKNOWN", "Email", "Email"]


def test_region_age_gender_rules(spark):
    df = spark.createDataFrame([(" il", 16), ("CT", 17), ("ma", 18), ("FL ", 54), (None, 55),
                                ("ON", None)], "t string, age int")
    got = df.select(rules.state_division("t").alias("r"),
                    rules.age_bucket(F.col("age")).alias("a")).collect()
    assert [r.r for r in got] == ["Midwest", "UNKNOWN", "UNKNOWN", "South", "UNKNOWN", "UNKNOWN"]
    assert [r.a for r in got] == ["AGE_LESS_17", "UKNOWN", "AGE_18_24", "AGE_41_54",
                                  "AGE_ABOVE_55", "UKNOWN"]
    g = spark.createDataFrame([("",), ("M",), ("F",), (None,), ("X",)], "gender string")
    assert [r[0] for r in g.select(rules.clean_gender()).collect()] == \
        ["UNKNOWN", "M", "F", "UNKNOWN", "UNKNOWN"]
    b = spark.createDataFrame([("U",), ("W",), (None,)], "pre_src_order string")
    assert [r[0] for r in b.select(rules.buying_channel()).collect()] == \
        ["Instore", "Online", "Online"]


def test_coverage_rounding_matches_numpy(spark):
    import numpy as np
    cases = [(43, 100), (406, 1000), (405, 1000), (29, 100), (42, 100), (0, 10), (10, 10)]
    df = spark.createDataFrame(cases, "n bigint, r bigint")
    got = [r[0] for r in df.select(coverage_percent("n", "r")).collect()]
    want = [int(round(np.float64(1 - n / r), 2) * 100) for n, r in cases]
    assert got == want
    x = spark.createDataFrame([(0.125,), (0.135,), (2.675,)], "x double")
    assert [r[0] for r in x.select(np_round("x", 2)).collect()] == \
        [float(np.round(v, 2)) for v in (0.125, 0.135, 2.675)]


def test_nan_counts_as_missing(spark):
    from winback.operators.quality import null_report
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double")
    assert null_report(df).first()["null_count"] == 2


def test_drop_duplicates_keeps_first_by_order(spark):
    from winback.operators.quality import drop_duplicates
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "z")],
                               "k int, o int, v string")
    got = sorted(tuple(r) for r in drop_duplicates(df, ["k"], ["o"]).collect())
    assert got == [(1, 1, "a"), (2, 5, "z")]


def test_latest_per_key_keeps_ties(spark):
    from winback.operators.attributes import latest_per_key
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, 1, "d")],
                               "k int, p int, v string")
    got = sorted(r.v for r in latest_per_key(df, "k", "p").collect())
    assert got == ["a", "b", "d"]


def test_strict_drop_raises_like_pandas(spark):
    import pytest
    from winback.operators.quality import drop_columns
    df = spark.createDataFrame([(1,)], "a int")
    assert drop_columns(df, "zz").columns == ["a"]
    with pytest.raises(KeyError):
        drop_columns(df, "zz", strict=True)


def test_pivot_duplicates_raise(spark):
    import pytest
    from winback.operators.propensity import pivot_wide
    long = spark.createDataFrame([(1, 1, 0.5), (1, 1, 0.7)], "customer_id int, k int, p double")
    with pytest.raises(Exception):
        pivot_wide(long, "customer_id", "k", "p", [1]).collect()


def test_distributed_ntile_equals_window_ntile(spark):
    from pyspark.sql import Window
    from winback.operators.ranking import ntile_within_group
    rows = [(g, i, (i * 37) % 101) for g, n in ((1, 3), (2, 10), (3, 23), (4, 400))
            for i in range(n)]
    df = spark.createDataFrame(rows, "g int, id int, v int").repartition(7)
    want = df.withColumn("t", F.ntile(10).over(Window.partitionBy("g").orderBy("v", "id")))
    got = ntile_within_group(df, "g", ["v", "id"], 10, "t")
    key = lambda r: (r.g, r.id)
    assert sorted(((r.g, r.id, r.t) for r in want.collect()), key=lambda t: t[:2]) == \
        sorted(((r.g, r.id, r.t) for r in got.collect()), key=lambda t: t[:2])


def test_impute_strategies(spark):
    from winback.operators.prep import MAX, MEAN, MEDIAN, MODE, impute
    df = spark.createDataFrame([(1.0, "b", 1.0, 5.0), (3.0, "a", 2.0, None), (None, "b", None, 1.0),
                                (2.0, None, 2.0, None), (2.0, "a", 9.0, 3.0)],
                               "x_mean double, s_mode string, y_median double, z_max double")
    rules = [("mean", MEAN), ("mode", MODE), ("median", MEDIAN), ("max", MAX)]
    got = impute(df, rules).collect()
    assert got[2].x_mean == 2.0
    assert got[3].s_mode == "a"          # tie a/b (2 each) -> smallest value
    assert got[2].y_median == 2.0
    assert got[1].z_max == 5.0 and got[3].z_max == 5.0


def test_cluster_conf_scales_partitions():
    from winback.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, total_cores=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_conf(10 * 1024 ** 2, total_cores=8)["spark.sql.shuffle.partitions"]) == 16


def test_rank_statistics_beyond_the_broadcast_bound(spark, monkeypatch):
    from winback.operators import ranking
    df = spark.createDataFrame([(i % 7, i) for i in range(100)], "g int, id int")
    want = {(i % 7, i): i // 7 + 1 for i in range(100)}
    for bound in (1_000, 3):
        monkeypatch.setattr(ranking, "STATS_MAX_ROWS", bound)
        got = ranking.rank_within_group(df, "g", ["id"], num_partitions=4)
        assert {(r.g, r.id): r.group_rank for r in got.collect()} == want
        plan = got._jdf.queryExecution().analyzed().toString()
        assert ("broadcast" in plan) == (bound == 1_000)


def test_nan_counts_as_missing_everywhere(spark):
    from winback.operators import prep, quality
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1, "nan", "x"), (2.0, 2, "7", "y.z"), (None, 4, None, "x"), (5.0, None, "3", None)],
                               "A_v double, A_i int, RECENCY string, `k.1` string")
    filled = prep.impute(df).collect()
    assert [r.A_v for r in filled] == [0.0, 2.0, 0.0, 5.0]
    mean = prep.impute(df, [("A_", prep.MEAN)]).collect()
    assert [r.A_v for r in mean] == [3.5, 2.0, 3.5, 5.0]
    assert abs(mean[3].A_i - 7 / 3) < 1e-12                       # not cut to a whole number
    scored = prep.impute_scoring(df, ["A_v", "RECENCY"], keep=()).collect()
    assert [tuple(r) for r in scored] == [(0.0, 365.0), (2.0, 7.0), (0.0, 365.0), (5.0, 3.0)]
    p = {r.column_name: r for r in quality.profile(df.select("A_v", "A_i")).collect()}
    assert (p["A_v"].null_count, p["A_v"].distinct_count, p["A_v"].max_value, p["A_v"].mean) == (2, 2, 5.0, 3.5)
    h = quality.histogram(df, ["A_v"], bins=3).collect()
    assert sorted((r.bin, r.bin_count) for r in h) == [(1, 1), (3, 1)]
    assert prep.fit_standard_scaler(df, ["A_v"]) == {"A_v": (3.5, 1.5)}
    hot = prep.one_hot(df, ["k.1"])                                # dotted names and levels
    assert hot.columns[-1] == "k.1_y.z"
    stats = prep.fit_standard_scaler(hot, ["k.1_y.z"])
    assert prep.apply_standard_scaler(hot, stats).count() == 4


def test_null_order_ids_and_addresses_are_spread(spark):
    from winback.operators.attribution import with_last_touch
    lr = spark.createDataFrame([(i, None if i % 2 else i) for i in range(40)],
                               "transaction_guid long, src_atg_ecom_order_id long")
    web = spark.createDataFrame([(i, f"c{i}") for i in range(0, 40, 4)] + [(None, "none")],
                                "orders long, last_touch_channel string")
    got = {r.transaction_guid: r.last_touch_channel for r in with_last_touch(lr, web_touch=web).collect()}
    assert got == {i: f"c{i}" if i % 4 == 0 else None for i in range(40)}


def test_distributed_rank_with_coalesced_partitions(spark):
    from pyspark.sql import Window
    from winback.operators.ranking import ntile_within_group
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = [(g, i, (i * 7919) % 1009) for g, n in ((1, 5), (2, 1500)) for i in range(n)]
        df = spark.createDataFrame(rows, "g int, id int, v int")
        want = df.withColumn("t", F.ntile(7).over(Window.partitionBy("g").orderBy("v", "id")))
        got = ntile_within_group(df, "g", ["v", "id"], 7, "t")
        assert sorted((r.g, r.id, r.t) for r in want.collect()) == \
            sorted((r.g, r.id, r.t) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_key_hash_sample_is_stable_and_near_fraction(spark):
    from winback.operators.prep import sample_rows
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = sample_rows(df, 0.6, keys=["k"])
    b = sample_rows(df.repartition(7), 0.6, keys=["k"])
    ka = {r.k for r in a.collect()}
    assert ka == {r.k for r in b.collect()}
    assert abs(len(ka) / 20000 - 0.6) < 0.02


def test_last_touch_shortcut_equals_general_join(spark, sf_dir):
    from winback.operators.attribution import ecomm_transactions, with_last_touch
    from winback.plans import jobs
    from winback.sources.fixtures import Fixtures
    fx = Fixtures(spark, sf_dir)
    lr = jobs.stage_reactivation(fx)
    a = with_last_touch(lr, web_touch=fx.web_touch()).distinct()
    b = with_last_touch(lr, ecomm=ecomm_transactions(fx.txn(), fx.web_touch())).distinct()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_vector_one_hot_drops_the_same_first_level(spark):
    from pyspark.ml.functions import vector_to_array
    from winback.operators.prep import one_hot, one_hot_vector
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, "b")], "id int, c string")
    flat = {r.id: (r.c_b, r.c_c) for r in one_hot(df, ["c"]).collect()}
    _, vec = one_hot_vector(df, ["c"])
    arr = {r.id: list(r.v) for r in vec.select("id", vector_to_array("c_vec").alias("v")).collect()}
    # alphabetDesc order c, b, a; dropLast removes 'a'; handleInvalid adds no slot for seen data
    for k, (b, c) in flat.items():
        assert arr[k][:2] == [c, b]


def test_one_row_per_transaction_keeps_first_previous_day_row(spark, sf_dir):
    from pyspark.sql import Window
    from winback.operators.reactivation import reactivations
    from winback.plans import jobs
    from winback.sources.fixtures import Fixtures
    trans = jobs.stage_transactions(Fixtures(spark, sf_dir))
    full = reactivations(trans, "2000-01-01")
    one = reactivations(trans, "2000-01-01", one_row_per="transaction")
    key = ["customer_id", "transaction_guid"]
    w = Window.partitionBy(*key).orderBy("previous_trans_id", F.col("pre_ecom_order_id").asc_nulls_first(),
                                         "pre_coupon_flag", "pre_src_order")
    want = full.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")
    assert one.count() == full.select(*key).distinct().count()
    assert want.exceptAll(one.select(*want.columns)).count() == 0


def test_ethnicity_fan_out_kept_unless_deduped(spark):
    from winback.operators.attributes import ethnicity_source
    demo = spark.createDataFrame([(1, 11, 1, 0, 0, 0), (1, 11, 1, 0, 0, 0)],
                                 "customer_guid bigint, address_guid bigint, A3101N_RACE_WHITE int, "
                                 "A3101N_RACE_HISP int, A3101N_RACE_AFRAM int, A3101N_RACE_ASIAN int")
    assert ethnicity_source(demo).count() == 2
    assert ethnicity_source(demo, dedupe=True).count() == 1
