"""Joins whose keys hold much of a table: salted heavy keys, snapshots by key, the oracle's
own mapping against a mutated one."""

import collections

import pytest
from pyspark.sql import functions as F

from oracle.queries import oracle_queries
from tests.oracle_compare import compare
from winback.operators import attributes as attr
from winback.operators.skew import heavy_keys, skewed_join
from winback.plans import jobs
from winback.sources.fixtures import Fixtures


def _sides(spark):
    left = spark.range(20_000).select((F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 10 == 1, 8)
                                       .when(F.col("id") % 97 == 3, None).otherwise(F.col("id") % 900 + 20)).alias("k"), "id")
    right = spark.range(700).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("v"))
    return left, right.unionByName(spark.createDataFrame([(7, -1), (7, -2), (None, -3)], "rk long, v long"))


def test_skewed_join_equals_a_plain_one(spark):
    left, right = _sides(spark)
    left = left.unionByName(left.where("id < 50"))              # repeated rows
    assert heavy_keys(left, "k") == [7, 8]
    want = left.join(right, F.col("k") == F.col("rk"))
    got = skewed_join(left, right, "k", "rk")
    assert got.columns == want.columns
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(map(tuple, want.collect()))
    assert heavy_keys(left.limit(0), "k") == [] and skewed_join(left.limit(0), right, "k", "rk").count() == 0


def test_half_of_all_rows_on_one_key_are_spread(spark):
    left, right = _sides(spark)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = skewed_join(left, right, "k", "rk").groupBy(F.spark_partition_id().alias("p")).count().collect()
        sizes = sorted(r["count"] / 3 for r in rows)            # the heavy key has three matches
        assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _pit(fx, columns=attr.FEATURE_COLUMNS, roles=attr.PERIOD_ROLE):
    keep = ["customer_id", "transaction_guid", "previous_trans_id", "address_id", "previous_buy",
            "FISCAL_PERIOD_ID", "PRE_FISCAL_PERIOD_ID"]
    return attr.with_snapshots(jobs.stage_channel(fx), jobs.snapshot_tables(fx), columns=columns, period_role=roles, keep=keep)


@pytest.mark.parametrize("what", ["none", "column", "snapshot", "period"])
def test_the_oracle_sees_a_wrong_mapping(spark, sf_dir, duck, what, monkeypatch):
    columns, roles = list(attr.FEATURE_COLUMNS), dict(attr.PERIOD_ROLE)
    if what == "column":        # two attributes of one snapshot exchanged
        i, j = [k for k, c in enumerate(columns) if c[1] == "g"][:2]
        columns[i], columns[j] = (columns[i][0], "g", columns[j][2]), (columns[j][0], "g", columns[i][2])
    elif what == "snapshot":    # an attribute taken from another snapshot
        i = next(k for k, c in enumerate(columns) if c[1] == "f")
        columns[i] = (columns[i][0], "h", columns[i][2])
    elif what == "period":      # a snapshot read at the other purchase's period
        roles["h"] = "FISCAL_PERIOD_ID"
    monkeypatch.setattr(attr, "FEATURE_COLUMNS", columns)
    info = compare(spark, duck, "pit_features", lambda s, d: _pit(Fixtures(s, d), columns, roles),
                   oracle_queries()["pit_features"], sf_dir)
    assert info["cols"] and info["hash"] == (what == "none")


def test_snapshot_keys_must_be_unique(spark):
    base = spark.createDataFrame([(1, 10, 202001, 202002), (2, None, 202001, 202002), (3, None, 202001, None)],
                                 "customer_id long, address_id long, PRE_FISCAL_PERIOD_ID int, FISCAL_PERIOD_ID int")
    t = spark.createDataFrame([(10, 202001, 1.0), (10, 202002, 2.0), (None, 202001, 9.0)],
                              "address_guid long, fiscal_period_id int, x double")
    roles = {"b": "PRE_FISCAL_PERIOD_ID", "e": "FISCAL_PERIOD_ID"}
    columns = [("X", "b", "x"), ("Y", "e", "x")]
    got = attr.with_snapshots(base, {"b": t, "e": t}, columns, roles, keep=["customer_id"])
    assert sorted(map(tuple, got.collect())) == [(1, 1.0, 2.0), (2, None, None), (3, None, None)]
    with pytest.raises(Exception, match="snapshot rows repeat"):
        attr.with_snapshots(base, {"b": t.unionByName(t), "e": t}, columns, roles, keep=["customer_id"]).collect()


def test_snapshots_are_cut_to_the_keys_read(spark):
    base = spark.createDataFrame([(1, 10, 202001, 202002), (2, None, 202001, 202002), (3, None, 202001, None)],
                                 "customer_id long, address_id long, PRE_FISCAL_PERIOD_ID int, FISCAL_PERIOD_ID int")
    t = spark.createDataFrame([(10, 202001, 1.0), (10, 202002, 2.0), (20, 202001, 3.0), (20, 202001, 4.0)],
                              "address_guid long, fiscal_period_id int, x double")
    roles = {"b": "PRE_FISCAL_PERIOD_ID", "e": "FISCAL_PERIOD_ID"}
    columns = [("X", "b", "x"), ("Y", "e", "x")]
    got = attr.with_snapshots(base, {"b": t, "e": t}, columns, roles, keep=["customer_id"], read_at=base)
    assert sorted(map(tuple, got.collect())) == [(1, 1.0, 2.0), (2, None, None), (3, None, None)]
    with pytest.raises(Exception, match="snapshot rows repeat"):
        attr.with_snapshots(base, {"b": t.unionByName(t), "e": t}, columns, roles, keep=["customer_id"],
                            read_at=base).collect()


def test_snapshots_are_shuffled_once_per_role(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    conf = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        base = spark.createDataFrame([(1, 10, 202001, 202002)],
                                     "customer_id long, address_id long, PRE_FISCAL_PERIOD_ID int, FISCAL_PERIOD_ID int")
        plan = attr.with_snapshots(base, jobs.snapshot_tables(fx), keep=["customer_id"])
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", conf[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", conf[1])
    assert text.count("Exchange hashpartitioning") == 4         # two roles, both sides of two joins
