"""Replaced tables, the value table, dictionaries and weights of many classes."""

import math
import random
import uuid
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from winback.operators import prep, quality, values, weights
from winback.session import scratch_path
from winback.sources import io


def _path(spark):
    return scratch_path(spark, f"test_{uuid.uuid4().hex[:12]}")


def test_a_failing_write_leaves_the_old_table(spark):
    path = _path(spark)
    io.write_table(spark.range(5), path)
    broken = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        io.write_table(broken, path)
    assert io.read_table(spark, path).count() == 5
    reader = io.read_table(spark, path)             # a reader that began before the replacement
    io.write_table(io.read_table(spark, path).select((F.col("id") + 1).alias("id")), path)      # reads what it replaces
    assert sorted(r.id for r in reader.collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.id for r in io.read_table(spark, path).collect()) == [1, 2, 3, 4, 5]
    for _ in range(3):
        io.write_table(spark.range(2), path)
    assert len(io.Files(spark, path).names(io.VERSIONS)) == 2
    with pytest.raises(Exception):
        spark.read.parquet(path).count()            # never two versions at once


def test_partitions_order_and_plain_folders(spark):
    path = _path(spark)
    df = spark.range(20).select("id", (F.col("id") % 3).alias("k"))
    io.write_table(df, path, partition_by=["k"], sort_within=[F.desc("id")])
    assert io.read_table(spark, path).where("k = 1").count() == 7
    plain = _path(spark)
    df.write.parquet(plain)
    assert io.read_table(spark, plain).count() == 20


def test_catalog_table_is_replaced(spark):
    name, path = f"t_{uuid.uuid4().hex[:8]}", _path(spark)
    try:
        io.replace_catalog_table(spark.range(3), name, path)
        io.replace_catalog_table(spark.range(5), name, path)
        assert spark.table(name).count() == 5
        with pytest.raises(Exception):
            io.replace_catalog_table(spark.range(5).select(F.raise_error(F.lit("no")).alias("id")), name, path)
        assert spark.table(name).count() == 5
        io.replace_catalog_table(spark.range(2).select("id", F.lit("x").alias("y")), name, path)
        assert spark.table(name).columns == ["id", "y"] and spark.table(name).count() == 2
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _mixed(spark, n=4000):
    r = random.Random(4)
    nan = float("nan")
    rows = [(i, r.choice([None, nan, 1.5, -0.0, 0.0, r.random()]), 2 ** 53 + r.randrange(4), r.choice(["a", "b", "", None]),
             r.random() < 0.3, None) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id int, `x.y` double, big long, t string, f boolean, e double")


def test_profile_from_the_value_table(spark):
    rows, df = _mixed(spark)
    got = {r.column_name: r for r in quality.profile(df).collect()}
    for i, c in enumerate(df.columns):
        v = [x[i] for x in rows if x[i] is not None and not (isinstance(x[i], float) and math.isnan(x[i]))]
        assert (got[c].null_count, got[c].distinct_count) == (len(rows) - len(v), len(set(v)))
        if i in (0, 1, 2):
            assert got[c].median == pytest.approx(float(np.median(v)), rel=1e-15)
        else:
            assert got[c].median is None
    plan = quality.profile(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_quantiles_and_modes(spark):
    rows, df = _mixed(spark)
    df = df.repartition(7)
    at = [0.0, 0.25, 0.5, 0.9, 1.0]
    v = values.value_table(df)
    got = {(r.column_name, r.quantile): r.value for r in values.quantiles(v, at).collect()}
    for i, c in ((0, "id"), (1, "x.y")):
        x = [r[i] for r in rows if r[i] is not None and not math.isnan(r[i])]
        for q in at:
            assert got[c, q] == pytest.approx(float(np.quantile(x, q)))
    assert not any(c in ("t", "f", "e") for c, _ in got)
    modes = {r.column_name: r for r in values.modes(v).collect()}
    count = Counter(r[3] for r in rows if r[3] is not None)
    assert modes["t"].text == min(count, key=lambda k: (-count[k], k))
    empty = values.value_table(df.limit(0))
    assert values.quantiles(empty).count() == 0 and quality.profile(df.limit(0)).count() == len(df.columns)


def test_dictionary_and_weights_of_100_000_classes(spark):
    df = spark.range(200_001).select("id", F.format_string("c%06d", F.col("id") % 100_000).alias("k"))
    df = df.unionByName(spark.createDataFrame([(-1, None)], "id long, k string"))
    lab = prep.label_index(df, "k")
    assert lab.columns == ["id", "k", "label"] and lab.count() == 200_002
    assert lab.where("label is not null and label != id % 100000").count() == 0
    assert lab.where("label is null").count() == 1
    w = weights.sample_weights(lab, 0.5)
    r = {x.id: x.sample_weight for x in w.where("id in (-1, 0, 1, 99999)").collect()}
    one = 200_001 / (100_000 * 2)
    assert r[-1] is None and r[1] == r[99999] == pytest.approx(one)
    assert r[0] == pytest.approx(200_001 / (100_000 * 3) * 0.5)         # the largest class
    second = weights.sample_weights(lab, 0.5, adjust="index", index=1).where("id = 1").first()
    assert second.sample_weight == pytest.approx(one / 2)
