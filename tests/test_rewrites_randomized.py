"""The skew-safe rewrites give exactly the naive SQL's rows on random data
with a hot key, same-day ties, exact duplicates and NULLs (DuckDB runs the
naive form: LAG over raw rows, BETWEEN join, row_number)."""

import datetime as dt
import random

import duckdb
import pandas as pd

from winback.operators.exposure import window_join
from winback.operators.quality import drop_duplicates
from winback.operators.reactivation import reactivations

COLS = ["customer_id", "transaction_booked_date", "src_atg_ecom_order_id", "coupon_flag",
        "same_day_delivery_line_indicator", "ecom_order_source_code", "transaction_guid"]
SCHEMA = ("customer_id bigint, transaction_booked_date date, src_atg_ecom_order_id bigint, "
          "coupon_flag string, same_day_delivery_line_indicator string, "
          "ecom_order_source_code string, transaction_guid bigint")


def _random_trans(seed: int, hot_rows: int = 3000):
    rng = random.Random(seed)
    start = dt.date(2021, 1, 1)
    rows, guid = [], 0
    # one hot customer (a third of the rows or more), a few sparse ones
    for cust, n in [(1, hot_rows)] + [(c, rng.randint(1, 40)) for c in range(2, 60)]:
        days = sorted(rng.sample(range(0, 1100), k=min(n, rng.randint(2, 25))))
        for _ in range(n):
            guid += 1
            d = start + dt.timedelta(days=rng.choice(days))
            rows.append((cust, d, rng.choice([None, guid, guid * 3]), rng.choice("YN"),
                         rng.choice("YN"), rng.choice(["U", "W", None]), guid))
    rows += rng.sample(rows, 40)            # exact duplicate rows
    return rows


def _cell(v) -> str:
    if v is None or (isinstance(v, float) and v != v):
        return ""
    if isinstance(v, float) and v.is_integer():
        return str(int(v))      # pandas widens nullable integers to float
    return str(v)


def _canon(records):
    return sorted(tuple(_cell(v) for v in r) for r in records)


def test_reactivation_rewrite_equals_naive_lag(spark):
    rows = _random_trans(7)
    got = reactivations(spark.createDataFrame(rows, SCHEMA), "2023-12-31", 24, 6)
    pdf = pd.DataFrame(rows, columns=COLS)
    con = duckdb.connect()
    con.register("raw", pdf)
    want = con.execute("""
    WITH t AS (SELECT DISTINCT * FROM raw),
    w AS (SELECT *, lag(transaction_booked_date) OVER (PARTITION BY customer_id ORDER BY
            transaction_booked_date, transaction_guid, src_atg_ecom_order_id NULLS FIRST,
            coupon_flag NULLS FIRST, same_day_delivery_line_indicator NULLS FIRST,
            ecom_order_source_code NULLS FIRST) AS previous_buy
          FROM t WHERE transaction_booked_date BETWEEN DATE '2021-12-31' AND DATE '2023-12-31')
    SELECT a.customer_id, a.transaction_guid, a.transaction_booked_date, a.src_atg_ecom_order_id,
           a.coupon_flag, a.same_day_delivery_line_indicator, a.ecom_order_source_code,
           a.previous_buy,
           CAST(abs(date_diff('day', a.previous_buy, a.transaction_booked_date)) AS INTEGER),
           CAST(abs(date_diff('month', a.previous_buy, a.transaction_booked_date)) AS INTEGER),
           b.transaction_guid, b.coupon_flag, b.ecom_order_source_code, b.src_atg_ecom_order_id
    FROM w a LEFT JOIN t b ON a.customer_id = b.customer_id
      AND a.previous_buy = b.transaction_booked_date
    WHERE abs(date_diff('month', a.previous_buy, a.transaction_booked_date)) >= 6""").fetchall()
    assert len(want) > 0
    assert _canon([tuple(r) for r in got.collect()]) == _canon(want)


def test_bucketed_window_join_equals_between_join(spark):
    rng = random.Random(3)
    base = dt.date(2022, 1, 1)
    left = [(rng.choice([1, 1, 1, 2, 3]), base + dt.timedelta(days=rng.randint(0, 200)), i)
            for i in range(800)]
    right = [(rng.choice([1, 1, 2, 4]), base + dt.timedelta(days=rng.randint(-20, 210)), j)
             for j in range(300)]
    ldf = spark.createDataFrame(left, "k bigint, d date, lid int")
    rdf = spark.createDataFrame(right, "rk bigint, start date, rid int")
    got = window_join(ldf, rdf, left_key="k", right_key="rk", left_date="d",
                      right_start="start", days=14, how="left").select("lid", "rid")
    con = duckdb.connect()
    con.register("l", pd.DataFrame(left, columns=["k", "d", "lid"]))
    con.register("r", pd.DataFrame(right, columns=["rk", "start", "rid"]))
    want = con.execute("""SELECT lid, rid FROM l LEFT JOIN r ON l.k = r.rk
                          AND l.d BETWEEN r.start AND r.start + INTERVAL 14 DAY""").fetchall()
    assert _canon([tuple(r) for r in got.collect()]) == _canon(want)


def test_min_struct_dedup_equals_row_number(spark):
    rows = _random_trans(11, hot_rows=2000)
    df = spark.createDataFrame(rows, SCHEMA)
    got = drop_duplicates(df, ["customer_id", "transaction_booked_date"], ["transaction_guid"])
    con = duckdb.connect()
    con.register("raw", pd.DataFrame(rows, columns=COLS))
    want = con.execute("""
    SELECT customer_id, transaction_booked_date, src_atg_ecom_order_id, coupon_flag,
           same_day_delivery_line_indicator, ecom_order_source_code, transaction_guid
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, transaction_booked_date
            ORDER BY transaction_guid, src_atg_ecom_order_id NULLS FIRST, coupon_flag NULLS FIRST,
                     same_day_delivery_line_indicator NULLS FIRST,
                     ecom_order_source_code NULLS FIRST) AS rn FROM raw) WHERE rn = 1""").fetchall()
    assert _canon([tuple(r) for r in got.collect()]) == _canon(want)
