"""Oracle SQL for the data-quality, preparation and metric queries."""

from __future__ import annotations

# prep_wide columns and whether they are numeric (by the fixture's schema)
PREP_COLS = [("customer_id", 1), ("reactivation_channel", 0), ("State_Division", 0),
             ("gender", 0), ("age_bucket", 0), ("INCOME", 0), ("ethnicity", 0),
             ("pre_src_order", 0), ("pre_coupon_flag", 0), ("time_interval", 1),
             ("BUYS_Q_01", 1), ("COUPON_Q_01", 1), ("A_X", 1), ("BBB_R_2Y", 1), ("PCT_T", 0),
             ("X_DECILE", 1), ("PH_DM_RECENCY", 1), ("BBB_EMPTY", 1), ("MOVER", 0)]
NUMERIC = [c for c, n in PREP_COLS if n]
TEXT = [c for c, n in PREP_COLS if not n]

_NULLS = " UNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
    f"count(*) AS row_count FROM prep_wide" for c, _ in PREP_COLS)

_COVERAGE = f"""
SELECT column_name, null_count, row_count,
       1 - null_count / row_count AS coverage_ratio,
       CAST(trunc(round_even((1 - null_count / row_count) * 100, 0) / 100 * 100) AS INTEGER)
         AS coverage_pct
FROM ({_NULLS})"""


def _profile_part(c: str, numeric: int) -> str:
    if numeric:
        x = f"CAST({c} AS DOUBLE)"
        stats = (f"min({x}), max({x}), round(avg({x}), 6), round(stddev_samp({x}), 6), "
                 f"CAST(median({x}) AS DOUBLE)")
    else:
        stats = ", ".join(["CAST(NULL AS DOUBLE)"] * 5)
    return (f"SELECT '{c}', count(*), CAST(count(*) - count({c}) AS BIGINT), "
            f"count(DISTINCT {c}), {numeric}, {stats} FROM prep_wide")


_PROFILE = ("SELECT * FROM (" + " UNION ALL\n".join(_profile_part(c, n) for c, n in PREP_COLS)
            + ") t(column_name, row_count, null_count, distinct_count, is_numeric, min_value, "
              "max_value, mean, std, median)")

_TOP = """
SELECT column_name, value, value_count, value_rank FROM (
  SELECT column_name, value, value_count,
         CAST(row_number() OVER (PARTITION BY column_name ORDER BY value_count DESC, value) AS INTEGER)
           AS value_rank
  FROM (SELECT column_name, value, count(*) AS value_count FROM (
        """ + " UNION ALL\n        ".join(
    f"SELECT '{c}' AS column_name, {c} AS value FROM prep_wide" for c in TEXT) + """
        ) WHERE value IS NOT NULL GROUP BY 1, 2))
WHERE value_rank <= 20"""


def _hist_part(c: str) -> str:
    return f"""
SELECT '{c}' AS column_name, bin, lo + (bin - 1) * w AS bin_lo, lo + bin * w AS bin_hi,
       count(*) AS bin_count
FROM (SELECT CASE WHEN w = 0 THEN 1
                  ELSE least(50, CAST(floor((x - lo) / w) AS INTEGER) + 1) END AS bin, lo, w
      FROM (SELECT CAST({c} AS DOUBLE) AS x FROM prep_wide WHERE {c} IS NOT NULL) v,
           (SELECT min(CAST({c} AS DOUBLE)) AS lo, (max(CAST({c} AS DOUBLE)) - min(CAST({c} AS DOUBLE))) / 50 AS w
            FROM prep_wide) s)
GROUP BY bin, lo, w"""


_HIST = " UNION ALL".join(_hist_part(c) for c in NUMERIC if c != "BBB_EMPTY")

_MODE_INCOME = ("(SELECT INCOME FROM prep_wide WHERE INCOME IS NOT NULL GROUP BY INCOME "
                "ORDER BY count(*) DESC, INCOME LIMIT 1)")

_IMPUTED = f"""
SELECT customer_id, reactivation_channel, State_Division,
       coalesce(gender, 'UNKNOWN') AS gender, age_bucket,
       coalesce(INCOME, {_MODE_INCOME}) AS INCOME, ethnicity, pre_src_order, pre_coupon_flag,
       time_interval, coalesce(BUYS_Q_01, 0) AS BUYS_Q_01, coalesce(COUPON_Q_01, 0) AS COUPON_Q_01,
       coalesce(A_X, 0) AS A_X, BBB_R_2Y, PCT_T, X_DECILE, PH_DM_RECENCY, BBB_EMPTY, MOVER
FROM prep_wide"""

# expected sorted category levels of the prepared table (first level dropped)
_LEVELS = {
    "State_Division": ["Midwest", "Northeast", "South", "UNKNOWN", "West"],
    "gender": ["F", "M", "UNKNOWN"],
    "age_bucket": ["AGE_18_24", "AGE_25_40", "AGE_41_54", "AGE_ABOVE_55", "AGE_LESS_17", "UKNOWN"],
    "INCOME": ["A", "B", "C", "D", "E"],
    "ethnicity": ["AFRAM", "ASIAN", "HISP", "WHITE"],
    "Pre_Buying_Channel": ["Instore", "Online"],
}
_ENC = ",\n       ".join(
    f"CAST(CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS \"{c}_{v}\""
    for c, lv in _LEVELS.items() for v in lv[1:])

_ONE_HOT = f"""
SELECT customer_id, reactivation_channel, time_interval, BUYS_Q_01, COUPON_Q_01, BBB_R_2Y, PCT_T,
       X_DECILE, PH_DM_RECENCY, MOVER,
       {_ENC}
FROM (SELECT customer_id, reactivation_channel, State_Division,
             CASE gender WHEN '' THEN 'UNKNOWN' WHEN 'M' THEN 'M' WHEN 'F' THEN 'F'
                         ELSE 'UNKNOWN' END AS gender,
             age_bucket, INCOME, ethnicity,
             CASE WHEN pre_src_order IS NOT DISTINCT FROM 'U' THEN 'Instore' ELSE 'Online' END
               AS Pre_Buying_Channel,
             time_interval, BUYS_Q_01, COUPON_Q_01, BBB_R_2Y, PCT_T, X_DECILE, PH_DM_RECENCY, MOVER
      FROM ({_IMPUTED}))"""

_LABELLED = """
SELECT customer_id, reactivation_channel,
       CAST(dense_rank() OVER (ORDER BY reactivation_channel) - 1 AS INTEGER) AS label
FROM prep_wide"""

_SPLIT = f"""
SELECT customer_id, label,
       CASE WHEN rk <= floor(n * 0.65 + 0.5) THEN 'train'
            WHEN rk <= floor(n * {0.65 + 0.175!r} + 0.5) THEN 'valid' ELSE 'test' END AS split
FROM (SELECT customer_id, label,
             row_number() OVER (PARTITION BY label ORDER BY customer_id) AS rk,
             count(*) OVER (PARTITION BY label) AS n
      FROM ({_LABELLED}))"""

_SCALE_COLS = ["time_interval", "BUYS_Q_01", "COUPON_Q_01", "BBB_R_2Y", "X_DECILE",
               "PH_DM_RECENCY"]
_SCALED = ",\n       ".join(
    f"round((CAST(d.{c} AS DOUBLE) - s.m_{c}) / "
    f"CASE WHEN s.s_{c} IS NULL OR s.s_{c} = 0 THEN 1 ELSE s.s_{c} END, 6) AS {c}"
    for c in _SCALE_COLS)
_STATS = ", ".join(f"avg(CAST(d.{c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST(d.{c} AS DOUBLE)) AS s_{c}"
                   for c in _SCALE_COLS)

_TRANS_RAW = """
SELECT b.customer_id, a.transaction_booked_date, a.src_atg_ecom_order_id, a.coupon_flag,
       a.same_day_delivery_line_indicator, a.ecom_order_source_code, a.transaction_guid
FROM txn a JOIN txn_xref b ON a.transaction_guid = b.trans_id AND b.customer_id > 0
WHERE a.concept_format_id = 1"""

_DEDUP = f"""
SELECT customer_id, transaction_booked_date, src_atg_ecom_order_id, coupon_flag,
       same_day_delivery_line_indicator, ecom_order_source_code, transaction_guid
FROM (SELECT *, row_number() OVER (
        PARTITION BY customer_id, transaction_booked_date
        ORDER BY transaction_guid, src_atg_ecom_order_id NULLS FIRST, coupon_flag NULLS FIRST,
                 same_day_delivery_line_indicator NULLS FIRST,
                 ecom_order_source_code NULLS FIRST) AS rn
      FROM ({_TRANS_RAW}))
WHERE rn = 1"""

_SCORING = [("BBB_INSTORE_M_DECILE_2Y", 11), ("A_AAP000447N_ASET_PRPN_DIS_INC", 0),
            ("time_interval", 0), ("PH_DM_RECENCY", 365), ("AVG_NET_SALES_PER_TXN", 0),
            ("COUPON_SALES_Q_08", 0), ("A_A3101N_RACE_WHITE", 0), ("BBB_R_2Y", 720),
            ("MOVER", 0), ("NUM_MERCH_DIVISIONS", 0), ("AVG_TOTAL_ITEMS_PER_TXN", 0),
            ("A_A8588N_HM_SQR_FT", 0), ("PH_MREDEEM730D_PERC", 0)]

_REPORT = """
WITH cm AS (SELECT label, prediction, count(*) AS n FROM predictions GROUP BY 1, 2),
sup AS (SELECT label AS k, sum(n) AS support FROM cm GROUP BY 1),
prd AS (SELECT prediction AS k, sum(n) AS predicted FROM cm GROUP BY 1),
tp AS (SELECT label AS k, n AS tp FROM cm WHERE label = prediction),
per AS (SELECT coalesce(sup.k, prd.k) AS k, coalesce(support, 0) AS support,
               coalesce(predicted, 0) AS predicted, coalesce(tp, 0) AS tp
        FROM sup FULL JOIN prd ON sup.k = prd.k LEFT JOIN tp ON tp.k = coalesce(sup.k, prd.k)),
m AS (SELECT CAST(k AS VARCHAR) AS class_name, support, tp,
             CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM per),
f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1 FROM m),
tot AS (SELECT sum(support) AS t, sum(tp) AS c FROM f)
SELECT class_name, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(c / t, 6), CAST(t AS BIGINT) FROM tot
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6),
                 CAST((SELECT t FROM tot) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * support) / (SELECT t FROM tot), 6),
                 round(sum(r * support) / (SELECT t FROM tot), 6),
                 round(sum(f1 * support) / (SELECT t FROM tot), 6),
                 CAST((SELECT t FROM tot) AS BIGINT) FROM f"""

PREDICTIONS = """
SELECT customer_id, label,
       CASE WHEN customer_id % 5 = 4 THEN label ELSE CAST(customer_id % 5 % 3 AS INTEGER) END
         AS prediction
FROM (SELECT customer_id, CASE reactivation_channel WHEN 'DM' THEN 0 WHEN 'Others' THEN 1
                                ELSE 2 END AS label FROM prep_wide)"""

BODIES: dict[str, str] = {
    "null_report": _NULLS,
    "coverage": _COVERAGE,
    "drop_low_coverage": "SELECT * EXCLUDE (A_X, BBB_EMPTY) FROM prep_wide",
    "profile": _PROFILE,
    "top_values": _TOP,
    "histogram": _HIST,
    "dedup": _DEDUP,
    "dedup_report": f"""
SELECT (SELECT count(*) FROM ({_TRANS_RAW})) AS rows_before, (SELECT count(*) FROM ({_DEDUP})) AS rows_after,
       (SELECT count(*) FROM ({_TRANS_RAW})) - (SELECT count(*) FROM ({_DEDUP})) AS rows_removed""",
    "recast": """
SELECT customer_id, reactivation_channel, State_Division, gender, age_bucket, INCOME, ethnicity,
       pre_src_order, pre_coupon_flag, time_interval, BUYS_Q_01,
       CAST(COUPON_Q_01 AS DOUBLE) AS COUPON_Q_01, CAST(A_X AS DOUBLE) AS A_X,
       CAST(BBB_R_2Y AS DOUBLE) AS BBB_R_2Y, CAST(PCT_T AS DOUBLE) AS PCT_T, X_DECILE,
       PH_DM_RECENCY, CAST(BBB_EMPTY AS DOUBLE) AS BBB_EMPTY, MOVER
FROM prep_wide""",
    "impute": _IMPUTED,
    "impute_scoring": "SELECT customer_id, pdm_prod_type_id, " + ", ".join(
        f"coalesce(TRY_CAST({c} AS DOUBLE), {float(v)!r}) AS {c}" for c, v in _SCORING)
        + " FROM propensity_training",
    "buying_channel": """
SELECT customer_id, pre_src_order,
       CASE WHEN pre_src_order IS NOT DISTINCT FROM 'U' THEN 'Instore' ELSE 'Online' END
         AS Pre_Buying_Channel
FROM prep_wide""",
    "gender_clean": """
SELECT customer_id, gender AS gender_raw,
       CASE gender WHEN '' THEN 'UNKNOWN' WHEN 'M' THEN 'M' WHEN 'F' THEN 'F' ELSE 'UNKNOWN' END
         AS gender
FROM prep_wide""",
    "one_hot": _ONE_HOT,
    "label_index": _LABELLED,
    "split_counts": f"SELECT split, label, count(*) AS class_count FROM ({_SPLIT}) GROUP BY 1, 2",
    "standard_scale": f"""
WITH d AS (SELECT i.customer_id, {", ".join("i." + c for c in _SCALE_COLS)}, sp.split
           FROM ({_IMPUTED}) i JOIN ({_SPLIT}) sp ON i.customer_id = sp.customer_id),
s AS (SELECT {_STATS} FROM d WHERE d.split = 'train')
SELECT d.customer_id, {_SCALED}, d.split FROM d, s""",
    "class_weights": f"""
SELECT label, class_count,
       CAST(sum(class_count) OVER () AS DOUBLE) / (count(*) OVER () * class_count) AS class_weight
FROM (SELECT label, count(*) AS class_count FROM ({_LABELLED}) GROUP BY 1)""",
    "sample_weights": f"""
WITH sp AS ({_SPLIT}),
coef AS (SELECT max(n) / sum(n) AS c FROM (SELECT label, count(*) AS n FROM sp GROUP BY 1)),
tr AS (SELECT customer_id, label FROM sp WHERE split = 'train'),
cc AS (SELECT label, count(*) AS n FROM tr GROUP BY 1),
w AS (SELECT label, n, CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n) AS cw,
             row_number() OVER (ORDER BY n DESC, label) AS big FROM cc)
SELECT tr.customer_id, tr.label,
       CASE WHEN w.big = 1 THEN w.cw * (SELECT c FROM coef) ELSE w.cw END AS sample_weight
FROM tr JOIN w ON tr.label = w.label""",
    "confusion": "SELECT label, prediction, count(*) AS n FROM predictions GROUP BY 1, 2",
    "class_report": _REPORT,
}


_PRODUCTS = [1, 2, 3, 4, 5, 6]  # six part types at every scale factor

BODIES.update({
    "product_targets": "SELECT customer_id, pdm_prod_type_id, " + ", ".join(
        f"CASE WHEN pdm_prod_type_id = {p} THEN 1 ELSE 0 END AS target_{p}" for p in _PRODUCTS)
        + " FROM propensity_training",
    "pivot_wide": "SELECT customer_id, " + ", ".join(
        f"max(CASE WHEN pdm_prod_type_id = {p} THEN lines END) AS p{p}" for p in _PRODUCTS) + """
FROM (SELECT o.o_custkey AS customer_id, pt.pdm_prod_type_id, count(*) AS lines
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN part p ON l.l_partkey = p.p_partkey JOIN product_types pt ON p.p_type = pt.p_type
      GROUP BY 1, 2)
GROUP BY customer_id""",
    "sample_limit": """
SELECT * FROM propensity_training ORDER BY customer_id, pdm_prod_type_id LIMIT 1000""",
    "sort_mixed": "SELECT * FROM o_channel ORDER BY customer_id, DM_Flag DESC",
    "roundtrip_table": "SELECT * FROM o_channel",
    "roundtrip_csv": _NULLS,
})


BODIES["score_frame_sql"] = ("SELECT customer_id, " + ", ".join(c for c, _ in _SCORING)
                             + " FROM propensity_training GROUP BY ALL")

# ---- what model outputs must satisfy --------------------------------------------------
# Model numbers have no SQL; the rows, bounds and counts of their outputs have.
_LEVEL_COLUMNS = " + ".join(f"(SELECT greatest(count(DISTINCT {c}) - 1, 0) FROM encoded)" for c in _LEVELS)

BODIES.update({
    "importance_checks": f"""
WITH encoded AS (
  SELECT State_Division, CASE gender WHEN 'M' THEN 'M' WHEN 'F' THEN 'F' ELSE 'UNKNOWN' END AS gender, age_bucket,
         coalesce(INCOME, {_MODE_INCOME}) AS INCOME, ethnicity,
         CASE WHEN pre_src_order IS NOT DISTINCT FROM 'U' THEN 'Instore' ELSE 'Online' END AS Pre_Buying_Channel
  FROM prep_wide),
n AS (SELECT least(30, 7 + {_LEVEL_COLUMNS}) AS n)  -- seven numeric columns stay: MOVER is text, two are dropped
SELECT CAST(n AS BIGINT) AS features, CAST(n AS BIGINT) AS names, CAST(n AS BIGINT) AS last_rank,
       CAST(0 AS BIGINT) AS negative, CAST(1 AS DOUBLE) AS total_importance FROM n""",
    "tuning_checks": """
SELECT CAST(3 AS BIGINT) AS trials, CAST(180 AS BIGINT) AS trees, CAST(3 AS BIGINT) AS inside,
       CAST(3 AS BIGINT) AS draws, true AS beats_largest_class""",
    "model_report_checks": f"""
SELECT split, label, count(*) AS support, true AS ratios, true AS accuracy_agrees
FROM ({_SPLIT}) WHERE split IN ('train', 'test') GROUP BY 1, 2""",
    "boosted_checks": f"""
SELECT label, count(*) AS support, true AS in_bounds, true AS explained
FROM ({_SPLIT}) WHERE split = 'test' GROUP BY 1""",
    "propensity_checks": """
SELECT pt.pdm_prod_type_id, count(*) AS customers, count(*) AS scores, CAST(0 AS BIGINT) AS outside, true AS mean_agrees
FROM (SELECT DISTINCT customer_id FROM propensity_training), product_types pt GROUP BY 1""",
})
