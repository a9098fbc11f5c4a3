"""Oracle SQL bodies per registered query (prefixed with the CTEs they need)."""

from __future__ import annotations

from oracle.sql import FEATURE_SELECT, attrs_body, with_ctes

KEYS = ("base.customer_id, base.transaction_guid, base.previous_trans_id, base.address_id, "
        "base.previous_buy")

BODIES: dict[str, str] = {
    "reactivation": "SELECT * FROM o_react",
    "campaign_exposure": "SELECT * FROM o_expo",
    "exposure_window_join": """
SELECT a.customer_id, a.transaction_guid, a.transaction_booked_date, a.previous_trans_id,
       d.COUPON_BARCODE1, d.IN_HOME_DT
FROM o_react a LEFT JOIN o_expo d ON d.customer_id = a.customer_id
  AND a.transaction_booked_date - d.IN_HOME_DT BETWEEN 0 AND 14""",
    "channel_attribution": "SELECT * FROM o_channel",
    "demographics": attrs_body([KEYS, "gender", "age_bucket", "ethnicity", "INCOME"],
                               ["age", "gender", "ethnicity", "income"]),
    "region_division": attrs_body([KEYS, "State_Division"], ["territory"]),
    "pit_features": attrs_body([KEYS, "base.FISCAL_PERIOD_ID", "base.PRE_FISCAL_PERIOD_ID",
                                FEATURE_SELECT], ["snapshots"]),
    "latest_persona": """
SELECT p.customer_id, p.scoring_year_and_period, p.Persona FROM persona_hist p
WHERE p.scoring_year_and_period >= ALL (SELECT q.scoring_year_and_period FROM persona_hist q
                                        WHERE q.customer_id = p.customer_id)""",
    "customer_attributes": "SELECT * FROM o_attrs",
    "segment_link": "SELECT * FROM o_link",
    "segment_flags": """
SELECT DISTINCT a.customer_id, cc.address_id,
       CASE WHEN EXISTS (SELECT 1 FROM address_segments sg WHERE sg.ADDRESS_ID = cc.address_id)
            THEN 1 ELSE 0 END AS ME_LINK
FROM (SELECT DISTINCT customer_id FROM o_attrs) a
LEFT JOIN customer_curr cc ON cc.customer_id = a.customer_id""",
    "segment_population": """
SELECT * FROM o_attrs WHERE customer_id IN (SELECT customer_id FROM o_link)""",
}


def _attributes_coverage() -> str:
    from oracle.sql import DERIVED
    from oracle.features import FEATURES
    base = ["customer_id", "transaction_guid", "transaction_booked_date", "src_atg_ecom_order_id",
            "coupon_flag", "same_day_delivery_line_indicator", "ecom_order_source_code",
            "previous_buy", "time_interval", "month_interval", "previous_trans_id",
            "pre_coupon_flag", "pre_src_order", "pre_ecom_order_id", "FISCAL_PERIOD_ID",
            "PRE_FISCAL_PERIOD_ID", "last_touch_channel", "DM_Flag", "address_id",
            "reactivation_channel"]
    cols = base + list(DERIVED) + [o for (o, _, _) in FEATURES]
    parts = " UNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
        f"count(*) AS row_count FROM o_attrs" for c in cols)
    return f"""
SELECT column_name, null_count, row_count, 1 - null_count / row_count AS coverage_ratio,
       CAST(trunc(round_even((1 - null_count / row_count) * 100, 0) / 100 * 100) AS INTEGER)
         AS coverage_pct
FROM ({parts})"""


def oracle_queries() -> dict[str, str]:
    from oracle.notebook import BODIES as NOTEBOOK
    bodies = {**BODIES, **NOTEBOOK, "attributes_coverage": _attributes_coverage()}
    return {k: with_ctes(v) for k, v in bodies.items()}
