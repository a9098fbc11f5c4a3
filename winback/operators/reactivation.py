"""Dormancy / reactivation detection (first SQL statement of the pipeline).

WIN-1/2/3, JOIN-1, JOIN-3, AGG-1, FLT-1/2/5, PRJ-1.

Semantics (as the warehouse SQL): per customer, transactions inside the
trailing window are ordered by date; each gets the previous transaction's
date (``LAG``), the day gap and the calendar-month gap; rows with a gap of at
least ``min_gap_months`` are reactivations. Each is then joined back to *all*
distinct transactions of that customer on the previous date (fan-out kept).

Plan shape, chosen for skew: the ``LAG`` is not computed over raw
transactions. With ties broken by transaction id, only the first transaction
of a day can carry a non-zero gap, so the window runs over one row per
(customer, day), built by a hash aggregate with map-side partial aggregation.
A window partition therefore holds at most one row per day of the trailing
window (about 731), even for a customer that owns a third of all rows. The
fan-out join back is keyed on (customer, day) and reads only in-window rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winback.functions.dates import day_gap, month_gap, trailing_window

TRANS_COLUMNS = ["customer_id", "transaction_booked_date", "src_atg_ecom_order_id",
                 "coupon_flag", "same_day_delivery_line_indicator",
                 "ecom_order_source_code", "transaction_guid"]
# Tie-break of same-day transactions: transaction id, then the other columns.
_TIE_ORDER = ["transaction_guid", "src_atg_ecom_order_id", "coupon_flag",
              "same_day_delivery_line_indicator", "ecom_order_source_code"]


def clean_transactions(txn: DataFrame, xref: DataFrame, concept_format_id: int = 1) -> DataFrame:
    """TRANS: transactions of one concept linked to a known customer (JOIN-1,
    FLT-1). The ``customer_id > 0`` predicate is pushed into the xref scan.
    Rows are not de-duplicated here: every consumer below either aggregates or
    de-duplicates after narrowing, which avoids a full shuffle of all rows."""
    t = txn.where(F.col("concept_format_id") == concept_format_id)
    x = xref.where(F.col("customer_id") > 0).select("trans_id", "customer_id")
    return t.join(x, t.transaction_guid == x.trans_id).select(*TRANS_COLUMNS)


def reactivations(trans: DataFrame, as_of: str, window_months: int = 24,
                  min_gap_months: int = 6, one_row_per: str | None = None) -> DataFrame:
    """LR_Reactive: one row per (reactivating transaction, transaction on the
    previous purchase date); 14 columns.

    ``one_row_per="transaction"`` drops the fan-out instead: each reactivation
    keeps only the first transaction of the previous day (same tie order).
    That one comes from the lag of the per-day rows themselves, so this
    variant needs no join back at all."""
    # The explicit NOT NULL (implied by the window) is also what the optimizer
    # infers for the join-back branch below; stating it here makes both reads
    # of the transactions canonically equal, so their shuffle is reused.
    tw = trans.where(trailing_window("transaction_booked_date", as_of, window_months) &
                     F.col("transaction_booked_date").isNotNull())

    first = F.min(F.struct(*_TIE_ORDER)).alias("first")
    days = tw.groupBy("customer_id", "transaction_booked_date").agg(first)

    w = Window.partitionBy("customer_id").orderBy("transaction_booked_date")
    prev = F.lag("transaction_booked_date").over(w)
    gaps = (days.withColumn("previous_buy", prev)
            .withColumn("prev_first", F.lag("first").over(w))
            .withColumn("month_interval", month_gap("previous_buy", "transaction_booked_date"))
            .where(F.col("month_interval") >= min_gap_months)
            .select("customer_id",
                    F.col("first.transaction_guid").alias("transaction_guid"),
                    "transaction_booked_date",
                    F.col("first.src_atg_ecom_order_id").alias("src_atg_ecom_order_id"),
                    F.col("first.coupon_flag").alias("coupon_flag"),
                    F.col("first.same_day_delivery_line_indicator")
                     .alias("same_day_delivery_line_indicator"),
                    F.col("first.ecom_order_source_code").alias("ecom_order_source_code"),
                    "previous_buy",
                    day_gap("previous_buy", "transaction_booked_date").alias("time_interval"),
                    "month_interval", "prev_first"))

    if one_row_per == "transaction":
        return gaps.select(*[c for c in gaps.columns if c != "prev_first"],
                           F.col("prev_first.transaction_guid").alias("previous_trans_id"),
                           F.col("prev_first.coupon_flag").alias("pre_coupon_flag"),
                           F.col("prev_first.ecom_order_source_code").alias("pre_src_order"),
                           F.col("prev_first.src_atg_ecom_order_id").alias("pre_ecom_order_id"))
    if one_row_per is not None:
        raise ValueError("one_row_per must be None or 'transaction'")
    gaps = gaps.drop("prev_first")

    # JOIN-3. previous_buy is always an in-window date of the same customer, so
    # the reference's LEFT join always matches: an inner join is equal and lets
    # AQE split a skewed side.
    b = tw.select(F.col("customer_id").alias("b_customer_id"),
                  F.col("transaction_booked_date").alias("b_date"),
                  F.col("transaction_guid").alias("previous_trans_id"),
                  F.col("coupon_flag").alias("pre_coupon_flag"),
                  F.col("ecom_order_source_code").alias("pre_src_order"),
                  F.col("src_atg_ecom_order_id").alias("pre_ecom_order_id"),
                  F.col("same_day_delivery_line_indicator").alias("b_same_day"))
    joined = gaps.join(b, (gaps.customer_id == b.b_customer_id) &
                       (gaps.previous_buy == b.b_date))
    # TRANS was DISTINCT over its 7 columns: de-duplicate the joined rows on
    # (reactivation row, all 7 columns of b), then drop b's extra columns.
    # Rows that differ only in a dropped column stay duplicated, as before.
    out_cols = gaps.columns + ["previous_trans_id", "pre_coupon_flag",
                               "pre_src_order", "pre_ecom_order_id"]
    return joined.select(*out_cols, "b_same_day").distinct().select(*out_cols)
