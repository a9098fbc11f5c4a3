"""Campaign exposure: direct-mail selection and the windowed exposure join.

FLT-2, FLT-3, FLT-7, JOIN-2, JOIN-4, JOIN-7, AGG-2, FN-4, FN-7, FN-8.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.functions.dates import trailing_window
from winback.operators.skew import skewed_join
from winback.sources.tables import projected_scan

DIRECT_MAIL_PATTERN = "%MAIN EVENT%DIRECT MAIL%"


def direct_mail_events(coupon_event: DataFrame, as_of: str, concept_format_id: int = 1,
                       pattern: str = DIRECT_MAIL_PATTERN, window_months: int = 24) -> DataFrame:
    """DM_step1: coupon events of one concept whose upper-cased description
    matches ``pattern`` and whose in-home date lies in the trailing window."""
    return projected_scan(coupon_event, ["Coupon_barcode_id", "IN_HOME_DT"],
                          (F.col("CONCEPT_FORMAT_ID") == concept_format_id) &
                          F.upper("COUPON_EVENT_KEY_DESC").like(pattern) &
                          trailing_window("IN_HOME_DT", as_of, window_months))


def campaign_exposures(campaign_hist: DataFrame, dm_events: DataFrame,
                       cust_skid: DataFrame, concept_id: int = 1) -> DataFrame:
    """step2: delivered direct-mail pieces resolved to the current customer.

    The source filters campaign history with ``IN (SELECT ...)`` and then
    inner-joins the same table on the same key; the inner join alone gives the
    same rows (duplicates still come from the event side), so the semi join is
    not repeated. The household link is de-duplicated before joining."""
    a = (campaign_hist.where((F.col("concept_id") == concept_id) &
                             F.col("DLVRY_STATUS_CD").isNotNull() &
                             (F.col("COUPON_BARCODE_ID1") > 0))
         .select("COUPON_BARCODE_ID1", "COUPON_BARCODE1", "CUST_HHLD_ADDR_SKID"))
    # A barcode mailed to millions: its pieces are counted and spread.
    b = dm_events.where(F.col("Coupon_barcode_id") > 0)
    c = (cust_skid.select("CUST_HHLD_ADDR_SKID", "CURRENT_ADDRESS_ID", "CURRENT_CUSTOMER_ID")
         .distinct().where(F.col("CURRENT_CUSTOMER_ID") > 0)
         .withColumnRenamed("CUST_HHLD_ADDR_SKID", "c_skid"))
    j = (skewed_join(a, b, "COUPON_BARCODE_ID1", "Coupon_barcode_id")
         .join(c, F.col("CUST_HHLD_ADDR_SKID") == c.c_skid))
    return j.select("COUPON_BARCODE_ID1", "COUPON_BARCODE1",
                    F.col("CURRENT_CUSTOMER_ID").alias("customer_id"), "IN_HOME_DT")


def _bucket(d: Column, width: int) -> Column:
    return F.floor(F.datediff(d, F.lit("1970-01-01").cast("date")) / F.lit(width))


def window_join(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str,
                left_date: str, right_start: str, days: int, how: str = "inner") -> DataFrame:
    """JOIN-4: rows of ``right`` whose ``[start, start + days]`` window (both
    ends inclusive) contains ``left_date``, for the same key.

    A plain join on the key with a BETWEEN residual compares every left row
    with every right row of a key, which explodes for a hot key. Here time is
    cut into buckets ``days + 1`` wide; a right window touches at most two
    buckets, so each right row is emitted for those (at most 2x), and the join
    is an equi join on (key, bucket) followed by the exact BETWEEN check. A
    left row lives in one bucket, so every match is produced exactly once and
    unmatched left rows survive a left join exactly once.
    """
    width = days + 1
    start = F.col(right_start)
    r = right.withColumn("_wj_bucket", F.explode(F.array_distinct(F.array(
        _bucket(start, width), _bucket(F.date_add(start, days), width)))))
    l = left.withColumn("_wj_lbucket", _bucket(F.col(left_date), width))
    cond = ((l[left_key] == r[right_key]) & (l["_wj_lbucket"] == r["_wj_bucket"]) &
            l[left_date].between(r[right_start], F.date_add(r[right_start], days)))
    return l.join(r, cond, how).drop("_wj_bucket", "_wj_lbucket")
