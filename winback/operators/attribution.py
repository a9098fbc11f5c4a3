"""Channel attribution (second SQL statement).

JOIN-4, JOIN-5, JOIN-6, CLS-1, CLS-2, AGG-1, FLT-4, SRC-3, SRT-1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.functions import rules
from winback.operators.exposure import window_join


def ecomm_transactions(txn: DataFrame, web_touch: DataFrame, concept_format_id: int = 1) -> DataFrame:
    """Ecomm_trans: transactions with their web order's last-touch channel."""
    t = txn.where(F.col("concept_format_id") == concept_format_id)
    return (t.join(web_touch, t.src_atg_ecom_order_id == web_touch.orders)
            .select("last_touch_channel", "transaction_guid", "src_atg_ecom_order_id",
                    "transaction_booked_date"))


def exposure_flags(left: DataFrame, exposures: DataFrame, window_days: int = 14) -> DataFrame:
    """CLS-2 via JOIN-4: ``left`` rows (left join) with ``DM_Flag`` = 1 for
    each exposure row whose window holds the transaction date. Exposures are
    first reduced to distinct (customer, in-home date, has-barcode), which is
    all the flag depends on; this bounds the fan-out per row by the window."""
    exp = (exposures.select(F.col("customer_id").alias("d_customer"), "IN_HOME_DT",
                            F.col("COUPON_BARCODE1").isNotNull().alias("d_has_code"))
           .distinct())
    j = window_join(left, exp, left_key="customer_id", right_key="d_customer",
                    left_date="transaction_booked_date", right_start="IN_HOME_DT",
                    days=window_days, how="left")
    return j.withColumn("DM_Flag", rules.flag(F.col("d_has_code"))).drop(
        "d_customer", "IN_HOME_DT", "d_has_code")


def with_last_touch(lr: DataFrame, *, web_touch: DataFrame | None = None,
                    ecomm: DataFrame | None = None) -> DataFrame:
    """JOIN-5: attach the web order's last-touch channel to each row.

    General form (``ecomm``): left join on (transaction id, date, web order
    id) against all web transactions. When ``lr`` comes from
    ``reactivations`` over the same transactions (the pipeline's case), every
    row *is* a concept-1 transaction with exactly those three values, so that
    join can only confirm the row itself; the channel then comes straight
    from ``web_touch`` on the order id, and the all-transactions join (a full
    shuffle of the fact table at scale) disappears. Duplicate matches either
    way are removed by the final DISTINCT. NULL order ids never match."""
    if ecomm is not None:
        b = ecomm.select(F.col("transaction_guid").alias("b_guid"),
                         F.col("transaction_booked_date").alias("b_date"),
                         F.col("src_atg_ecom_order_id").alias("b_ecom"), "last_touch_channel")
        j = lr.join(b, (lr.transaction_guid == b.b_guid) &
                    (lr.transaction_booked_date == b.b_date) &
                    (lr.src_atg_ecom_order_id == b.b_ecom), "left")
        return j.drop("b_guid", "b_date", "b_ecom")
    # Store purchases have no order id, a third of all rows under one NULL key: they get a
    # key of their own from the row, and the condition on the id itself never matches them.
    kind = lr.schema["src_atg_ecom_order_id"].dataType
    w = web_touch.select(F.col("orders").cast(kind).alias("b_order"), "last_touch_channel").where("b_order IS NOT NULL")
    a = lr.withColumn("_key", F.coalesce("src_atg_ecom_order_id", F.xxhash64("transaction_guid").cast(kind)))
    return (a.join(w, (a["_key"] == w.b_order) & a.src_atg_ecom_order_id.isNotNull(), "left")
            .drop("b_order", "_key"))


def channel_attribution(lr: DataFrame, exposures: DataFrame, time_dim: DataFrame,
                        customer_curr: DataFrame, *, web_touch: DataFrame | None = None,
                        ecomm: DataFrame | None = None, window_days: int = 14) -> DataFrame:
    """Reactive: reactivation rows + fiscal periods, last touch, DM flag,
    current address and the attributed channel; exact duplicates removed
    (the source's GROUP BY over all 20 columns). Pass ``web_touch`` when
    ``lr`` was built from the same transactions, else ``ecomm``."""
    j = with_last_touch(lr, web_touch=web_touch, ecomm=ecomm)
    j = exposure_flags(j, exposures, window_days)

    # JOIN-6: one calendar joined in two roles.
    cal = time_dim.select("GREGORIAN_CALENDAR_DATE", "FISCAL_PERIOD_ID")
    g = cal.select(F.col("GREGORIAN_CALENDAR_DATE").alias("g_date"), "FISCAL_PERIOD_ID")
    z = cal.select(F.col("GREGORIAN_CALENDAR_DATE").alias("z_date"),
                   F.col("FISCAL_PERIOD_ID").alias("PRE_FISCAL_PERIOD_ID"))
    j = (j.join(g, j.transaction_booked_date == g.g_date, "left")
          .join(z, j.previous_buy == z.z_date, "left")
          .where(F.col("customer_id").isNotNull()))
    ecomm_cols = list(lr.columns) + ["FISCAL_PERIOD_ID", "PRE_FISCAL_PERIOD_ID",
                                     "last_touch_channel", "DM_Flag"]
    q = (customer_curr.where((F.col("customer_purge_ind") == "N") &
                             (F.col("customer_id") > 0) & (F.col("address_id") > 0))
         .select(F.col("customer_id").alias("q_customer"), "address_id"))
    j = j.select(*ecomm_cols)
    out = j.join(q, j.customer_id == q.q_customer, "left").select(
        *ecomm_cols, "address_id", rules.reactivation_channel().alias("reactivation_channel"))
    return out.distinct()


def sorted_for_sink(df: DataFrame) -> DataFrame:
    """SRT-1 for a table sink: order within partitions only (no global range
    shuffle); the order carries no meaning once written."""
    return df.sortWithinPartitions(F.col("customer_id"), F.col("DM_Flag").desc())


def sorted_globally(df: DataFrame) -> DataFrame:
    """SRT-1 as a total order: customer ascending, DM flag descending."""
    return df.orderBy(F.col("customer_id"), F.col("DM_Flag").desc())
