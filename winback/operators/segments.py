"""Segment link and population (fourth and fifth SQL statements).

JOIN-7, JOIN-12, FLT-7, AGG-1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _linked(attrs: DataFrame, customer_curr: DataFrame) -> DataFrame:
    cust = attrs.select("customer_id").distinct()
    c = customer_curr.select(F.col("customer_id").alias("c_customer"), "address_id")
    return cust.join(c, cust.customer_id == c.c_customer, "left").select("customer_id", "address_id")


def segment_flags(attrs: DataFrame, customer_curr: DataFrame, segments: DataFrame) -> DataFrame:
    """JOIN-12 in flag form: (customer, current address, ME_LINK 0/1).

    The existence test is a left join against *distinct* segment addresses,
    so a repeated segment row cannot multiply customers."""
    seg = segments.select(F.col("ADDRESS_ID").alias("s_address")).distinct()
    base = _linked(attrs, customer_curr).distinct()
    j = base.join(seg, base.address_id == seg.s_address, "left")
    return j.select("customer_id", "address_id",
                    F.when(F.col("s_address").isNull(), 0).otherwise(1).alias("ME_LINK"))


def segment_link(attrs: DataFrame, customer_curr: DataFrame, segments: DataFrame) -> DataFrame:
    """ME_CUST: distinct (customer, address) whose current address is in a
    segment. The source's left join + ``ME_LINK = 1`` is a semi join, written
    as one so no segment row is carried through the shuffle."""
    seg = segments.select(F.col("ADDRESS_ID").alias("s_address"))
    base = _linked(attrs, customer_curr)
    return (base.join(seg, base.address_id == seg.s_address, "left_semi")
            .select("customer_id", "address_id").distinct())


def segment_population(master: DataFrame, link: DataFrame) -> DataFrame:
    """ME_CUST_POP: rows of the master table whose customer is linked
    (``customer_id IN (SELECT ...)`` planned as LeftSemi)."""
    return master.join(link.select(F.col("customer_id").alias("_k")),
                       master.customer_id == F.col("_k"), "left_semi")
