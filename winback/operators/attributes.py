"""Customer attributes (third SQL statement): demographics, region,
latest-per-key, point-in-time feature lookups, and their composition.

JOIN-8, JOIN-9, JOIN-10, JOIN-11, AGG-2, AGG-3, PRJ-2, CLS-3..CLS-7, FN-6, FN-9.

Join order is chosen so joins on the same key are adjacent: the left side is
shuffled once per key set (customer; customer+address; address+previous
period; address+current period). The snapshots of one period role are brought
together by (address, period), one shuffle for all of them, which also checks that
the key is unique in each.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.functions import rules
from winback.functions.dates import year_of

# --- fixed values: attribute projection (output name, snapshot alias, source) --
# Snapshot aliases: b contact strategy, c merfm, d promo history, e zip summary,
# f rfm, g seasonality, h shopping metrics, i product affinity, j demographics.
# The 19 measures the source selects without a qualifier are given an explicit
# snapshot here (c, d, e, i); change the alias if they live elsewhere.
_J = ["A_A2779N_PROPEN_SCR_INTNT_01_03", "A_A2779N_PROPEN_SCR_INTNT_04_07",
      "A_A2779N_PROPEN_SCR_INTNT_08_10", "A_A7467N_RECNT_HOME_BUYER_YES",
      "A_A7478N_NEW_MOVER_YES", "A_A7779N_CHILD_INTRST_YES", "A_A7830N_HM_IMPROVE_GRP_YES",
      "A_A7851N_HM_IMPROVE_DIY_YES", "A_A8271N_HM_LIVING_IND_YES", "A_A8588N_HM_SQR_FT",
      "A_A8589N_HM_LOT_SQR_FT", "A_A8592N_HM_YR_BUILT", "A_A8606N_HM_OWN_RENT_HOME_OWNER",
      "A_A8606N_HM_OWNER_RENTER_RENTER", "A_A8607N_HM_LNTH_RES_01_02",
      "A_A8607N_HM_LNTH_RES_03_05", "A_A8607N_HM_LNTH_RES_06_10",
      "A_A8607N_HM_LNTH_RES_11_14", "A_A8609N_MARITAL_STAT_HH_M_A",
      "A_A8609N_MARITAL_STAT_HH_S_B", "A_A8641_INC_ESTMT_HHLD_1", "A_A8641_INC_ESTMT_HHLD_2",
      "A_A8641_INC_ESTMT_HHLD_3", "A_A8641_INC_ESTMT_HHLD_4", "A_A8641_INC_ESTMT_HHLD_5",
      "A_A8641_INC_ESTMT_HHLD_6", "A_A8641_INC_ESTMT_HHLD_7", "A_A8641_INC_ESTMT_HHLD_8",
      "A_A8641_INC_ESTMT_HHLD_9", "A_A8642_HM_MKT_VAL_LT_75", "A_A8642_HM_MKT_VAL_75_149",
      "A_A8642_HM_MKT_VAL_150_299", "A_A8642_HM_MKT_VAL_300_499",
      "A_A8642_HM_MKT_VAL_500_999", "A_A8642_HM_MKT_VAL_1M_PLUS",
      "A_A9153N_RPC_FURNITURE_BUYR_YES", "A_A9153N_RPC_HM_IMPROVE_YES", "A_A9509N_EDU_1ST_1",
      "A_A9509N_EDU_1ST_2", "A_A9509N_EDU_1ST_3", "A_A9509N_EDU_1ST_4", "A_A3101N_RACE_AFRAM",
      "A_A3101N_RACE_ASIAN", "A_A3101N_RACE_HISP", "A_A3101N_RACE_WHITE",
      "A_A9350N_ECONOMIC_STB_01_10", "A_AAP000447N_ASET_PRPN_DIS_INC"]

FEATURE_COLUMNS: list[tuple[str, str, str]] = (
    [("BBB_R_2Y", "f", "beyond_recency_two_years")]
    + [(c, "j", c) for c in _J]
    + [("BBB_INSTORE_F", "f", "beyond_instore_frequency"),
       ("BBB_INSTORE_F_2Y", "f", "beyond_instore_frequency_two_years"),
       ("BBB_ONCOUPON_R_DECILE_2Y", "f", "beyond_oncoupon_recency_decile_two_years"),
       ("BUYS_Q_01", "g", "BUYS_Q_01"), ("BUYS_Q_02", "g", "BUYS_Q_02"),
       ("BUYS_M_01", "g", "BUYS_M_01"), ("BUYS_M_06", "g", "BUYS_M_06"),
       ("BUYS_Q_04", "g", "BUYS_Q_04"), ("BUYS_Q_08", "g", "BUYS_Q_08"),
       ("COUPON_ANY_AMT", "d", "total_coupon_price_reduction_amount"),
       ("COUPON_Q_01", "g", "COUPON_Q_01"), ("COUPON_Q_04", "g", "COUPON_Q_04"),
       ("COUPON_SALES_Q_05", "g", "COUPON_SALES_Q_05"),
       ("COUPON_SALES_Q_08", "g", "COUPON_SALES_Q_08"),
       ("HARMON_SALES_L12M", "b", "sales_in_last_12_months_at_HARMON_concept"),
       ("NUM_PERIODS", "h", "number_of_periods_purchased"),
       ("NUM_QUARTERS", "h", "number_of_quarters_purchased"),
       ("NUM_TOTAL_ITEMS", "h", "number_of_items_purchased"),
       ("NUM_TXNS", "h", "number_of_transactions_involving_sales"),
       ("BBBY_CLUSTER_NUMBER", "h", "BBBY_CLUSTER_NUMBER"),
       ("PH_CFREQ90D", "d", "PH_CFREQ90D"), ("PH_CREDEEM365D", "d", "PH_CREDEEM365D"),
       ("PH_CREDEEM90D", "d", "PH_CREDEEM90D"), ("PH_CSTACK_90D", "d", "PH_CSTACK_90D"),
       ("PH_MREDEEM182D_PERC", "d", "PH_MREDEEM182D_PERC"),
       ("PH_MREDEEM730D_PERC", "d", "PH_MREDEEM730D_PERC"),
       ("PH_NMFREQ182D", "d", "PH_NMFREQ182D"), ("PH_PREDEEM365D", "d", "PH_PREDEEM365D"),
       ("PH_PREDEEM548D", "d", "PH_PREDEEM548D"), ("PH_PREDEEM730D", "d", "PH_PREDEEM730D"),
       ("RECENCY", "h", "number_of_days_since_last_purchase"),
       ("TOTAL_SALES_L12M", "b", "total_sales_in_last_12_months"),
       ("TOTAL_TXNS_L12M", "b", "total_transactions_in_last_12_months"),
       ("PH_PSTACK_182D", "d", "PH_PSTACK_182D"), ("PH_PFREQ182D", "d", "PH_PFREQ182D"),
       ("PH_PSTACK_90D", "d", "PH_PSTACK_90D"), ("PH_PFREQ90D", "d", "PH_PFREQ90D"),
       ("PH_PSTACK_365D", "d", "PH_PSTACK_365D"), ("PH_MSTACK_182D", "d", "PH_MSTACK_182D"),
       ("PH_STACK_182D", "d", "PH_STACK_182D"), ("PH_PFREQ365D", "d", "PH_PFREQ365D"),
       ("PH_MSTACK_90D", "d", "PH_MSTACK_90D"), ("PH_MFREQ182D", "d", "PH_MFREQ182D"),
       ("PH_STACK_90D", "d", "PH_STACK_90D"), ("PH_MFREQ90D", "d", "PH_MFREQ90D"),
       ("PH_FREQ182D", "d", "PH_FREQ182D"), ("PH_FREQ90D", "d", "PH_FREQ90D"),
       ("PH_DM_RECENCY", "d", "PH_DM_RECENCY"),
       ("BBB_M_DECILE_2Y", "f", "beyond_monetary_decile_two_years"),
       ("BBB_M_DECILE", "f", "beyond_monetary_decile"),
       ("BBB_ONCOUPON_M_DECILE", "f", "beyond_oncoupon_monetary_decile"),
       ("BBB_ONCOUPON_M_DECILE_2Y", "f", "beyond_oncoupon_monetary_decile_two_years"),
       ("BBB_INSTORE_M_DECILE_2Y", "f", "beyond_instore_monetary_decile_two_years"),
       ("BBB_INSTORE_M_DECILE", "f", "beyond_instore_monetary_decile"),
       ("BBB_RFM_DECILE_2Y", "f", "beyond_recency_frequency_monetary_decile_two_years"),
       ("BBB_OFFCOUPON_F_DECILE_2Y", "f", "beyond_offcoupon_frequency_decile_two_years"),
       ("BBB_RFM_DECILE", "f", "beyond_recency_frequency_monetary_decile"),
       ("BBB_OFFCOUPON_RFM_DECILE_2Y", "f",
        "beyond_offcoupon_recency_frequency_monetary_decile_two_years"),
       ("BBB_OFFCOUPON_M_DECILE_2Y", "f", "beyond_offcoupon_monetary_decile_two_years"),
       ("BBB_ONCOUPON_RFM_DECILE_2Y", "f",
        "beyond_oncoupon_recency_frequency_monetary_decile_two_years"),
       ("BBB_ONCOUPON_RFM_DECILE", "f", "beyond_oncoupon_recency_frequency_monetary_decile"),
       ("BBB_F_DECILE_2Y", "f", "beyond_frequecy_decile_two_years"),
       ("BBB_INSTORE_RFM_DECILE_2Y", "f",
        "beyond_instore_recency_frequency_monetary_decile_two_years"),
       ("BBB_F_DECILE", "f", "beyond_frequency_decile"),
       ("BBB_INSTORE_RFM_DECILE", "f", "beyond_instore_recency_frequency_monetary_decile"),
       ("BBB_M_2Y", "f", "beyond_monetary_two_years"),
       ("AVG_NET_SALES_PER_TXN", "c", "avg_net_sales_per_transaction"),
       ("AVG_SALES_PER_TXN", "c", "avg_sales_per_transaction"),
       ("NUM_DEPARTMENTS", "i", "number_of_departments_purchased"),
       ("NUM_ITEM_CATEGORIES", "i", "number_of_item_categories_purchased"),
       ("PCT_SALES_ON_TXN_PCT_COUPON", "e", "pct_sales_on_transaction_pct_off_coupons"),
       ("PCT_SALES_ON_TXN_DOL_COUPON", "e", "pct_sales_on_transaction_USD_off_coupons"),
       ("PCT_TXN_DOL_COUPON_DEPTH", "e", "pct_transaction_USD_off_coupon_depth"),
       ("PCT_ITEMS_ON_ITEM_PCT_COUPON", "e", "pct_items_sold_on_item_pct_off_coupons"),
       ("AVG_UNIQUE_ITEMS_PER_TXN", "i", "avg_unique_items_per_transaction"),
       ("NUM_SUB_DEPARTMENT", "i", "number_of_sub_departments_purchased"),
       ("AVG_TOTAL_ITEMS_PER_TXN", "i", "avg_items_per_transaction"),
       ("PCT_TXNS_ON_ITEM_PCT_COUPON", "e", "pct_transactions_on_item_pct_off_coupons"),
       ("PCT_TXNS_ON_TXN_DOL_COUPON", "e", "pct_transactions_on_transaction_USD_off_coupons"),
       ("PCT_ITEM_PCT_COUPON_DEPTH", "e", "pct_coupon_depth_for_item_pct_off_coupons"),
       ("PCT_SALES_ON_ITEM_PCT_COUPON", "e", "pct_sales_on_item_pct_off_coupons"),
       ("PCT_TXNS_ON_TXN_PCT_COUPON", "e", "pct_transactions_on_transaction_pct_off_coupons"),
       ("PCT_ITEMS_ON_TXN_PCT_COUPON", "e", "pct_items_sold_on_transaction_pct_off_coupons"),
       ("PCT_TXN_PCT_COUPON_DEPTH", "e", "pct_transaction_pct_off_coupon_depth"),
       ("NUM_CHANNELS", "h", "number_of_channels_purchased"),
       ("NUM_CLASSES", "h", "number_of_classes_purchased"),
       ("NUM_MERCH_DIVISIONS", "h", "number_of_merchandise_divisions_purchased"),
       ("NUM_PRODUCT_GROUPS", "h", "number_of_product_groups_purchased")])

# Which period each snapshot is read at: the previous purchase's period avoids
# leaking the comeback itself into the features; two snapshots use the current.
PERIOD_ROLE = {"b": "PRE_FISCAL_PERIOD_ID", "c": "PRE_FISCAL_PERIOD_ID",
               "d": "PRE_FISCAL_PERIOD_ID", "e": "FISCAL_PERIOD_ID",
               "f": "PRE_FISCAL_PERIOD_ID", "g": "PRE_FISCAL_PERIOD_ID",
               "h": "PRE_FISCAL_PERIOD_ID", "i": "PRE_FISCAL_PERIOD_ID",
               "j": "FISCAL_PERIOD_ID"}
SNAPSHOT_ALIASES = ["b", "c", "d", "e", "f", "g", "h", "i", "j"]
# ------------------------------------------------------------------------------


def latest_per_key(history: DataFrame, key: str, order_col: str) -> DataFrame:
    """AGG-3: rows holding the greatest ``order_col`` of their key, ties kept.

    Written as group-max joined back (not a window): the max is a hash
    aggregate with map-side partial aggregation, and the join back is
    many-to-one, which AQE can split when one key is hot. A window would put
    every row of a hot key into one task."""
    mx = history.groupBy(key).agg(F.max(order_col).alias("_max"))
    mx = mx.withColumnRenamed(key, "_k")
    j = history.join(mx, (history[key] == mx["_k"]) & (history[order_col] == mx["_max"]))
    return j.drop("_k", "_max")


def age_source(cdg_info: DataFrame) -> DataFrame:
    """Birth year per customer; strict integer cast (ANSI: bad text raises)."""
    return (cdg_info.where(F.col("DOB_YR_INDIV_1").isNotNull())
            .select(F.col("customer_id").alias("age_customer_id"),
                    F.col("DOB_YR_INDIV_1").cast("int").alias("DOB_YR")))


def income_source(cdg_info: DataFrame, income_lookup: DataFrame) -> DataFrame:
    """JOIN-10, AGG-2: distinct (customer, code) joined to the code table."""
    a = cdg_info.select("customer_id", "INC_ESTMT_HHLD_CD").distinct()
    lk = income_lookup.select("INC_ESTMT_HHLD_CD", "INC_ESTMT_HHLD_DESC")
    return (a.join(lk, "INC_ESTMT_HHLD_CD")
            .select(F.col("customer_id").alias("inc_customer_id"), "INC_ESTMT_HHLD_CD",
                    "INC_ESTMT_HHLD_DESC").distinct())


def gender_source(demo: DataFrame) -> DataFrame:
    return (demo.select(F.col("customer_guid").alias("g_customer"),
                        F.col("address_guid").alias("g_address"), "A8688_GENDER_INP")
            .distinct())


def ethnicity_source(demo: DataFrame, dedupe: bool = False) -> DataFrame:
    """Not de-duplicated by default, as in the source: duplicate demographic
    rows multiply attribute rows (kept for fidelity); ``dedupe=True`` keeps
    one row per distinct (customer, address, ethnicity)."""
    out = demo.select(F.col("customer_guid").alias("e_customer"),
                      F.col("address_guid").alias("e_address"),
                      rules.ethnicity().alias("ethnicity_raw"))
    return out.distinct() if dedupe else out


def territory_source(customer_address: DataFrame, address_mstr: DataFrame,
                     mailing_address: DataFrame) -> DataFrame:
    """JOIN-11: address -> master -> mailing, preferred addresses only. The
    flag filter is applied to the left-most table before the joins."""
    a = customer_address.where(F.col("PREFD_CUST_IND") == "Y").select("CUSTOMER_ID", "ADDRESS_ID")
    b = address_mstr.select(F.col("ADDRESS_ID").alias("m_address"), "MAILING_ADDRESS_ID")
    c = mailing_address.select(F.col("MAILING_ADDRESS_ID").alias("m_mailing"), "TERRITORY_CD")
    j = (a.join(b, a.ADDRESS_ID == b.m_address, "left")
         .join(c, F.col("MAILING_ADDRESS_ID") == c.m_mailing, "left"))
    return j.select(F.col("CUSTOMER_ID").alias("u_customer"), "TERRITORY_CD")


def with_region(base: DataFrame, territory: DataFrame) -> DataFrame:
    """CLS-3 after JOIN-11 (left join on customer)."""
    j = base.join(territory, base.customer_id == territory.u_customer, "left")
    return j.select(*base.columns, rules.state_division("TERRITORY_CD").alias("State_Division"))


def with_demographics(base: DataFrame, cdg_info: DataFrame, demo: DataFrame,
                      income_lookup: DataFrame, dedupe_ethnicity: bool = False) -> DataFrame:
    """JOIN-9 chain and the derived gender / age / ethnicity / income labels."""
    age, inc = age_source(cdg_info), income_source(cdg_info, income_lookup)
    g, e = gender_source(demo), ethnicity_source(demo, dedupe_ethnicity)
    j = (base.join(age, base.customer_id == age.age_customer_id, "left")
         .join(inc, base.customer_id == inc.inc_customer_id, "left")
         .join(g, (base.customer_id == g.g_customer) & (base.address_id == g.g_address), "left")
         .join(e, (base.customer_id == e.e_customer) & (base.address_id == e.e_address), "left"))
    age_years = year_of("previous_buy") - F.col("DOB_YR")
    return j.select(*base.columns,
                    rules.default_unknown("A8688_GENDER_INP").alias("gender"),
                    rules.age_bucket(age_years).alias("age_bucket"),
                    rules.default_unknown("ethnicity_raw").alias("ethnicity"),
                    rules.default_unknown("INC_ESTMT_HHLD_DESC").alias("INCOME"))


def snapshots_by_key(snapshots: Mapping[str, DataFrame], needed: Mapping[str, list[str]]) -> DataFrame:
    """(s_addr, s_period, one struct per snapshot): all snapshots side by side by (address,
    period). Their rows are shuffled once on the key, whatever their number; a snapshot
    with two rows for a key, which would multiply attribute rows, raises."""
    parts = []
    for alias in sorted(snapshots):
        t = snapshots[alias]
        kept = [F.col(f"`{s}`") for s in needed[alias]] or [F.lit(1).alias("_any")]
        parts.append(t.where(F.col("address_guid").isNotNull()).select(
            F.col("address_guid").alias("s_addr"), F.col("fiscal_period_id").alias("s_period"),
            F.struct(*kept).alias(f"s_{alias}")))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    one = every.groupBy("s_addr", "s_period").agg(
        *[F.first(f"s_{a}", ignorenulls=True).alias(f"s_{a}") for a in sorted(snapshots)],
        F.greatest(*[F.count(f"s_{a}") for a in sorted(snapshots)], F.lit(0)).alias("most"))
    repeated = F.raise_error(F.format_string("snapshot rows repeat for address %s, period %s",
                                             F.col("s_addr").cast("string"), F.col("s_period").cast("string")))
    # the check rides on the values: the key stays as it was shuffled
    return one.select("s_addr", "s_period", *[F.when(F.col("most") > 1, repeated).otherwise(F.col(f"s_{a}")).alias(f"s_{a}")
                                              for a in sorted(snapshots)])


def with_snapshots(base: DataFrame, snapshots: Mapping[str, DataFrame],
                   columns=FEATURE_COLUMNS, period_role=PERIOD_ROLE,
                   keep=None, read_at: DataFrame | None = None) -> DataFrame:
    """JOIN-8 + PRJ-2: point-in-time lookups of snapshot tables by (address, period role),
    then one flat projection of the renamed columns. The snapshots of one role are brought
    together first, so there is one join per role and not per snapshot. ``keep`` lists
    extra left columns to carry.

    ``read_at``: a stored table with all (address, period) pairs of ``base`` (it is read
    more than once). Given that, snapshot rows of other keys are left out before their wide
    rows are shuffled, and uniqueness is checked for the keys that are read.

    Purged customers have no address: they get a key of their own from the row's hash,
    which spreads them, and the join's condition on the address itself never matches them."""
    kind = base.schema["address_id"].dataType
    whole = [c for c in base.columns if c != "address_id"]
    out = base.withColumn("_addr", F.coalesce("address_id", F.xxhash64(*whole).cast(kind)))
    for role in sorted({period_role[a] for a in snapshots}, reverse=True):
        of = {a: t for a, t in snapshots.items() if period_role[a] == role}
        if read_at is not None:
            keys = read_at.select(F.col("address_id").alias("k_addr"), F.col(role).alias("k_period")).distinct()
            of = {a: t.join(keys, (t["address_guid"].cast(kind) == keys["k_addr"]) &
                            (t["fiscal_period_id"] == keys["k_period"]), "left_semi") for a, t in of.items()}
        right = snapshots_by_key(of, {a: list(dict.fromkeys(s for (_, x, s) in columns if x == a)) for a in of})
        right = right.withColumnsRenamed({"s_addr": f"s_addr_{role}", "s_period": f"s_period_{role}"})
        right = right.withColumn(f"s_addr_{role}", F.col(f"s_addr_{role}").cast(kind))
        out = out.join(right, (out["_addr"] == right[f"s_addr_{role}"]) & (out[role] == right[f"s_period_{role}"]) &
                       out["address_id"].isNotNull(), "left")
    keep_cols = list(base.columns) if keep is None else keep
    return out.select(*keep_cols, *[F.col(f"s_{a}.{s}").alias(o) for (o, a, s) in columns])


def customer_attributes(reactive: DataFrame, *, cdg_info: DataFrame, demo: DataFrame,
                        income_lookup: DataFrame, snapshots: Mapping[str, DataFrame],
                        persona_hist: DataFrame, customer_address: DataFrame,
                        address_mstr: DataFrame, mailing_address: DataFrame,
                        dedupe_ethnicity: bool = False, stored: bool = False) -> DataFrame:
    """The full third statement: 20 base + 5 derived + 136 feature columns.

    The latest-persona lookup contributes no column but multiplies rows when a
    customer has tied latest personas; that multiplicity is kept. ``stored``: ``reactive``
    is a stored table, so snapshots are cut to its keys first."""
    base_cols = list(reactive.columns)
    persona = latest_per_key(persona_hist, "customer_id", "scoring_year_and_period")
    persona = persona.select(F.col("customer_id").alias("z_customer"),
                             F.col("Persona").alias("z_persona"))
    territory = territory_source(customer_address, address_mstr, mailing_address)

    # customer-keyed joins first (one shuffle of the base on customer_id)
    age, inc = age_source(cdg_info), income_source(cdg_info, income_lookup)
    b = reactive
    j = (b.join(age, b.customer_id == age.age_customer_id, "left")
         .join(inc, b.customer_id == inc.inc_customer_id, "left")
         .join(persona, b.customer_id == persona.z_customer, "left")
         .join(territory, b.customer_id == territory.u_customer, "left"))
    g, e = gender_source(demo), ethnicity_source(demo, dedupe_ethnicity)
    j = (j.join(g, (j.customer_id == g.g_customer) & (j.address_id == g.g_address), "left")
          .join(e, (j.customer_id == e.e_customer) & (j.address_id == e.e_address), "left"))
    age_years = year_of("previous_buy") - F.col("DOB_YR")
    derived = j.select(*base_cols,
                       rules.state_division("TERRITORY_CD").alias("State_Division"),
                       rules.default_unknown("A8688_GENDER_INP").alias("gender"),
                       rules.age_bucket(age_years).alias("age_bucket"),
                       rules.default_unknown("ethnicity_raw").alias("ethnicity"),
                       rules.default_unknown("INC_ESTMT_HHLD_DESC").alias("INCOME"))
    return with_snapshots(derived, snapshots, read_at=reactive if stored else None)
