"""Input views of the reactivation pipeline, derived from the test tables.

The real pipeline reads warehouse tables (transactions, web touches, campaign
history, feature snapshots ...). The test data is a TPC-H-like star schema, so
each input is derived here with arithmetic on keys only (no hashing, no
randomness), which makes every view reproducible in any SQL engine. All views
are lazy DataFrames; nothing is materialised.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.sources.tables import read_table

AS_OF = "2000-01-01"

# --- fixed values -----------------------------------------------------------
# Web last-touch channel names, picked by o_orderkey % 16 (0-based).
CHANNELS = ["Paid Search", "None", "Natural Search", "QR", "CSE", "Retargeting",
            "Internal", "Display", "Direct", "Affiliate", "Referring Domains",
            "Social Marketing", "Social Networks", "Email"]
# Territory codes by c_nationkey (0-based): lower case, padding, a NULL and
# foreign codes on purpose.
TERRITORIES = [" il", "OH", "MI", "NY", "NJ", "PA", "CT", "MA", "TX", "FL ", "ga",
               "DC", "CA", "WA", "HI", "AK", "CO", None, "ON", "KY", "VA", "ND",
               "VT", "UT", "PR"]
# Market segments in alphabetical order -> income codes A..E.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
INCOME_CODES = ["A", "B", "C", "D", "E"]
INCOME_DESC = {"A": "LESS_THAN_50K", "B": "50K_TO_99K", "C": "100K_TO_149K",
               "D": "150K_PLUS"}
# ----------------------------------------------------------------------------


def _pick(values, index: Column) -> Column:
    """values[index] (0-based) for a literal list; NULL entries allowed."""
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (index + 1).cast("int"))


def _address(custkey: Column) -> Column:
    return custkey * 10 + 1


def _memo(fn):
    """Build a view once per Fixtures instance: repeated use returns the same
    lazy DataFrame, so the plan holds identical subtrees (exchange reuse) and
    the files are listed once."""
    def wrapper(self, *args):
        key = (fn.__name__,) + args
        if key not in self._views:
            self._views[key] = fn(self, *args)
        return self._views[key]
    wrapper.__name__, wrapper.__doc__ = fn.__name__, fn.__doc__
    return wrapper


class Fixtures:
    """All fixture views over one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self._views: dict = {}

    @_memo
    def t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # -- transactions ------------------------------------------------------
    @_memo
    def txn(self) -> DataFrame:
        o = self.t("orders")
        key, status = F.col("o_orderkey"), F.col("o_orderstatus")
        return o.select(
            key.alias("transaction_guid"),
            F.to_date("o_orderdate").alias("transaction_booked_date"),
            F.when(key % 10 == 0, 2).otherwise(1).alias("concept_format_id"),
            F.when(status == "F", F.lit(None).cast("bigint")).otherwise(key)
             .alias("src_atg_ecom_order_id"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Y")
             .otherwise("N").alias("coupon_flag"),
            F.when(key % 7 == 0, "Y").otherwise("N")
             .alias("same_day_delivery_line_indicator"),
            F.when(status == "F", "U").when(status == "O", "W")
             .alias("ecom_order_source_code"))

    @_memo
    def txn_xref(self) -> DataFrame:
        o = self.t("orders")
        return o.select(
            F.col("o_orderkey").alias("trans_id"),
            F.when(F.col("o_custkey") % 50 == 0, F.lit(0).cast("bigint"))
             .otherwise(F.col("o_custkey")).alias("customer_id"))

    @_memo
    def web_touch(self) -> DataFrame:
        o = self.t("orders")
        key = F.col("o_orderkey")
        return (o.where((F.col("o_orderstatus") != "F") & (key % 16 < 14))
                 .select(key.alias("orders"),
                         _pick(CHANNELS, key % 16).alias("last_touch_channel")))

    # -- campaigns -----------------------------------------------------------
    @_memo
    def _exposed_lines(self) -> DataFrame:
        li = self.t("lineitem").where(F.col("l_returnflag").isin("R", "A"))
        return li.select(
            "l_orderkey", "l_returnflag", "l_shipdate",
            (F.col("l_orderkey") * 10 +
             F.when(F.col("l_returnflag") == "R", 1).otherwise(2)).alias("barcode"))

    @_memo
    def coupon_event(self) -> DataFrame:
        lines = self._exposed_lines()
        return (lines.groupBy("barcode", "l_returnflag")
                .agg(F.to_date(F.min("l_shipdate")).alias("IN_HOME_DT"))
                .select(F.col("barcode").alias("Coupon_barcode_id"), "IN_HOME_DT",
                        F.lit(1).alias("CONCEPT_FORMAT_ID"),
                        F.when(F.col("l_returnflag") == "R",
                               "Fall Main Event - Direct Mail")
                         .otherwise("Fall Main Event - Email")
                         .alias("COUPON_EVENT_KEY_DESC")))

    @_memo
    def campaign_hist(self) -> DataFrame:
        lines = self._exposed_lines().select("l_orderkey", "barcode")
        o = self.t("orders").select("o_orderkey", "o_custkey")
        pairs = (lines.join(o, lines.l_orderkey == o.o_orderkey)
                 .select("barcode", "o_orderkey",
                         (F.col("o_custkey") + 100000).alias("skid"))
                 .distinct())
        return pairs.select(
            F.col("barcode").alias("COUPON_BARCODE_ID1"),
            F.concat(F.lit("C"), F.col("barcode").cast("string")).alias("COUPON_BARCODE1"),
            F.col("skid").alias("CUST_HHLD_ADDR_SKID"),
            F.lit(1).alias("concept_id"),
            F.when(F.col("o_orderkey") % 9 == 0, F.lit(None).cast("string"))
             .otherwise("D").alias("DLVRY_STATUS_CD"))

    @_memo
    def cust_skid(self) -> DataFrame:
        c = self.t("customer").select("c_custkey")
        base = c.select((F.col("c_custkey") + 100000).alias("CUST_HHLD_ADDR_SKID"),
                        _address(F.col("c_custkey")).alias("CURRENT_ADDRESS_ID"),
                        F.col("c_custkey").alias("CURRENT_CUSTOMER_ID"))
        dup = base.where(F.col("CURRENT_CUSTOMER_ID") % 3 == 0)
        return base.unionByName(dup)

    @_memo
    def time_dim(self) -> DataFrame:
        d = self.t("orders").select(F.to_date("o_orderdate").alias("GREGORIAN_CALENDAR_DATE")).distinct()
        return d.withColumn("FISCAL_PERIOD_ID",
                            F.year("GREGORIAN_CALENDAR_DATE") * 100 + F.month("GREGORIAN_CALENDAR_DATE"))

    # -- customers -----------------------------------------------------------
    @_memo
    def customer_curr(self) -> DataFrame:
        c = self.t("customer")
        k = F.col("c_custkey")
        return c.select(k.alias("customer_id"), _address(k).alias("address_id"),
                        F.when(k % 20 == 0, "Y").otherwise("N").alias("customer_purge_ind"))

    def _income_code(self) -> Column:
        return _pick(INCOME_CODES, F.array_position(
            F.array(*[F.lit(s) for s in SEGMENTS]), F.col("c_mktsegment")) - 1)

    @_memo
    def cdg_info(self) -> DataFrame:
        c = self.t("customer")
        k = F.col("c_custkey")
        return c.select(k.alias("customer_id"),
                        F.when(k % 11 == 0, F.lit(None).cast("string"))
                         .otherwise((1930 + k % 60).cast("string")).alias("DOB_YR_INDIV_1"),
                        self._income_code().alias("INC_ESTMT_HHLD_CD"))

    @_memo
    def income_lookup(self) -> DataFrame:
        codes = (self.t("customer").select(self._income_code().alias("INC_ESTMT_HHLD_CD"))
                 .distinct().where(F.col("INC_ESTMT_HHLD_CD") != "E"))
        desc = F.create_map(*[x for kv in INCOME_DESC.items() for x in map(F.lit, kv)])
        return codes.select("INC_ESTMT_HHLD_CD",
                            desc[F.col("INC_ESTMT_HHLD_CD")].alias("INC_ESTMT_HHLD_DESC"))

    @_memo
    def demo_individual(self) -> DataFrame:
        c = self.t("customer")
        k, n6 = F.col("c_custkey"), F.col("c_nationkey") % 6
        flag = lambda *vals: F.when(n6.isin(*vals), 1).otherwise(0)
        return c.select(
            k.alias("customer_guid"), _address(k).alias("address_guid"),
            _pick(["M", "F", "", None, "X"], k % 5).alias("A8688_GENDER_INP"),
            flag(0, 5).alias("A3101N_RACE_WHITE"), flag(1, 5).alias("A3101N_RACE_HISP"),
            flag(2).alias("A3101N_RACE_AFRAM"), flag(3).alias("A3101N_RACE_ASIAN"))

    @_memo
    def customer_address(self) -> DataFrame:
        c = self.t("customer")
        k = F.col("c_custkey")
        return c.select(k.alias("CUSTOMER_ID"), _address(k).alias("ADDRESS_ID"),
                        F.when(k % 13 == 0, "N").otherwise("Y").alias("PREFD_CUST_IND"))

    @_memo
    def address_mstr(self) -> DataFrame:
        c = self.t("customer")
        a = _address(F.col("c_custkey"))
        return c.select(a.alias("ADDRESS_ID"), a.alias("MAILING_ADDRESS_ID"))

    @_memo
    def mailing_address(self) -> DataFrame:
        c = self.t("customer")
        return c.select(_address(F.col("c_custkey")).alias("MAILING_ADDRESS_ID"),
                        _pick(TERRITORIES, F.col("c_nationkey")).alias("TERRITORY_CD"))

    @_memo
    def address_segments(self) -> DataFrame:
        c = self.t("customer").where(F.col("c_mktsegment") == "BUILDING")
        base = c.select(_address(F.col("c_custkey")).alias("ADDRESS_ID"),
                        F.col("c_nationkey").alias("SEGMENT_ID"),
                        F.lit(202401).alias("scoring_year_and_period"),
                        F.col("c_custkey"))
        return base.unionByName(base.where(F.col("c_custkey") % 2 == 0)).drop("c_custkey")

    @_memo
    def persona_hist(self) -> DataFrame:
        """One row per (customer, period, persona); several personas on a
        customer's last period are ties."""
        e = self.t("events")
        return e.select(F.col("user_id").alias("customer_id"),
                        (202400 + F.dayofmonth("ts")).alias("scoring_year_and_period"),
                        F.col("event_type").alias("Persona")).distinct()

    # -- feature snapshots -----------------------------------------------------
    @_memo
    def snapshots(self) -> DataFrame:
        """(address_guid, fiscal_period_id) -> count / sum / avg / decile of order value:
        the warehouse's snapshot tables stand stored before the pipeline runs, so this
        one is stored once for each version of the input files and read from then on."""
        from winback.session import ensure_checkpoint_dir, shared_path
        from winback.sources.manifest import RunManifest
        ensure_checkpoint_dir(self.spark)
        run = RunManifest(self.spark, shared_path(self.spark, "snapshots"))
        path, _ = run.stage("orders", {}, (run.inputs([f"{self.sf_dir}/orders.parquet"]),),
                            lambda path: self._snapshots().write.mode("overwrite").parquet(path))
        return self.spark.read.parquet(path)

    def _snapshots(self) -> DataFrame:
        o = self.t("orders")
        g = (o.groupBy(_address(F.col("o_custkey")).alias("address_guid"),
                       (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("fiscal_period_id"))
             .agg(F.count(F.lit(1)).cast("double").alias("m_count"),
                  F.round(F.sum("o_totalprice"), 2).alias("m_sum"))
             .withColumn("m_avg", F.floor(F.col("m_sum") / F.col("m_count")).cast("double")))
        # ntile(10) per period, ordered by (sum, address), computed without a
        # per-period window (one period would otherwise sort in one task)
        from winback.operators.ranking import ntile_within_group
        d = ntile_within_group(g, "fiscal_period_id", ["m_sum", "address_guid"], 10, "m_decile")
        return d.withColumn("m_decile", F.col("m_decile").cast("double"))

    @_memo
    def feature_table(self, alias: str) -> DataFrame:
        """Snapshot table ``alias`` with the source columns the attribute projection reads
        from it; each column has values of its own (a measure plus an offset that follow
        from the column's full name), so a value taken from elsewhere shows."""
        import zlib

        from winback.operators.attributes import FEATURE_COLUMNS
        cols = []
        for s in sorted({s for (_, a, s) in FEATURE_COLUMNS if a == alias}):
            code = zlib.crc32(f"{alias}.{s}".encode())
            cols.append((F.col(["m_count", "m_sum", "m_avg", "m_decile"][code % 4]) + code % 99_991).alias(s))
        return self.snapshots().select("address_guid", "fiscal_period_id", *cols)

    # -- wide preparation table (notebook input) -------------------------------
    @_memo
    def prep_wide(self) -> DataFrame:
        """One row per customer with columns named to hit every name-pattern
        rule and NULLs at fixed residues (coverage 70, exactly 60 -> kept,
        57 -> reported 56 by the truncation, 0 -> dropped)."""
        c = self.t("customer")
        k, bal, nat = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_nationkey")
        null_if = lambda cond, val: F.when(cond, F.lit(None)).otherwise(val)
        return c.select(
            k.alias("customer_id"),
            F.when(bal < 0, "UNKNOWN").when(bal < 4500, "Others").otherwise("DM")
             .alias("reactivation_channel"),
            _pick(["Midwest", "Northeast", "South", "West", "UNKNOWN"], nat % 5)
             .alias("State_Division"),
            _pick(["M", "F", "", None, "X"], k % 5).alias("gender"),
            _pick(["AGE_LESS_17", "AGE_18_24", "AGE_25_40", "AGE_41_54", "AGE_ABOVE_55",
                   "UKNOWN"], k % 6).alias("age_bucket"),
            null_if(k % 10 == 3, self._income_code()).alias("INCOME"),
            _pick(["WHITE", "HISP", "AFRAM", "ASIAN"], nat % 4).alias("ethnicity"),
            _pick(["U", "W", None], k % 3).alias("pre_src_order"),
            _pick(["Y", "N"], k % 2).alias("pre_coupon_flag"),
            (k % 400 + 30).cast("int").alias("time_interval"),
            null_if(k % 10 < 3, F.floor(bal / 100).cast("double")).alias("BUYS_Q_01"),
            null_if(k % 150 < 60, (k % 17).cast("double")).alias("COUPON_Q_01"),
            null_if(k % 100 < 43, (nat % 2).cast("double")).alias("A_X"),
            bal.alias("BBB_R_2Y"),
            (k % 9).cast("string").alias("PCT_T"),
            null_if(k % 4 == 0, (k % 10 + 1).cast("double")).alias("X_DECILE"),
            null_if(k % 5 == 0, (k % 365).cast("double")).alias("PH_DM_RECENCY"),
            F.lit(None).cast("double").alias("BBB_EMPTY"),
            F.when(k % 7 == 0, "n/a").otherwise((k % 3).cast("string")).alias("MOVER"))

    @_memo
    def predictions(self) -> DataFrame:
        """Deterministic (label, prediction) pairs for the metric operators:
        label = alphabetical class index of prep_wide's channel, prediction a
        rule that is right for one customer in five plus chance."""
        w = self.prep_wide()
        k = F.col("customer_id")
        label = (F.when(F.col("reactivation_channel") == "DM", 0)
                 .when(F.col("reactivation_channel") == "Others", 1).otherwise(2))
        return w.select("customer_id", label.alias("label")).select(
            "customer_id", "label",
            F.when(k % 5 == 4, F.col("label")).otherwise((k % 5 % 3).cast("int")).alias("prediction"))

    @_memo
    def product_types(self) -> DataFrame:
        """Product list: one id per part type, by alphabetical rank. The rank
        window has no partition key; its input is the distinct type list (a
        catalogue, bounded by the number of product types)."""
        from pyspark.sql import Window
        types = self.t("part").select("p_type").distinct()
        return types.select("p_type", F.dense_rank().over(Window.orderBy("p_type"))
                            .cast("int").alias("pdm_prod_type_id"))

    @_memo
    def propensity_training(self) -> DataFrame:
        """One row per distinct (customer, product type) bought, with 13
        customer features (NULLs at fixed residues, one text column with bad
        numbers), as the product-propensity models read them."""
        li = self.t("lineitem").select("l_orderkey", "l_partkey")
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_totalprice")
        p = self.t("part").select("p_partkey", "p_type")
        pairs = (li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey)
                 .join(p, li.l_partkey == p.p_partkey)
                 .select(F.col("o_custkey").alias("customer_id"), "p_type").distinct())
        pairs = pairs.join(self.product_types(), "p_type")
        stats = o.groupBy(F.col("o_custkey").alias("s_customer")).agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("s"))
        c = self.t("customer").select("c_custkey", "c_acctbal", "c_nationkey")
        j = (pairs.join(stats, pairs.customer_id == stats.s_customer)
             .join(c, pairs.customer_id == c.c_custkey))
        k, n, sm = F.col("customer_id"), F.col("n"), F.col("s")
        null_if = lambda cond, val: F.when(cond, F.lit(None)).otherwise(val)
        return j.select(
            "customer_id", "pdm_prod_type_id",
            null_if(k % 7 == 0, (k % 10 + 1).cast("double")).alias("BBB_INSTORE_M_DECILE_2Y"),
            F.col("c_acctbal").alias("A_AAP000447N_ASET_PRPN_DIS_INC"),
            (k % 400 + 30).cast("int").alias("time_interval"),
            null_if(k % 5 == 0, (n * 10).cast("double")).alias("PH_DM_RECENCY"),
            F.floor(sm / n).cast("double").alias("AVG_NET_SALES_PER_TXN"),
            null_if(k % 3 == 0, n.cast("double")).alias("COUPON_SALES_Q_08"),
            F.when((F.col("c_nationkey") % 6).isin(0, 5), 1).otherwise(0)
             .alias("A_A3101N_RACE_WHITE"),
            null_if(k % 4 == 0, (k % 700).cast("double")).alias("BBB_R_2Y"),
            F.when(k % 7 == 0, "n/a").otherwise((k % 2).cast("string")).alias("MOVER"),
            (n % 5).cast("int").alias("NUM_MERCH_DIVISIONS"),
            F.floor(sm / n / 1000).cast("double").alias("AVG_TOTAL_ITEMS_PER_TXN"),
            (k % 3000).cast("double").alias("A_A8588N_HM_SQR_FT"),
            ((k % 100) / 100.0).cast("double").alias("PH_MREDEEM730D_PERC"))


def union_all(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
