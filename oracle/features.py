"""The oracle's own statement of what the library is checked against: which snapshot and
column each attribute comes from, at which period each snapshot is read, and the code
lists of the input views. Nothing here is imported from the library."""

from __future__ import annotations

import zlib

AS_OF = "2000-01-01"

# Snapshot alias, source column, attribute name where it differs.
_FEATURES = """
f beyond_recency_two_years BBB_R_2Y
j A_A2779N_PROPEN_SCR_INTNT_01_03
j A_A2779N_PROPEN_SCR_INTNT_04_07
j A_A2779N_PROPEN_SCR_INTNT_08_10
j A_A7467N_RECNT_HOME_BUYER_YES
j A_A7478N_NEW_MOVER_YES
j A_A7779N_CHILD_INTRST_YES
j A_A7830N_HM_IMPROVE_GRP_YES
j A_A7851N_HM_IMPROVE_DIY_YES
j A_A8271N_HM_LIVING_IND_YES
j A_A8588N_HM_SQR_FT
j A_A8589N_HM_LOT_SQR_FT
j A_A8592N_HM_YR_BUILT
j A_A8606N_HM_OWN_RENT_HOME_OWNER
j A_A8606N_HM_OWNER_RENTER_RENTER
j A_A8607N_HM_LNTH_RES_01_02
j A_A8607N_HM_LNTH_RES_03_05
j A_A8607N_HM_LNTH_RES_06_10
j A_A8607N_HM_LNTH_RES_11_14
j A_A8609N_MARITAL_STAT_HH_M_A
j A_A8609N_MARITAL_STAT_HH_S_B
j A_A8641_INC_ESTMT_HHLD_1
j A_A8641_INC_ESTMT_HHLD_2
j A_A8641_INC_ESTMT_HHLD_3
j A_A8641_INC_ESTMT_HHLD_4
j A_A8641_INC_ESTMT_HHLD_5
j A_A8641_INC_ESTMT_HHLD_6
j A_A8641_INC_ESTMT_HHLD_7
j A_A8641_INC_ESTMT_HHLD_8
j A_A8641_INC_ESTMT_HHLD_9
j A_A8642_HM_MKT_VAL_LT_75
j A_A8642_HM_MKT_VAL_75_149
j A_A8642_HM_MKT_VAL_150_299
j A_A8642_HM_MKT_VAL_300_499
j A_A8642_HM_MKT_VAL_500_999
j A_A8642_HM_MKT_VAL_1M_PLUS
j A_A9153N_RPC_FURNITURE_BUYR_YES
j A_A9153N_RPC_HM_IMPROVE_YES
j A_A9509N_EDU_1ST_1
j A_A9509N_EDU_1ST_2
j A_A9509N_EDU_1ST_3
j A_A9509N_EDU_1ST_4
j A_A3101N_RACE_AFRAM
j A_A3101N_RACE_ASIAN
j A_A3101N_RACE_HISP
j A_A3101N_RACE_WHITE
j A_A9350N_ECONOMIC_STB_01_10
j A_AAP000447N_ASET_PRPN_DIS_INC
f beyond_instore_frequency BBB_INSTORE_F
f beyond_instore_frequency_two_years BBB_INSTORE_F_2Y
f beyond_oncoupon_recency_decile_two_years BBB_ONCOUPON_R_DECILE_2Y
g BUYS_Q_01
g BUYS_Q_02
g BUYS_M_01
g BUYS_M_06
g BUYS_Q_04
g BUYS_Q_08
d total_coupon_price_reduction_amount COUPON_ANY_AMT
g COUPON_Q_01
g COUPON_Q_04
g COUPON_SALES_Q_05
g COUPON_SALES_Q_08
b sales_in_last_12_months_at_HARMON_concept HARMON_SALES_L12M
h number_of_periods_purchased NUM_PERIODS
h number_of_quarters_purchased NUM_QUARTERS
h number_of_items_purchased NUM_TOTAL_ITEMS
h number_of_transactions_involving_sales NUM_TXNS
h BBBY_CLUSTER_NUMBER
d PH_CFREQ90D
d PH_CREDEEM365D
d PH_CREDEEM90D
d PH_CSTACK_90D
d PH_MREDEEM182D_PERC
d PH_MREDEEM730D_PERC
d PH_NMFREQ182D
d PH_PREDEEM365D
d PH_PREDEEM548D
d PH_PREDEEM730D
h number_of_days_since_last_purchase RECENCY
b total_sales_in_last_12_months TOTAL_SALES_L12M
b total_transactions_in_last_12_months TOTAL_TXNS_L12M
d PH_PSTACK_182D
d PH_PFREQ182D
d PH_PSTACK_90D
d PH_PFREQ90D
d PH_PSTACK_365D
d PH_MSTACK_182D
d PH_STACK_182D
d PH_PFREQ365D
d PH_MSTACK_90D
d PH_MFREQ182D
d PH_STACK_90D
d PH_MFREQ90D
d PH_FREQ182D
d PH_FREQ90D
d PH_DM_RECENCY
f beyond_monetary_decile_two_years BBB_M_DECILE_2Y
f beyond_monetary_decile BBB_M_DECILE
f beyond_oncoupon_monetary_decile BBB_ONCOUPON_M_DECILE
f beyond_oncoupon_monetary_decile_two_years BBB_ONCOUPON_M_DECILE_2Y
f beyond_instore_monetary_decile_two_years BBB_INSTORE_M_DECILE_2Y
f beyond_instore_monetary_decile BBB_INSTORE_M_DECILE
f beyond_recency_frequency_monetary_decile_two_years BBB_RFM_DECILE_2Y
f beyond_offcoupon_frequency_decile_two_years BBB_OFFCOUPON_F_DECILE_2Y
f beyond_recency_frequency_monetary_decile BBB_RFM_DECILE
f beyond_offcoupon_recency_frequency_monetary_decile_two_years BBB_OFFCOUPON_RFM_DECILE_2Y
f beyond_offcoupon_monetary_decile_two_years BBB_OFFCOUPON_M_DECILE_2Y
f beyond_oncoupon_recency_frequency_monetary_decile_two_years BBB_ONCOUPON_RFM_DECILE_2Y
f beyond_oncoupon_recency_frequency_monetary_decile BBB_ONCOUPON_RFM_DECILE
f beyond_frequecy_decile_two_years BBB_F_DECILE_2Y
f beyond_instore_recency_frequency_monetary_decile_two_years BBB_INSTORE_RFM_DECILE_2Y
f beyond_frequency_decile BBB_F_DECILE
f beyond_instore_recency_frequency_monetary_decile BBB_INSTORE_RFM_DECILE
f beyond_monetary_two_years BBB_M_2Y
c avg_net_sales_per_transaction AVG_NET_SALES_PER_TXN
c avg_sales_per_transaction AVG_SALES_PER_TXN
i number_of_departments_purchased NUM_DEPARTMENTS
i number_of_item_categories_purchased NUM_ITEM_CATEGORIES
e pct_sales_on_transaction_pct_off_coupons PCT_SALES_ON_TXN_PCT_COUPON
e pct_sales_on_transaction_USD_off_coupons PCT_SALES_ON_TXN_DOL_COUPON
e pct_transaction_USD_off_coupon_depth PCT_TXN_DOL_COUPON_DEPTH
e pct_items_sold_on_item_pct_off_coupons PCT_ITEMS_ON_ITEM_PCT_COUPON
i avg_unique_items_per_transaction AVG_UNIQUE_ITEMS_PER_TXN
i number_of_sub_departments_purchased NUM_SUB_DEPARTMENT
i avg_items_per_transaction AVG_TOTAL_ITEMS_PER_TXN
e pct_transactions_on_item_pct_off_coupons PCT_TXNS_ON_ITEM_PCT_COUPON
e pct_transactions_on_transaction_USD_off_coupons PCT_TXNS_ON_TXN_DOL_COUPON
e pct_coupon_depth_for_item_pct_off_coupons PCT_ITEM_PCT_COUPON_DEPTH
e pct_sales_on_item_pct_off_coupons PCT_SALES_ON_ITEM_PCT_COUPON
e pct_transactions_on_transaction_pct_off_coupons PCT_TXNS_ON_TXN_PCT_COUPON
e pct_items_sold_on_transaction_pct_off_coupons PCT_ITEMS_ON_TXN_PCT_COUPON
e pct_transaction_pct_off_coupon_depth PCT_TXN_PCT_COUPON_DEPTH
h number_of_channels_purchased NUM_CHANNELS
h number_of_classes_purchased NUM_CLASSES
h number_of_merchandise_divisions_purchased NUM_MERCH_DIVISIONS
h number_of_product_groups_purchased NUM_PRODUCT_GROUPS
"""
FEATURES = [(p[-1], p[0], p[1]) for p in map(str.split, _FEATURES.strip().splitlines())]

# Snapshots read at the current purchase's period; the others at the
# previous one's, so that the comeback itself does not leak into the attributes.
CURRENT_PERIOD = ["e", "j"]
ALIASES = ["b", "c", "d", "e", "f", "g", "h", "i", "j"]


def period_column(alias: str) -> str:
    return "FISCAL_PERIOD_ID" if alias in CURRENT_PERIOD else "PRE_FISCAL_PERIOD_ID"


def stand_in(alias: str, source: str) -> tuple[str, int]:
    """The measure and the offset that a snapshot column's values are made of."""
    code = zlib.crc32(f"{alias}.{source}".encode())
    return ["m_count", "m_sum", "m_avg", "m_decile"][code % 4], code % 99_991


# Code lists of the input views.
CHANNELS = ['Paid Search', 'None', 'Natural Search', 'QR', 'CSE', 'Retargeting', 'Internal', 'Display', 'Direct', 'Affiliate', 'Referring Domains', 'Social Marketing', 'Social Networks', 'Email']
TERRITORIES = [' il', 'OH', 'MI', 'NY', 'NJ', 'PA', 'CT', 'MA', 'TX', 'FL ', 'ga', 'DC', 'CA', 'WA', 'HI', 'AK', 'CO', None, 'ON', 'KY', 'VA', 'ND', 'VT', 'UT', 'PR']
INCOME_DESC = {'A': 'LESS_THAN_50K', 'B': '50K_TO_99K', 'C': '100K_TO_149K', 'D': '150K_PLUS'}
