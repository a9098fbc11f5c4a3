"""Feature preparation: name-pattern recast / imputation, categorical
encoding, label index, exact stratified split, standard scaling, sampling.

PREP-1..PREP-8, FN-12..FN-18, AGG-9, SET-2.

Rules chosen by column name are resolved on the driver against the schema
and compiled into one flat ``select`` (no ``withColumn`` loops, no data pass).
Fitted state (modes, levels, means) comes from one small aggregate per step.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winback.functions import rules
from winback.functions.numeric import present, quoted, to_number
from winback.operators.ranking import rank_within_group
from winback.sources.io import materialize

Pattern = str | Callable[[str], bool]


class Strategy:
    """A fill value computed from the data (AGG-9 / AGG-10)."""

    def __init__(self, name: str):
        self.name = name

    def __repr__(self) -> str:
        return self.name.upper()


MODE, MEAN, MEDIAN, MIN, MAX, STD = (Strategy(n) for n in
                                     ("mode", "mean", "median", "min", "max", "std"))
_STAT_FN = {"mean": F.avg, "min": F.min, "max": F.max, "std": F.stddev}

# --- fixed values: name-pattern rules (first match wins, case-sensitive) ------
RECAST_RULES: list[tuple[Pattern, str]] = [
    ("BBB_", "double"), ("PCT_", "double"), ("COUPON_", "double"), ("A_", "double")]
IMPUTE_RULES: list[tuple[Pattern, object]] = [
    ("BUYS", 0), ("COUPON", 0), ("INCOME", MODE), ("A_", 0), ("gender", "UNKNOWN")]
SCORING_RULES: list[tuple[Pattern, object]] = [
    ("DECILE", 11), ("_R_2Y", 720), ("RECENCY", 365), (lambda name: True, 0)]
SCORING_FEATURES = ["BBB_INSTORE_M_DECILE_2Y", "A_AAP000447N_ASET_PRPN_DIS_INC",
                    "time_interval", "PH_DM_RECENCY", "AVG_NET_SALES_PER_TXN",
                    "COUPON_SALES_Q_08", "A_A3101N_RACE_WHITE", "BBB_R_2Y", "MOVER",
                    "NUM_MERCH_DIVISIONS", "AVG_TOTAL_ITEMS_PER_TXN", "A_A8588N_HM_SQR_FT",
                    "PH_MREDEEM730D_PERC"]
CATEGORICAL = ["State_Division", "gender", "age_bucket", "INCOME", "ethnicity",
               "Pre_Buying_Channel"]
SPLIT_FRACTIONS = (0.65, 0.175, 0.175)
SPLIT_SEED = 1121218
# ------------------------------------------------------------------------------


def match_rule(name: str, rule_list: Sequence[tuple[Pattern, object]]):
    """Action of the first rule whose pattern (substring or predicate) matches."""
    for pat, action in rule_list:
        if (pat(name) if callable(pat) else pat in name):
            return action
    return None


def recast(df: DataFrame, rule_list=RECAST_RULES) -> DataFrame:
    """PREP-1: cast columns by name pattern (strict cast: bad text raises)."""
    out = []
    for c in df.columns:
        t = match_rule(c, rule_list)
        out.append(quoted(c).cast(t).alias(c) if t else quoted(c))
    return df.select(*out)


def _fill(df: DataFrame, c: str, value, fractional: bool = False):
    """The column with its missing cells (NULL, NaN) set to ``value``; with
    ``fractional`` a whole-number column becomes double, so a mean stays whole."""
    dtype, col = df.schema[c].dataType, present(df, c)
    if fractional and isinstance(dtype, T.IntegralType):
        dtype, col = T.DoubleType(), col.cast("double")
    lit = F.lit(value)
    if not isinstance(dtype, T.StringType) or not isinstance(value, str):
        lit = lit.cast(dtype)
    return F.coalesce(col, lit).alias(c)


def column_modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """AGG-9 for several columns in one job: most frequent non-NULL value,
    ties to the smallest value. Counting is a (column, value) aggregate and
    the per-column pick a WindowGroupLimit, so one row per column returns."""
    if not cols:
        return {}
    from pyspark.sql import Window
    numeric = _numeric(df)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("k"), present(df, c).cast("string").alias("v"),
                 (present(df, c).cast("double") if c in numeric else F.lit(None).cast("double"))
                 .alias("n")) for c in cols])).alias("s")).select("s.*").where(
        F.col("v").isNotNull())
    cnt = long.groupBy("k", "v", "n").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("k").orderBy(F.col("c").desc(), F.col("n").asc_nulls_last(),
                                        F.col("v"))
    rows = cnt.withColumn("r", F.row_number().over(w)).where("r = 1").select("k", "v").collect()
    return {k: v for k, v in rows}


def _numeric(df: DataFrame) -> set:
    from winback.operators.quality import numeric_columns
    return set(numeric_columns(df))


def fit_fill_values(df: DataFrame, wanted: dict) -> dict:
    """Data-derived fill values (mode / mean / median / min / max / std) for
    all columns at once: one aggregate job for the numeric statistics, one
    for the modes."""
    stats = {c: s for c, s in wanted.items()
             if isinstance(s, Strategy) and s not in (MODE, MEDIAN)}
    out = {}
    medians = [c for c, s in wanted.items() if s is MEDIAN]
    if medians:
        from winback.operators.values import medians as exact_medians
        out.update({r[0]: r[1] for r in exact_medians(df, medians).collect()})
    if stats:
        row = df.agg(*[_STAT_FN[s.name](present(df, c).cast("double")).alias(f"f{i}")
                       for i, (c, s) in enumerate(stats.items())]).first()
        out.update({c: row[f"f{i}"] for i, c in enumerate(stats)})
    modes = column_modes(df, [c for c, s in wanted.items() if s is MODE])
    out.update(modes)
    return out


def impute(df: DataFrame, rule_list=IMPUTE_RULES) -> DataFrame:
    """PREP-2: fill NULLs and NaN by name pattern. A constant fills directly; a
    ``Strategy`` (MODE, MEAN, MEDIAN, MIN, MAX, STD) is fitted on the data
    first, for all such columns in at most two small jobs."""
    actions = {c: match_rule(c, rule_list) for c in df.columns}
    fitted = fit_fill_values(df, {c: a for c, a in actions.items() if isinstance(a, Strategy)})
    out = []
    for c in df.columns:
        v = fitted.get(c) if isinstance(actions[c], Strategy) else actions[c]
        out.append(quoted(c) if v is None else _fill(df, c, v, actions[c] in (MEAN, MEDIAN, STD)))
    return df.select(*out)


def impute_scoring(df: DataFrame, features=SCORING_FEATURES, keep=("customer_id",),
                   rule_list=SCORING_RULES) -> DataFrame:
    """PREP-3: coerce each feature to a number (bad text -> NULL), then fill
    by pattern: DECILE -> 11, _R_2Y -> 720, RECENCY -> 365, else 0. Rows whose
    features are all NULL stay (the original lost them in a stack/unstack)."""
    cols = [F.coalesce(to_number(f), F.lit(float(match_rule(f, rule_list)))).alias(f)
            for f in features]
    return df.select(*keep, *cols)


def with_buying_channel(df: DataFrame, src="pre_src_order") -> DataFrame:
    """CLS-8 as a new column Pre_Buying_Channel."""
    return df.select("*", rules.buying_channel(src).alias("Pre_Buying_Channel"))


def with_clean_gender(df: DataFrame, col="gender") -> DataFrame:
    """CLS-5 cleaning in place."""
    return df.select(*[rules.clean_gender(c).alias(c) if c == col else quoted(c)
                       for c in df.columns])


def category_levels(df: DataFrame, cols: Sequence[str], max_levels: int = 1000) -> dict:
    """Sorted distinct non-NULL values per column, in one job. At most
    ``len(cols) * max_levels + 1`` rows reach the driver; more means a
    column is not categorical and raises instead of being collected."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("k"), present(df, c).cast("string").alias("v")) for c in cols]))
        .alias("s")).select("s.*").where(F.col("v").isNotNull()).distinct()
    cap = len(cols) * max_levels
    rows = long.limit(cap + 1).collect()
    if len(rows) > cap:
        raise ValueError(f"more than {max_levels} levels in some of {list(cols)}")
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for k, v in rows:
        levels[k].append(v)
    for k in levels:
        if len(levels[k]) > max_levels:
            raise ValueError(f"column {k} has more than {max_levels} levels")
        levels[k].sort()
    return levels


def one_hot(df: DataFrame, cols: Sequence[str] = CATEGORICAL, drop_first: bool = True,
            levels: dict | None = None) -> DataFrame:
    """PREP-4 / SET-2: ``<col>_<level>`` 0/1 double columns for the sorted
    levels (first level dropped), originals removed. A NULL encodes as all
    zeros. Flat columns keep names, unlike an assembled vector."""
    levels = levels or category_levels(df, cols)
    keep = [quoted(c) for c in df.columns if c not in cols]
    enc = []
    for c in cols:
        lv = levels[c][1:] if drop_first else levels[c]
        enc += [F.when(quoted(c) == v, 1.0).otherwise(0.0).alias(f"{c}_{v}") for v in lv]
    return df.select(*keep, *enc)


def one_hot_vector(df: DataFrame, cols: Sequence[str] = CATEGORICAL, suffix: str = "_vec"):
    """PREP-4, vector form for ``pyspark.ml`` stages: ``StringIndexer`` with
    ``alphabetDesc`` puts the alphabetically first level last, and
    ``OneHotEncoder(dropLast=True)`` drops it - the same levels as the flat
    ``one_hot``. Returns the fitted pipeline model (fit = one distinct-values
    job per column) and the transformed frame."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    idx = [f"{c}__idx" for c in cols]
    stages = [StringIndexer(inputCols=list(cols), outputCols=idx,
                            stringOrderType="alphabetDesc", handleInvalid="keep"),
              OneHotEncoder(inputCols=idx, outputCols=[f"{c}{suffix}" for c in cols],
                            dropLast=True, handleInvalid="keep")]
    model = Pipeline(stages=stages).fit(df)
    return model, model.transform(df).drop(*idx)


def dictionary(df: DataFrame, col: str) -> DataFrame:
    """(value, id from 0 by value, row_count) of a column's non-missing values, stored:
    the idx2class / class2idx table. Ids come from the distributed rank over the
    distinct values, so there may be any number of them."""
    values = (df.select(present(df, col).alias("value")).where(F.col("value").isNotNull())
              .groupBy("value").agg(F.count(F.lit(1)).alias("row_count")).withColumn("_all", F.lit(0)))
    ranked = rank_within_group(values, "_all", ["value"])
    return materialize(ranked.select("value", (F.col("group_rank") - 1).cast("int").alias("id"), "row_count"),
                       "dictionary")


def label_index(df: DataFrame, label_col: str = "reactivation_channel", out: str = "label",
                classes: DataFrame | None = None) -> DataFrame:
    """PREP-5 / FN-18: integer label by class order (Spark has no row order, so "order of
    first appearance" is replaced), joined from the stored ``dictionary``. Its size is
    known, so Spark broadcasts a small one and shuffles for a large one, where AQE splits
    a hot class. Missing classes get no label."""
    classes = dictionary(df, label_col) if classes is None else classes
    d = classes.select(F.col("value").alias("_class"), F.col("id").cast("int").alias("_id"))
    j = df.join(d, present(df, label_col) == F.col("_class"), "left")
    return j.select(*[quoted(c) for c in df.columns], F.col("_id").alias(out))


def stratified_split(df: DataFrame, label_col: str, order_cols: Sequence[str],
                     fractions=SPLIT_FRACTIONS) -> DataFrame:
    """PREP-6: exact per-class split into train / valid / test.

    Within each class rows are ranked by ``order_cols``; the first
    ``floor(n * f_train + 0.5)`` are train, up to ``floor(n * (f_train +
    f_valid) + 0.5)`` valid, the rest test. Ordering by an id gives a
    repeatable split; pass a seeded hash column for a random one."""
    cut1 = float(fractions[0])
    cut2 = float(fractions[0] + fractions[1])
    r = rank_within_group(df, label_col, order_cols)
    n = F.col("group_size")
    split = (F.when(F.col("group_rank") <= F.floor(n * cut1 + 0.5), "train")
             .when(F.col("group_rank") <= F.floor(n * cut2 + 0.5), "valid")
             .otherwise("test"))
    return r.select(*[quoted(c) for c in df.columns], split.alias("split"))


def fit_standard_scaler(df: DataFrame, cols: Sequence[str]) -> dict:
    """PREP-7 fit: mean and *population* std per column in one aggregate
    (ML's StandardScaler uses the sample std). Zero/undefined std -> 1."""
    row = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.avg(present(df, c).cast("double")).alias(f"m{i}"),
        F.stddev_pop(present(df, c).cast("double")).alias(f"s{i}"))]).first()
    out = {}
    for i, c in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        out[c] = (0.0 if m is None else m, 1.0 if not s else s)
    return out


def apply_standard_scaler(df: DataFrame, stats: dict, digits: int | None = None) -> DataFrame:
    """PREP-7 transform: (x - mean) / std, names kept."""
    def scaled(c):
        m, s = stats[c]
        e = (quoted(c).cast("double") - F.lit(m)) / F.lit(s)
        return (F.round(e, digits) if digits is not None else e).alias(c)
    return df.select(*[scaled(c) if c in stats else quoted(c) for c in df.columns])


def sample_rows(df: DataFrame, fraction: float, seed: int = SPLIT_SEED,
                keys: Sequence[str] | None = None) -> DataFrame:
    """PREP-8: keep about ``fraction`` of the rows, seeded.

    With ``keys`` a row is kept when a seeded 64-bit hash of its key falls
    below the fraction: membership depends only on the row, so a retried task
    or a re-read input (even one whose order came out of a shuffle) keeps
    exactly the same rows. Without keys it is Spark's Bernoulli sample, which
    is repeatable only for a deterministic input order."""
    if not keys:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    bucket = F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(1_000_000))
    return df.where(bucket < int(round(fraction * 1_000_000)))
