"""Rule tables compiled to one CASE expression (FN-10, FN-12, FN-13, CLS-*).

A rule table is an ordered list of ``(condition, value)`` pairs; the first
matching condition wins, like SQL's searched CASE and ``np.select``. Keeping
the rules as data lets a user correct a mapping (for example the two states
missing from the region lists) without touching the operators. Everything
compiles to built-in expressions inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_match(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... ELSE default END."""
    expr = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if expr is None else expr.otherwise(d)


def flag(cond: Column) -> Column:
    """np.where(cond, 1, 0); NULL condition gives 0."""
    return F.when(cond, 1).otherwise(0)


# --- fixed values (reactivation channel rules) --------------------------------
SOCIAL_CHANNELS = ["Social Marketing", "Social Networks"]
WEB_CHANNELS = ["Paid Search", "None", "Natural Search", "QR", "CSE", "Retargeting",
                "Internal", "Display", "Direct", "Affiliate", "Referring Domains"]
# ------------------------------------------------------------------------------


def reactivation_channel(channel="last_touch_channel", dm="DM_Flag",
                         social=SOCIAL_CHANNELS, web=WEB_CHANNELS) -> Column:
    """CLS-1: attribute a comeback to a channel; first match wins.

    'None' is a channel *name*, not NULL. Social beats direct mail, and any
    channel outside both lists passes through unchanged (also beating DM).
    """
    ch, dmc = _c(channel), _c(dm)
    return first_match([
        (ch.isin(*social), "Social"),
        (ch.isNull() & (dmc == 1), "DM"),
        (ch.isin(*web) & (dmc == 1), "DM"),
        (ch.isin(*web) & (dmc == 0), "Others"),
        (ch.isNull() & (dmc == 0), "UNKNOWN"),
    ], default=ch)


# --- fixed values (US census divisions by state code) -------------------------
REGIONS = [
    ("Midwest", ["IA", "IL", "IN", "KS", "MI", "MN", "MO", "ND", "NE", "OH", "SD", "WI"]),
    ("Northeast", ["ME", "NH", "NJ", "NY", "PA", "RI", "VT"]),
    ("South", ["AL", "AR", "DC", "DE", "FL", "GA", "KY", "LA", "MD", "MS", "NC", "OK",
               "SC", "TN", "TX", "VA", "WV"]),
    ("West", ["AK", "AZ", "CA", "CO", "HI", "ID", "MT", "NM", "NV", "OR", "UT", "WA", "WY"]),
]
# ------------------------------------------------------------------------------


def state_division(territory="TERRITORY_CD", regions=REGIONS) -> Column:
    """CLS-3: region of a trimmed, upper-cased state code; else UNKNOWN.
    CT and MA are in no list and fall to UNKNOWN, as in the source rules."""
    code = F.trim(F.upper(_c(territory)))
    return first_match([(code.isin(*states), name) for name, states in regions],
                       default="UNKNOWN")


# --- fixed values (age bands; the fall-through label is spelt as in the source)
AGE_UNKNOWN = "UKNOWN"
# ------------------------------------------------------------------------------


def age_bucket(age: Column) -> Column:
    """CLS-4: age band. Exactly 17 and NULL both fall through to 'UKNOWN'."""
    return first_match([
        (age < 17, "AGE_LESS_17"),
        ((age >= 18) & (age <= 24), "AGE_18_24"),
        ((age >= 25) & (age <= 40), "AGE_25_40"),
        ((age >= 41) & (age <= 54), "AGE_41_54"),
        (age >= 55, "AGE_ABOVE_55"),
    ], default=AGE_UNKNOWN)


def ethnicity(white="A3101N_RACE_WHITE", hisp="A3101N_RACE_HISP",
              afram="A3101N_RACE_AFRAM", asian="A3101N_RACE_ASIAN") -> Column:
    """CLS-6: one label from four one-hot flags, WHITE > HISP > AFRAM > ASIAN."""
    return first_match([(_c(white) == 1, "WHITE"), (_c(hisp) == 1, "HISP"),
                        (_c(afram) == 1, "AFRAM"), (_c(asian) == 1, "ASIAN")],
                       default="UNKNOWN")


def default_unknown(x) -> Column:
    """CLS-5 / CLS-7: NULL -> 'UNKNOWN'."""
    return F.coalesce(_c(x), F.lit("UNKNOWN"))


def buying_channel(src="pre_src_order") -> Column:
    """CLS-8: 'U' -> Instore, anything else including NULL -> Online.

    Null-safe equality: in pandas NaN != 'U' is True, so NULL is Online."""
    return F.when(_c(src).eqNullSafe("U"), "Instore").otherwise("Online")


def clean_gender(g="gender") -> Column:
    """CLS-5 cleaning: '' -> UNKNOWN, M, F, UNKNOWN kept; any other value
    (including NULL and codes like 'X') -> UNKNOWN (explicit default)."""
    gc = _c(g)
    return first_match([(gc == "", "UNKNOWN"), (gc == "M", "M"), (gc == "F", "F"),
                        (gc == "UNKNOWN", "UNKNOWN")], default="UNKNOWN")
