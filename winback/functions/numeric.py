"""Numeric expressions with pandas/numpy-compatible results (FN-14..FN-16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def np_round(x, digits: int = 2) -> Column:
    """numpy's round: rint(x * 10^d) / 10^d (half to even on the scaled
    value). Spark's ``round`` is half-up and ``bround`` works on the decimal
    value; both differ from numpy on some ratios."""
    s = float(10 ** digits)
    return F.rint(_c(x) * s) / s


def coverage_percent(nulls, rows) -> Column:
    """int(round(1 - nulls/rows, 2) * 100): truncation after the float
    product, so 0.57 becomes 56 like in the pandas original."""
    ratio = F.lit(1.0) - _c(nulls).cast("double") / _c(rows).cast("double")
    return (np_round(ratio, 2) * 100).cast("int")


def quoted(name: str) -> Column:
    """A column by its whole name (dots and back-ticks are part of it)."""
    return F.col("`" + name.replace("`", "``") + "`")


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN as NULL: pandas counts both as missing."""
    col = quoted(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col), col)
    return col


def to_number(x) -> Column:
    """pandas ``to_numeric(errors='coerce')``: bad text becomes NULL, and so
    does NaN (also as the text 'nan')."""
    n = (quoted(x) if isinstance(x, str) else x).try_cast("double")
    return F.when(~F.isnan(n), n)
