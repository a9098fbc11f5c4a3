"""Date expressions (FN-1..FN-6, WIN-2, WIN-3, FLT-2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_index(d) -> Column:
    """Months since year 0: year*12 + month."""
    d = _c(d)
    return F.year(d) * 12 + F.month(d)


def month_boundaries(start, end) -> Column:
    """Calendar-month boundaries crossed from ``start`` to ``end`` (signed).

    2024-01-31 -> 2024-07-01 gives 6, unlike ``months_between`` (5.03) or
    ``timestampdiff(MONTH)`` (5).
    """
    return month_index(end) - month_index(start)


def day_gap(start, end) -> Column:
    """|end - start| in days."""
    return F.abs(F.datediff(_c(end), _c(start)))


def month_gap(start, end) -> Column:
    """|calendar-month boundaries| between two dates."""
    return F.abs(month_boundaries(start, end))


def trailing_window(d, as_of: str, months: int = 24) -> Column:
    """``d`` BETWEEN as_of - months AND as_of, both ends inclusive.

    ``as_of`` is a literal parameter (the reference used the run date, which
    makes results change daily). ``add_months`` maps 29 Feb to 28 Feb.
    """
    end = F.to_date(F.lit(as_of))
    return _c(d).between(F.add_months(end, -months), end)


def year_of(x) -> Column:
    """EXTRACT(YEAR FROM CAST(x AS DATE))."""
    return F.year(F.to_date(_c(x)))
