"""Scalar expressions with the semantics the attribution queries rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "date_lit", "days_between", "month_boundaries", "left_chars",
    "regexp_nth", "regexp_delete", "earlier_of", "ratio", "money",
    "strip_spaces", "fiscal_year",
]


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_lit(value: str) -> Column:
    """String literal coerced to DATE (the warehouse does it implicitly)."""
    return F.lit(value).cast("date")


def days_between(start, end) -> Column:
    """``datediff(day, start, end)``: midnights crossed, not whole 24 h spans.
    Spark's ``datediff(end, start)`` casts both sides to DATE first, which is
    exactly the boundary count (23:00 -> 01:00 next day is 1)."""
    return F.datediff(col_of(end), col_of(start))


def month_boundaries(start, end) -> Column:
    """``datediff('months', start, end)``: month boundaries crossed, signed.
    (31 Jan -> 1 Feb is 1; Spark's ``months_between`` would give ~0.03.)"""
    s, e = col_of(start), col_of(end)
    return (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))


def left_chars(c, n: int) -> Column:
    """``left(x, n)``; dates and timestamps are sliced in their ISO text form."""
    return F.substring(col_of(c).cast("string"), 1, n)


def regexp_nth(c, pattern: str, n: int) -> Column:
    """n-th (1-based) whole match of ``pattern`` or NULL when there are fewer
    matches (``regexp_substr(x, re, 1, n)``)."""
    return F.get(F.regexp_extract_all(col_of(c), F.lit(pattern), F.lit(0)), n - 1)


def regexp_delete(c, pattern: str) -> Column:
    """Two-argument ``regexp_replace``: delete every match."""
    return F.regexp_replace(col_of(c), pattern, "")


def strip_spaces(c) -> Column:
    """Two-argument ``replace(x, ' ')``: delete every blank."""
    return F.replace(col_of(c), F.lit(" "), F.lit(""))


def earlier_of(a, b) -> Column:
    """``case when a > b then b else a end``: a NULL ``b`` falls to ``a`` and a
    NULL ``a`` stays NULL (unlike ``least``, which skips NULLs)."""
    a, b = col_of(a), col_of(b)
    return F.when(a > b, b).otherwise(a)


def ratio(num, den) -> Column:
    """Division that yields NULL instead of failing when ``den`` is 0 or NULL."""
    return F.try_divide(col_of(num), col_of(den))


def money(c) -> Column:
    """Money as fixed decimal: sums stay exact and order independent."""
    return col_of(c).cast("decimal(18,2)")


def fiscal_year(c, start_month: int = 4) -> Column:
    """Fiscal year label of a date for years starting in ``start_month``
    (a rule, in place of a per-day lookup table join)."""
    d = col_of(c)
    y = F.year(d) + F.when(F.month(d) >= start_month, 1).otherwise(0)
    return F.concat(F.lit("FY"), y.cast("string"))
