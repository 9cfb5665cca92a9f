"""Exact decimal arithmetic for money and averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for the numerator of any report, narrow enough that a division by decimal(18,0)
# still keeps 16 fractional digits. decimal(38,s) numerators keep only 6 and round wrongly.
_NUMERATOR = "decimal(24,2)"
_COUNT = "decimal(18,0)"


def money(col: Column | str) -> Column:
    """Amounts as decimal(12,2); cast before summing, so that sums do not depend on row order."""
    return F.col(col).cast("decimal(12,2)") if isinstance(col, str) else col.cast("decimal(12,2)")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Exact quotient of an amount by a count, NULL when the count is zero."""
    return numerator.cast(_NUMERATOR) / F.nullif(denominator.cast(_COUNT), F.lit(0).cast(_COUNT))


def rounded_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Quotient rounded half away from zero on decimals."""
    return F.round(ratio(numerator, denominator), digits)


def rounded_avg(col: Column | str, digits: int = 2) -> Column:
    """``ROUND(AVG(x), n)`` over a numeric column of at most two decimals, without double rounding.

    Spark's ``avg`` of a decimal is already rounded to four more digits than its input, and ``avg``
    of an integer is a double; a second rounding can then move an exact tie or a value near it.
    """
    c = F.col(col) if isinstance(col, str) else col
    return rounded_ratio(F.sum(c), F.count(c), digits)


def weighted_sum(amount: Column, weight: Column) -> Column:
    """Sum of ``amount`` as if every row occurred ``weight`` times."""
    return F.sum(amount.cast("decimal(18,2)") * weight.cast("decimal(12,0)"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole * 100`` on decimals, NULL when the whole is zero."""
    w = whole.cast("decimal(22,2)")
    return F.round(part.cast("decimal(22,2)") * 100 / F.nullif(w, F.lit(0).cast("decimal(22,2)")), digits)


def blank_to_null(col: Column) -> Column:
    """Empty text becomes NULL."""
    return F.nullif(col, F.lit(""))


def parse_number(col: Column, sql_type: str) -> Column:
    """Text to a number; blanks become NULL, anything else that is not a number becomes NULL too."""
    return blank_to_null(F.trim(col)).try_cast(sql_type)


def positive_or_null(col: Column) -> Column:
    """Measures that must be positive: zero and negative values become NULL."""
    return F.when(col > 0, col)


def default_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))
