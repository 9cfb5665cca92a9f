"""Time filters, buckets and expiry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

YEAR_COLUMN = "purchase_year"


def _as_datetime(value: str | dt.datetime | dt.date) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(value)


def bound(df: DataFrame, column: str, value: str | dt.datetime | dt.date) -> Column:
    """A literal in the column's own type, so that the comparison is pushed to the scan."""
    return F.lit(_as_datetime(value).isoformat(sep=" ")).cast(df.schema[column].dataType)


def half_open(
    df: DataFrame, column: str, start: str | dt.datetime, end: str | dt.datetime, year_column: str = YEAR_COLUMN
) -> DataFrame:
    """Rows with ``start <= column < end``.

    A year-partitioned layout prunes only on its year column; nothing derives that predicate from a
    timestamp filter. So it is added here whenever the frame carries the column.
    """
    out = df.where((F.col(column) >= bound(df, column, start)) & (F.col(column) < bound(df, column, end)))
    if year_column in df.columns:
        last = _as_datetime(end) - dt.timedelta(microseconds=1)
        out = out.where(F.col(year_column).between(_as_datetime(start).year, last.year))
    return out


def closed(
    df: DataFrame, column: str, start: str | dt.datetime, end: str | dt.datetime, year_column: str = YEAR_COLUMN
) -> DataFrame:
    """Rows with ``column BETWEEN start AND end``: an end given as a date stops at its midnight."""
    out = df.where(F.col(column).between(bound(df, column, start), bound(df, column, end)))
    if year_column in df.columns:
        out = out.where(F.col(year_column).between(_as_datetime(start).year, _as_datetime(end).year))
    return out


def since(df: DataFrame, column: str, start: str | dt.datetime) -> DataFrame:
    return df.where(F.col(column) >= bound(df, column, start))


def within_last(df: DataFrame, column: str, as_of: str | dt.datetime, hours: int) -> DataFrame:
    """Rows no older than ``hours`` before ``as_of`` (newer ones included)."""
    return since(df, column, _as_datetime(as_of) - dt.timedelta(hours=hours))


def not_expired(df: DataFrame, column: str, as_of: str | dt.datetime) -> DataFrame:
    return df.where(F.col(column) > bound(df, column, as_of))


def month_label(col: Column | str) -> Column:
    return F.date_format(col, "yyyy-MM")


def micros_between(later: Column, earlier: Column) -> Column:
    """Elapsed microseconds as a long, for either timestamp type."""
    return F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))


def seconds_between(later: Column, earlier: Column) -> Column:
    return (micros_between(later, earlier) / 1_000_000).cast("double")


def parse_timestamp(col: Column) -> Column:
    """Text to timestamp; blank or malformed text gives NULL."""
    return F.try_to_timestamp(F.nullif(F.trim(col), F.lit("")))


def plus(col: Column | str, interval: str) -> Column:
    """``col`` moved by an interval such as ``90 days`` or ``24 hours``."""
    c = F.col(col) if isinstance(col, str) else col
    return c + F.expr(f"interval {interval}")


def next_year(as_of: str | dt.datetime) -> Column:
    """Year of the date twelve months ahead."""
    return F.year(F.add_months(F.lit(_as_datetime(as_of).date()), 12))
