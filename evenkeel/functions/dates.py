"""Day windows over typed, text and numeric date columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The accepted date formats and how midnight is written in each.
DATE_FORMATS = {
    "yyyy-mm-dd": "%Y-%m-%d",
    "yyyymmdd": "%Y%m%d",
    "yyyymmdd HH24:mm:ss": "%Y%m%d 00:00:00",
    "yyyy-mm-dd HH24:mm:ss": "%Y-%m-%d 00:00:00",
}


def as_day(day: str | dt.date) -> dt.date:
    """Accept a date or its ``YYYY-MM-DD`` text."""
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def check_format(date_format: str) -> str:
    if date_format not in DATE_FORMATS:
        raise ValueError(f"unsupported date format {date_format!r}, use one of {list(DATE_FORMATS)}")
    return date_format


def format_day(day: str | dt.date, date_format: str) -> str:
    """Midnight of ``day`` written in one of the accepted formats."""
    return as_day(day).strftime(DATE_FORMATS[check_format(date_format)])


def day_bounds(day: str | dt.date, date_format: str) -> tuple[str, str]:
    """First instant of ``day`` and of the day after it, as text."""
    first = as_day(day)
    return format_day(first, date_format), format_day(first + dt.timedelta(days=1), date_format)


def relative_day(offset_days: int = 2, as_of: str | dt.date | None = None) -> dt.date:
    """The day to check: ``offset_days`` before ``as_of`` (default today)."""
    return (as_day(as_of) if as_of else dt.date.today()) - dt.timedelta(days=offset_days)


def day_window(df: DataFrame, column: str, day: str | dt.date, date_format: str = "yyyy-mm-dd") -> Column:
    """Half-open predicate ``day <= column < day + 1``.

    The column itself is never wrapped, so the range reaches the scan: it prunes
    partitions, skips row groups and is sent to a database as plain comparisons.
    Text columns are compared with formatted text, all others with typed literals.
    """
    check_format(date_format)
    field = next((f for f in df.schema.fields if f.name.lower() == column.lower()), None)
    if field is None:
        raise ValueError(f"date column {column!r} not found among {df.columns}")
    if isinstance(field.dataType, (T.StringType, T.CharType, T.VarcharType)):
        low, high = (F.lit(text) for text in day_bounds(day, date_format))
    elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        low, high = (F.lit(text).cast(field.dataType) for text in day_bounds(day, "yyyy-mm-dd"))
    elif isinstance(field.dataType, T.NumericType) and date_format == "yyyymmdd":
        low, high = (F.lit(int(text)).cast(field.dataType) for text in day_bounds(day, date_format))
    else:
        raise ValueError(f"{field.dataType.simpleString()} column {column!r} does not hold {date_format!r} dates")
    value = F.col(f"`{field.name}`")
    return (value >= low) & (value < high)
