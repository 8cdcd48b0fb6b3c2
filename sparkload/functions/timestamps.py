"""Typed literals for time bounds.

Bounds are computed on the driver from ``RunContext`` and enter the plan as
constant-folded literals of the **column's own type**, so the comparison is
a plain ``col >= literal`` that reaches ``PushedFilters`` of a parquet or
JDBC scan.  Comparing a ``timestamp_ntz`` column with a ``timestamp``
literal would instead cast the column through the session zone and stop
push-down.
"""

from __future__ import annotations

import calendar
import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FMT = "%Y-%m-%d %H:%M:%S.%f"


def column_type(df: DataFrame, name: str) -> T.DataType:
    """Type of column ``name`` (case-insensitive, like Spark's resolver)."""
    lowered = name.lower()
    for fld in df.schema.fields:
        if fld.name.lower() == lowered:
            return fld.dataType
    raise KeyError(f"column {name!r} not in {df.columns}")


def ts_literal(value: dt.datetime, dtype: T.DataType, time_zone: str) -> Column:
    """``value`` (naive wall-clock in ``time_zone``) as a literal of ``dtype``."""
    text = value.strftime(_FMT)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(text).cast(T.TimestampNTZType())
    if isinstance(dtype, T.TimestampType):
        # A region id in the text pins the instant whatever the session zone.
        return F.lit(f"{text} {time_zone}").cast(T.TimestampType())
    if isinstance(dtype, T.DateType):
        return F.lit(value.date().isoformat()).cast(T.DateType())
    raise TypeError(f"no timestamp literal for column type {dtype.simpleString()}")


def _parsed(col: Column) -> Column:
    """A text timestamp (ISO-8601 with an offset, as a CRM returns it)."""
    return F.coalesce(F.try_to_timestamp(col, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSZ")), col.cast(T.TimestampType()))


def at_least(df: DataFrame, name: str, bound: dt.datetime, time_zone: str) -> Column:
    """``name >= bound`` with the bound typed to the column.

    For a ``date`` column MySQL compares ``date`` as midnight of that day, so
    ``d >= bound`` holds for the first whole day at or after ``bound``.
    """
    dtype = column_type(df, name)
    col = df[name]
    if isinstance(dtype, T.StringType):
        return _parsed(col) >= ts_literal(bound, T.TimestampType(), time_zone)
    if isinstance(dtype, T.DateType):
        first = bound.date() if bound.time() == dt.time(0) else bound.date() + dt.timedelta(days=1)
        return col >= F.lit(first.isoformat()).cast(T.DateType())
    return col >= ts_literal(bound, dtype, time_zone)


def at_most(df: DataFrame, name: str, bound: dt.datetime, time_zone: str) -> Column:
    """``name <= bound`` with the bound typed to the column."""
    dtype = column_type(df, name)
    col = df[name]
    if isinstance(dtype, T.StringType):
        return _parsed(col) <= ts_literal(bound, T.TimestampType(), time_zone)
    if isinstance(dtype, T.DateType):
        return col <= F.lit(bound.date().isoformat()).cast(T.DateType())
    return col <= ts_literal(bound, dtype, time_zone)


def epoch_seconds(value: dt.datetime, time_zone: str) -> int:
    """Epoch seconds of wall-clock ``value`` in ``time_zone`` (the inverse of
    MySQL's ``from_unixtime`` in that session zone)."""
    aware = value.replace(tzinfo=ZoneInfo(time_zone))
    return calendar.timegm(aware.utctimetuple())


def epoch_of_ntz(col: Column) -> Column:
    """Whole epoch seconds of a ``timestamp_ntz`` column read as UTC (the
    fraction is floored).  Built from the calendar fields, which do not
    depend on the session zone; a cast to ``timestamp`` would."""
    days = F.unix_date(F.to_date(col)).cast(T.LongType())
    return days * 86400 + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)


def add_months(value: dt.datetime, months: int) -> dt.datetime:
    """Calendar month arithmetic that clamps to the month's last day, like
    MySQL ``date_sub(x, interval n month)`` and Spark ``add_months``."""
    index = value.year * 12 + (value.month - 1) + months
    year, month = divmod(index, 12)
    month += 1
    last = calendar.monthrange(year, month)[1]
    return value.replace(year=year, month=month, day=min(value.day, last))
