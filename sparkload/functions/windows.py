"""Predicate builders for the extract windows.

Every builder takes the frame (for column types), the column name(s) and a
``RunContext`` and returns a ``Column``.  All bounds are inclusive and are
literals computed here, so they push down to the scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from .timestamps import add_months, at_least, at_most, epoch_seconds

# Fixed values of the reference's windows.
INSERT_CUTOFF = dt.time(5, 0, 0)
POLL_CUTOFF = dt.time(4, 40, 0)
UPDATE_LOOKBACK_DAYS = 3
LOG_CREATION_LOOKBACK_MONTHS = 7
CREATION_FLOOR = dt.datetime(2021, 1, 1, 0, 0, 0)
OPPORTUNITY_YEARS = 3


def month_start_bound(ctx: RunContext) -> dt.datetime:
    """``date_sub(curdate(), interval day(curdate()) day)``: midnight of the
    last day of the previous month (not the 1st)."""
    day = ctx.day
    return dt.datetime.combine(day - dt.timedelta(days=day.day), dt.time(0))


def cutoff_bound(ctx: RunContext, cutoff: dt.time = INSERT_CUTOFF) -> dt.datetime:
    """``concat(curdate(), ' 05:00:00')``: today at the cutoff time."""
    return dt.datetime.combine(ctx.day, cutoff)


def between(df: DataFrame, column: str, low: dt.datetime, high: dt.datetime, ctx: RunContext) -> Column:
    return at_least(df, column, low, ctx.time_zone) & at_most(df, column, high, ctx.time_zone)


def month_to_date(df: DataFrame, column: str, ctx: RunContext, cutoff: dt.time = INSERT_CUTOFF) -> Column:
    """``column`` in [last day of previous month, today cutoff]."""
    return between(df, column, month_start_bound(ctx), cutoff_bound(ctx, cutoff), ctx)


def month_to_date_epoch(df: DataFrame, column: str, ctx: RunContext, cutoff: dt.time = INSERT_CUTOFF) -> Column:
    """the F1 window on an epoch-seconds column.

    ``from_unixtime(c) >= x`` is not sargable; ``c >= epoch(x)`` is the same
    test on whole seconds and pushes down.
    """
    low = epoch_seconds(month_start_bound(ctx), ctx.time_zone)
    high = epoch_seconds(cutoff_bound(ctx, cutoff), ctx.time_zone)
    return (df[column] >= F.lit(low)) & (df[column] <= F.lit(high))


def rolling_update(
    df: DataFrame,
    updated: str,
    created: str,
    ctx: RunContext,
    days: int = UPDATE_LOOKBACK_DAYS,
    floor: dt.datetime | None = CREATION_FLOOR,
    floor_months: int | None = None,
    cutoff: dt.time = INSERT_CUTOFF,
) -> Column:
    """``updated`` in [as_of - days, today cutoff] and ``created``
    above a floor: a fixed instant (F4) or ``as_of - floor_months`` (F5).

    The lower bound keeps the time of day of ``as_of`` (``sysdate()``); the
    upper uses the calendar day (``curdate()``).
    """
    cond = between(df, updated, ctx.as_of - dt.timedelta(days=days), cutoff_bound(ctx, cutoff), ctx)
    if floor_months is not None:
        cond = cond & at_least(df, created, add_months(ctx.as_of, -floor_months), ctx.time_zone)
    elif floor is not None:
        cond = cond & at_least(df, created, floor, ctx.time_zone)
    return cond


def created_since(df: DataFrame, column: str, floor: dt.datetime, ctx: RunContext) -> Column:
    """``column >= floor``."""
    return at_least(df, column, floor, ctx.time_zone)


def last_n_years_bound(ctx: RunContext, years: int = OPPORTUNITY_YEARS) -> dt.datetime:
    """Start of ``LAST_N_YEARS:n``: 1 January, ``n`` years before this year."""
    return dt.datetime(ctx.day.year - years, 1, 1)


def last_n_years(df: DataFrame, column: str, ctx: RunContext, years: int = OPPORTUNITY_YEARS) -> Column:
    """``column >= LAST_N_YEARS:n``."""
    return at_least(df, column, last_n_years_bound(ctx, years), ctx.time_zone)


@dataclass(frozen=True)
class Marks:
    """High-water marks of a target table; ``None`` means the target had no
    value (empty or all null), read as minus infinity."""

    created: dt.datetime | None
    updated: dt.datetime | None


def _since(df: DataFrame, column: str, mark: dt.datetime | None, ctx: RunContext) -> Column:
    if mark is None:
        return df[column].isNotNull()
    return at_least(df, column, mark, ctx.time_zone)


def watermark_delta(
    df: DataFrame,
    marks: Marks,
    ctx: RunContext,
    created: str = "created_at",
    updated: str = "updated_at",
    update_floor: dt.datetime | None = None,
) -> Column:
    """F7 ``created >= ca or updated >= ua`` and, with ``update_floor``, F8
    ``created >= ca or (updated >= ua and created >= floor)``.

    Both marks null (first load) selects every row.
    """
    if marks.created is None and marks.updated is None:
        return F.lit(True)
    update_arm = _since(df, updated, marks.updated, ctx)
    if update_floor is not None:
        update_arm = update_arm & at_least(df, created, update_floor, ctx.time_zone)
    return _since(df, created, marks.created, ctx) | update_arm
