"""High-water-mark increments.

* ``watermark`` is the one-row ``max(created), max(updated)`` of the target
  (nulls ignored; an empty target gives one row of nulls).  Only the two
  pruned columns are read; partial maxima are combined map-side, so one row
  per map task crosses the exchange.
* ``read_marks`` collects that single row to Python literals, so the delta
  predicate is a constant comparison that pushes into the source scan.
* ``delta`` applies F7/F8 (and the optional ``distinct``).
* ``cascade`` keeps child rows whose parent key is in the delta, optionally
  requiring the child's own change (J3), then ``distinct`` (J2-J4).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import RunContext
from ..functions.timestamps import column_type
from ..functions.windows import Marks, watermark_delta
from .distinct import distinct_keys, distinct_rows
from .materialize import KeySet
from .projection import select_columns
from .semijoin import DEFAULT_MAX_BROADCAST_KEYS, semi_join


def _as_wallclock(df: DataFrame, name: str, zone: str | None = None) -> Column:
    """A max-able column whose collected value is the wall-clock datetime in
    ``zone``, or else in the session's (``timestamp`` → ``timestamp_ntz``;
    PySpark would otherwise convert a ``timestamp`` through the driver's local
    zone).  The shift to ``zone`` goes by the instant, whatever the session's
    zone is."""
    dtype = column_type(df, name)
    col = df[name]
    if isinstance(dtype, T.TimestampType):
        if zone is not None:
            return F.timestamp_add("MICROSECOND", F.unix_micros(F.from_utc_timestamp(col, zone)), F.lit("1970-01-01").cast("timestamp_ntz"))
        return col.cast(T.TimestampNTZType())
    if isinstance(dtype, T.DateType):
        return col.cast(T.TimestampNTZType())
    if isinstance(dtype, T.TimestampNTZType):
        return col
    raise TypeError(f"watermark column {name!r} has type {dtype.simpleString()}")


def watermark(target: DataFrame, created: str = "created_at", updated: str = "updated_at",
              zone: str | None = None) -> DataFrame:
    """A3: one row ``(max_created_at, max_updated_at)`` over the target."""
    return target.agg(
        F.max(_as_wallclock(target, created, zone)).alias("max_created_at"),
        F.max(_as_wallclock(target, updated, zone)).alias("max_updated_at"),
    )


def read_marks(target: DataFrame, created: str = "created_at", updated: str = "updated_at",
               zone: str | None = None) -> Marks:
    """Collect the single watermark row as ``Marks`` (naive datetimes)."""
    row = watermark(target, created, updated, zone).first()
    def _value(v: dt.datetime | None) -> dt.datetime | None:
        return v if v is None or isinstance(v, dt.datetime) else dt.datetime.combine(v, dt.time(0))
    return Marks(_value(row["max_created_at"]), _value(row["max_updated_at"]))


def delta(
    parent: DataFrame,
    marks: Marks,
    ctx: RunContext,
    created: str = "created_at",
    updated: str = "updated_at",
    update_floor: dt.datetime | None = None,
    distinct: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """F7/F8 delta of ``parent``; ``columns`` projects (P2) after the filter
    and ``distinct`` de-duplicates whole rows (A1)."""
    out = parent.where(watermark_delta(parent, marks, ctx, created, updated, update_floor))
    if columns is not None:
        out = select_columns(out, columns)
    return distinct_rows(out) if distinct else out


def delta_keys(parent_delta: DataFrame, key: str = "id") -> DataFrame:
    """``select distinct id`` of a delta: the keys children are matched on."""
    return distinct_keys(parent_delta, key)


def cascade(
    child: DataFrame,
    keys: DataFrame | KeySet,
    child_key: str,
    key: str = "id",
    key_count: int | None = None,
    own_delta: Column | None = None,
    distinct: bool = True,
    max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS,
    salt_buckets: int | None = None,
    text_ranges: bool = True,
) -> DataFrame:
    """Child rows of changed parents.

    ``own_delta`` (J3) is the child's own change predicate; it is applied
    before the join so it filters at the scan.  A ``KeySet`` brings its
    count and key intervals, which also prune the child's scan
    (``text_ranges=False``: not by the order of text keys).
    """
    key_range = key_bytes = None
    intervals = ()
    if isinstance(keys, KeySet):
        intervals = keys.intervals
        keys, key_count, key_range, key_bytes = keys.frame, keys.count, (keys.low, keys.high), keys.bytes
    filtered = child.where(own_delta) if own_delta is not None else child
    out = semi_join(filtered, keys, child_key, key, key_count, max_broadcast_keys, salt_buckets, key_range, key_bytes,
                    intervals, text_ranges)
    return distinct_rows(out) if distinct else out
