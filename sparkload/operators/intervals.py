"""Disjoint key intervals of a key set, to prune a child's scan.

One old key in a delta stretches ``[min, max]`` over the whole child.  Its keys
are instead covered by a few disjoint intervals, cut at the widest gaps between
neighbouring keys, so the scan reads the old key's row groups (or index range)
and the recent ones and nothing between.

The gaps are found by zooming, without sorting: each round cuts every interval
into blocks, takes ``min`` and ``max`` of the keys of each block (partial
aggregates; the driver gets a row per block that holds keys) and keeps the
widest gaps between neighbouring blocks.  Blocks keep the keys' order, so the
intervals hold every key whatever the rounds have found.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Intervals at most: terms of the filter on the child.
MAX_INTERVALS = 16
#: Blocks of an interval in each round.
BLOCKS = 256
ROUNDS = 4
#: A gap is cut out if it is at least this share of what is still covered.
LEAST_SHARE = 0.02

Interval = tuple[Any, Any]


def divisible(dtype: T.DataType) -> bool:
    """Types whose values can be cut into blocks and turned into literals."""
    return isinstance(dtype, (T.IntegralType, T.DecimalType, T.DateType)) or _binary_text(dtype)


def _binary_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StringType) and dtype.collation in (None, "UTF8_BINARY")


def _number(value: Any) -> float:
    return float(value.toordinal()) if isinstance(value, dt.date) else float(value)


def _shared_prefix(low: bytes, high: bytes) -> int:
    n = min(len(low), len(high))
    return next((i for i in range(n) if low[i] != high[i]), n)


def _block(key: Column, dtype: T.DataType, interval: Interval) -> Column:
    """Block of a key inside an interval, from 0 to ``BLOCKS`` - 1, rising with
    the key."""
    low, high = interval
    if isinstance(dtype, T.StringType):  # by the first byte in which the interval's ends differ
        at = _shared_prefix(low.encode(), high.encode())
        byte = F.substring(F.encode(key, "UTF-8"), at + 1, 1)
        return F.coalesce(F.conv(F.hex(byte), 16, 10).cast("int"), F.lit(0))
    place = (F.unix_date(key) + F.lit(dt.date(1970, 1, 1).toordinal()) if isinstance(dtype, T.DateType) else key).cast("double")
    width = (_number(high) - _number(low)) or 1.0
    return F.least(F.floor((place - F.lit(_number(low))) / F.lit(width) * BLOCKS).cast("int"), F.lit(BLOCKS - 1))


def _gap(a: Any, b: Any, low: Any, high: Any) -> float:
    """How much lies between ``a`` and ``b``, of keys between ``low`` and
    ``high``: values of whole numbers, dates and decimals, or a measure of
    texts."""
    if not isinstance(a, str):
        unit = 10.0**min(0, a.as_tuple().exponent) if isinstance(a, Decimal) else 1.0
        return max(0.0, _number(b) - _number(a) - unit)
    at = _shared_prefix(low.encode(), high.encode())
    number = lambda s: int.from_bytes(s.encode()[at:at + 8].ljust(8, b"\0"), "big")
    return float(number(b) - number(a))


def cut(blocks: Sequence[Interval], most: int) -> list[Interval]:
    """Neighbouring intervals joined, but for at most ``most`` - 1 gaps: the
    widest ones, as long as each takes ``LEAST_SHARE`` off what is covered."""
    low, high = blocks[0][0], blocks[-1][1]
    gaps = sorted(((_gap(a[1], b[0], low, high), i) for i, (a, b) in enumerate(zip(blocks, blocks[1:]))), reverse=True)
    covered, cuts = _gap(low, high, low, high), set()
    for gap, i in gaps[:most - 1]:
        if gap <= 0 or gap < LEAST_SHARE * covered:
            break
        cuts.add(i)
        covered -= gap
    out: list[Interval] = []
    start = 0
    for i in range(len(blocks)):
        if i in cuts or i == len(blocks) - 1:
            out.append((blocks[start][0], blocks[i][1]))
            start = i + 1
    return out


def key_intervals(keys: DataFrame, key: str, low: Any, high: Any, most: int = MAX_INTERVALS) -> tuple[Interval, ...]:
    """At most ``most`` disjoint, rising intervals that hold every key that is
    not null; ``low`` and ``high`` are the keys' range."""
    dtype = keys.schema[key].dataType
    if low is None or not divisible(dtype):
        return ()
    found: list[Interval] = [(low, high)]
    for _ in range(ROUNDS):
        block = F.lit(None).cast("int")
        for i, interval in reversed(list(enumerate(found))):
            block = F.when(keys[key] <= F.lit(interval[1]), F.lit(i * BLOCKS) + _block(keys[key], dtype, interval)).otherwise(block)
        rows = keys.where(keys[key].isNotNull()).groupBy(block.alias("block")).agg(F.min(keys[key]).alias("a"), F.max(keys[key]).alias("b"))
        blocks = [(r["a"], r["b"]) for r in sorted(rows.collect(), key=lambda r: r["block"])]  # most * BLOCKS rows at most
        new = cut(blocks, most)
        if new == found:
            break
        found = new
    return tuple(found)


def within(key: Column, intervals: Sequence[Interval]) -> Column:
    """A key in one of the intervals."""
    return reduce(Column.__or__, [key == F.lit(a) if a == b else (key >= F.lit(a)) & (key <= F.lit(b)) for a, b in intervals])
