"""Projections P2-P5: column lists, derived columns, envelope drop."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Map requested names to the frame's own spelling, case-insensitively
    (``NAME`` finds ``Name``), keeping the request order.  Unknown names
    raise, as the source would for a bad column list."""
    by_lower = {c.lower(): c for c in df.columns}
    missing = [n for n in names if n.lower() not in by_lower]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return [by_lower[n.lower()] for n in names]


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep ``names`` in the given order.  Column pruning carries the
    list into the scan's ``ReadSchema`` (or the JDBC ``SELECT``)."""
    return df.select(*[df[c] for c in resolve_columns(df, names)])


def with_derived(df: DataFrame, derived: Mapping[str, Column | str]) -> DataFrame:
    """``select *, expr AS name`` for each derived column.  A string is
    parsed as a Spark SQL expression."""
    extra = [(F.expr(e) if isinstance(e, str) else e).alias(name) for name, e in derived.items()]
    return df.select("*", *extra) if extra else df


def drop_envelope(df: DataFrame, envelope: str = "attributes") -> DataFrame:
    """P5: drop the record envelope column if present."""
    return df.drop(envelope) if envelope in df.columns else df
