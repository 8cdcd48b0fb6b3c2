"""Row and key de-duplication (A1, A2).

``distinct`` plans as partial hash aggregate → exchange on the grouping
columns → final aggregate.  Copies of one row collapse inside each map task
before the shuffle, so a row repeated across a third of the table sends at
most one copy per map task to its reducer.

Rows that are nearly all different collapse nowhere, and the whole table
crosses the network to find a few copies.  ``distinct_by_digest`` shuffles eight
bytes a row instead: digests that occur more than once are found first, and only
the rows that have one are compared in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .materialize import materialize

#: Repeated digests that are sent to every task at most (16 MB).
MAX_REPEATED = 2_000_000


def _check_groupable(df: DataFrame) -> None:
    bad = [f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)]
    if bad:
        raise TypeError(f"distinct over map columns is not supported by Spark: {bad}")


def distinct_rows(df: DataFrame) -> DataFrame:
    """A1: ``select distinct *``."""
    _check_groupable(df)
    return df.distinct()


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """A2: ``select distinct key``."""
    return df.select(df[key]).distinct()


def _digest(df: DataFrame) -> Column | None:
    """A hash that equal rows share; ``None`` where ``distinct`` takes values
    as equal that the hash tells apart."""
    cols = []
    for f in df.schema.fields:
        c = df[f"`{f.name}`"]
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = c + F.lit(0.0).cast(f.dataType)  # -0.0 equals 0.0
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.VariantType)) or getattr(f.dataType, "collation", None) not in (None, "UTF8_BINARY"):
            return None
        cols.append(c)
    return F.xxhash64(*cols) if cols else None


def distinct_by_digest(spark: SparkSession, df: DataFrame, max_repeated: int = MAX_REPEATED) -> DataFrame:
    """A1 of a frame of which most rows differ: the rows of ``distinct``.

    ``df`` is read three times and must give the same rows each time (a stored
    table, not a source that may move on).  Rows whose digest is unique cannot
    have a copy and are passed on where they lie; the others, true copies and
    the odd collision, are shuffled and compared column by column.  The repeated
    digests are counted as they are stored and broadcast up to
    ``max_repeated``; a frame with more of them has many copies, which the
    plain ``distinct`` collapses map-side."""
    _check_groupable(df)
    digest = _digest(df)
    if digest is None:
        return df.distinct()
    counts = df.select(digest.alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    repeated, n = materialize(spark, counts.where("n > 1").select("digest"), "repeated_digests")
    if n > max_repeated:
        return df.distinct()
    repeated = F.broadcast(repeated)
    once = df.join(repeated, digest == repeated["digest"], "left_anti")
    again = df.join(repeated, digest == repeated["digest"], "left_semi").distinct()
    return once.unionAll(again)
