"""Cutting lineage through the shared checkpoint folder.

A frame that several outputs must see identically (a parent delta and its
children) is written once as parquet under ``spark.checkpoint.dir`` and read
back.  Lost executors then cost only the files they had not committed; the
source is not re-read, so every reader sees the same rows.  A
machine-local folder or ``localCheckpoint`` would not survive executor
loss and is never used.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..context import scratch_path
from .intervals import Interval, key_intervals


def _write_once(spark: SparkSession, df: DataFrame, name: str, *metrics) -> tuple[DataFrame, dict]:
    """Write ``df`` to a fresh folder in the checkpoint dir, observing its
    row count and ``metrics`` on that write; return the re-read frame (with
    the known schema: no footer inference) and the metrics."""
    path = scratch_path(spark, "materialized", name)
    obs = Observation(f"materialize_{name}_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics).write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path), obs.get


def materialize(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write ``df`` once to the checkpoint folder and return the re-read
    frame with its row count (counted while writing)."""
    frame, m = _write_once(spark, df, name)
    return frame, int(m.get("rows", 0))


@dataclass(frozen=True)
class KeySet:
    """A materialized distinct key set with its size (rows, and bytes as text) and range, all observed
    on the write that stored it.  ``low``/``high`` are ``None`` when empty.  ``intervals``
    cover the keys more tightly than the range where they leave wide gaps (see
    operators/intervals.py); empty for types that have none."""

    frame: DataFrame
    count: int
    low: Any
    high: Any
    bytes: int = 0
    intervals: tuple[Interval, ...] = ()


def materialize_keys(spark: SparkSession, keys: DataFrame, key: str, name: str) -> KeySet:
    """Write a key set once to the checkpoint folder; the row count (which
    picks the join strategy) and the key range come from the same write, the
    intervals (which prune the child's scan) from short aggregations of the
    stored keys.  Whole numbers that fill half of their range have no gaps
    worth a look."""
    frame, m = _write_once(spark, keys, name, F.min(keys[key]).alias("low"), F.max(keys[key]).alias("high"),
                           F.sum(F.octet_length(keys[key].cast("string"))).alias("bytes"))
    count, low, high = int(m.get("rows", 0)), m.get("low"), m.get("high")
    dense = isinstance(low, int) and high - low < 2 * count
    intervals = ((low, high),) if dense else key_intervals(frame, key, low, high)
    return KeySet(frame, count, low, high, int(m.get("bytes") or 0), intervals)
