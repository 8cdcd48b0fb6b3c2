"""Measurement aid: the reference's per-table data path in one process.

Not part of the engine.  The reference publishes no timings, so this times
what its code does for each table of a full load, written independently
with pandas: the whole table in one frame, two regex replacements over every
cell, the whole CSV rendered into an in-memory buffer.  Parquet reads stand
in for its database reads (which would add network time), and nothing is
uploaded.  The engine's number for the same tables is one snapshot extract
per table (scan, clean-up, CSV write) run by ``Loader``.

    python docs/single_process_baseline.py [sf_dir]

Prints one JSON line: seconds per table for both, and the totals.
"""

from __future__ import annotations

import datetime as dt
import io
import json
import os
import sys
import tempfile
import time

import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("customer", "orders", "lineitem", "events", "documents")


def single_process(sf_dir: str, table: str) -> float:
    t0 = time.perf_counter()
    df = pd.read_parquet(f"{sf_dir}/{table}.parquet")
    df = df.replace(r"\\", "/", regex=True)
    df = df.replace(r"\n", " ", regex=True)
    with io.StringIO() as buf:
        df.to_csv(buf, index=False, escapechar="\\")
        buf.getvalue()
    return time.perf_counter() - t0


def engine(spark, sf_dir: str, table: str, out: str) -> float:
    from sparkload import RunContext
    from sparkload.plans.jobs import Loader
    from sparkload.plans.manifest import Extract, TableSpec
    from sparkload.sinks import Layout
    from sparkload.sources import SourceConfig, SourceRegistry
    reg = SourceRegistry([SourceConfig("lake", "parquet", root=sf_dir)])
    spec = TableSpec("full", "lake", "lake", table, Extract.SNAPSHOT, Layout.SNAPSHOT)
    t0 = time.perf_counter()
    res = Loader(spark, RunContext(dt.datetime(2024, 1, 1), "UTC", out), reg, set_session_zone=False).run([spec])[0]
    assert res.status == "ok", res
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = (sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1").rstrip("/")
    from pyspark.sql import SparkSession

    from sparkload.context import SCALE_CONF
    builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    out = tempfile.mkdtemp(prefix="single-process-baseline-")
    engine(spark, sf_dir, "region", out)  # warm-up
    pandas_s, engine_s = {}, {}
    for t in TABLES:
        pandas_s[t] = round(min(single_process(sf_dir, t) for _ in range(3)), 3)
        engine_s[t] = round(min(engine(spark, sf_dir, t, tempfile.mkdtemp(dir=out)) for _ in range(3)), 3)
    print(json.dumps({"sf_dir": sf_dir, "single_process": pandas_s, "engine": engine_s,
                      "single_process_total": round(sum(pandas_s.values()), 3),
                      "engine_total": round(sum(engine_s.values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
