"""Faults of sources and runs: isolation, caps, zones, wide keys."""

from __future__ import annotations

import datetime as dt
import threading
import time

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from sparkload import RunContext
from sparkload import functions as fn
from sparkload import operators as op
from sparkload.functions.windows import Marks
from sparkload.operators import semijoin
from sparkload.operators.incremental import read_marks
from sparkload.plans import Loader
from sparkload.plans.manifest import Extract, Layout, TableSpec
from sparkload.plans.explain import plan_text
from sparkload.plans.report import LoadResult, lost
from sparkload.sources import SourceConfig, SourceRegistry

AS_OF = dt.datetime(2024, 1, 2, 6, 0, 0)


def snapshot(source, table, **more):
    return TableSpec("full", source, source, table, Extract.SNAPSHOT, Layout.SNAPSHOT, **more)


def test_a_source_that_is_down_loses_only_its_own_tables(spark, outdir, monkeypatch):
    reg = SourceRegistry([SourceConfig("up", "parquet", root=SF_SMALL), SourceConfig("down", "parquet", root=SF_SMALL)])
    ask = reg.catalog

    def catalog(s, source, *args, **kwargs):
        if source == "down":
            raise RuntimeError("Communications link failure")
        return ask(s, source, *args, **kwargs)

    monkeypatch.setattr(reg, "catalog", catalog)
    got = Loader(spark, RunContext(AS_OF, "UTC", outdir), reg).run([snapshot("down", "nation"), snapshot("up", "region")])
    assert [r.status for r in got] == ["error", "ok"] and "Communications link failure" in got[0].error


def test_a_name_of_another_source_is_missing(spark, outdir):
    spark.range(3).write.parquet(f"{outdir}/in/other.parquet")
    reg = SourceRegistry([SourceConfig("s1", "parquet", root=SF_SMALL), SourceConfig("s2", "parquet", root=f"{outdir}/in")])
    got = Loader(spark, RunContext(AS_OF, "UTC", outdir), reg).run([snapshot("s1", "region"), snapshot("s2", "region")])
    assert [r.status for r in got] == ["ok", "missing"]


def test_a_field_of_no_record_is_an_error_and_keeps_the_file(spark, outdir):
    spark.createDataFrame([("1", "a")], "Id string, Name string").write.json(f"{outdir}/crm/Account.json")
    reg = SourceRegistry([SourceConfig("crm", "json", root=f"{outdir}/crm", path_template="{root}/{table}.json")])
    spec = TableSpec("records", "crm", "crm", "Account", Extract.RECORDS, Layout.SNAPSHOT, columns=("ID", "NAME"))
    load = lambda s: Loader(spark, RunContext(AS_OF, "UTC", outdir), reg).run([s])[0]
    good = load(spec)
    assert (good.status, good.rows) == ("ok", 1)
    bad = load(spec.but(columns=("ID", "Nmae")))
    assert bad.status == "error" and "Nmae" in bad.error
    assert spark.read.option("header", True).csv(good.path).columns == ["ID", "NAME"]


def test_lost_children_count_as_lost():
    result = lambda status, error=None: LoadResult("j", "s", "t", "l", None, None, status, error)
    assert lost(result("error")) and lost(result("skipped", "parent p failed"))
    assert not lost(result("missing")) and not lost(result("skipped", "parent p missing")) and not lost(result("ok"))


def test_a_family_keeps_to_the_source_cap(spark, outdir, monkeypatch):
    lake = SourceRegistry([SourceConfig("tpch", "parquet", root=SF_SMALL, max_parallel_reads=1)])
    spark.createDataFrame([], "o_orderdate timestamp_ntz, u timestamp_ntz").write.parquet(f"{outdir}/in/target.parquet")
    lake.add(SourceConfig("warehouse", "parquet", root=f"{outdir}/in"))
    parent = TableSpec("incremental", "tpch", "tpch", "orders", Extract.INCREMENT, Layout.DAILY_INCR, key="o_orderkey",
                       created="o_orderdate", updated="o_orderdate", target_source="warehouse", target_table="target",
                       columns=("o_custkey", "o_orderdate"))
    child = TableSpec("incremental", "tpch", "tpch", "lineitem", Extract.CASCADE, Layout.DAILY_INCR, parent="orders", child_key="l_orderkey")
    kids = [child.but(output_name=f"lineitem{k}") for k in range(3)]
    loader, now, peak, guard = Loader(spark, RunContext(AS_OF, "UTC", outdir), lake, max_parallel=4), [0], [0], threading.Lock()
    write = loader.write
    monkeypatch.setattr(lake, "marks", lambda *a, **k: Marks(None, None))

    def counted(spec, df, *args):
        with guard:
            now[0] += spec.extract is Extract.CASCADE
            peak[0] = max(peak[0], now[0])
        time.sleep(0.2)
        try:
            return write(spec, df, *args)
        finally:
            with guard:
                now[0] -= spec.extract is Extract.CASCADE

    monkeypatch.setattr(loader, "write", counted)
    got = loader.run([parent, *kids])
    assert [r.status for r in got] == ["ok"] * 4, [r.error for r in got]
    assert peak[0] == 1
    assert spark.read.option("header", True).csv(got[0].path).columns == ["o_custkey", "o_orderdate"]


@pytest.mark.parametrize("session", ["UTC", "America/New_York"])
def test_marks_are_wall_clock_of_the_run_zone(spark, session):
    before = spark.conf.get("spark.sql.session.timeZone")
    target = spark.sql("SELECT timestamp'2024-11-03T06:30:00Z' AS created_at, timestamp'2024-07-01T04:00:00.000001Z' AS updated_at")
    try:
        spark.conf.set("spark.sql.session.timeZone", session)
        marks = read_marks(target, zone="America/New_York")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert marks == Marks(dt.datetime(2024, 11, 3, 1, 30), dt.datetime(2024, 7, 1, 0, 0, 0, 1))


def test_wide_keys_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(semijoin, "MAX_BROADCAST_BYTES", 10_000)
    child = spark.range(100).select(F.col("id").cast("string").alias("k"))
    wide = spark.range(100).select(F.rpad(F.col("id").cast("string"), 300, "x").alias("key"))
    keys = op.materialize_keys(spark, wide, "key", "wide")
    assert keys.bytes == 30_000
    assert "ResolvedHint" not in plan_text(op.cascade(child, keys, "k", "key", distinct=False), "extended")
    few = op.materialize_keys(spark, spark.range(3).select(F.col("id").cast("string").alias("key")), "key", "few")
    assert "strategy=broadcast" in plan_text(op.cascade(child, few, "k", "key", distinct=False), "extended")


def test_names_with_dots_are_cleaned(spark):
    got = fn.sanitize(spark.createDataFrame([("a\\b", 1)], "`x.y` string, n int"))
    assert got.columns == ["x.y", "n"] and got.first()[0] == "a/b"
