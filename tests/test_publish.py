"""One-step replacement, family publishing, file sizes, ledger."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from sparkload import RunContext
from sparkload.plans import Loader
from sparkload.plans.ledger import Ledger
from sparkload.plans.manifest import Extract, Layout, TableSpec, Window
from sparkload.queries import job_incremental_specs, register_standins
from sparkload.sinks import current_path, publish_all, settle, staged_path
from sparkload.sinks import publish as publish_one
from sparkload.sinks.publish import Store
from sparkload.sources import SourceConfig, SourceRegistry

AS_OF = dt.datetime(2000, 6, 15, 6)


class Killed(BaseException):
    """The driver goes away."""


def put(spark, path, rows):
    spark.range(rows).coalesce(1).write.csv(path)
    return path


def count(spark, path):
    return spark.read.schema("id long").csv(current_path(spark, path)).count()


@pytest.mark.parametrize("calls", range(12))
def test_a_kill_at_any_step_leaves_a_complete_day(spark, outdir, monkeypatch, calls):
    """The swap is cut off before its n-th file operation."""
    path = put(spark, f"{outdir}/T/T20240101.csv", 3)
    staged = put(spark, staged_path(path), 5)
    left = [calls]

    def cut(name, do):
        def step(self, *args):
            if left[0] == 0:
                raise Killed
            left[0] -= 1
            return do(self, *args)
        monkeypatch.setattr(Store, name, step)

    for name in ("rename", "delete"):
        cut(name, getattr(Store, name))
    try:
        publish_one(spark, staged, path)
        done = True
    except Killed:
        done = False
    monkeypatch.undo()
    assert count(spark, path) in ((5,) if done else (3, 5))
    before = count(spark, path)
    settle(spark, path)  # the next run
    assert count(spark, path) == before == spark.read.schema("id long").csv(path).count()
    assert done == (calls >= 5) and not [n for n in os.listdir(f"{outdir}/T") if n.endswith(".next")]
    publish_one(spark, put(spark, staged_path(path), 7), path)
    assert spark.read.csv(path).count() == 7


@pytest.mark.parametrize("calls", range(14))
def test_several_outputs_change_together(spark, outdir, monkeypatch, calls):
    paths = [put(spark, f"{outdir}/{t}/{t}.csv", 1) for t in "ab"]
    outputs = [(put(spark, staged_path(p), 2), p) for p in paths]
    left = [calls]
    for name in ("rename", "delete"):
        def step(self, *args, do=getattr(Store, name)):
            if left[0] == 0:
                raise Killed
            left[0] -= 1
            return do(self, *args)
        monkeypatch.setattr(Store, name, step)
    try:
        publish_all(spark, outputs)
    except Killed:
        pass
    monkeypatch.undo()
    seen = [count(spark, p) for p in paths]
    assert seen in ([1, 1], [2, 2])
    settle(spark, paths[1])
    assert [count(spark, p) for p in paths] == seen == [spark.read.csv(p).count() for p in paths]


def lake(**more):
    return SourceRegistry([SourceConfig("tpch", "parquet", root=SF_SMALL, **more)])


def views():
    return SourceRegistry([SourceConfig("lake", "table", prefix="src_"), SourceConfig("warehouse", "table", prefix="wh_")])


def snapshot(table, **more):
    return TableSpec("full", "tpch", "tpch", table, Extract.SNAPSHOT, Layout.SNAPSHOT, **more)


def test_a_rerun_that_dies_in_the_swap_is_finished_by_the_next(spark, outdir, monkeypatch):
    load = lambda spec: Loader(spark, RunContext(AS_OF, output_root=outdir), lake()).run([spec])[0]
    first = load(snapshot("nation"))
    rename, n = Store.rename, [0]

    def dying(self, old, new):
        n[0] += "_nation" in new and new.endswith(".old")
        rename(self, old, new)
        if n[0]:
            raise Killed  # the old day is away, the new one not in place

    monkeypatch.setattr(Store, "rename", dying)
    with pytest.raises(Killed):
        loader = Loader(spark, RunContext(AS_OF, output_root=outdir), lake())
        loader.write(snapshot("nation"), loader.frame(snapshot("nation")).limit(20))
    monkeypatch.undo()
    failing = snapshot("region", derived=(("lost", "raise_error('source connection lost')"),))
    assert load(failing).status == "error" and os.listdir(f"{outdir}/mysql_backups/tpch/region") == []
    read = lambda p: spark.read.option("header", True).csv(p).count()
    assert not os.path.exists(first.path) and read(current_path(spark, first.path)) == 20
    assert load(snapshot("nation")).status == "ok" and read(first.path) == 25
    assert sorted(os.listdir(os.path.dirname(first.path))) == ["nation20000615.csv"]


def test_a_selective_window_writes_few_even_files(spark, outdir):
    rows = spark.range(0, 400_000, numPartitions=200).select(
        F.expr("timestampadd(SECOND, id * 10, timestamp_ntz'2000-05-01')").alias("created_at"), F.expr("CASE WHEN id % 3 = 0 THEN 1 ELSE id END").alias("k"),
        F.expr("repeat(md5(string(id)), 2)").alias("body"))
    rows.createOrReplaceTempView("win_big")
    reg = SourceRegistry([SourceConfig("w", "table", prefix="win_")])
    spec = TableSpec("insert_update", "w", "w", "big", Extract.WINDOW, Layout.INSERT, window=Window("month_to_date", column="created_at"))
    sizes = lambda p: [os.path.getsize(f"{p}/{f}") for f in os.listdir(p) if f.startswith("part-")]
    plain = Loader(spark, RunContext(AS_OF, output_root=f"{outdir}/plain"), reg, rebalance=False).run([spec])[0]
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        even = Loader(spark, RunContext(AS_OF, output_root=f"{outdir}/even"), reg).run([spec])[0]
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert plain.rows == even.rows > 100_000
    a, b = sizes(plain.path), sizes(even.path)
    assert len(a) > 50 and len(b) <= 12 and max(b) < 3 * sorted(b)[len(b) // 2]
    schema = rows.schema
    from sparkload.sinks import read_csv
    total = lambda p: read_csv(spark, p, schema).agg(F.count("*"), F.sum(F.crc32("body"))).first()
    assert total(plain.path) == total(even.path)


def test_whole_families(spark, outdir):
    register_standins(spark, SF_SMALL)
    specs = job_incremental_specs()[:3]
    broken = [specs[0], specs[1], specs[2].but(created="no_such_column")]
    got = Loader(spark, RunContext(AS_OF, output_root=outdir), views(), whole_families=True).run(broken)
    assert [r.status for r in got] == ["skipped", "skipped", "error"] and "lineitem_own" in got[0].error
    assert not [f for _, _, fs in os.walk(outdir) for f in fs if f.startswith("part-")]
    again = Loader(spark, RunContext(AS_OF, output_root=outdir), views(), whole_families=True).run(specs)
    apart = Loader(spark, RunContext(AS_OF, output_root=f"{outdir}/apart"), views()).run(specs)
    assert [(r.table_name, r.status, r.rows) for r in again] == [(r.table_name, r.status, r.rows) for r in apart]
    assert all(os.path.isdir(r.path) for r in again)


def test_a_run_that_dies_is_resumed(spark, outdir, monkeypatch):
    register_standins(spark, SF_SMALL)
    ctx, ledger = RunContext(AS_OF, output_root=f"{outdir}/out"), f"{outdir}/ledger"
    specs = [snapshot("region"), snapshot("nation"), snapshot("supplier")]
    loader = Loader(spark, ctx, lake(), max_parallel=1, ledger=ledger)
    write, seen = Loader.write, []

    def dying(self, spec, df, *args):
        seen.append(spec.name)
        if spec.name == "nation" and not self.resume:
            raise Killed
        return write(self, spec, df, *args)

    monkeypatch.setattr(Loader, "write", dying)
    with pytest.raises(Killed):
        loader.run(specs)
    kept = Ledger(spark, ledger, ctx.run_stamp).done()
    assert ("full", "tpch", "region", "snapshot") in kept and ("full", "tpch", "nation", "snapshot") not in kept
    seen.clear()
    got = Loader(spark, ctx, lake(), ledger=ledger, resume=True).run(specs)
    assert [(r.table_name, r.status, r.rows) for r in got] == [("region", "ok", 5), ("nation", "ok", 25), ("supplier", "ok", 10)]
    assert "region" not in seen and "nation" in seen
    assert len(Ledger(spark, ledger, ctx.run_stamp).done()) == 3
    later = RunContext(AS_OF + dt.timedelta(days=1), output_root=f"{outdir}/out")
    assert Loader(spark, later, lake(), ledger=ledger, resume=True).run(specs[:1])[0].path.endswith("region20000616.csv")


def test_a_family_is_resumed_as_a_whole(spark, outdir, monkeypatch):
    register_standins(spark, SF_SMALL)
    ctx, ledger = RunContext(AS_OF, output_root=f"{outdir}/out"), f"{outdir}/ledger"
    specs = job_incremental_specs()[:2]
    broken = [specs[0], specs[1].but(child_key="gone")]
    first = Loader(spark, ctx, views(), ledger=ledger).run(broken)
    assert [r.status for r in first] == ["ok", "error"]
    got = Loader(spark, ctx, views(), ledger=ledger, resume=True).run(specs)
    assert [r.status for r in got] == ["ok", "ok"] and got[0].rows == first[0].rows
    assert Loader(spark, ctx, views(), ledger=ledger, resume=True).run(specs) == got
