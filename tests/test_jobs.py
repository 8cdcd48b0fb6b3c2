"""Load jobs: manifest shape, isolation, missing tables, cascades, report."""

from __future__ import annotations

import datetime as dt
import os

from conftest import SF_SMALL

from sparkload.context import RunContext
from sparkload.plans import manifest as mf
from sparkload.plans.jobs import Loader, pool_name
from sparkload.plans.manifest import Extract, TableSpec
from sparkload.queries import (
    AS_OF,
    job_full_specs,
    job_incremental_specs,
    register_standins,
)
from sparkload.sinks import Layout, read_csv
from sparkload.sources import SourceConfig, SourceRegistry

D = dt.datetime


def test_reference_manifest_shape():
    full = mf.full_load_manifest()
    assert len(full) == 135
    assert len(mf.names(mf.SMC_SNAPSHOT_TABLES)) == 108
    assert sum(not s.sanitize for s in full) == 22  # written before the clean-up in the reference
    iu = mf.insert_update_manifest()
    assert len(iu) == 11 and sum(not s.sanitize for s in iu) == 2
    inc = mf.incremental_manifest()
    assert sum(s.extract is Extract.INCREMENT for s in inc) == 5
    assert sum(s.extract is Extract.CASCADE for s in inc) == 7
    ticket = [s for s in inc if s.table == "ticket"][0]
    assert ticket.columns and len(ticket.columns) == 60 and not ticket.distinct and ticket.update_floor
    recs = mf.records_manifest()
    assert [len(s.columns) for s in recs] == [61, 42, 33, 7, 24, 16]
    assert {s.name for s in recs} >= {"RelatedPartner"} and recs[0].window is not None
    folders = {s.out_folder() for s in full}
    assert {"billing_service", "vcenter_new", "power_etl"} <= folders


def _lake():
    return SourceRegistry([SourceConfig("tpch", "parquet", root=SF_SMALL)])


def test_full_job_writes_and_reports(spark, outdir):
    ctx = RunContext(as_of=AS_OF, output_root=outdir)
    results = Loader(spark, ctx, _lake(), max_parallel=3).run(job_full_specs())
    by = {(r.table_name, r.status) for r in results}
    assert ("missing_table", "missing") in by
    ok = [r for r in results if r.status == "ok"]
    assert len(ok) == 8
    cust = [r for r in ok if r.table_name == "customer"][0]
    assert cust.path.endswith("mysql_backups/tpch/customer/customer20000615.csv")
    schema = spark.read.parquet(f"{SF_SMALL}/customer.parquet").schema
    assert read_csv(spark, cust.path, schema).count() == cust.rows == 150


def test_each_extract_runs_in_its_own_fair_pool(spark, outdir):
    from concurrent.futures import ThreadPoolExecutor
    assert spark.sparkContext.getConf().get("spark.scheduler.mode") == "FAIR"
    loader = Loader(spark, RunContext(as_of=AS_OF, output_root=outdir), _lake())
    specs = [TableSpec("full", "tpch", "tpch", t, Extract.SNAPSHOT, Layout.SNAPSHOT) for t in ("nation", "region")]

    def pool_of(spec):
        loader._describe(spec)
        return spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(pool_of, specs)) == [pool_name(s) for s in specs]
    assert len({pool_name(s) for s in specs}) == 2


def test_failure_is_isolated(spark, outdir):
    ctx = RunContext(as_of=AS_OF, output_root=outdir)
    specs = [
        TableSpec("full", "tpch", "tpch", "region", Extract.SNAPSHOT, Layout.SNAPSHOT, columns=("no_such_column",)),
        TableSpec("full", "tpch", "tpch", "nation", Extract.SNAPSHOT, Layout.SNAPSHOT),
    ]
    results = Loader(spark, ctx, _lake()).run(specs)
    assert [r.status for r in results] == ["error", "ok"]
    assert "no_such_column" in results[0].error and results[1].rows == 25


def test_incremental_family(spark, outdir):
    register_standins(spark, SF_SMALL)
    sources = SourceRegistry([SourceConfig("lake", "table", prefix="src_"),
                              SourceConfig("warehouse", "table", prefix="wh_")])
    ctx = RunContext(as_of=AS_OF, output_root=outdir)
    results = Loader(spark, ctx, sources).run(job_incremental_specs())
    assert [r.status for r in results] == ["ok"] * 5
    parent = results[0]
    assert "/daily_incr/orders/orders20000615060000.csv" in parent.path
    # every child row's parent is in the parent file
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    parent_rows = read_csv(spark, parent.path, spark.table("src_orders").schema).select("o_orderkey").distinct()
    child = read_csv(spark, results[1].path, li.schema)
    assert child.count() == results[1].rows
    assert child.join(parent_rows, child.l_orderkey == parent_rows.o_orderkey, "left_anti").count() == 0


def test_incremental_parent_failure_skips_children(spark, outdir):
    register_standins(spark, SF_SMALL)
    sources = SourceRegistry([SourceConfig("lake", "table", prefix="src_"),
                              SourceConfig("warehouse", "table", prefix="wh_")])
    specs = job_incremental_specs()[:2]
    specs[0] = specs[0].but(created="no_such_column")
    results = Loader(spark, RunContext(as_of=AS_OF, output_root=outdir), sources).run(specs)
    assert [r.status for r in results] == ["error", "skipped"]


def test_parquet_output(spark, outdir):
    ctx = RunContext(as_of=AS_OF, output_root=outdir)
    spec = TableSpec("full", "tpch", "tpch", "nation", Extract.SNAPSHOT, Layout.SNAPSHOT)
    res = Loader(spark, ctx, _lake(), output_format="parquet").run([spec])[0]
    assert res.path.endswith("nation20000615.parquet") and spark.read.parquet(res.path).count() == 25
    assert os.path.isdir(res.path)


def test_single_file_extract(spark, outdir):
    ctx = RunContext(as_of=AS_OF, output_root=outdir)
    spec = TableSpec("full", "tpch", "tpch", "customer", Extract.SNAPSHOT, Layout.SNAPSHOT, single_file=True)
    res = Loader(spark, ctx, _lake()).run([spec])[0]
    assert res.status == "ok" and res.rows == 150
    assert len([p for p in os.listdir(res.path) if p.startswith("part-")]) == 1
    schema = spark.read.parquet(f"{SF_SMALL}/customer.parquet").schema
    assert read_csv(spark, res.path, schema).count() == 150


def test_staged_overwrite_keeps_the_previous_file_when_the_source_fails(spark, outdir):
    ctx = RunContext(as_of=AS_OF, output_root=outdir)
    good = TableSpec("full", "tpch", "tpch", "nation", Extract.SNAPSHOT, Layout.SNAPSHOT)
    first = Loader(spark, ctx, _lake()).run([good])[0]
    schema = spark.read.parquet(f"{SF_SMALL}/nation.parquet").schema
    assert read_csv(spark, first.path, schema).count() == 25
    failing = good.but(derived=(("lost", "raise_error('source connection lost')"),))
    staged = Loader(spark, ctx, _lake()).run([failing])[0]
    assert staged.status == "error" and "source connection lost" in staged.error
    assert read_csv(spark, first.path, schema).count() == 25  # the day's earlier file is intact
    plain = Loader(spark, ctx, _lake(), stage_overwrites=False).run([failing])[0]
    assert plain.status == "error"
    assert not os.path.exists(first.path) or not any(p.startswith("part-") for p in os.listdir(first.path))


def _page(folder, name, recs):
    import json
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        json.dump({"totalSize": len(recs), "done": True, "records": recs}, f)


def test_records_job_pages_and_empty_object(spark, outdir):
    landed = os.path.join(outdir, "landed")
    env = {"type": "Opportunity", "url": "/o"}
    _page(os.path.join(landed, "Opportunity"), "p0.json", [
        {"attributes": env, "Id": "1", "Name": "a\\b", "CreatedDate": "2021-01-01T00:00:00.000+0000"},
        {"attributes": env, "Id": "2", "Name": "old", "CreatedDate": "2020-12-31T23:59:59.000+0000"}])
    _page(os.path.join(landed, "Opportunity"), "p1.json", [
        {"attributes": env, "Id": "3", "Name": "x\ny", "CreatedDate": "2024-05-01T10:00:00.000+0000"}])
    _page(os.path.join(landed, "AccountTeamMember"), "p0.json", [])
    specs = [s for s in mf.records_manifest() if s.name in ("Opportunity", "AccountTeamMember")]
    specs = [s.but(columns=("Id", "Name", "CreatedDate")) for s in specs]
    sources = SourceRegistry([SourceConfig("crm", "records", root=landed, path_template="{root}/{table}")])
    ctx = RunContext(as_of=D(2024, 6, 15, 6), output_root=os.path.join(outdir, "bucket"))
    results = {r.table_name: r for r in Loader(spark, ctx, sources, records_layout="pages").run(specs)}
    opp, team = results["Opportunity"], results["AccountTeamMember"]
    assert opp.status == "ok" and opp.rows == 2  # 1 Jan of year-3 onwards
    assert opp.path.endswith("salesforce_backups/Opportunity/Opportunity20240615.csv")
    got = {r["Id"]: r["Name"] for r in read_csv(spark, opp.path, "Id string, Name string, CreatedDate string").collect()}
    assert got == {"1": "a/b", "3": "x y"}
    assert team.status == "ok" and team.rows == 0
    parts = [p for p in os.listdir(team.path) if p.startswith("part-")]
    assert "".join(open(os.path.join(team.path, p)).read() for p in parts).strip() == "Id,Name,CreatedDate"


def test_sessions_without_a_spark_context(spark):
    """A Spark Connect session has no SparkContext: the scratch folder must
    then come from spark.checkpoint.dir, and pools are skipped."""
    import pytest

    from sparkload.context import scratch_root, spark_context

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Remote:
        def __init__(self, values):
            self.conf = Conf(values)

        @property
        def sparkContext(self):
            raise RuntimeError("not supported in Spark Connect")

    assert spark_context(Remote({})) is None and spark_context(spark) is not None
    assert scratch_root(Remote({"spark.checkpoint.dir": "s3a://shared/ckpt/"})) == "s3a://shared/ckpt"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Remote({}))
    loader = Loader.__new__(Loader)
    loader.spark = Remote({})
    loader._describe(TableSpec("full", "tpch", "tpch", "nation", Extract.SNAPSHOT, Layout.SNAPSHOT))


def test_distinct_is_skipped_under_a_unique_key(spark):
    """``select distinct *`` removes nothing when a unique key is among the
    columns, so its shuffle is left out; the rows are the same."""
    from sparkload.functions import Marks
    from sparkload.plans.explain import exchanges
    register_standins(spark, SF_SMALL)
    sources = SourceRegistry([SourceConfig("lake", "table", prefix="src_"),
                              SourceConfig("warehouse", "table", prefix="wh_")])
    loader = Loader(spark, RunContext(as_of=AS_OF), sources)
    parent = job_incremental_specs()[0]
    marks = Marks(D(2001, 5, 1), D(2001, 5, 1))
    plain = loader.frame(parent, marks=marks)
    keyed = loader.frame(parent.but(unique_key=("o_orderkey",)), marks=marks)
    assert exchanges(plain) == 1 and exchanges(keyed) == 0
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, keyed.collect()))
    # a column list with distinct means select distinct <columns>
    cols = loader.frame(parent.but(columns=("o_orderstatus",)), marks=marks)
    assert sorted(r[0] for r in cols.collect()) == sorted(set(r[0] for r in cols.collect()))
    # a key left out by the column list cannot vouch for the rows
    assert exchanges(loader.frame(parent.but(columns=("o_orderstatus",), unique_key=("o_orderkey",)),
                                  marks=marks)) == 1


def test_primary_key_of_a_jdbc_source(spark, monkeypatch):
    """Spark SQL stands in for the source's information_schema."""
    from sparkload.sources import jdbc
    spark.sql("SELECT * FROM VALUES ('PRIMARY', 'smc', 'asset', 'PRIMARY KEY'), "
              "('fk_1', 'smc', 'change_asset', 'FOREIGN KEY') AS t(constraint_name, table_schema, table_name, "
              "constraint_type)").createOrReplaceTempView("pk_constraints")
    spark.sql("SELECT * FROM VALUES ('PRIMARY', 'smc', 'asset', 'id', 1), "
              "('fk_1', 'smc', 'change_asset', 'change_id', 1) AS t(constraint_name, table_schema, table_name, "
              "column_name, ordinal_position)").createOrReplaceTempView("pk_usage")
    monkeypatch.setattr(jdbc, "query_one_row", lambda s, base, sql: s.sql(
        sql.replace("information_schema.table_constraints", "pk_constraints")
           .replace("information_schema.key_column_usage", "pk_usage")))
    reg = SourceRegistry([SourceConfig("smc", "jdbc", options={"url": "jdbc:mysql://db/smc"}),
                          SourceConfig("lake", "table")])
    assert reg.unique_key(spark, "smc", "smc", "asset") == ("id",)
    assert reg.unique_key(spark, "smc", "smc", "change_asset") is None
    assert reg.unique_key(spark, "lake", "smc", "asset") is None

    def no_catalog(s, base, sql):
        raise RuntimeError("permission denied on information_schema")
    monkeypatch.setattr(jdbc, "query_one_row", no_catalog)
    assert reg.unique_key(spark, "smc", "smc", "asset") is None  # keep the distinct, do not fail


def test_source_cap_bounds_concurrent_extracts(spark, outdir, monkeypatch):
    """``max_parallel_reads`` bounds how many extracts read one source at
    once, whatever the loader's own parallelism."""
    import threading
    import time as _time
    running, peak, lock = [0], [0], threading.Lock()
    write = Loader.write

    def tracked(self, spec, df):
        with lock:
            running[0] += 1
            peak[0] = max(peak[0], running[0])
        try:
            _time.sleep(0.3)
            return write(self, spec, df)
        finally:
            with lock:
                running[0] -= 1

    monkeypatch.setattr(Loader, "write", tracked)
    specs = [TableSpec("full", "tpch", "tpch", t, Extract.SNAPSHOT, Layout.SNAPSHOT)
             for t in ("region", "nation", "supplier", "part")]
    ctx = RunContext(as_of=AS_OF, output_root=outdir)
    capped = SourceRegistry([SourceConfig("tpch", "parquet", root=SF_SMALL, max_parallel_reads=1)])
    assert [r.status for r in Loader(spark, ctx, capped, max_parallel=4).run(specs)] == ["ok"] * 4
    assert peak[0] == 1
    peak[0] = 0
    free = SourceRegistry([SourceConfig("tpch", "parquet", root=SF_SMALL)])
    Loader(spark, RunContext(as_of=AS_OF, output_root=outdir + "/free"), free, max_parallel=4).run(specs)
    assert peak[0] > 1
