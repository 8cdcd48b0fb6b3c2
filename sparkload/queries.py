"""Registered queries and their DuckDB oracles.

Each query exercises the library's operators on the provided test tables
(whole tables, no row caps).  Roles, as in FIXTURES.md: ``orders`` stands
for a parent with ``created_at``/``updated_at`` (``updated_at`` derived from
the key), ``lineitem`` for its child, ``events`` for ``poll_data`` and,
with an epoch column, ``tblTransactions``; ``customer`` for a snapshot and
a CRM object; ``documents`` for text clean-up and CSV.

The oracle SQL computes window bounds by arithmetic on the run date rather
than repeating the builders' literals, so it checks them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import functions as fn
from . import operators as op
from .context import RunContext, scratch_path
from .sinks import csv as csv_sink
from .sources import catalog, records

# Run instants and floors of the stand-in queries (test parameters).
AS_OF = dt.datetime(2000, 6, 15, 6, 0, 0)
EVENTS_AS_OF = dt.datetime(2024, 1, 15, 6, 0, 0)
YEARS_AS_OF = dt.datetime(2001, 6, 15, 6, 0, 0)
FIXED_FLOOR = dt.datetime(1999, 9, 1)
KEYS_FLOOR = dt.datetime(2001, 1, 1)
TARGET_CUTOFF = dt.datetime(2001, 6, 1)
UPDATE_FLOOR = dt.datetime(2001, 3, 1)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def ctx_at(as_of: dt.datetime) -> RunContext:
    return RunContext(as_of=as_of, time_zone="UTC")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def updated_at_of(orderkey: Column, orderdate: Column) -> Column:
    """Stand-in ``updated_at``: null for every tenth key, else the order date
    plus ``key % 400`` days."""
    return F.when(orderkey % 10 == 0, F.lit(None)).otherwise(F.timestamp_add("DAY", orderkey % 400, orderdate))


def tracked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with ``created_at`` and ``updated_at`` (the parent ``T``)."""
    o = table(spark, sf_dir, "orders")
    return o.select("*", o["o_orderdate"].alias("created_at"),
                    updated_at_of(o["o_orderkey"], o["o_orderdate"]).alias("updated_at"))


def target_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse copy ``W``: ``T`` as loaded before ``TARGET_CUTOFF``."""
    t = tracked_orders(spark, sf_dir)
    ctx = ctx_at(TARGET_CUTOFF)
    before = ~fn.at_least(t, "created_at", TARGET_CUTOFF, ctx.time_zone)
    upd_before = t["updated_at"].isNull() | ~fn.at_least(t, "updated_at", TARGET_CUTOFF, ctx.time_zone)
    return t.where(before & upd_before)


def events_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``unixdate``: whole epoch seconds of ``ts`` (UTC)."""
    e = table(spark, sf_dir, "events")
    return e.select("*", fn.epoch_of_ntz(e["ts"]).alias("unixdate"))


# --------------------------------------------------------------------------
# queries


def q_snapshot_full(spark, sf_dir):
    return fn.sanitize(table(spark, sf_dir, "customer"))


def q_project_columns(spark, sf_dir):
    return fn.sanitize(op.select_columns(table(spark, sf_dir, "orders"), ["o_orderkey", "o_orderstatus", "o_orderdate"]))


def q_derived_column(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return fn.sanitize(op.with_derived(li, {"net_impact": li["l_extendedprice"] * (1 - li["l_discount"])}))


def q_mtd_created(spark, sf_dir):
    t = tracked_orders(spark, sf_dir)
    return fn.sanitize(t.where(fn.month_to_date(t, "created_at", ctx_at(AS_OF))))


def q_mtd_poll(spark, sf_dir):
    # poll_data is written before the clean-up runs, so it is not sanitized.
    e = table(spark, sf_dir, "events")
    return e.where(fn.month_to_date(e, "ts", ctx_at(EVENTS_AS_OF), cutoff=fn.POLL_CUTOFF))


def q_mtd_epoch(spark, sf_dir):
    # tblTransactions is written before the clean-up runs, so it is not sanitized.
    e = events_epoch(spark, sf_dir)
    return e.where(fn.month_to_date_epoch(e, "unixdate", ctx_at(EVENTS_AS_OF)))


def q_rolling_update_fixed(spark, sf_dir):
    t = tracked_orders(spark, sf_dir)
    return fn.sanitize(t.where(fn.rolling_update(t, "updated_at", "created_at", ctx_at(AS_OF), floor=FIXED_FLOOR)))


def q_rolling_update_months(spark, sf_dir):
    t = tracked_orders(spark, sf_dir)
    return fn.sanitize(t.where(fn.rolling_update(t, "updated_at", "created_at", ctx_at(AS_OF), floor_months=7)))


def q_distinct_keys(spark, sf_dir):
    t = tracked_orders(spark, sf_dir)
    return op.distinct_keys(t.where(fn.created_since(t, "created_at", KEYS_FLOOR, ctx_at(AS_OF))), "o_custkey")


def q_distinct_rows(spark, sf_dir):
    # Its rows are nearly all different.
    return fn.sanitize(op.distinct_by_digest(spark, table(spark, sf_dir, "lineitem")))


def q_last_n_years(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return fn.sanitize(o.where(fn.last_n_years(o, "o_orderdate", ctx_at(YEARS_AS_OF), years=3)))


def q_semi_static(spark, sf_dir):
    t = tracked_orders(spark, sf_dir)
    parent_keys = op.distinct_keys(t.where(fn.created_since(t, "created_at", KEYS_FLOOR, ctx_at(AS_OF))), "o_orderkey")
    keys = op.materialize_keys(spark, parent_keys, "o_orderkey", "semi_static_keys")
    li = table(spark, sf_dir, "lineitem")
    return fn.sanitize(op.cascade(li, keys, "l_orderkey", "o_orderkey", distinct=False))


def q_watermark(spark, sf_dir):
    return op.watermark(target_copy(spark, sf_dir))


def _delta(spark, sf_dir, update_floor=None, distinct=True):
    marks = op.read_marks(target_copy(spark, sf_dir))
    t = tracked_orders(spark, sf_dir)
    return op.delta(t, marks, ctx_at(AS_OF), update_floor=update_floor, distinct=distinct), marks


def q_incr_delta(spark, sf_dir):
    return fn.sanitize(_delta(spark, sf_dir)[0])


def q_incr_delta_floor(spark, sf_dir):
    return fn.sanitize(_delta(spark, sf_dir, update_floor=UPDATE_FLOOR, distinct=False)[0])


def _cascade(spark, sf_dir, update_floor=None, parent_distinct=True, own=False):
    parent, marks = _delta(spark, sf_dir, update_floor, parent_distinct)
    # Keys are computed once into the checkpoint folder; the count comes
    # from the write and decides the join strategy; the key range prunes the
    # child scan.
    keys = op.materialize_keys(spark, op.delta_keys(parent, "o_orderkey"), "o_orderkey", "delta_keys")
    li = table(spark, sf_dir, "lineitem")
    own_delta = fn.watermark_delta(li, marks, ctx_at(AS_OF), "l_shipdate", "l_shipdate") if own else None
    return fn.sanitize(op.cascade(li, keys, "l_orderkey", "o_orderkey", own_delta=own_delta,
                                  distinct=True))


def q_cascade_delta(spark, sf_dir):
    return _cascade(spark, sf_dir)


def q_cascade_delta_own(spark, sf_dir):
    return _cascade(spark, sf_dir, own=True)


def q_cascade_delta_floor(spark, sf_dir):
    return _cascade(spark, sf_dir, update_floor=UPDATE_FLOOR, parent_distinct=False)


def q_sanitize_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    with_slash = d.select("doc_id", F.concat(d["source"], F.lit("\\"), d["text"]).alias("text"), "lang", "source", "n_chars")
    return fn.sanitize(with_slash)


def lake_catalog(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """S4 on a folder source: the listed names whose dataset exists."""
    from .sources import SourceConfig, SourceRegistry
    reg = SourceRegistry([SourceConfig("tpch", "parquet", root=sf_dir.rstrip("/"))])
    return reg.catalog(spark, "tpch", names=names)


def _row_counts(spark, sf_dir, names):
    """Name and row count of each table that a catalog lookup found."""
    counts = [table(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
              for n in names]
    return reduce(DataFrame.unionByName, counts)


def q_catalog_allowlist(spark, sf_dir):
    names = ["orders", "customer", "missing"]
    return _row_counts(spark, sf_dir, catalog.existing_tables(spark, lake_catalog(spark, sf_dir, names), names))


def q_catalog_lower(spark, sf_dir):
    # The warehouse spells names upper case; they are folded to lower.
    names = ["ORDERS", "LINEITEM", "MISSING"]
    found = lake_catalog(spark, sf_dir, [n.lower() for n in names])
    warehouse = found.select(F.upper("table_schema").alias("table_schema"), F.upper("table_name").alias("table_name"))
    rows = catalog.allowlisted(spark, warehouse, names, fold_case=True).collect()  # bounded by the list
    return _row_counts(spark, sf_dir, sorted(r["table_name"] for r in rows))


# Field list of the customer-as-CRM-object stand-in, spelled as a SOQL
# query might (case-insensitive resolution, P3).
CUSTOMER_FIELDS = ["C_CUSTKEY", "c_name", "C_NationKey", "c_acctbal", "c_mktsegment"]


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` with every seventh name null: its key is not landed."""
    cust = table(spark, sf_dir, "customer")
    return cust.withColumn("c_name", F.when(cust["c_custkey"] % 7 != 0, cust["c_name"]))


def q_records_scan(spark, sf_dir):
    cust = customers(spark, sf_dir)
    landed = scratch_path(spark, "landed_records", "customer")
    records.to_records(cust, "Customer", "/records/Customer/", "c_custkey").write.json(landed)
    got = records.read_records(spark, landed, cust.schema, CUSTOMER_FIELDS)
    return fn.sanitize(got)


def q_csv_roundtrip(spark, sf_dir):
    docs = fn.sanitize(table(spark, sf_dir, "documents"))
    path = scratch_path(spark, "csv_roundtrip", "documents")
    csv_sink.write_csv(docs, path, mode="errorifexists")
    return csv_sink.read_csv(spark, path, docs.schema)


def q_distinct_keys_roundtrip(spark, sf_dir):
    """K4 with null and empty keys among the others: a one-column file."""
    o = table(spark, sf_dir, "orders")
    nth = o["o_orderkey"] % 50
    key = F.when(nth == 0, F.lit(None)).when(nth == 1, F.lit("")).otherwise(F.concat(o["o_orderpriority"], F.lit(" "), (o["o_custkey"] % 90).cast("string")))
    keys = op.distinct_keys(o.select(key.alias("key")), "key")
    path = scratch_path(spark, "csv_roundtrip", "distinct_keys")
    csv_sink.write_csv(keys, path, mode="errorifexists")
    return csv_sink.read_csv(spark, path, keys.schema)


# --------------------------------------------------------------------------
# job runs: a manifest over the test tables; the report is the result


def _report_frame(spark, results) -> DataFrame:
    """The report, with each file's path below the run's own folder."""
    from .plans.report import report_frame
    from .sinks.paths import DATABASE_ROOT, RECORDS_ROOT
    path = F.regexp_extract("path", f"({DATABASE_ROOT}|{RECORDS_ROOT})/.*$", 0)
    return report_frame(spark, results).select("table_name", "layout", path.alias("path"), "rows", "status")


def _loader(spark, ctx, sources, name):
    from .plans.jobs import Loader
    out = scratch_path(spark, "jobs", name)
    # The stand-in tables are timestamp_ntz, so the caller's session zone is
    # left as it is.
    return Loader(spark, RunContext(ctx.as_of, ctx.time_zone, out), sources, set_session_zone=False)


def _lake(sf_dir: str):
    from .sources import SourceConfig, SourceRegistry
    return SourceRegistry([SourceConfig("tpch", "parquet", root=sf_dir.rstrip("/"))])


def q_load_report(spark, sf_dir):
    from .plans.manifest import Extract, TableSpec
    from .sinks.paths import Layout
    specs = [TableSpec("full", "tpch", "tpch", t, Extract.SNAPSHOT, Layout.SNAPSHOT)
             for t in ("customer", "orders", "lineitem", "missing_table")]
    return _report_frame(spark, _loader(spark, ctx_at(AS_OF), _lake(sf_dir), "load_report").run(specs))


def job_full_specs():
    """G1 over the test tables: snapshots, J1 semi join, P4 derived column,
    a table written without clean-up and one missing from the catalog."""
    from .plans.manifest import Extract, TableSpec, Window
    from .sinks.paths import Layout
    snap = lambda t, **kw: TableSpec("full", "tpch", "tpch", t, Extract.SNAPSHOT, Layout.SNAPSHOT, **kw)
    return [
        *[snap(t) for t in ("region", "nation", "customer", "supplier", "part")],
        TableSpec("full", "tpch", "tpch", "lineitem", Extract.SEMI_STATIC, Layout.SNAPSHOT, parent="orders",
                  child_key="l_orderkey", key="o_orderkey", output_name="lineitem_recent",
                  parent_window=Window("created_since", column="o_orderdate", floor=KEYS_FLOOR)),
        snap("lineitem", derived=(("net_impact", "l_extendedprice * (1 - l_discount)"),)),
        snap("events", sanitize=False),
        snap("missing_table"),
    ]


def q_job_full(spark, sf_dir):
    return _report_frame(spark, _loader(spark, ctx_at(AS_OF), _lake(sf_dir), "full").run(job_full_specs()))


def register_standins(spark: SparkSession, sf_dir: str, prefix: str = "src_") -> None:
    """Temp views of the stand-in tables, derived by Spark from the given
    ones: ``orders`` with change columns, its warehouse copy, events with an
    epoch column and lineitem."""
    tracked_orders(spark, sf_dir).createOrReplaceTempView(f"{prefix}orders")
    events_epoch(spark, sf_dir).createOrReplaceTempView(f"{prefix}events")
    table(spark, sf_dir, "lineitem").createOrReplaceTempView(f"{prefix}lineitem")
    target_copy(spark, sf_dir).createOrReplaceTempView("wh_orders")
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("wh_lineitem")


def _views():
    from .sources import SourceConfig, SourceRegistry
    return SourceRegistry([SourceConfig("lake", "table", prefix="src_"),
                           SourceConfig("warehouse", "table", prefix="wh_")])


def job_insert_update_specs():
    """G2 over the stand-ins (run date ``AS_OF`` for orders)."""
    from .plans.manifest import Extract, TableSpec, Window
    from .sinks.paths import Layout
    iu = "insert_update"
    mtd = Window("month_to_date", column="created_at")
    return [
        TableSpec(iu, "lake", "smc", "orders", Extract.WINDOW, Layout.INSERT, window=mtd),
        TableSpec(iu, "lake", "smc", "orders", Extract.WINDOW, Layout.UPDATE,
                  window=Window("rolling_update", column="updated_at", floor=FIXED_FLOOR)),
        TableSpec(iu, "lake", "smc", "orders", Extract.DISTINCT_KEYS, Layout.DISTINCT, key="o_custkey",
                  window=Window("created_since", column="created_at", floor=KEYS_FLOOR)),
        TableSpec(iu, "lake", "smc", "orders", Extract.WINDOW, Layout.UPDATE, output_name="orders_months",
                  window=Window("rolling_update", column="updated_at", floor=None, floor_months=7)),
        TableSpec(iu, "lake", "smc", "orders", Extract.WINDOW, Layout.INSERT, output_name="orders_cols",
                  window=mtd, columns=("o_orderkey", "o_orderstatus", "created_at", "updated_at")),
    ]


def job_insert_update_event_specs():
    """G2 extracts on ``events`` (run date ``EVENTS_AS_OF``)."""
    from .plans.manifest import Extract, TableSpec, Window
    from .sinks.paths import Layout
    iu = "insert_update"
    return [
        TableSpec(iu, "lake", "vcoloburst", "events", Extract.WINDOW, Layout.SNAPSHOT, sanitize=False,
                  output_name="poll_data", window=Window("month_to_date", column="ts", cutoff=fn.POLL_CUTOFF)),
        TableSpec(iu, "lake", "sslvpn", "events", Extract.WINDOW, Layout.SNAPSHOT, sanitize=False,
                  output_name="tblTransactions", window=Window("month_to_date_epoch", column="unixdate")),
    ]


def q_job_insert_update(spark, sf_dir):
    register_standins(spark, sf_dir)
    first = _loader(spark, ctx_at(AS_OF), _views(), "insert_update").run(job_insert_update_specs())
    second = _loader(spark, ctx_at(EVENTS_AS_OF), _views(), "insert_update").run(job_insert_update_event_specs())
    return _report_frame(spark, first + second)


def job_incremental_specs():
    """G3 over the stand-ins: an F7 parent with J2 and J3 children and an F8
    parent with a J4 child; marks come from the warehouse copy."""
    from .plans.manifest import Extract, TableSpec
    from .sinks.paths import Layout
    inc = "incremental"
    parent = lambda **kw: TableSpec(inc, "lake", "smc", "orders", Extract.INCREMENT, Layout.DAILY_INCR,
                                    key="o_orderkey", target_source="warehouse", target_table="ORDERS", **kw)
    child = lambda p, **kw: TableSpec(inc, "lake", "smc", "lineitem", Extract.CASCADE, Layout.DAILY_INCR,
                                      parent=p, child_key="l_orderkey", distinct=True,
                                      target_source="warehouse", target_table="LINEITEM", **kw)
    return [
        parent(distinct=True),
        child("orders"),
        child("orders", own_delta=True, created="l_shipdate", updated="l_shipdate", output_name="lineitem_own"),
        parent(distinct=False, update_floor=UPDATE_FLOOR, output_name="orders_floor"),
        child("orders_floor", output_name="lineitem_floor"),
    ]


def q_job_incremental(spark, sf_dir):
    register_standins(spark, sf_dir)
    return _report_frame(spark, _loader(spark, ctx_at(AS_OF), _views(), "incremental").run(job_incremental_specs()))


def land_records(spark: SparkSession, sf_dir: str) -> str:
    """Land ``customer`` as ``Account`` and ``orders`` as ``Opportunity``
    records (JSON lines with an ``attributes`` envelope); returns the root."""
    root = scratch_path(spark, "landed")
    cust = customers(spark, sf_dir)
    records.to_records(cust, "Account", "/records/Account/", "c_custkey").write.json(f"{root}/Account")
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "CreatedDate")
    records.to_records(o, "Opportunity", "/records/Opportunity/", "o_orderkey").write.json(f"{root}/Opportunity")
    return root


def job_records_specs():
    from .plans.manifest import Extract, TableSpec, Window
    from .sinks.paths import Layout
    opp_fields = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "CreatedDate", "o_orderpriority")
    return [
        TableSpec("records", "crm", "crm", "Opportunity", Extract.RECORDS, Layout.RECORDS, columns=opp_fields,
                  record_schema=("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                                 "CreatedDate timestamp_ntz, o_orderpriority string"),
                  window=Window("last_n_years", column="CreatedDate", floor=None, years=3)),
        TableSpec("records", "crm", "crm", "Account", Extract.RECORDS, Layout.RECORDS,
                  columns=tuple(CUSTOMER_FIELDS),
                  record_schema="c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        TableSpec("records", "crm", "crm", "Related_Partners__c", Extract.RECORDS, Layout.RECORDS,
                  columns=("Id",), output_name="RelatedPartner"),
    ]


def q_job_records(spark, sf_dir):
    from .sources import SourceConfig, SourceRegistry
    root = land_records(spark, sf_dir)
    sources = SourceRegistry([SourceConfig("crm", "records", root=root, path_template="{root}/{table}")])
    return _report_frame(spark, _loader(spark, ctx_at(YEARS_AS_OF), sources, "records").run(job_records_specs()))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "snapshot_full": q_snapshot_full,
    "project_columns": q_project_columns,
    "derived_column": q_derived_column,
    "mtd_created": q_mtd_created,
    "mtd_poll": q_mtd_poll,
    "mtd_epoch": q_mtd_epoch,
    "rolling_update_fixed": q_rolling_update_fixed,
    "rolling_update_months": q_rolling_update_months,
    "distinct_keys": q_distinct_keys,
    "distinct_rows": q_distinct_rows,
    "last_n_years": q_last_n_years,
    "semi_static": q_semi_static,
    "watermark": q_watermark,
    "incr_delta": q_incr_delta,
    "incr_delta_floor": q_incr_delta_floor,
    "cascade_delta": q_cascade_delta,
    "cascade_delta_own": q_cascade_delta_own,
    "cascade_delta_floor": q_cascade_delta_floor,
    "sanitize_text": q_sanitize_text,
    "catalog_allowlist": q_catalog_allowlist,
    "catalog_lower": q_catalog_lower,
    "records_scan": q_records_scan,
    "csv_roundtrip": q_csv_roundtrip,
    "distinct_keys_roundtrip": q_distinct_keys_roundtrip,
    "load_report": q_load_report,
    "job_full": q_job_full,
    "job_insert_update": q_job_insert_update,
    "job_incremental": q_job_incremental,
    "job_records": q_job_records,
}


# --------------------------------------------------------------------------
# oracles (DuckDB SQL over the provided tables)


def _clean(col: str) -> str:
    return f"replace(replace({col}, '\\', '/'), chr(10), ' ') AS {col}"


_T = ("WITH t AS (SELECT *, o_orderdate AS created_at, "
      "CASE WHEN o_orderkey % 10 = 0 THEN NULL "
      "ELSE o_orderdate + to_days(CAST(o_orderkey % 400 AS INTEGER)) END AS updated_at FROM orders)")
_W = (", w AS (SELECT * FROM t WHERE created_at < TIMESTAMP '2001-06-01 00:00:00' "
      "AND (updated_at IS NULL OR updated_at < TIMESTAMP '2001-06-01 00:00:00'))"
      ", m AS (SELECT max(created_at) AS ca, max(updated_at) AS ua FROM w)")
_T_COLS = (f"o_orderkey, o_custkey, {_clean('o_orderstatus')}, o_totalprice, o_orderdate, "
           f"{_clean('o_orderpriority')}, created_at, updated_at")
_LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
            f"{_clean('l_returnflag')}, {_clean('l_linestatus')}, l_shipdate")
_CUST_COLS = f"c_custkey, {_clean('c_name')}, c_nationkey, c_acctbal, {_clean('c_mktsegment')}"
_DOC_COLS = f"doc_id, {_clean('text')}, {_clean('lang')}, {_clean('source')}, n_chars"

def _mtd(col: str, day: str, cut: str) -> str:
    h, m, s = cut.split(":")
    return (f"{col} >= CAST(DATE '{day}' - CAST(day(DATE '{day}') AS INTEGER) AS TIMESTAMP) "
            f"AND {col} <= CAST(DATE '{day}' AS TIMESTAMP) + INTERVAL {int(h)} HOUR + INTERVAL {int(m)} MINUTE "
            f"+ INTERVAL {int(s)} SECOND")


_DELTA = "(created_at >= m.ca OR updated_at >= m.ua)"
_DELTA_FLOOR = "(created_at >= m.ca OR (updated_at >= m.ua AND created_at >= TIMESTAMP '2001-03-01 00:00:00'))"

ORACLES: dict[str, str] = {
    "snapshot_full": f"SELECT {_CUST_COLS} FROM customer",
    "project_columns": f"SELECT o_orderkey, {_clean('o_orderstatus')}, o_orderdate FROM orders",
    "derived_column": f"SELECT {_LI_COLS}, l_extendedprice * (1 - l_discount) AS net_impact FROM lineitem",
    "mtd_created": f"{_T} SELECT {_T_COLS} FROM t WHERE {_mtd('created_at', '2000-06-15', '05:00:00')}",
    "mtd_poll": f"SELECT * FROM events WHERE {_mtd('ts', '2024-01-15', '04:40:00')}",
    "mtd_epoch": (
        "WITH e AS (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS unixdate FROM events) "
        "SELECT * FROM e WHERE "
        + _mtd("make_timestamp(unixdate * 1000000)", "2024-01-15", "05:00:00")
    ),
    "rolling_update_fixed": (
        f"{_T} SELECT {_T_COLS} FROM t WHERE updated_at >= TIMESTAMP '2000-06-15 06:00:00' - INTERVAL 3 DAY "
        "AND updated_at <= CAST(DATE '2000-06-15' AS TIMESTAMP) + INTERVAL 5 HOUR "
        "AND created_at >= TIMESTAMP '1999-09-01 00:00:00'"
    ),
    "rolling_update_months": (
        f"{_T} SELECT {_T_COLS} FROM t WHERE updated_at >= TIMESTAMP '2000-06-15 06:00:00' - INTERVAL 3 DAY "
        "AND updated_at <= CAST(DATE '2000-06-15' AS TIMESTAMP) + INTERVAL 5 HOUR "
        "AND created_at >= TIMESTAMP '2000-06-15 06:00:00' - INTERVAL 7 MONTH"
    ),
    "distinct_keys": f"{_T} SELECT DISTINCT o_custkey FROM t WHERE created_at >= TIMESTAMP '2001-01-01 00:00:00'",
    "distinct_rows": f"SELECT DISTINCT {_LI_COLS} FROM lineitem",
    "last_n_years": (
        f"SELECT o_orderkey, o_custkey, {_clean('o_orderstatus')}, o_totalprice, o_orderdate, "
        f"{_clean('o_orderpriority')} FROM orders "
        "WHERE o_orderdate >= CAST(make_date(year(DATE '2001-06-15') - 3, 1, 1) AS TIMESTAMP)"
    ),
    "semi_static": (
        f"SELECT {_LI_COLS} FROM lineitem WHERE l_orderkey IN "
        "(SELECT DISTINCT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00')"
    ),
    "watermark": f"{_T}{_W} SELECT ca AS max_created_at, ua AS max_updated_at FROM m",
    "incr_delta": f"{_T}{_W} SELECT DISTINCT {_T_COLS} FROM t, m WHERE {_DELTA}",
    "incr_delta_floor": f"{_T}{_W} SELECT {_T_COLS} FROM t, m WHERE {_DELTA_FLOOR}",
    "cascade_delta": (
        f"{_T}{_W} SELECT DISTINCT {_LI_COLS} FROM lineitem WHERE l_orderkey IN "
        f"(SELECT DISTINCT o_orderkey FROM t, m WHERE {_DELTA})"
    ),
    "cascade_delta_own": (
        f"{_T}{_W} SELECT DISTINCT {_LI_COLS} FROM lineitem, m WHERE l_orderkey IN "
        f"(SELECT DISTINCT o_orderkey FROM t, m WHERE {_DELTA}) "
        "AND (l_shipdate >= m.ca OR l_shipdate >= m.ua)"
    ),
    "cascade_delta_floor": (
        f"{_T}{_W} SELECT DISTINCT {_LI_COLS} FROM lineitem WHERE l_orderkey IN "
        f"(SELECT DISTINCT o_orderkey FROM t, m WHERE {_DELTA_FLOOR})"
    ),
    "sanitize_text": (
        "SELECT doc_id, replace(replace(source || '\\' || text, '\\', '/'), chr(10), ' ') AS text, "
        f"{_clean('lang')}, {_clean('source')}, n_chars FROM documents"
    ),
    "catalog_allowlist": (
        "SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders "
        "UNION ALL SELECT 'customer', count(*) FROM customer"
    ),
    "catalog_lower": (
        "SELECT 'lineitem' AS table_name, count(*) AS n_rows FROM lineitem "
        "UNION ALL SELECT 'orders', count(*) FROM orders"
    ),
    "records_scan": (
        f"SELECT {_CUST_COLS} FROM (SELECT * REPLACE (CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS c_name) FROM customer) c"
    ),
    "csv_roundtrip": f"SELECT {_DOC_COLS} FROM documents",
    # Both are an empty field of the file, which reads as null.
    "distinct_keys_roundtrip": (
        "SELECT nullif(key, '') AS key FROM (SELECT DISTINCT CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 50 = 1 THEN '' "
        "ELSE o_orderpriority || ' ' || (o_custkey % 90) END AS key FROM orders)"
    ),
}


def _path_sql(name: str, layout: str, folder: str, as_of: str) -> str:
    """The path of an extract's file, dated by SQL."""
    if layout == "daily_incr":
        return f"'mysql_backups/{folder}/daily_incr/{name}/{name}' || strftime(TIMESTAMP '{as_of}', '%Y%m%d%H%M%S') || '.csv'"
    top = {"records": f"salesforce_backups/{name}", "snapshot": f"mysql_backups/{folder}/{name}"}.get(layout, f"mysql_backups/{folder}/{name}/{layout}")
    return f"'{top}/{name}' || strftime(TIMESTAMP '{as_of}', '%Y%m%d') || '.csv'"


def _count_row(name: str, layout: str, source: str, where: str = "", folder: str = "", as_of: str = "2000-06-15 06:00:00") -> str:
    cond = f" WHERE {where}" if where else ""
    return (f"SELECT '{name}' AS table_name, '{layout}' AS layout, {_path_sql(name, layout, folder, as_of)} AS path, "
            f"CAST(count(*) AS BIGINT) AS rows, 'ok' AS status FROM {source}{cond}")


def _missing_row(name: str, layout: str, status: str = "missing") -> str:
    return (f"SELECT '{name}' AS table_name, '{layout}' AS layout, NULL AS path, CAST(NULL AS BIGINT) AS rows, "
            f"'{status}' AS status")


_SEMI = "l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00')"
_EPOCH = "(SELECT CAST(floor(epoch(ts)) AS BIGINT) AS unixdate FROM events) e"

ORACLES.update({
    "load_report": " UNION ALL ".join([
        _count_row("customer", "snapshot", "customer", folder="tpch"),
        _count_row("orders", "snapshot", "orders", folder="tpch"),
        _count_row("lineitem", "snapshot", "lineitem", folder="tpch"),
        _missing_row("missing_table", "snapshot"),
    ]),
    "job_full": " UNION ALL ".join([
        *[_count_row(t, "snapshot", t, folder="tpch") for t in ("region", "nation", "customer", "supplier", "part")],
        _count_row("lineitem_recent", "snapshot", "lineitem", _SEMI, folder="tpch"),
        _count_row("lineitem", "snapshot", "lineitem", folder="tpch"),
        _count_row("events", "snapshot", "events", folder="tpch"),
        _missing_row("missing_table", "snapshot"),
    ]),
    "job_insert_update": _T + " " + " UNION ALL ".join([
        _count_row("orders", "insert", "t", _mtd("created_at", "2000-06-15", "05:00:00"), "smc"),
        _count_row("orders", "update", "t", "updated_at >= TIMESTAMP '2000-06-15 06:00:00' - INTERVAL 3 DAY "
                   "AND updated_at <= CAST(DATE '2000-06-15' AS TIMESTAMP) + INTERVAL 5 HOUR "
                   "AND created_at >= TIMESTAMP '1999-09-01 00:00:00'", "smc"),
        _count_row("orders", "distinct", "(SELECT DISTINCT o_custkey FROM t "
                   "WHERE created_at >= TIMESTAMP '2001-01-01 00:00:00') k", folder="smc"),
        _count_row("orders_months", "update", "t", "updated_at >= TIMESTAMP '2000-06-15 06:00:00' - INTERVAL 3 DAY "
                   "AND updated_at <= CAST(DATE '2000-06-15' AS TIMESTAMP) + INTERVAL 5 HOUR "
                   "AND created_at >= TIMESTAMP '2000-06-15 06:00:00' - INTERVAL 7 MONTH", "smc"),
        _count_row("orders_cols", "insert", "t", _mtd("created_at", "2000-06-15", "05:00:00"), "smc"),
        _count_row("poll_data", "snapshot", "events", _mtd("ts", "2024-01-15", "04:40:00"), "vcoloburst", "2024-01-15 06:00:00"),
        _count_row("tblTransactions", "snapshot", _EPOCH,
                   _mtd("make_timestamp(unixdate * 1000000)", "2024-01-15", "05:00:00"), "sslvpn", "2024-01-15 06:00:00"),
    ]),
    "job_incremental": _T + _W + " " + " UNION ALL ".join([
        _count_row("orders", "daily_incr", f"(SELECT DISTINCT * FROM t, m WHERE {_DELTA}) d", folder="smc"),
        _count_row("lineitem", "daily_incr", "(SELECT DISTINCT * FROM lineitem WHERE l_orderkey IN "
                   f"(SELECT o_orderkey FROM t, m WHERE {_DELTA})) c", folder="smc"),
        _count_row("lineitem_own", "daily_incr", "(SELECT DISTINCT lineitem.* FROM lineitem, m WHERE l_orderkey IN "
                   f"(SELECT o_orderkey FROM t, m WHERE {_DELTA}) "
                   "AND (l_shipdate >= m.ca OR l_shipdate >= m.ua)) c", folder="smc"),
        _count_row("orders_floor", "daily_incr", f"(SELECT t.* FROM t, m WHERE {_DELTA_FLOOR}) d", folder="smc"),
        _count_row("lineitem_floor", "daily_incr", "(SELECT DISTINCT * FROM lineitem WHERE l_orderkey IN "
                   f"(SELECT o_orderkey FROM t, m WHERE {_DELTA_FLOOR})) c", folder="smc"),
    ]),
    "job_records": " UNION ALL ".join([
        _count_row("Opportunity", "records", "orders",
                   "o_orderdate >= CAST(make_date(year(DATE '2001-06-15') - 3, 1, 1) AS TIMESTAMP)", as_of="2001-06-15 06:00:00"),
        _count_row("Account", "records", "customer", as_of="2001-06-15 06:00:00"),
        _missing_row("RelatedPartner", "records"),
    ]),
})
