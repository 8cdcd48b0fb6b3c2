"""The reference's own four jobs (164 extracts) run end to end.

Every schema of the manifest is bound to a catalog source over small
fixture tables shaped after the columns its extracts use (ids, change
columns, the 60 ``ticket`` columns, epoch and poll columns, parent keys);
the warehouse holds upper-case copies with older marks, and the CRM objects
are landed as JSON records.  Every extract must succeed and a few row
counts are checked against the windows.
"""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest

from sparkload.context import RunContext
from sparkload.functions.timestamps import epoch_seconds
from sparkload.plans import manifest as mf
from sparkload.plans.jobs import Loader
from sparkload.sources import SourceConfig, SourceRegistry

AS_OF = dt.datetime(2024, 3, 15, 6, 0, 0)
ROWS = 3  # ids 1..3, created 1..3 hours before 04:00 on the run day
NOW = "timestamp_ntz'2024-03-15 04:00:00'"

# Canonical API names of fields the query spells differently.
API_SPELLING = {"NAME": "Name", "ContactID": "ContactId", "AccountID": "AccountId"}

GENERIC = ("id", "name", "created_at", "updated_at")
SPECIAL = {
    "ticket": mf.names(mf.TICKET_COLUMNS),
    "ticket_asset": ("ticket_id", "asset_id"),
    "delivery_lineitem": ("id", "lineitem_id", "quantity"),
    "lineitem": ("id", "quantity"),
    "tblTransactions": ("unixdate", "name"),
    "poll_data": ("poll_timestamp", "value"),
    "asset_ip_info": ("id", "asset_id", "ip", "created_at", "updated_at"),
    "change_asset": ("change_id", "asset_id"),
    "change_customer": ("change_id", "customer_id"),
    "incident_asset": ("incident_id", "asset_id"),
    "incident_customer": ("incident_id", "customer_id"),
    "incident_facility": ("incident_id", "facility_id"),
}


def column_expr(name: str) -> str:
    """A fixture value for column ``name`` of row ``id`` (1..ROWS)."""
    if name == "unixdate":
        return f"{epoch_seconds(dt.datetime(2024, 3, 15, 4), 'UTC')} - id * 3600 AS unixdate"
    if name.endswith("_at") or name in ("poll_timestamp",):
        return f"timestampadd(HOUR, -id, {NOW}) AS {name}"
    if name.startswith("is_"):
        return f"id % 2 = 0 AS {name}"
    if name == "id" or name.endswith(("_id", "_by", "_count")) or name in ("assigned_to", "quantity"):
        return f"id AS {name}"
    if name == "value":
        return f"id * 1.5 AS {name}"
    return f"concat('{name}\\\\', id, '\\n') AS {name}"  # a backslash and a newline to clean


def view_name(prefix: str, table: str) -> str:
    return f"{prefix}{table}"


def prefix_of(schema: str) -> str:
    return "m_" + schema.replace("-", "_") + "__"


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    specs = mf.reference_manifest()
    tables = {(s.schema, s.table) for s in specs if s.extract is not mf.Extract.RECORDS}
    tables |= {(s.schema, s.parent) for s in specs if s.extract is mf.Extract.SEMI_STATIC}
    for schema, table in tables:
        cols = SPECIAL.get(table, GENERIC)
        spark.range(1, ROWS + 1).selectExpr(*[column_expr(c) for c in cols]) \
            .createOrReplaceTempView(view_name(prefix_of(schema), table))
    # Warehouse copies: marks one day older than the fixture rows.
    for s in specs:
        if s.target_source:
            spark.sql("SELECT timestamp_ntz'2024-03-14 00:00:00' AS created_at, "
                      "timestamp_ntz'2024-03-14 00:00:00' AS updated_at") \
                .createOrReplaceTempView(view_name("wh__", s.target_table))
    landed = str(tmp_path_factory.mktemp("crm"))
    for output, obj, fields, _ in mf.CRM_OBJECTS:
        os.makedirs(os.path.join(landed, obj))
        with open(os.path.join(landed, obj, "part-0.json"), "w") as f:
            for i, created in enumerate(("2024-01-01T00:00:00.000+0000", "2020-12-31T23:59:59.000+0000")):
                rec = {"attributes": {"type": obj, "url": f"/{obj}/{i}"}}
                # keys as the API spells them (the query says NAME, ContactID, AccountID)
                rec.update({API_SPELLING.get(n, n): f"{n}\\{i}\nx" for n in mf.names(fields)})
                rec["CreatedDate"] = created
                f.write(json.dumps(rec) + "\n")
    # The source-side function of the derived column, as a SQL function.
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION GetTotalImpactForLineitem(i BIGINT, q BIGINT) "
              "RETURNS DOUBLE RETURN q * 2.5")
    configs = [SourceConfig(schema, "table", prefix=prefix_of(schema)) for schema in {s for s, _ in tables}]
    configs += [SourceConfig("warehouse", "table", prefix="wh__"),
                SourceConfig("crm", "records", root=landed, path_template="{root}/{table}")]
    return SourceRegistry(configs)


def run(spark, sources, specs, outdir):
    # Catalog sources evaluate the derived column in Spark, not in the source.
    specs = [s.but(derived_in_source=False) if s.derived else s for s in specs]
    loader = Loader(spark, RunContext(AS_OF, "UTC", outdir), sources, max_parallel=8, set_session_zone=False)
    results = loader.run(specs)
    bad = [(r.table_name, r.layout, r.status, r.error) for r in results if r.status != "ok"]
    assert not bad, bad
    return {(r.schema_name, r.table_name, r.layout): r for r in results}


def row_counts(results):
    return {key: r.rows for key, r in results.items()}


def test_full_load_manifest_runs(spark, sources, outdir):
    rows = row_counts(run(spark, sources, mf.full_load_manifest(), outdir))
    assert len(rows) == 135 and set(rows.values()) == {ROWS}


def test_insert_update_manifest_runs(spark, sources, outdir):
    rows = row_counts(run(spark, sources, mf.insert_update_manifest(), outdir))
    assert len(rows) == 11
    assert rows[("smc", "note", "insert")] == ROWS and rows[("smc", "note", "distinct")] == ROWS
    assert rows[("smc", "ticket", "update")] == ROWS
    assert rows[("sslvpn", "tblTransactions", "snapshot")] == ROWS
    assert rows[("vcoloburst", "poll_data", "snapshot")] == ROWS


def test_incremental_manifest_runs(spark, sources, outdir):
    rows = row_counts(run(spark, sources, mf.incremental_manifest(), outdir))
    assert len(rows) == 12 and set(rows.values()) == {ROWS}


def test_records_manifest_runs(spark, sources, outdir):
    results = run(spark, sources, mf.records_manifest(), outdir)
    rows = row_counts(results)
    assert len(rows) == 6
    assert rows[("crm", "Opportunity", "records")] == 1  # 1 Jan of year-3 onwards
    assert rows[("crm", "RelatedPartner", "records")] == 2
    from sparkload.sinks import read_csv
    user = results[("crm", "User", "records")]
    fields = [f for o, _, fs, _ in mf.CRM_OBJECTS if o == "User" for f in mf.names(fs)]
    back = read_csv(spark, user.path, ", ".join(f"`{f}` string" for f in fields))
    assert back.where("NAME IS NULL OR ContactID IS NULL OR AccountID IS NULL").count() == 0
    assert {r["NAME"] for r in back.collect()} == {"NAME/0 x", "NAME/1 x"}


def test_incremental_manifest_against_an_upper_case_jdbc_warehouse(spark, sources, outdir, monkeypatch):
    """The warehouse through the JDBC code path: its catalog spells schema
    and tables upper case (``SMC``, ``ASSET``).  Spark SQL stands in for the
    warehouse and runs the SQL text the library sends."""
    from sparkload.sources import jdbc
    upper = sorted({s.target_table for s in mf.incremental_manifest()})
    rows = ", ".join(f"('SMC', '{t}')" for t in upper) + ", ('OTHER', 'TASK_ARCHIVE')"
    spark.sql(f"SELECT * FROM VALUES {rows} AS t(table_schema, table_name)").createOrReplaceTempView("wh_catalog")
    for t in upper:
        spark.table(view_name("wh__", t)).createOrReplaceTempView(t)
    sent = []

    def warehouse(session, base, sql):
        sent.append(sql)
        return session.sql(sql.replace("information_schema.tables", "wh_catalog"))

    monkeypatch.setattr(jdbc, "query_one_row", warehouse)
    sources = SourceRegistry([*(sources.get(n) for n in sources.names() if n != "warehouse"),
                              SourceConfig("warehouse", "jdbc", options={"url": "jdbc:stand-in"})])
    rows = row_counts(run(spark, sources, mf.incremental_manifest(), outdir))
    assert len(rows) == 12 and set(rows.values()) == {ROWS}
    assert any("upper(table_schema) = 'SMC'" in q for q in sent)
    assert any("max(`created_at`)" in q and "from `ASSET`" in q for q in sent)
