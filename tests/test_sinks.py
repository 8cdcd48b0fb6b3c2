"""CSV dialect, read-back and path rules (K1-K6)."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from sparkload.context import RunContext
from sparkload.functions import sanitize
from sparkload.sinks import Layout, folder_for_schema, output_path, read_csv, write_csv, write_mode

D = dt.datetime
TEXT_DDL = "id int, s string, t timestamp_ntz, x double"


def test_path_rules():
    ctx = RunContext(as_of=D(2024, 3, 15, 6, 5, 9), output_root="s3a://bucket")
    assert output_path(ctx, Layout.SNAPSHOT, "smc", "customer") == \
        "s3a://bucket/mysql_backups/smc/customer/customer20240315.csv"
    assert output_path(ctx, Layout.INSERT, "smc", "note") == \
        "s3a://bucket/mysql_backups/smc/note/insert/note20240315.csv"
    assert output_path(ctx, Layout.UPDATE, "smc", "log") == \
        "s3a://bucket/mysql_backups/smc/log/update/log20240315.csv"
    assert output_path(ctx, Layout.DISTINCT, "smc", "note") == \
        "s3a://bucket/mysql_backups/smc/note/distinct/note20240315.csv"
    assert output_path(ctx, Layout.DAILY_INCR, "smc", "ASSET_IP_INFO") == \
        "s3a://bucket/mysql_backups/smc/daily_incr/asset_ip_info/asset_ip_info20240315060509.csv"
    assert output_path(ctx, Layout.RECORDS, "", "RelatedPartner") == \
        "s3a://bucket/salesforce_backups/RelatedPartner/RelatedPartner20240315.csv"
    assert folder_for_schema("billing-service") == "billing_service"
    assert folder_for_schema("vcenter-new") == "vcenter_new"
    assert folder_for_schema("power-etl") == "power_etl"
    assert write_mode(Layout.DAILY_INCR) == "errorifexists"
    assert write_mode(Layout.SNAPSHOT) == "overwrite"


def tricky_rows():
    return [
        (1, 'say "hi", friend', D(2024, 1, 1, 0, 0, 0), 1.5),
        (2, "  leading and trailing  ", D(2024, 1, 1, 12, 30, 45, 123456), None),
        (3, "back\\slash\nnew line", None, 2.0),
        (4, "carriage\rreturn", D(2024, 1, 2), 3.25),
        (5, "", D(2024, 1, 3), 0.0),
        (6, None, D(2024, 1, 4), -1.0),
        (7, "comma,separated,values", D(2024, 1, 5), 7.0),
    ]


def test_roundtrip_tricky_text(spark, outdir):
    df = spark.createDataFrame(tricky_rows(), TEXT_DDL)
    clean = sanitize(df)
    path = os.path.join(outdir, "t20240101.csv")
    write_csv(clean, path)
    back = {r["id"]: r.asDict() for r in read_csv(spark, path, TEXT_DDL).collect()}
    want = {r["id"]: r.asDict() for r in clean.collect()}
    want[5]["s"] = None  # empty string and null both read back as null
    assert back == want
    assert back[3]["s"] == "back/slash new line"
    assert back[4]["s"] == "carriage\rreturn"
    assert back[2]["s"] == "  leading and trailing  "


def test_csv_text_format(spark, outdir):
    df = spark.createDataFrame([(1, 'a "q"', D(2024, 1, 1, 5, 0, 0), 2.5)], TEXT_DDL)
    path = os.path.join(outdir, "f.csv")
    write_csv(df, path, single_file=True)
    parts = [p for p in os.listdir(path) if p.startswith("part-")]
    assert len(parts) == 1
    text = open(os.path.join(path, parts[0])).read().splitlines()
    assert text[0] == "id,s,t,x"
    assert text[1] == '1,"a ""q""",2024-01-01 05:00:00.000000,2.5'


def test_same_day_rerun_overwrites(spark, outdir):
    ctx = RunContext(as_of=D(2024, 3, 15, 6), output_root=outdir)
    path = output_path(ctx, Layout.SNAPSHOT, "smc", "t")
    write_csv(spark.createDataFrame([(1,), (2,)], "id int"), path, mode=write_mode(Layout.SNAPSHOT))
    write_csv(spark.createDataFrame([(3,)], "id int"), path, mode=write_mode(Layout.SNAPSHOT))
    assert [r["id"] for r in read_csv(spark, path, "id int").collect()] == [3]


def test_per_run_path_must_be_new(spark, outdir):
    ctx = RunContext(as_of=D(2024, 3, 15, 6), output_root=outdir)
    path = output_path(ctx, Layout.DAILY_INCR, "smc", "asset")
    write_csv(spark.createDataFrame([(1,)], "id int"), path, mode=write_mode(Layout.DAILY_INCR))
    with pytest.raises(Exception):
        write_csv(spark.createDataFrame([(2,)], "id int"), path, mode=write_mode(Layout.DAILY_INCR))


def test_empty_result_writes_header_only(spark, outdir):
    path = os.path.join(outdir, "empty.csv")
    write_csv(spark.createDataFrame([], "id int, s string"), path, single_file=True)
    parts = [p for p in os.listdir(path) if p.startswith("part-")]
    body = "".join(open(os.path.join(path, p)).read() for p in parts)
    assert body.strip() == "id,s"


def test_single_file_is_size_checked(spark, outdir):
    df = spark.range(0, 1000, numPartitions=4)
    path = os.path.join(outdir, "big.csv")
    with pytest.raises(ValueError, match="1000 rows are too many"):
        write_csv(df, path, single_file=True, max_single_file_rows=100)
    assert not os.path.exists(path)


def test_binary_is_base64(spark, outdir):
    df = spark.createDataFrame([(1, bytearray(b"\x00\xffab"))], "id int, b binary")
    path = os.path.join(outdir, "bin.csv")
    write_csv(df, path)
    assert read_csv(spark, path, "id int, b string").collect()[0]["b"] == "AP9hYg=="


@pytest.mark.parametrize("table", ["pages", "conversations", "events"])
def test_roundtrip_of_provided_tables_matches_duckdb(spark, outdir, table):
    """Cleaned tables with quotes, commas, newlines and JSON text survive the
    CSV dialect: read back with their schema they equal DuckDB's cleaning of
    the same parquet (``pages.html`` always holds quotes, most texts hold
    newlines; ``events.props`` is JSON text)."""
    from conftest import SF_CHECK
    from oracle_harness import duck, duck_rows, spark_rows

    from sparkload.queries import _clean
    src = spark.read.parquet(f"{SF_CHECK}/{table}.parquet")
    path = os.path.join(outdir, f"{table}.csv")
    write_csv(sanitize(src), path)
    con = duck(SF_CHECK)
    cols = con.execute(f"DESCRIBE SELECT * FROM {table}").fetchall()
    sql = "SELECT " + ", ".join(_clean(c[0]) if c[1] == "VARCHAR" else c[0] for c in cols) + f" FROM {table}"
    assert spark_rows(read_csv(spark, path, src.schema)) == duck_rows(con, sql)


def test_one_column_keeps_null_and_empty_rows(spark, outdir):
    """A distinct key set with a null and an empty key: a row each."""
    for schema, rows in (("k string", [("a",), (None,), ("",), ("b",)]), ("k long", [(1,), (None,)])):
        path = f"{outdir}/{schema[2:]}"
        write_csv(spark.createDataFrame(rows, schema).coalesce(1), path)
        assert [r.k or None for r in read_csv(spark, path, schema).collect()] == [k or None for k, in rows]
