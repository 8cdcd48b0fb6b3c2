"""JDBC reads by primary key: SQL texts, disjoint and complete ranges."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from sparkload.sources import JdbcPartitioning, SourceConfig, SourceRegistry, jdbc
from sparkload.sources.config import registry_from_dict


def test_predicates_of_two_columns():
    assert jdbc.key_predicates(("a", "b"), [(1, "x"), (1, "x"), (2, "o'y")]) == [
        "(`a` <= 1 and (`a` < 1 or `b` < 'x')) or `a` is null or `b` is null",
        "`a` >= 1 and (`a` > 1 or `b` >= 'x') and `a` <= 2 and (`a` < 2 or `b` < 'o''y') and `b` is not null",
        "`a` >= 2 and (`a` > 2 or `b` >= 'o''y') and `b` is not null"]
    assert jdbc.key_predicates(("d",), [(dt.date(2024, 1, 2),), (dt.datetime(2024, 1, 3, 4),)], '"') == [
        "\"d\" < '2024-01-02' or \"d\" is null", "\"d\" >= '2024-01-02' and \"d\" < '2024-01-03 04:00:00'", "\"d\" >= '2024-01-03 04:00:00'"]
    assert jdbc.sql_literal(b"\x01\xff") == "x'01ff'"
    assert jdbc.tiles_query("`t`", ("a", "b"), 4) == (
        "select k0, k1, tile from (select k0, k1, tile, row_number() over (partition by tile order by k0, k1) as place from "
        "(select `a` as k0, `b` as k1, ntile(4) over (order by `a`, `b`) as tile from `t` where `a` is not null and `b` is not null) "
        "sparkload_t) sparkload_u where place = 1")
    assert jdbc.hash_predicates(JdbcPartitioning(("a", "b"), 2, balance="hash")) == [
        "mod(crc32(concat_ws('|', `a`, `b`)), 2) = 0", "mod(crc32(concat_ws('|', `a`, `b`)), 2) = 1"]


def members(con, preds):
    return [[r[0] for r in con.execute(f"SELECT rid FROM t WHERE {p}").fetchall()] for p in preds]


def tiled(con, key, tiles):
    rows = con.execute(jdbc.tiles_query('"t"', key, tiles, '"')).fetchall()
    firsts = [r[:len(key)] for r in sorted(rows, key=lambda r: r[len(key)])]
    return jdbc.key_predicates(key, firsts[1:], '"') or ["true"]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)), st.one_of(st.none(), st.text(alphabet="aAbé'", max_size=2))), max_size=60), st.integers(1, 7))
def test_composite_ranges_hold_every_row_once(rows, tiles):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (rid INTEGER, a INTEGER, b VARCHAR)")
    if rows:
        con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, *r) for i, r in enumerate(rows)])
    got = members(con, tiled(con, ("a", "b"), tiles))
    assert sorted(i for m in got for i in m) == list(range(len(rows)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbBzZ_é", max_size=3), max_size=50, unique=True), st.integers(1, 6))
def test_text_ranges_under_a_collation_hold_every_row_once(keys, tiles):
    """Upper and lower case are one in the source's order, not in Python's."""
    con = duckdb.connect()
    con.execute("CREATE TABLE t (rid INTEGER, k VARCHAR COLLATE NOCASE)")
    if keys:
        con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(keys)))
    got = members(con, tiled(con, ("k",), tiles))
    assert sorted(i for m in got for i in m) == list(range(len(keys)))


def test_unique_composite_tiles_are_even():
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT i::INTEGER AS rid, (CASE WHEN i % 3 = 0 THEN 7 ELSE i END)::INTEGER AS a, i AS b FROM range(900) r(i)")
    got = members(con, tiled(con, ("a", "b"), 6))  # a third of the rows under one leading value
    assert [len(m) for m in got] == [150] * 6


def test_plans_of_keys(spark):
    schema = T.StructType.fromDDL("Id bigint, code string, day date, at timestamp_ntz, x double, u binary, d decimal(20,0), z timestamp")
    plan = lambda *key: jdbc.key_partitioning(key, schema, 8)
    assert plan("id") == JdbcPartitioning("id", 8) and plan("d") == JdbcPartitioning("d", 8)
    for key in (("code",), ("day",), ("at",), ("u",), ("id", "code"), ("id", "day")):
        assert plan(*key) == JdbcPartitioning(key, 8, balance="quantiles")
    assert plan("x") is None and plan("z") is None and plan("id", "x") is None and plan("gone") is None and plan() is None
    with pytest.raises(ValueError, match="one column"):
        JdbcPartitioning(("a", "b"), 4)


@pytest.fixture()
def stood_in(spark, monkeypatch):
    """The source's queries are answered by Spark SQL over views; the reads
    themselves are recorded."""
    seen = {}
    monkeypatch.setattr(jdbc, "query_one_row", lambda s, base, sql: s.sql(sql))
    monkeypatch.setattr(jdbc, "_load", lambda s, opts: seen.update(opts=dict(opts), preds=None) or s.table(opts["dbtable"].strip("`")))
    monkeypatch.setattr(jdbc, "_load_parts", lambda s, base, dbtable, preds, fetch: seen.update(preds=preds) or s.table(dbtable.strip("`")))
    monkeypatch.setattr(jdbc, "ROWS_PER_RANGE", 100)
    return seen


def test_read_by_key_of_each_kind(spark, stood_in):
    base = {"url": "jdbc:mysql://db/smc"}
    spark.range(1, 1001).selectExpr("id", "concat('c', id % 400, '-', id) AS code", "date_add(date'2024-01-01', int(id % 500)) AS day", "id % 3 AS grp").createOrReplaceTempView("keyed")
    jdbc.read_by_key(spark, base, "keyed", ("id",), 16)
    assert {k: stood_in["opts"][k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "1000", "numPartitions": "10"}
    df = spark.table("keyed")
    for key, most in ((("code",), 100), (("day",), 102), (("grp", "id"), 100)):
        jdbc.read_by_key(spark, base, "keyed", key, 16)
        sizes = [df.where(p).count() for p in stood_in["preds"]]
        assert len(sizes) == 10 and sum(sizes) == 1000 and max(sizes) <= most, (key, sizes)
    jdbc.read_by_key(spark, base, "keyed", ("code",), 4)
    assert len(stood_in["preds"]) == 4
    spark.range(5).selectExpr("id", "concat('c', id) AS code").createOrReplaceTempView("few")
    for key in (("id",), ("code",)):
        jdbc.read_by_key(spark, base, "few", key, 16)
        assert stood_in["preds"] is None and "partitionColumn" not in stood_in["opts"]  # one connection


def test_sources_that_cannot_tile(spark, stood_in, monkeypatch, caplog):
    spark.range(1000).selectExpr("concat('c', id) AS code").createOrReplaceTempView("texts")

    def old(s, base, sql):
        if "ntile" in sql:
            raise RuntimeError("syntax error near over")
        return s.sql(sql)

    monkeypatch.setattr(jdbc, "query_one_row", old)
    jdbc.read_by_key(spark, {"url": "jdbc:mysql://db/smc"}, "texts", ("code",), 16)
    sizes = [spark.table("texts").where(p).count() for p in stood_in["preds"]]
    assert len(sizes) == 10 and sum(sizes) == 1000 and max(sizes) < 150
    stood_in["preds"] = None
    jdbc.read_by_key(spark, {"url": "jdbc:other://db"}, "texts", ("code",), 16)
    assert stood_in["preds"] is None and "cannot be tiled" in caplog.text
    with pytest.raises(RuntimeError):  # a plan that was asked for fails the extract
        jdbc.read_table(spark, {"url": "jdbc:mysql://db/smc"}, "texts", JdbcPartitioning("code", 4, balance="quantiles"))
    jdbc.read_table(spark, {"url": "jdbc:mysql://db/smc"}, "texts", JdbcPartitioning("code", 4, balance="hash"))
    assert len(stood_in["preds"]) == 4


def test_tables_without_a_plan_are_read_by_their_primary_key(spark, monkeypatch):
    asked, read = [], []

    def catalog(s, base, sql):
        asked.append(sql)
        return spark.createDataFrame([("ASSET_ID", 2), ("TICKET_ID", 1)] if "ticket_asset" in sql else [], "NAME string, POS int")

    monkeypatch.setattr(jdbc, "query_one_row", catalog)
    monkeypatch.setattr(jdbc, "read_by_key", lambda s, base, table, key, n, derived, quote: read.append((table, key, n)))
    monkeypatch.setattr(jdbc, "read_table", lambda s, base, table, plan, *a, **k: read.append((table, plan)))
    reg = registry_from_dict({"smc": {"format": "jdbc", "options": {"url": "jdbc:mysql://db/smc"}, "auto_partitions": 8,
                                      "partitioning": {"note": {"column": ["id", "part"], "num_partitions": 4, "balance": "quantiles"}}}})
    reg.read(spark, "smc", "ticket_asset", schema="smc")
    reg.read(spark, "smc", "ticket_asset", schema="smc")
    assert len(asked) == 1 and read.pop() == read[0]
    reg.read(spark, "smc", "heap", schema="smc")
    reg.read(spark, "smc", "note", schema="smc")
    reg.read(spark, "smc", "ticket_asset", schema="smc", partitioned=False)
    reg.read(spark, "smc", "ticket_asset")
    assert read == [("ticket_asset", ("TICKET_ID", "ASSET_ID"), 8), ("heap", None), ("note", JdbcPartitioning(("id", "part"), 4, balance="quantiles")),
                    ("ticket_asset", None), ("ticket_asset", None)]
    assert len(asked) == 2
    one = SourceRegistry([SourceConfig("smc", "jdbc", options={"url": "u"}, auto_partitions=1)])
    one.read(spark, "smc", "ticket_asset", schema="smc")
    assert read[-1] == ("ticket_asset", None) and len(asked) == 2
