"""Catalog allow-list (S4/S5), landed records (S6), JDBC options."""

from __future__ import annotations

import json
import os

from hypothesis import given, settings
from hypothesis import strategies as st

from sparkload.sources import (
    JdbcPartitioning,
    SourceConfig,
    SourceRegistry,
    allowlisted,
    existing_tables,
    read_records,
    string_fields,
)
from sparkload.sources import jdbc


def _catalog(spark):
    return spark.createDataFrame(
        [("smc", "customer"), ("smc", "asset"), ("other", "ticket"), ("SMC", "TICKET_ASSET")],
        "table_schema string, table_name string")


def test_allowlist_skips_missing_and_other_schemas(spark):
    cat = _catalog(spark)
    got = existing_tables(spark, cat, ["customer", "ticket", "missing", "asset"], schema="smc")
    assert got == ["customer", "asset"]  # manifest order; other schema and missing skipped


def test_allowlist_case_folding(spark):
    cat = _catalog(spark)
    got = allowlisted(spark, cat, ["TICKET_ASSET", "ASSET"], schema="SMC", fold_case=True)
    assert sorted(r["table_name"] for r in got.collect()) == ["asset", "ticket_asset"]


def test_registry_parquet_catalog_and_read(spark):
    reg = SourceRegistry([SourceConfig("lake", "parquet", root="/root/testdata/sf0.001")])
    cat = reg.catalog(spark, "lake", names=["orders", "nope"])
    assert [r["table_name"] for r in cat.collect()] == ["orders"]
    assert reg.read(spark, "lake", "region").count() == 5


def test_registry_table_prefix(spark):
    spark.range(3).createOrReplaceTempView("pfx_things")
    reg = SourceRegistry([SourceConfig("views", "table", prefix="pfx_")])
    assert "things" in {r["table_name"] for r in reg.catalog(spark, "views").collect()}
    assert reg.read(spark, "views", "things").count() == 3


def _write_pages(folder, pages):
    os.makedirs(folder, exist_ok=True)
    for i, recs in enumerate(pages):
        with open(os.path.join(folder, f"page{i}.json"), "w") as f:
            json.dump({"totalSize": len(recs), "done": True, "records": recs}, f, indent=2)


def test_records_pages_layout(spark, outdir):
    env = {"type": "User", "url": "/u"}
    pages = [[{"attributes": env, "Id": "1", "Name": "a\\b", "ContactId": "c1"},
              {"attributes": env, "Id": "2", "Name": "x\ny", "ContactId": None}],
             [{"attributes": env, "Id": "3", "Name": "z", "ContactId": "c3"}]]
    folder = os.path.join(outdir, "User")
    _write_pages(folder, pages)
    df = read_records(spark, folder, "Id string, Name string, ContactId string", ["Id", "NAME", "ContactID"],
                      layout="pages")
    assert df.columns == ["Id", "Name", "ContactId"]
    assert sorted(r["Id"] for r in df.collect()) == ["1", "2", "3"]


def test_records_lines_layout_text_fields(spark, outdir):
    folder = os.path.join(outdir, "Opp")
    os.makedirs(folder)
    with open(os.path.join(folder, "part.json"), "w") as f:
        f.write(json.dumps({"attributes": {"type": "Opportunity", "url": "/o"}, "Id": "9", "Amount": 12.5}) + "\n")
    from sparkload.sources import string_fields
    df = read_records(spark, folder, string_fields(["Id", "Amount"]), ["Id", "Amount"])
    assert df.collect()[0].asDict() == {"Id": "9", "Amount": "12.5"}


def test_jdbc_options():
    base = {"url": "jdbc:mysql://db/smc", "driver": "com.mysql.cj.jdbc.Driver"}
    opts = jdbc.reader_options(base, "`ticket`", JdbcPartitioning("id", 16, 1, 1000))
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "16"
    assert opts["lowerBound"] == "1" and opts["upperBound"] == "1000" and opts["dbtable"] == "`ticket`"
    fetched = jdbc.reader_options(base, "t", JdbcPartitioning("id", 8), bounds=(5, 500))
    assert fetched["lowerBound"] == "5" and fetched["upperBound"] == "500"
    single = jdbc.reader_options(base, "t", JdbcPartitioning("id", 8), bounds=(5, 5))
    assert "partitionColumn" not in single
    assert opts["preferTimestampNTZ"] == "true"
    assert jdbc.reader_options({**base, "preferTimestampNTZ": "false"}, "t")["preferTimestampNTZ"] == "false"
    # MySQL values as the reference's Python driver returns them; the caller can override
    assert opts["tinyInt1isBit"] == "false" and opts["yearIsDateType"] == "false"
    assert opts["zeroDateTimeBehavior"] == "CONVERT_TO_NULL"
    # rows stream in bounded batches, also for a table read whole
    whole = jdbc.reader_options(base, "t")
    assert whole["fetchsize"] == "10000" and whole["useCursorFetch"] == "true"
    assert jdbc.reader_options({**base, "tinyInt1isBit": "true"}, "t")["tinyInt1isBit"] == "true"
    other = jdbc.reader_options({"url": "jdbc:postgresql://db/x"}, "t")
    assert "tinyInt1isBit" not in other and other["preferTimestampNTZ"] == "true"


def test_jdbc_sql_texts():
    assert jdbc.derived_subquery("lineitem", {"net_impact": "GetTotalImpactForLineitem(id, quantity)"}) == \
        "(select *, GetTotalImpactForLineitem(id, quantity) as `net_impact` from `lineitem`) sparkload_q"
    assert jdbc.marks_query("`ASSET`", "created_at", "updated_at", "`") == \
        "select max(`created_at`) as max_created_at, max(`updated_at`) as max_updated_at from `ASSET`"
    assert jdbc.catalog_query("smc", ["note", "o'brien"]) == (
        "select table_schema, table_name from information_schema.tables where table_schema = 'smc' "
        "and table_name in ('note', 'o''brien')")
    assert jdbc.quote_ident('we"ird', '"') == '"we""ird"'
    # bare identifiers (quote ""), which a warehouse folds to its own case
    assert jdbc.marks_query(jdbc.quote_ident("ASSET", ""), "created_at", "updated_at", "") == \
        "select max(created_at) as max_created_at, max(updated_at) as max_updated_at from ASSET"
    # the warehouse spells SMC and ASSET upper case; the manifest lower case
    assert jdbc.catalog_query("smc", ["asset", "ticket"], fold_case=True) == (
        "select table_schema, table_name from information_schema.tables where upper(table_schema) = 'SMC' "
        "and upper(table_name) in ('ASSET', 'TICKET')")


def test_jdbc_quantile_ranges_balance_a_dense_key_block(spark, monkeypatch):
    # 300 ids spread thinly, 600 in one dense block, 5 null keys.  Equal
    # strides of [min, max] would put the block (2/3 of the rows) in one task.
    rows = [(i * 1000,) for i in range(300)] + [(500_000 + i,) for i in range(600)] + [(None,)] * 5
    spark.createDataFrame(rows, "id long").createOrReplaceTempView("skewed_keys")
    # The source is stood in for by Spark SQL, which reads the same SQL text.
    monkeypatch.setattr(jdbc, "query_one_row", lambda s, base, sql: s.sql(sql))
    preds = jdbc.quantile_predicates(spark, {}, "`skewed_keys`", JdbcPartitioning("id", 4, balance="quantiles"))
    assert len(preds) == 4
    df = spark.table("skewed_keys")
    sizes = [df.where(p).count() for p in preds]
    assert sum(sizes) == len(rows)  # disjoint and complete, nulls included
    assert max(sizes) <= 230, sizes  # about 905 / 4 each
    lo, hi = 0, 500_599
    cuts = [lo + (hi - lo) * i // 4 for i in range(1, 4)]
    stride_sizes = [df.where(p).count() for p in jdbc.range_predicates("id", cuts)]
    assert max(stride_sizes) >= 600


def test_jdbc_quantile_option_validation():
    import pytest
    with pytest.raises(ValueError):
        JdbcPartitioning("id", 4, balance="even")
    assert jdbc.range_predicates("id", []) == []
    assert jdbc.range_predicates("k", ["b", "a", "b"]) == ["`k` < 'a' or `k` is null", "`k` >= 'a' and `k` < 'b'",
                                                          "`k` >= 'b'"]


def test_catalog_table_names_match_regardless_of_case(spark, outdir):
    import datetime as dt

    from sparkload.context import RunContext
    from sparkload.plans.jobs import Loader
    from sparkload.plans.manifest import Extract, TableSpec
    from sparkload.sinks import Layout
    spark.range(2).createOrReplaceTempView("cs__tblMixedCase")  # the catalog keeps it as cs__tblmixedcase
    reg = SourceRegistry([SourceConfig("vpn", "table", prefix="cs__"), SourceConfig("dir", "parquet", root=outdir)])
    assert reg.folds_case(spark, "vpn") and not reg.folds_case(spark, "dir")
    spec = TableSpec("full", "vpn", "vpn", "tblMixedCase", Extract.SNAPSHOT, Layout.SNAPSHOT)
    res = Loader(spark, RunContext(dt.datetime(2024, 1, 2), "UTC", outdir), reg).run([spec])[0]
    assert res.status == "ok" and res.rows == 2 and res.path.endswith("tblMixedCase20240102.csv")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-10**12, 10**12), max_size=300, unique=True), st.integers(0, 5), st.integers(1, 9))
def test_tile_ranges_cover_every_row_once_and_stay_even(keys, nulls, tiles):
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE t (rid INTEGER, k BIGINT)")
    rows = [(i, k) for i, k in enumerate(keys)] + [(len(keys) + i, None) for i in range(nulls)]
    if rows:
        con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    firsts = sorted(r[0] for r in con.execute(jdbc.tiles_query('"t"', "k", tiles, '"')).fetchall())
    preds = jdbc.range_predicates("k", firsts[1:], '"') or ["true"]
    members = [set(r[0] for r in con.execute(f"SELECT rid FROM t WHERE {p}").fetchall()) for p in preds]
    assert sum(len(m) for m in members) == len(rows)  # disjoint ...
    assert set().union(*members) == {r[0] for r in rows}  # ... and complete
    even = -(-len(keys) // tiles)  # ceil: the largest tile of unique keys
    assert max(len(m) for m in members) <= even + nulls
    assert len(preds) <= tiles


def test_jdbc_default_partitioning_applies_where_the_key_exists(spark, monkeypatch):
    from pyspark.sql import types as T

    from sparkload.sources.config import registry_from_dict
    default = JdbcPartitioning("id", 16)
    assert jdbc.partitionable(default, T.StructType.fromDDL("ID bigint, name string"))
    assert jdbc.partitionable(default, T.StructType.fromDDL("id decimal(20,0)"))
    assert not jdbc.partitionable(default, T.StructType.fromDDL("id string"))
    assert not jdbc.partitionable(default, T.StructType.fromDDL("ticket_id bigint"))
    reg = registry_from_dict({"smc": {
        "format": "jdbc", "options": {"url": "jdbc:mysql://db/smc"},
        "partitioning": {"ticket": {"column": "id", "num_partitions": 64, "balance": "quantiles"}},
        "default_partitioning": {"column": "id", "num_partitions": 16}, "max_parallel_reads": 2}})
    assert reg.get("smc").max_parallel_reads == 2 and reg.gate("smc") is not None
    calls = []
    monkeypatch.setattr(jdbc, "read_table", lambda spark, base, table, plan, derived, quote, check_column=False:
                        calls.append((table, plan, check_column)))
    reg.read(None, "smc", "ticket")
    reg.read(None, "smc", "note")
    assert calls == [("ticket", JdbcPartitioning("id", 64, balance="quantiles"), False),
                     ("note", default, True)]
    reg.read(None, "smc", "ticket", partitioned=False)  # one connection, one snapshot
    assert calls[-1] == ("ticket", None, False)
    bare = SourceRegistry([SourceConfig("x", "jdbc", options={"url": "u"})])
    bare.read(None, "x", "note")
    assert calls[-1] == ("note", None, False)


def test_records_fields_match_api_spelling_and_types(spark, outdir):
    """The query spells NAME and ContactID; the API returns Name and
    ContactId.  Values are found regardless of case and cast to the declared
    type; malformed records fail instead of disappearing."""
    import pytest
    folder = os.path.join(outdir, "User")
    os.makedirs(folder)
    env = {"type": "User", "url": "/u"}
    with open(os.path.join(folder, "part.json"), "w") as f:
        f.write(json.dumps({"attributes": env, "Id": "1", "Name": "Ann", "ContactId": "c1", "Amount": 2.5,
                            "IsActive": True, "CreatedDate": "2024-01-01T05:00:00.000+0000"}) + "\n\n")
        f.write(json.dumps({"attributes": env, "Id": "2", "Name": None, "ContactId": "c2", "Amount": None,
                            "IsActive": False, "CreatedDate": None}) + "\n")
    fields = ["Id", "NAME", "ContactID", "Amount", "IsActive", "CreatedDate"]
    text = read_records(spark, folder, string_fields(fields), fields)
    assert text.columns == fields
    assert [r.asDict() for r in text.orderBy("Id").collect()] == [
        {"Id": "1", "NAME": "Ann", "ContactID": "c1", "Amount": "2.5", "IsActive": "true",
         "CreatedDate": "2024-01-01T05:00:00.000+0000"},
        {"Id": "2", "NAME": None, "ContactID": "c2", "Amount": None, "IsActive": "false", "CreatedDate": None}]
    typed = read_records(spark, folder, "Id string, Amount double, IsActive boolean, CreatedDate timestamp", fields)
    assert typed.columns == ["Id", "NAME", "ContactID", "Amount", "IsActive", "CreatedDate"]
    first = typed.where("Id = '1'").first()
    assert first["Amount"] == 2.5 and first["IsActive"] is True and first["NAME"] == "Ann"
    assert typed.where("Id = '1'").selectExpr("unix_timestamp(CreatedDate) AS s").first()["s"] == 1704085200
    with pytest.raises(Exception):  # a declared type the records do not hold fails, not nulls
        read_records(spark, folder, "Id int", fields).collect()
    with open(os.path.join(folder, "part2.json"), "w") as f:
        f.write('{"Id": "3", "Name": \n')
    with pytest.raises(Exception):
        read_records(spark, folder, string_fields(fields), fields).collect()


def test_quantiles_that_fail_fail_the_read(spark, monkeypatch):
    import pytest

    def no_ntile(*args, **kwargs):
        raise RuntimeError("FUNCTION ntile does not exist")

    monkeypatch.setattr(jdbc, "quantile_predicates", no_ntile)
    with pytest.raises(RuntimeError, match="ntile"):
        jdbc.read_table(spark, {"url": "jdbc:mysql://db/smc"}, "ticket", JdbcPartitioning("id", 8, balance="quantiles"))


def _land(folder, *lines):
    import os
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/records.json", "w") as f:
        f.write("\n".join(lines) + "\n")
    return folder


def test_records_are_matched_on_their_own_keys(spark, outdir):
    from sparkload.sources.records import read_records
    path = _land(outdir + "/r", '{"Id":"1"}', '{"Id":"2","Name":"x","Born":"2020-02-03"}', "", '{"ID":"3","name":"y","N":5,"Tags":["a","b"]}')
    rows = read_records(spark, path, "NAME string, id string, born date, n int, tags array<string>").collect()
    assert [r["id"] for r in rows] == ["1", "2", "3"] and [r["NAME"] for r in rows] == [None, "x", "y"]
    assert [str(r["born"]) for r in rows] == ["None", "2020-02-03", "None"]
    assert [r["n"] for r in rows] == [None, None, 5] and rows[2]["tags"] == ["a", "b"]


def test_broken_records_fail_the_read(spark, outdir):
    import pytest
    from sparkload.sources.records import read_records
    for k, line in enumerate(['{"Id":', '{"Id":"1","ID":"2"}', '{"Id":"x1"}']):
        path = _land(f"{outdir}/broken{k}", line)
        with pytest.raises(Exception):
            read_records(spark, path, "id int").collect()
