"""Landed CRM records: one parse, typed fields, pages split between tasks."""

from __future__ import annotations

import datetime as dt
import json
import os
import re

import pytest

from sparkload.plans.explain import plan_text
from sparkload.sources.records import read_records, string_fields

ENV = {"type": "T", "url": "/u"}


def land(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)
    return folder


def parses(df):
    """Parse expressions of the executed plan."""
    return len(re.findall(r"from_json\(", plan_text(df, "extended").split("== Physical Plan ==")[1]))


def test_typed_records_are_parsed_once(spark, outdir):
    rec = {"attributes": ENV, "Id": "1", "N": 5, "Amount": 2.5, "On": True, "Day": "2024-01-02", "At": "2024-01-02T03:04:05.678", "Note": 7, "Gone": None}
    path = land(f"{outdir}/t", "a.json", json.dumps(rec) + "\n" + json.dumps({"ID": "2", "note": {"a": [1]}, "AMOUNT": 3}) + "\n")
    df = read_records(spark, path, "Id string, n int, amount double, on boolean, day date, at timestamp_ntz, note string, gone long")
    assert parses(df) == 1 and parses(read_records(spark, path, string_fields(["Id", "Note"]))) == 1
    rows = [tuple(r) for r in df.orderBy("Id").collect()]
    assert rows == [("1", 5, 2.5, True, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5, 678000), "7", None),
                    ("2", None, 3.0, None, None, None, '{"a":[1]}', None)]


@pytest.mark.parametrize("field,value", [("n int", '"5"'), ("n int", "5.5"), ("n int", "3000000000"), ("n int", "true"), ("d double", '"x"'), ("b boolean", '"true"'),
                                         ("d date", '"soon"'), ("d date", "5"), ("t timestamp", '"nope"'), ("d decimal(4,1)", "123456"), ("n long", "{}")])
def test_values_of_another_type_fail(spark, outdir, field, value):
    path = land(f"{outdir}/v", "a.json", json.dumps({"Id": "1"})[:-1] + f', "{field.split()[0]}": {value}}}\n')
    with pytest.raises(Exception):
        read_records(spark, path, f"Id string, {field}").collect()


def test_numbers_as_text(spark, outdir):
    path = land(f"{outdir}/n", "a.json", '{"Id": 1.50, "N": 1}\n')
    assert read_records(spark, path, string_fields(["Id"])).first()[0] == "1.5"
    assert read_records(spark, path, "Id string, N int").first()[0] == "1.5"


def page(records, indent=None, **more):
    return json.dumps({"totalSize": len(records), "done": True, "records": records} | more, indent=indent)


def test_a_page_is_split_between_tasks(spark, outdir):
    records = [{"attributes": ENV | {"url": f"/{i}"}, "Id": str(i), "Name": f'say \\"attributes\\" {{}} [ "attributes": é {i}', "Amount": i / 4} for i in range(20_000)]
    path = land(f"{outdir}/p", "page.json", page(records))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        df = read_records(spark, path, "Id string, Name string, Amount double", layout="pages")
        assert df.rdd.getNumPartitions() >= 8
        got = {r["Id"]: (r["Name"], r["Amount"]) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {r["Id"]: (r["Name"], r["Amount"]) for r in records}
    whole = read_records(spark, path, "Id string, Name string, Amount double", layout="whole_pages")
    assert whole.rdd.getNumPartitions() == 1 and whole.count() == 20_000


@pytest.mark.parametrize("indent", [None, 2])
def test_pages_of_each_shape(spark, outdir, indent):
    flat = [{"attributes": ENV, "Id": str(i), "Tags": ["a]", "{b"], "Name": None} for i in range(3)]
    path = land(f"{outdir}/s", "a.json", page(flat, indent, nextRecordsUrl="/x"))
    land(path, "b.json", page([], indent))
    land(path, "c.json", page([{"Id": "7", "Name": "no envelope"}], indent))
    land(path, "d.json", page([{"attributes": ENV, "Id": "8"}], indent) + "\n")
    rows = read_records(spark, path, "Id string, Name string, Tags array<string>", layout="pages").collect()
    assert sorted((r["Id"], r["Name"], r["Tags"]) for r in rows) == [("0", None, ["a]", "{b"]), ("1", None, ["a]", "{b"]), ("2", None, ["a]", "{b"]), ("7", "no envelope", None), ("8", None, None)]


@pytest.mark.parametrize("records", [
    [{"Id": "1", "attributes": ENV, "Name": "x"}, {"Id": "2", "attributes": ENV}],
    [{"attributes": ENV, "Id": "1", "Owner": {"attributes": ENV, "Name": "o"}}, {"attributes": ENV, "Id": "2"}],
    [{"attributes": ENV, "Id": "attributes"}, {"attributes": ENV, "Id": "2"}],
])
def test_pages_that_cannot_be_cut_fail(spark, outdir, records):
    path = land(f"{outdir}/x", "a.json", page(records))
    with pytest.raises(Exception):
        read_records(spark, path, string_fields(["Id", "Name"]), layout="pages").collect()
    whole = read_records(spark, path, string_fields(["Id", "Name"]), layout="whole_pages").collect()
    assert len(whole) == 2 and whole[0]["Id"] in ("1", "attributes")


def test_a_cut_off_page_fails(spark, outdir):
    text = page([{"attributes": ENV, "Id": str(i)} for i in range(5)])
    path = land(f"{outdir}/c", "a.json", text[:text.rindex('"Id"') + 3])
    with pytest.raises(Exception):
        read_records(spark, path, string_fields(["Id"]), layout="pages").collect()
