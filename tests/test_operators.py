"""Projection, clean-up, distinct, marks, delta and cascade operators."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkload import functions as fn
from sparkload import operators as op
from sparkload.context import RunContext
from sparkload.functions.windows import Marks

D = dt.datetime


def test_sanitize_only_strings(spark):
    df = spark.createDataFrame([(1, "a\\b\nc\rd", 2.5, True)], "id int, s string, x double, f boolean")
    row = fn.sanitize(df).collect()[0]
    assert row["s"] == "a/b c\rd" and row["x"] == 2.5 and row["f"] is True
    assert fn.sanitize(df).columns == df.columns


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab\\\n\r\" ,é")), max_size=12), min_size=1, max_size=8))
def test_sanitize_property(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, s string")
    got = {r["id"]: r["s"] for r in fn.sanitize(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == t.replace("\\", "/").replace("\n", " ")
        assert "\\" not in got[i] and "\n" not in got[i]


def test_select_columns_case_insensitive(spark):
    df = spark.createDataFrame([(1, "n", 3)], "Id int, Name string, ContactId int")
    assert op.select_columns(df, ["NAME", "ContactID", "id"]).columns == ["Name", "ContactId", "Id"]
    with pytest.raises(KeyError):
        op.select_columns(df, ["nope"])


def test_derived_and_envelope(spark):
    df = spark.createDataFrame([(("T", "/u"), 2, 3.0)], "attributes struct<type:string,url:string>, id int, q double")
    out = op.drop_envelope(op.with_derived(df, {"net": "q * 2"}))
    assert out.columns == ["id", "q", "net"] and out.collect()[0]["net"] == 6.0


def test_watermark_one_row_even_when_empty(spark):
    empty = spark.createDataFrame([], "created_at timestamp_ntz, updated_at timestamp_ntz")
    assert op.read_marks(empty) == Marks(None, None)
    only_created = spark.createDataFrame([(D(2024, 1, 1), None)], "created_at timestamp_ntz, updated_at timestamp_ntz")
    assert op.read_marks(only_created) == Marks(D(2024, 1, 1), None)


def test_marks_of_ltz_target_use_session_zone(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",)], "s string").selectExpr(
        "cast(s as timestamp) as created_at", "cast(s as timestamp) as updated_at")
    assert op.read_marks(df) == Marks(D(2024, 1, 1, 10), D(2024, 1, 1, 10))


def _family(spark):
    parent = spark.createDataFrame(
        [(1, D(2024, 1, 10), D(2024, 1, 10)), (1, D(2024, 1, 10), D(2024, 1, 10)),  # duplicate row
         (2, D(2023, 1, 1), D(2024, 1, 11)), (3, D(2023, 1, 1), D(2023, 6, 1)), (None, D(2024, 1, 12), None)],
        "id long, created_at timestamp_ntz, updated_at timestamp_ntz")
    child = spark.createDataFrame(
        [(10, 1, D(2024, 1, 10), None), (10, 1, D(2024, 1, 10), None),  # duplicate child row
         (11, 2, D(2022, 1, 1), D(2022, 1, 1)), (12, 3, D(2024, 1, 11), None), (13, None, D(2024, 1, 11), None),
         (14, 4, D(2024, 1, 11), None)],
        "cid long, parent_id long, created_at timestamp_ntz, updated_at timestamp_ntz")
    return parent, child


def test_delta_and_cascade(spark):
    parent, child = _family(spark)
    marks = Marks(D(2024, 1, 10), D(2024, 1, 11))
    ctx = RunContext(as_of=D(2024, 1, 15))
    delta = op.delta(parent, marks, ctx, distinct=True)
    assert sorted((r["id"] or 0) for r in delta.collect()) == [0, 1, 2]
    keys = op.delta_keys(delta, "id")
    kids = op.cascade(child, keys, "parent_id", "id", distinct=True)
    assert sorted(r["cid"] for r in kids.collect()) == [10, 11]  # null and orphan keys never match
    own = fn.watermark_delta(child, marks, ctx)
    kids_own = op.cascade(child, keys, "parent_id", "id", own_delta=own, distinct=True)
    assert sorted(r["cid"] for r in kids_own.collect()) == [10]


def test_cascade_strategies_agree(spark):
    parent, child = _family(spark)
    keys = op.delta_keys(parent.where("id is not null"), "id")
    want = sorted(tuple(r) for r in op.cascade(child, keys, "parent_id", "id").collect())
    shuffled = op.cascade(child, keys, "parent_id", "id", max_broadcast_keys=0)
    salted = op.cascade(child, keys, "parent_id", "id", max_broadcast_keys=0, salt_buckets=4)
    assert sorted(tuple(r) for r in shuffled.collect()) == want
    assert sorted(tuple(r) for r in salted.collect()) == want


def test_broadcast_only_under_the_bound(spark):
    parent, child = _family(spark)
    keys = op.delta_keys(parent, "id")
    small = op.semi_join(child, keys, "parent_id", "id", key_count=3, max_broadcast_keys=10)
    big = op.semi_join(child, keys, "parent_id", "id", key_count=30, max_broadcast_keys=10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in _plan(small)
        assert "BroadcastHashJoin" not in _plan(big) and "LeftSemi" in _plan(big)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 40), st.integers(0, 40)), min_size=1, max_size=25),
       st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3)), min_size=0, max_size=25))
def test_increment_properties(spark, parents, children):
    base = D(2024, 1, 1)
    pdf = spark.createDataFrame([(i, base + dt.timedelta(days=c), base + dt.timedelta(days=u)) for i, c, u in parents],
                                "id long, created_at timestamp_ntz, updated_at timestamp_ntz")
    cdf = spark.createDataFrame(children, "parent_id long, v long")
    marks = Marks(base + dt.timedelta(days=20), base + dt.timedelta(days=30))
    ctx = RunContext(as_of=D(2024, 3, 1))
    d1 = sorted(tuple(r) for r in op.delta(pdf, marks, ctx).collect())
    d2 = sorted(tuple(r) for r in op.delta(pdf, marks, ctx).collect())
    assert d1 == d2  # same marks, same rows
    keys = {r[0] for r in d1}
    kids = op.cascade(cdf, op.delta_keys(op.delta(pdf, marks, ctx), "id"), "parent_id", "id").collect()
    assert all(k["parent_id"] in keys for k in kids)  # every child's parent is in the delta
    assert len(kids) == len({(p, v) for p, v in children if p in keys})


def test_hot_parent_key_is_split_by_aqe(spark):
    """A parent key owning about half the child rows, shuffle path: AQE
    splits the hot partition (needs several map tasks, as any large input
    has), also when the child's distinct follows the join."""
    from pyspark.sql import functions as F
    tiny = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in tiny.items():
        spark.conf.set(k, v)
    try:
        li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").repartition(8)
        child = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 2, F.lit(7)).otherwise(F.col("l_orderkey")))
        keys = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select("o_orderkey")
        out = op.cascade(child, keys, "l_orderkey", "o_orderkey", key_count=10**9, max_broadcast_keys=0)
        rows = out.collect()
        assert len(rows) == child.distinct().count()
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in tiny:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_salt_spreads_identical_copies_and_is_repeatable(spark):
    """A group of identical rows (a third of a table, say) held by many input
    splits gets many salts, and computing the salts again gives the same."""
    from sparkload.operators.semijoin import row_salt
    copies = spark.range(0, 8000, numPartitions=8).selectExpr("7 AS parent_id", "'same' AS body")
    salted = copies.select(row_salt(copies, 8).alias("salt"))
    first = sorted(tuple(r) for r in salted.groupBy("salt").count().collect())
    assert len(first) >= 4  # not one reducer for all copies
    assert first == sorted(tuple(r) for r in salted.groupBy("salt").count().collect())
    with_map = spark.range(3).selectExpr("id AS parent_id", "map('k', id) AS m")
    assert with_map.select(row_salt(with_map, 4).alias("s")).count() == 3


def test_key_range_only_for_exact_literal_types(spark):
    import datetime as dt

    from sparkload.plans.explain import plan_text
    child = spark.range(1).selectExpr("timestampadd(HOUR, id, timestamp_ntz'2024-01-01 10:00:00') AS k", "1 AS v")
    keys = spark.sql("SELECT timestamp_ntz'2024-01-01 10:00:00' AS k")
    t = dt.datetime(2024, 1, 1, 10)
    out = op.semi_join(child, keys, "k", "k", key_count=1, key_range=(t, t))
    assert out.count() == 1 and " >= " not in plan_text(out, "simple")  # no range filter
    ids = spark.range(10).withColumnRenamed("id", "k")
    kept = op.semi_join(ids, ids.where("k in (3, 5)"), "k", "k", key_count=2, key_range=(3, 5))
    assert sorted(r.k for r in kept.collect()) == [3, 5]
    assert " >= 3)" in plan_text(kept, "simple")  # the range filter
