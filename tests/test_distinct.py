"""Distinct rows by digest (A1)."""

from __future__ import annotations

import random

import pytest
from conftest import SF_CHECK
from pyspark.sql import functions as F

from sparkload import operators as op
from sparkload.plans.explain import plan_text


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_equal_to_distinct(spark):
    r = random.Random(2)
    values = [(r.choice([None, 1, 2]), r.choice([None, "", "a", "b"]), r.choice([0.0, -0.0, float("nan"), 1.5, None]), r.choice([None, b"x", b""])) for _ in range(400)]
    df = spark.createDataFrame(values, "`a.b` int, s string, d double, x binary").repartition(6)
    got, want = op.distinct_by_digest(spark, df), df.distinct()
    norm = lambda d: rows_of(d.withColumn("d", F.col("d") + 0.0))
    assert norm(got) == norm(want) and got.columns == df.columns
    assert norm(op.distinct_by_digest(spark, df, max_repeated=3)) == norm(want)
    assert op.distinct_by_digest(spark, df.limit(0)).count() == 0
    unique = spark.range(100)
    assert op.distinct_by_digest(spark, unique).count() == 100


def test_collisions_are_compared_in_full(spark, monkeypatch):
    from sparkload.operators import distinct
    monkeypatch.setattr(distinct, "_digest", lambda df: F.col("k") % 7)
    df = spark.range(300).selectExpr("id % 150 AS k", "id % 2 AS v")
    assert rows_of(op.distinct_by_digest(spark, df)) == rows_of(df.distinct())


def test_nested_and_map_columns(spark):
    nested = spark.sql("SELECT array(1.0D, -0.0D) AS a UNION ALL SELECT array(1.0D, 0.0D)")
    assert op.distinct_by_digest(spark, nested).count() == nested.distinct().count()
    with pytest.raises(TypeError):
        op.distinct_by_digest(spark, spark.sql("SELECT map('a', 1) AS m"))


def shuffle_bytes(df) -> int:
    """What the exchanges of an executed plan wrote, by their own metrics."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    total, nodes = 0, [plan]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            nodes.append(node.plan())
            continue
        if node.nodeName() == "Exchange":
            total += node.metrics().get("shuffleBytesWritten").get().value()
        kids = node.children()
        nodes += [kids.apply(i) for i in range(kids.size())]
    return total


def test_shuffle_of_nearly_unique_rows(spark, monkeypatch):
    li = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet")
    df = li.unionAll(li.where("l_orderkey % 1000 = 0"))
    from sparkload.operators import distinct
    counts = []
    keep = distinct.materialize
    monkeypatch.setattr(distinct, "materialize", lambda s, d, name: counts.append(shuffle_bytes(d)) or keep(s, d, name))
    out = op.distinct_by_digest(spark, df)
    text = plan_text(out, "simple")
    assert text.count("Exchange hashpartitioning") == 1 and "LeftAnti" in text and "LeftSemi" in text
    plain = shuffle_bytes(df.distinct())
    assert 0 < counts[0] + shuffle_bytes(out) < plain / 3
    assert out.count() == li.distinct().count()
