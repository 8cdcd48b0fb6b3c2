"""Plan shape: push-down, pruning, semi joins, no Python evaluation."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL

from sparkload.queries import QUERIES as Q
from sparkload.plans.explain import exchanges, plan_text, pushed_filters, python_nodes, read_schemas


def test_window_bounds_reach_the_scan(spark):
    pushed = " ".join(pushed_filters(Q["mtd_created"](spark, SF_SMALL)))
    assert "GreaterThanOrEqual(o_orderdate,2000-05-31T00:00)" in pushed
    assert "LessThanOrEqual(o_orderdate,2000-06-15T05:00)" in pushed
    pushed = " ".join(pushed_filters(Q["mtd_poll"](spark, SF_SMALL)))
    assert "LessThanOrEqual(ts,2024-01-15T04:40)" in pushed
    pushed = " ".join(pushed_filters(Q["last_n_years"](spark, SF_SMALL)))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in pushed


def test_projection_prunes_columns(spark):
    schemas = read_schemas(Q["project_columns"](spark, SF_SMALL))
    assert schemas == ["struct<o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>"]
    schemas = read_schemas(Q["watermark"](spark, SF_SMALL))
    assert schemas == ["struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>"]
    schemas = read_schemas(Q["distinct_keys"](spark, SF_SMALL))
    assert schemas == ["struct<o_custkey:bigint,o_orderdate:timestamp_ntz>"]


def test_cascade_is_a_broadcast_semi_join(spark):
    text = plan_text(Q["cascade_delta"](spark, SF_SMALL))
    assert "LeftSemi" in text and "BroadcastHashJoin" in text


def test_key_range_reaches_the_child_scan(spark):
    import re
    pushed = " ".join(pushed_filters(Q["cascade_delta"](spark, SF_SMALL)))
    low = re.search(r"GreaterThanOrEqual\(l_orderkey,(\d+)\)", pushed)
    high = re.search(r"LessThanOrEqual\(l_orderkey,(\d+)\)", pushed)
    assert low and high and int(low.group(1)) <= int(high.group(1))


def test_empty_key_set_reads_no_child(spark):
    from sparkload import operators as op
    keys = op.materialize_keys(spark, spark.range(0).withColumnRenamed("id", "o_orderkey"), "o_orderkey", "none")
    assert keys.count == 0 and keys.low is None
    child = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    out = op.cascade(child, keys, "l_orderkey", "o_orderkey")
    assert "FileScan" not in plan_text(out, "simple") and out.count() == 0


def test_snapshot_needs_no_shuffle(spark):
    assert exchanges(Q["snapshot_full"](spark, SF_SMALL)) == 0
    assert exchanges(Q["mtd_created"](spark, SF_SMALL)) == 0


def test_watermark_is_partial_then_final_max(spark):
    text = plan_text(Q["watermark"](spark, SF_SMALL), "simple")
    assert text.count("HashAggregate") == 2 and "partial_max" in text


@pytest.mark.parametrize("name", sorted(n for n in Q if not n.startswith(("job_", "load_", "catalog_"))))
def test_no_python_in_plans(spark, name):
    assert python_nodes(Q[name](spark, SF_SMALL)) == []


# Shuffle budget of each query: scans, windows and clean-up need none; a
# distinct or a global max needs one; cascades broadcast the key set and
# shuffle only for their distinct.  A change that adds an exchange fails here.
SHUFFLES = {
    "snapshot_full": 0, "project_columns": 0, "derived_column": 0, "mtd_created": 0, "mtd_poll": 0,
    "mtd_epoch": 0, "rolling_update_fixed": 0, "rolling_update_months": 0, "last_n_years": 0,
    "sanitize_text": 0, "records_scan": 0, "csv_roundtrip": 0, "distinct_keys_roundtrip": 0,
    "incr_delta_floor": 0, "semi_static": 0,
    "distinct_keys": 1, "catalog_allowlist": 2, "catalog_lower": 2, "distinct_rows": 1, "watermark": 1, "incr_delta": 1,
    "cascade_delta": 1, "cascade_delta_own": 1, "cascade_delta_floor": 1,
}
BROADCASTS = {"distinct_rows", "semi_static", "cascade_delta", "cascade_delta_own", "cascade_delta_floor"}


def test_every_query_has_a_shuffle_budget():
    assert set(SHUFFLES) == {n for n in Q if not n.startswith(("job_", "load_"))}


@pytest.mark.parametrize("name", sorted(SHUFFLES))
def test_shuffle_budget(spark, name):
    df = Q[name](spark, SF_SMALL)
    assert exchanges(df) == SHUFFLES[name]
    assert ("BroadcastExchange" in plan_text(df, "simple")) == (name in BROADCASTS)
