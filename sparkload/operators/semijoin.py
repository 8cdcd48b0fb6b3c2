"""Child-of-changed-parent semi join (J1-J4) with a checked broadcast.

``child WHERE child_key IN (SELECT DISTINCT key FROM parent_delta)`` is a
left semi join; ``IN`` and an equi join agree that a null key never matches.

Strategy, decided on the driver from a **counted** key set:

* keys ≤ ``max_broadcast_keys`` and ≤ ``MAX_BROADCAST_BYTES``: broadcast hash semi join.  The child is
  filtered where it lies, with no shuffle, so a parent key that owns a third
  of the child rows costs nothing extra.
* more keys (a first load, or a very busy day): shuffle both sides on the
  key.  A hot key then lands in one reducer; AQE's skew-join rule splits
  that partition (``spark.sql.adaptive.skewJoin.enabled``), and with
  ``salt_buckets`` the split is explicit and deterministic instead: the hot
  keys are found by a sketch over the child's key column (``hot_keys``), their
  child rows get a salt in ``[0, n)`` (``row_salt``) and they alone are repeated
  once per salt with ``explode`` (no cross join), so each spreads over ``n``
  tasks while the other keys are shuffled once, as they are.  The salt is a
  hash of the row and its input partition, not ``rand()``, so a retried task
  recomputes the same partitioning.

Either way the child is first filtered by the key set's intervals (J1-J4's
keys cover few stretches of a child that is much larger), which reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .intervals import Interval, within

# 2M long keys build a broadcast hash relation of a few tens of MB.  Wide
# keys are bounded by their bytes as well.
DEFAULT_MAX_BROADCAST_KEYS = 2_000_000
MAX_BROADCAST_BYTES = 64 << 20
_SALT = "__sparkload_salt"
# Hot keys looked for at most, and the keys the sketch tracks for it (a few
# hundred KB a task).
MAX_HOT_KEYS = 128
TRACKED_KEYS = 10_000
# Key types whose collected min/max turn back into the same literal (a
# timestamp would pass through the driver's local zone).
_EXACT_LITERAL_TYPES = (T.NumericType, T.StringType, T.DateType)


def row_salt(df: DataFrame, buckets: int) -> Column:
    """A salt in ``[0, buckets)`` for each row: a hash of the row and of its
    input partition.  Deterministic, so a retried task routes its rows as the
    first attempt did; the partition id spreads identical copies of a row
    held by different input splits over different salts (a hash of the row
    alone would send every copy to one reducer).  Map columns, which Spark
    cannot hash, are left out of the hash."""
    hashable = [df[f.name] for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.pmod(F.xxhash64(*hashable, F.spark_partition_id()), F.lit(buckets))


def hot_keys(child: DataFrame, child_key: str, partitions: int) -> list | None:
    """The keys that own more than a shuffle partition's share of the child's
    rows (at most ``MAX_HOT_KEYS``), by a frequent-items sketch: one scan of
    the key column, combined map-side.  ``None`` for types whose values do not
    come back as the same literals.  The sketch only picks what is salted,
    never which rows match."""
    if not isinstance(child.schema[child_key].dataType, _EXACT_LITERAL_TYPES):
        return None
    only = child.select(child[child_key].alias("k"))
    row = only.agg(F.expr(f"approx_top_k(k, {MAX_HOT_KEYS}, {TRACKED_KEYS})").alias("top"), F.count("k").alias("n")).first()
    return [r["item"] for r in row["top"] or () if r["item"] is not None and r["count"] * partitions > row["n"]]


def _join_condition(child: DataFrame, child_key: str, keys: DataFrame, key: str) -> Column:
    return child[child_key] == keys[key]


def semi_join(
    child: DataFrame,
    keys: DataFrame,
    child_key: str,
    key: str,
    key_count: int | None = None,
    max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS,
    salt_buckets: int | None = None,
    key_range: tuple | None = None,
    key_bytes: int | None = None,
    key_intervals: Sequence[Interval] = (),
    text_ranges: bool = True,
) -> DataFrame:
    """Rows of ``child`` whose ``child_key`` is in ``keys[key]``.

    ``keys`` should already be distinct and, when reused, materialized.
    ``key_count`` is its row count if known (e.g. observed while it was
    written); otherwise it is counted here, which is cheap on a
    materialized key set, together with ``key_bytes``, the keys' size as
    text.  ``key_range`` is the keys' ``(min, max)``: a
    matching child key lies in it, so the range is applied to the child
    first, where it reaches the scan (parquet row-group skipping, a ``WHERE``
    on the source's index); ``(None, None)`` is an empty key set, which
    plans as an empty relation without reading the child.  ``key_intervals``
    (disjoint, holding every key) are applied in its place.  With
    ``text_ranges=False`` text keys are not compared by order: a source that
    evaluates the filter may order texts by a collation of its own.
    """
    if key_range is not None:
        low, high = key_range
        dtype = keys.schema[key].dataType
        if low is None:
            child = child.where(F.lit(False))
        elif isinstance(dtype, _EXACT_LITERAL_TYPES) and (text_ranges or not isinstance(dtype, T.StringType)):
            child = child.where(within(child[child_key], key_intervals or [(low, high)]))
    keys = keys.select(keys[key])
    small = key_count is None or key_count <= max_broadcast_keys
    if small and (key_count is None or key_bytes is None):
        key_count, key_bytes = keys.agg(F.count(F.lit(1)), F.sum(F.octet_length(keys[key].cast("string")))).first()
        small = key_count <= max_broadcast_keys
    if small and (key_bytes or 0) <= MAX_BROADCAST_BYTES:
        return child.join(F.broadcast(keys), _join_condition(child, child_key, keys, key), "left_semi")
    if not salt_buckets or salt_buckets <= 1:
        return child.join(keys, _join_condition(child, child_key, keys, key), "left_semi")
    hot = hot_keys(child, child_key, int(child.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if hot == []:
        return child.join(keys, _join_condition(child, child_key, keys, key), "left_semi")
    salt, salts = row_salt(child, salt_buckets), F.sequence(F.lit(0), F.lit(salt_buckets - 1))
    if hot:
        salt = F.when(child[child_key].isin(hot), salt).otherwise(F.lit(0))
        salts = F.when(keys[key].isin(hot), salts).otherwise(F.array(F.lit(0)))
    salted_child = child.withColumn(_SALT, salt)
    salted_keys = keys.select(keys[key], F.explode(salts).alias(_SALT))
    cond = (salted_child[child_key] == salted_keys[key]) & (salted_child[_SALT] == salted_keys[_SALT])
    return salted_child.join(salted_keys, cond, "left_semi").drop(_SALT)
