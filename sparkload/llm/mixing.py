"""Mixing sources to target weights, in DataFrame operations only.

1. One row per source with the words it holds (a partial aggregate, so a
   source with a third of all rows costs one row per map task).
2. Sources by code point (null last) weigh ``weights`` in turn and share
   ``share`` times all words.  A target stops at ``cap`` times its source's
   words; the excess is shared again by weight until none is above.
3. A document's rate is its source's target over its source's words.  It is
   emitted ``floor(rate)`` times, plus once more when a hash of the seed and
   its id, as a number in [0, 1), is below the fraction.  Nothing is drawn at
   random, so reruns and retried tasks agree.

Null texts have size 0.  A null source is a source of its own.  Rows that
repeat an id share its draw.  Empty documents get copies by the same rule but
add no words.  A very long text is one row like others; its copies stay
whole.  An empty table gives no rows.  Column names that start with
``__mix_`` are the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WORD, col, stored, text_of

WEIGHTS, SHARE, CAP, SEED = (3, 1, 2), 1.5, 2.0, "mix-1"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1): the first 52 bits of the md5 of seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def ranked(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank``, from 0, by code point of ``source``, null
    last.  The sort is a range shuffle; only the row counts of its partitions
    meet in one task."""
    ids = F.monotonically_increasing_id()
    rows = stored(spark, sources.orderBy(F.col("source").asc_nulls_last()).withColumn("at", ids), "mix_sources")
    rows = rows.withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", before.alias("before"))
    return rows.join(starts, "part").select("source", "source_size", (F.col("before") + F.col("at")).alias("rank"))


def targets(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per source: source, source_size, weight, target."""
    sizes = docs.groupBy(col(docs, "source").alias("source")).agg(F.sum(word_count(text_of(docs))).alias("source_size"))
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    rows = stored(spark, ranked(spark, sizes).withColumn("weight", turn), "mix_weights")
    level, full = None, -1
    while True:  # each round adds sources that reached their cap: one row of sums comes back
        above = F.lit(False) if level is None else F.col("weight") * F.lit(level) > F.col("source_size") * F.lit(cap)
        all_words, full_words, free_weight, n = rows.agg(
            F.sum("source_size"), F.sum(F.when(above, F.col("source_size")).otherwise(0)),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))), F.sum(above.cast("long"))).first()
        if n is None or n == full:
            break
        full = n
        if not free_weight:
            break
        level = (share * all_words - cap * full_words) / free_weight
    target = F.least(F.col("source_size") * F.lit(cap), F.col("weight") * F.lit(level or 0.0))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def mix(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP,
        seed: str = SEED) -> DataFrame:
    """``docs`` with ``__mix_source_size``, ``__mix_target`` and ``__mix_copies``.
    The source table is joined without a hint: Spark broadcasts it while its
    files are below the session's threshold and splits hot sources beyond."""
    plan = targets(spark, docs, weights, share, cap)
    plan = plan.select(F.col("source").alias("__mix_key"), F.col("source_size").alias("__mix_source_size"),
                       F.col("target").alias("__mix_target"))
    rate = F.when(F.col("__mix_source_size") > 0, F.col("__mix_target") / F.col("__mix_source_size")).otherwise(0.0)
    extra = (draw(col(docs, "doc_id"), seed) < rate - F.floor(rate)).cast("int")
    kept = [c for c in docs.columns if c not in ("__mix_source_size", "__mix_target", "__mix_copies")]
    joined = docs.select(*[col(docs, c) for c in kept]).join(plan, col(docs, "source").eqNullSafe(F.col("__mix_key")))
    return joined.drop("__mix_key").withColumn("__mix_copies", F.floor(rate).cast("int") + extra)


def emit(mixed: DataFrame) -> DataFrame:
    """Each row of ``mix`` as often as ``__mix_copies`` says, its own columns only."""
    own = [col(mixed, c) for c in mixed.columns if c not in ("__mix_source_size", "__mix_target", "__mix_copies")]
    return (mixed.where(F.col("__mix_copies") > 0)
            .withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(0), F.col("__mix_copies")))).select(*own))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import table

    mixed = mix(spark, table(spark, sf_dir, "documents"))
    size = word_count(text_of(mixed))
    return mixed.select("doc_id", size.alias("size"), F.col("__mix_source_size").alias("source_size"),
                        F.col("__mix_target").alias("target"), (size * F.col("__mix_copies")).alias("taken"),
                        F.col("__mix_copies").alias("copies"))


OP3_SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk FROM d GROUP BY source),
w AS (SELECT source, s, [{', '.join(map(str, WEIGHTS))}][(rnk % {len(WEIGHTS)}) + 1] AS weight FROM s),
o AS (SELECT source, s, weight, row_number() OVER (ORDER BY s / weight, source) AS k FROM w),
c AS (SELECT k, s, weight, coalesce(sum(s) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS full_words,
        (sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS free_weight,
        (sum(s) OVER ())::BIGINT AS all_words FROM o),
l AS (SELECT ({SHARE}::DOUBLE * all_words - {CAP}::DOUBLE * full_words) / free_weight AS level FROM c
      WHERE weight * (({SHARE}::DOUBLE * all_words - {CAP}::DOUBLE * full_words) / free_weight) <= s * {CAP}::DOUBLE ORDER BY k LIMIT 1),
t AS (SELECT source, s, least(s * {CAP}::DOUBLE, weight * (SELECT level FROM l)) AS target FROM w),
r AS (SELECT d.doc_id, d.size, t.s, t.target, CASE WHEN t.s > 0 THEN t.target / t.s ELSE 0 END AS rate,
        ('0x' || substr(md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT / {float(16**13)!r}::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, s AS source_size, target, (size * (floor(rate)::INT + (u < rate - floor(rate))::INT))::BIGINT AS taken,
  floor(rate)::INT + (u < rate - floor(rate))::INT AS copies FROM r
"""
