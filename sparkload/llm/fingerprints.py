"""Document fingerprints from closed syncmers, in DataFrame operations only.

Over a text's words (A-Z lower-cased), every run of ``K`` = 9 words has eight
inner pairs of neighbours.  The run is an anchor when its smallest pair, by
hash, is the first or the last one: a choice that looks at nothing outside the
run, so the same passage gives the same anchors wherever it stands.  Short
texts have few such runs, so texts of fewer than ``SHORT`` = 64 words also take
runs of three words (two pairs: one of them is the smallest, every run is an
anchor), and texts of fewer than ``LONG`` = 32 take these alone.  The
fingerprint is the 32-bit hashes of all anchors, short runs first, in text
order, as hexadecimal digits; a text without an anchor (under three words)
has the hash of its whole sequence of words.  Equal texts have equal
fingerprints.

The likeness of two fingerprints matches anchors by position: the anchors
they share are listed in the order of either text, and an anchor counts that
is followed by the same one in both lists (and one for the last).  A passage
that was moved as a whole thus keeps its anchors but for one.  The likeness is
twice their number over the number of different anchors of both texts (1 for
equal texts, 0 without a shared one).

Window minima and run hashes are built by doubling (2, 4, 8 neighbours), so
the work is linear in the text, however long.  Null texts are empty; texts
without words have equal fingerprints.  Repeated rows follow one another; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WORD, col, lower_ascii, stored, table, text_of

K, PAIRS = 9, 8
SHORT, LONG = 64, 32
#: Rows that a range of ids holds on average, and the most ranges: beyond,
#: ranges grow with the table.
RANGE_ROWS, RANGES = 1000, 65_536


def _slide(name: str, by: int, join) -> Column:
    """``join(x[i], x[i + by])`` for every i that has both."""
    x = F.col(name)
    n = F.greatest(F.size(x) - by, F.lit(0))
    return F.zip_with(F.slice(x, 1, n), F.slice(x, by + 1, n), join)


def _least(a: Column, b: Column) -> Column:
    return F.least(a, b)


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the anchors of column ``text``: an array of hashes in text
    order, all of them, repeats included."""
    kept = [c for c in df.columns if c != out]
    step = lambda d, **new: d.select(*kept, *[c for c in d.columns if c.startswith("__s_") and c not in new], *[v.alias(k) for k, v in new.items()])
    d = df.select(*kept, F.regexp_extract_all(lower_ascii(F.col(text)), F.lit(WORD), 0).alias("__s_w"))
    d = d.select(*kept, F.transform("__s_w", lambda w: F.xxhash64(w)).alias("__s_h"))
    d = step(d, __s_p=_slide("__s_h", 1, lambda a, b: F.xxhash64(a, b)))
    n = F.size("__s_h")
    fine = F.when(n < SHORT, F.transform(_slide("__s_p", 1, lambda a, b: F.xxhash64(a, b)), lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF))))
    d = step(d, __s_f=F.coalesce(fine, F.array().cast("array<bigint>")))
    d = step(d, __s_m=_slide("__s_p", 1, _least), __s_g=_slide("__s_p", 2, lambda a, b: F.xxhash64(a, b)))
    d = step(d, __s_m=_slide("__s_m", 2, _least), __s_g=_slide("__s_g", 4, lambda a, b: F.xxhash64(a, b)))
    d = step(d, __s_m=_slide("__s_m", 4, _least))
    first, last = (lambda i: F.get("__s_p", i)), (lambda i: F.get("__s_p", i + PAIRS - 1))
    low = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF))
    run = lambda m, i: F.when((first(i) == m) | (last(i) == m), low(F.xxhash64(F.get("__s_g", i), last(i))))
    coarse = F.filter(F.transform("__s_m", run), lambda x: x.isNotNull())
    d = step(d, __s_a=F.concat("__s_f", F.when(F.size("__s_h") >= LONG, coarse).otherwise(F.array().cast("array<bigint>"))))
    return d.select(*kept, F.when(F.size("__s_a") > 0, F.col("__s_a")).otherwise(F.array(low(F.xxhash64("__s_h")))).alias(out))


def fingerprint(anchors: Column) -> Column:
    return F.array_join(F.transform(anchors, lambda a: F.lpad(F.lower(F.hex(a)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    shared = lambda x, y: F.array_intersect(x, y)
    follows = lambda x: F.zip_with(F.slice(x, 1, F.greatest(F.size(x) - 1, F.lit(0))), F.slice(x, 2, F.size(x)), lambda p, q: F.shiftleft(p, 32).bitwiseOR(q))
    ours, theirs = shared(a, b), shared(b, a)
    same = F.when(F.size(ours) > 0, F.size(F.array_intersect(follows(ours), follows(theirs))) + 1).otherwise(0)
    both = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return 2.0 * same / both


def id_ranges(docs: DataFrame, range_rows: int = RANGE_ROWS, ranges: int = RANGES) -> Column:
    """The number of the range that a row's doc_id falls in, of about equal
    row counts (null: -1).  Only the ranges' limits, at most ``ranges``
    numbers, come to the driver; they are looked up in two steps."""
    n = docs.count()
    want = max(1, min(ranges, n // range_rows))
    shares = [i / want for i in range(1, want)]
    limits = sorted(set(docs.agg(F.percentile_approx(col(docs, "doc_id"), shares, max(10_000, 10 * want)).alias("q")).first().q or [])) if shares else []
    doc_id = col(docs, "doc_id")
    if not limits:
        return F.when(doc_id.isNull(), F.lit(-1)).otherwise(F.lit(0))
    width = max(1, int(len(limits) ** 0.5))
    chunks = [limits[i:i + width] for i in range(0, len(limits), width)]
    full = F.size(F.filter(F.lit([c[-1] for c in chunks]), lambda x: x <= doc_id))  # chunks wholly at or below the id
    inner = F.coalesce(F.get(F.array(*[F.lit(c) for c in chunks]), full), F.array().cast("array<bigint>"))
    return F.when(doc_id.isNull(), F.lit(-1)).otherwise(full * width + F.size(F.filter(inner, lambda x: x <= doc_id)))


def with_next(spark: SparkSession, docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, text, anchors, next_text, next_anchors: the next row is the one
    after it by descending doc_id (nulls last, ties by text), after the last
    the first.  One shuffle of the rows by id range; each range also gets a
    copy of the first row of the range that follows it."""
    rows = docs.select(col(docs, "doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    rows = rows.withColumn("part", id_ranges(rows, range_rows))
    tops = rows.groupBy("part").agg(F.max("doc_id").alias("top"))  # a row per range: at most RANGES + 2
    heads = rows.join(F.broadcast(tops), "part").where(F.col("doc_id").eqNullSafe(F.col("top")))
    heads = stored(spark, heads.groupBy("part", "doc_id").agg(F.min("text").alias("text")), "fingerprint_heads")
    down = W.orderBy(F.col("part").desc())
    after = heads.select("part", F.lead("part").over(down).alias("next"), F.max("part").over(W.partitionBy()).alias("top_part"))
    after = after.select(F.col("part").alias("of"), F.coalesce("next", "top_part").alias("part"))
    extra = heads.join(after, "part").select("doc_id", "text", F.col("of").alias("part"), F.lit(True).alias("extra"))
    rows = with_anchors(rows.withColumn("extra", F.lit(False)).unionByName(extra), "text", "anchors")
    order = W.partitionBy("part").orderBy("extra", F.col("doc_id").desc_nulls_last(), "text")
    rows = rows.select("doc_id", "text", "anchors", "extra", F.lead("text").over(order).alias("next_text"),
                       F.lead("anchors").over(order).alias("next_anchors"))
    return rows.where(~F.col("extra")).drop("extra")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(spark, table(spark, sf_dir, "documents"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "anchors", "next_anchors", edited.alias("edited"))
    rows = with_anchors(rows, "edited", "edited_anchors")
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("anchors")).alias("fingerprint"),
                       fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
                       likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
                       likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"))
