"""Near-duplicates by word shingles: fast similarity sketches, banding, exact
verification, and connected components.

Sketch.  A set is hashed into ``BANDS * ROWS`` bins in rounds: in each round
every element falls into one bin with a value; a bin keeps the smallest value
of the first round that reached it.  Rounds go on until every bin is filled; after
as many rounds as bins, round ``i`` fills bin ``i`` itself, so all bins fill for
any set.  Two sets agree in a bin with the probability of their similarity, and
the number of equal bins is concentrated around it.

Candidates.  Documents with equal sets are one class, and its smallest id
stands for it.  Classes that share a band's bins (a bucket) are candidates.
Within a bucket each member is first compared with the smallest one: as many
pairs as members.  After the components of the confirmed links are known, only
buckets that still hold several components matter: there, members of different
components are compared, all of them in buckets of up to ``SMALL`` members.  In
larger ones the members go through an exact join on their rarest shingles (the
prefix and positional filters), which misses no link.  So a group of
thousands of near copies, or of texts around one passage, never becomes all of
its pairs, and nothing is dropped.

A link is confirmed on the full sets: 100 * common >= 80 * union, on 64-bit
shingle hashes.  The one chance of a miss is a pair that shares no band: at
similarity 0.8, (1 - 0.8 ** 6) ** 50 = 3e-7, far less above.

Components come from alternating large-star and small-star rounds over the
links.  Every round's result is written to the shared folder.

A document with fewer than ``k`` words has its whole sequence as one shingle.
One without words (or with a null text) has an empty set, links to nothing and
stays.  Rows with the same id count as one document: they are linked when any
of their texts is.  A null id never stands for a class that has another id.

``dedup`` compares rows, not ids: every row gets a key of its own, and one row
of each group stays, that with the smallest id (nulls last, then by key).  The
column name ``__mh_key`` is its own.

A very long text is sketched whole by one task; an empty table gives no rows;
other columns are ignored by ``groups`` and kept by ``dedup``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, WORD, col, map_batches, stored, table

BANDS, ROWS, SMALL, PERCENT = 50, 6, 16, 80
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, on whole arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, k: int) -> np.ndarray:
    """The distinct 64-bit hashes of a text's k-word shingles, sorted."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n, out = max(1, len(words) - k + 1), None
    for j in range(min(k, len(words))):
        part = h[j:j + n]
        out = mix(part + _ODD) if out is None else mix((out + _ODD) ^ part)
    return np.unique(out)


_SEEDS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * _ODD)


def sketch(items: np.ndarray, bins: int = BANDS * ROWS) -> np.ndarray:
    """The sketch of a set of hashes: in each bin (round, value) in one number."""
    out = np.full(bins, np.iinfo(np.uint64).max)
    step = max(1, 1024 // len(items))
    for start in range(0, bins, step):  # rounds with random bins, some at a time
        rounds = np.arange(start, min(start + step, bins))
        x = mix(items[None, :] ^ _SEEDS[rounds][:, None])
        value = (rounds.astype(np.uint64)[:, None] << np.uint64(32)) | (x & np.uint64(0xFFFFFFFF))
        np.minimum.at(out, (((x >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).ravel().astype(np.int64), value.ravel())
        if out.max() < np.iinfo(np.uint64).max:
            return out
    for b in np.flatnonzero(out == np.iinfo(np.uint64).max):  # one round for each bin left
        out[b] = (np.uint64(bins + b) << np.uint64(32)) | (mix(items ^ _SEEDS[bins + b]) & np.uint64(0xFFFFFFFF)).min()
    return out


def band_keys(sketched: np.ndarray) -> np.ndarray:
    """A key for each band: a hash of its number and its bins."""
    rows = sketched.reshape(BANDS, ROWS)
    key = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD)
    for j in range(ROWS):
        key = mix(key ^ rows[:, j])
    return key.view(np.int64)


def _list_array(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, digest (of the set; null if empty), bands."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, digests, bands = [], [], []
        for text in batch.column("text").to_pylist():
            items = shingles(text, k)
            n.append(len(items))
            digests.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
            bands.append(band_keys(sketch(items)) if len(items) else np.empty(0, np.int64))
        return pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), _list_array(bands)], ["doc_id", "n_shingles", "digest", "bands"])

    texts = docs.select(col(docs, "doc_id").cast("long").alias("doc_id"), col(docs, "text").alias("text"))
    return map_batches(texts, rows, "doc_id long, n_shingles long, digest binary, bands array<long>")


def full_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """id, items: the full sets of the documents in ``ids``."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column("id"), _list_array([shingles(t, k) for t in batch.column("text").to_pylist()])], ["id", "items"])

    texts = docs.select(col(docs, "doc_id").cast("long").alias("id"), col(docs, "text").alias("text"))
    return map_batches(texts.join(ids, "id", "left_semi"), rows, "id long, items array<long>")


def similar(common: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * common >= percent * (a + b - common)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("items_b"))
    both = pairs.join(left, "a").join(right, "b")
    na, nb, common = F.size("items_a"), F.size("items_b"), F.size(F.array_intersect("items_a", "items_b"))
    could = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    return both.where(F.when(could, similar(common, na, nb, percent)).otherwise(False)).select("a", "b").distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """id, component (its smallest id) of every id in the links (a, b)."""
    def down(d, u, v):
        return d.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct()

    edges, seen = stored(spark, down(links, "a", "b"), "minhash_edges"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = down(both.join(least, "u").where("v > u").select("v", "m"), "v", "m")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("v", "m").unionByName(least.select(F.col("u").alias("v"), "m"))
        edges = stored(spark, down(small, "v", "m"), "minhash_edges")


def _labelled(members: DataFrame, found: DataFrame) -> DataFrame:
    """``members`` with the component of their id (itself if it has no link)."""
    return members.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _rare_pairs(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that can be similar: they share a shingle
    among the rarest of both, and the shingles from there on, in the order of
    rarity, are enough for the similarity asked for (exact filters: the first
    shingle that a similar pair shares meets them)."""
    rows = sets.join(labels, "id").select("id", "component", F.size("items").alias("n"), F.explode("items").alias("item"))
    counts = rows.groupBy("item").agg(F.count(F.lit(1)).alias("c"), F.min("component").alias("low"), F.max("component").alias("high"))
    rows = rows.join(counts, "item")
    entry = F.struct("c", "item", (F.col("low") != F.col("high")).alias("mixed"))
    rows = rows.groupBy("id", "component", "n").agg(F.array_sort(F.collect_list(entry)).alias("items"))
    need = F.ceil(F.col("n") * percent / 100).cast("int")
    rows = rows.select("id", "component", "n", F.posexplode(F.slice("items", 1, F.col("n") - need + 1)).alias("at", "e")).where("e.mixed")
    a = rows.select(F.col("id").alias("a"), F.col("component").alias("ca"), (F.col("n") - F.col("at")).alias("left_a"), F.col("n").alias("na"), F.col("e.item").alias("item"))
    b = rows.select(F.col("id").alias("b"), F.col("component").alias("cb"), (F.col("n") - F.col("at")).alias("left_b"), F.col("n").alias("nb"), F.col("e.item").alias("item"))
    close = ((100 + percent) * F.least("left_a", "left_b") >= percent * (F.col("na") + F.col("nb"))) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
    return a.join(b, "item").where(close).select("a", "b").distinct()


def groups(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = PERCENT, small: int = SMALL) -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    rows = stored(spark, sketches(docs, k), "minhash_rows")
    classes = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("id"), F.any_value("bands").alias("bands"))
    classes = stored(spark, classes.where("id IS NOT NULL"), "minhash_classes")
    members = classes.select("id", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where("n > 1")
    members = stored(spark, members.join(buckets, "bucket"), "minhash_members")  # without buckets of one
    pairs = members.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    sets = stored(spark, full_sets(docs, members.select("id").distinct(), k), "minhash_sets")
    links = stored(spark, confirmed(pairs, sets, percent), "minhash_links")
    found = stored(spark, components(spark, links), "minhash_components")

    rest = _labelled(members.where("n > 2"), found)
    open_buckets = rest.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    rest = stored(spark, rest.join(open_buckets, "bucket", "left_semi"), "minhash_open")
    a = rest.where(F.col("n") <= small).where("id <> first").select("bucket", F.col("id").alias("a"), F.col("component").alias("ca"))
    b = a.select("bucket", F.col("a").alias("b"), F.col("ca").alias("cb"))
    pairs = a.join(b, "bucket").where("a < b AND ca <> cb").select("a", "b").distinct()
    crowded = rest.where(F.col("n") > small).select("id", "component").distinct()
    pairs = pairs.unionByName(_rare_pairs(sets, crowded, percent)).distinct()
    more = stored(spark, confirmed(pairs, sets, percent), "minhash_more")
    if more.take(1):
        joined = found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more)
        found = stored(spark, components(spark, joined), "minhash_components")

    classes = _labelled(classes.select("digest", "id"), found).select("digest", F.col("component").alias("component_id"))
    classes = stored(spark, classes, "minhash_labels")
    return (rows.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def dedup(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near-duplicate rows, whatever their ids."""
    rows = stored(spark, docs.withColumn("__mh_key", F.monotonically_increasing_id()), "minhash_keyed")  # once: a rerun may number anew
    keyed = rows.select(F.col("__mh_key").alias("doc_id"), col(rows, "text").alias("text"))
    found = groups(spark, keyed, k, percent).select(F.col("doc_id").alias("__mh_key"), "component_id")
    found = stored(spark, found.join(rows.select("__mh_key", col(rows, "doc_id").alias("id")), "__mh_key"), "minhash_found")
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("__mh_key"))
    kept = found.groupBy("component_id").agg(F.min(order).alias("least")).select(F.col("least.__mh_key").alias("__mh_key"))
    gone = stored(spark, found.select("__mh_key").join(kept, "__mh_key", "left_anti"), "minhash_gone")
    return rows.join(gone, "__mh_key", "left_anti").drop("__mh_key")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = groups(spark, table(spark, sf_dir, "documents"), k=2)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


OP9_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS x FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS MATERIALIZED (SELECT doc_id, (dense_rank() OVER (ORDER BY x))::INT AS x FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM i a JOIN i b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= {PERCENT} * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, v.b FROM reach r JOIN both_ways v ON r.other = v.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(other) AS component_id, d.doc_id = min(other) AS kept
FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""
