"""Target-distribution importance resampling over hashed n-grams.

Features are all runs of 1 to ``GRAMS`` consecutive words, joined by a space;
a feature's bucket is the CRC-32 of its bytes modulo ``BUCKETS``.  A bucket's
gain is the log ratio of its smoothed shares in the target and in the corpus; a
document's weight is the mean gain of its features; adding Gumbel noise (from a
hash of the id) and taking the highest scores draws without replacement in
proportion to the weights' exponentials.

Tasks work on batches: the batch's texts are joined by a byte that UTF-8 never
has, one regex pass finds all words, the number of each word's document comes
from a search in the documents' offsets, which masks n-grams across documents,
and buckets are counted at once.  The CRC of an n-gram is put together from those of
its different words (shifting a CRC by a length is linear in it).  A text longer
than ``SLICE`` is taken in slices between words; the last words of one are
carried into the next, so no n-gram is lost.

The corpus is read twice, once for the counts and once for the weights;
texts are never shuffled.  Ranks come from a range shuffle of the scores with a
unique key each (the place of the row in its task, stored), so rows of one score
or id spread evenly, and the sum of the partitions before.

Null texts have no words: no features and weight 0.  Documents with fewer than
``WORDS`` words are never drawn.  A null id is hashed as the empty text and
comes last among ties; rows that repeat an id are drawn one by one, ties after
the id by order in the table.  Empty tables: no rows; an empty target has no
features (t = T = 0).  Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import col, map_partitions, stored, table

GRAMS, BUCKETS, PERCENT, WORDS, SEED = 2, 10_000, 25, 20, 7
#: Bytes of text that are joined at a time.
SLICE = 4 << 20
_SENTINEL = b"\xff"
_WORD = re.compile(rb"[0-9a-z\x80-\xf4]+")
_WORD_OR_END = re.compile(_WORD.pattern + b"|" + _SENTINEL)
_GAP = re.compile(rb"[^0-9a-z\x80-\xf4]")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_ROW = (1 << 33) - 1


@cache
def _steps() -> np.ndarray:
    """CRC-32 of a byte, from the polynomial 0xEDB88320."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1)
    return one


@cache
def _shift_table(length: int) -> np.ndarray:
    """What each of a CRC's four bytes becomes after ``length`` zero bytes."""
    if length == 0:
        return (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None])
    if length == 1:
        out = _shift_table(0)
        return _steps()[out & 0xFF] ^ (out >> 8)
    half = _shift_table(length // 2)
    out = _apply(half, half)
    return _apply(_shift_table(1), out) if length % 2 else out


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 0xFF] ^ table[1][crc >> 8 & 0xFF] ^ table[2][crc >> 16 & 0xFF] ^ table[3][crc >> 24]


def shifted(crc: np.ndarray, lengths: np.ndarray, size: int = 64) -> np.ndarray:
    """``crc`` after as many zero bytes as ``lengths`` has."""
    tables = np.stack([_shift_table(n) for n in range(size)])
    short = np.minimum(lengths, size - 1)
    out = tables[short, 0, crc & 0xFF] ^ tables[short, 1, crc >> 8 & 0xFF] ^ tables[short, 2, crc >> 16 & 0xFF] ^ tables[short, 3, crc >> 24]
    for n in np.unique(lengths[lengths >= size]).tolist():
        some = lengths == n
        out[some] = _apply(_shift_table.__wrapped__(n), crc[some])
    return out


def joined(texts: list[bytes], size: int) -> Iterator[tuple[list[int], list[bytes], int]]:
    """Parts of about ``size`` bytes at most to join: the numbers of their
    documents, their texts, and how many first words were in the part before
    (of a document that is taken in slices)."""
    numbers, part, n = [], [], 0
    for i, text in enumerate(texts):
        if len(text) > size:
            if part:
                yield numbers, part, 0
                numbers, part, n = [], [], 0
            at, carried = 0, []
            while at < len(text):
                gap = _GAP.search(text, at + size)
                end = gap.end() if gap else len(text)
                piece = text[at:end]
                yield [i], [b" ".join([*carried, piece])], len(carried)
                carried = (carried + _WORD.findall(piece))[-(GRAMS - 1):] if GRAMS > 1 else []
                at = end
            continue
        numbers.append(i)
        part.append(text)
        n += len(text) + 1
        if n >= size:
            yield numbers, part, 0
            numbers, part, n = [], [], 0
    if part:
        yield numbers, part, 0


def features(texts: list[bytes | None], size: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """For n-grams of each length: their documents' numbers and their buckets,
    and whether they are single words."""
    lower = [(t or b"").translate(_LOWER) for t in texts]
    for numbers, part, carried in joined(lower, size):
        found = pa.array(_WORD_OR_END.findall(_SENTINEL.join(part)), pa.binary()).dictionary_encode()
        words, code = found.dictionary.to_pylist(), found.indices.to_numpy()
        between = code == (words.index(_SENTINEL) if _SENTINEL in words else -1)
        offsets, code = np.flatnonzero(between) - np.arange(between.sum()), code[~between]
        if not len(code):
            continue
        crc = np.array([zlib.crc32(w) for w in words], np.uint32)[code]
        spaced = np.array([zlib.crc32(w + b" ") for w in words], np.uint32)[code]
        length = np.array([len(w) for w in words], np.int64)[code]
        doc = np.array(numbers)[np.searchsorted(offsets, np.arange(len(code)), "right")]
        gram = spaced  # of n - 1 words and a space
        yield doc[carried:], crc[carried:] % BUCKETS, True
        for n in range(2, GRAMS + 1):
            if len(code) < n:
                break
            prefix, last = gram[:len(code) - n + 1], slice(n - 1, None)
            value = shifted(prefix, length[last]) ^ crc[last]
            gram = shifted(prefix, length[last] + 1) ^ spaced[last] if n < GRAMS else gram
            within = doc[:len(code) - n + 1] == doc[last]
            within[:max(0, carried - n + 1)] = False  # wholly in the slice before
            yield doc[:len(code) - n + 1][within], value[within] % BUCKETS, False


def bucket_counts(docs: DataFrame) -> DataFrame:
    """bucket, n over all texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, bucket, _ in features(batch.column("text").to_pylist()):
                n += np.bincount(bucket, minlength=BUCKETS)
        some = np.flatnonzero(n)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(n[some])], ["bucket", "n"])

    texts = docs.select(col(docs, "text").cast("binary").alias("text"))
    return map_partitions(texts, rows, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of each bucket; the driver gets the counts by bucket."""
    s, t = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for counts, frame in ((s, docs), (t, target)):
        for r in bucket_counts(frame).collect():
            counts[r.bucket] = r.n
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_features, weight (and text) of every row, and its
    place: part, row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            n_words, n_features, total = (np.zeros(n, np.int64) for _ in range(3))
            for doc, bucket, single in features(batch.column("text").to_pylist()):
                counts = np.bincount(doc, minlength=n)
                n_words += counts * single
                n_features += counts
                total += np.bincount(doc, gains[bucket], n).astype(np.int64)  # sums of integers, exact
            weight = np.where(n_features > 0, total // np.maximum(n_features, 1), 0)
            out = [batch.column("doc_id"), pa.array(n_words), pa.array(n_features), pa.array(weight), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(row, row + n))]
            row += n
            names = ["doc_id", "n_words", "n_features", "weight", "part", "row"]
            yield pa.record_batch(out + [batch.column("text").cast(pa.string())] * with_text, names + ["text"] * with_text)

    texts = docs.select(col(docs, "doc_id").cast("long").alias("doc_id"), col(docs, "text").cast("binary").alias("text"))
    return map_partitions(texts, rows, "doc_id long, n_words long, n_features long, weight long, part int, row long" + ", text string" * with_text)


def draw(spark: SparkSession, weighed: DataFrame, percent: int = PERCENT, least_words: int = WORDS, seed: int = SEED) -> DataFrame:
    """Adds score and rank (null where not drawn) to the stored rows of
    ``weigh``."""
    weighed = stored(spark, weighed, "weights")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    scored = weighed.withColumn("score", F.col("weight") + noise)
    able = scored.where(F.col("n_words") >= least_words)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("part"), F.asc("row")]
    placed = able.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = stored(spark, placed, "scores")
    block = F.shiftright("place", 33)
    sizes = placed.groupBy(block.alias("block")).agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(W.orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select("block", F.coalesce(before, F.lit(0)).alias("before"), F.sum("size").over(W.partitionBy()).alias("all"))
    sizes = stored(spark, sizes, "score_blocks")  # a row for each partition
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit(_ROW)) + 1
    ranked = placed.withColumn("block", block).join(F.broadcast(sizes), "block")
    ranked = ranked.withColumn("rank", F.when(rank <= F.floor(F.lit(percent) * F.col("all") / 100), rank))
    names = [*scored.columns, "rank"]
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(names).unionByName(rest.select(names)).drop("part", "row")


def sample(spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = WORDS, seed: int = SEED) -> DataFrame:
    """The drawn rows: doc_id, text, weight, score, rank."""
    drawn = draw(spark, weigh(docs, bucket_gains(docs, target), with_text=True), percent, least_words, seed)
    return drawn.where(F.col("rank").isNotNull()).select("doc_id", "text", "weight", "score", "rank")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    drawn = draw(spark, weigh(docs, bucket_gains(docs, table(spark, sf_dir, "benchmark"))))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
