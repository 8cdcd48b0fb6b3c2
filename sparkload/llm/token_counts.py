"""Token counts through a cache of digests.

A text's content digest is the SHA-256 of the text with runs of ASCII white
space as one space (a tokenizer that drops white space counts both forms
alike); a tokenizer's version digest covers its file, the library's version
and the options in use.  Contents whose digest is not in the cache under that
version are brought together by digest, one text of each is encoded, and the
counts are appended to the cache, a Parquet table (tokenizer, digest,
n_tokens).  Then every document joins its count.

Copies meet in map-side partial aggregates, so a text that a third of all rows
hold reaches the encoding step once per map task and is encoded once.

Within a text, the library encodes each different word (between white space)
once per worker and its count is remembered, in a space bounded in bytes: the tokenizer
drops white space before it splits, so counts of words add up.  ``cache_path``
must be a folder that all executors and later runs can reach.  A null text is
empty: 0 bytes, 0 tokens.  Repeated rows each get their row.  A very long text is
encoded by one task; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import scratch_path
from .common import Memo, col, map_batches, stored, table, text_of, worker_state

LIMIT = 2048
#: Characters that one call of the library gets.
SLICE = 2_000_000


def slices(texts: list[str], size: int = SLICE) -> Iterator[list[str]]:
    """``texts`` in order, cut so that each part has about ``size`` characters."""
    part, n = [], 0
    for text in texts:
        part.append(text)
        n += len(text)
        if n >= size:
            yield part
            part, n = [], 0
    if part:
        yield part


def load(path: str):
    """The tokenizer of a file, without truncation and padding."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def word_counter(path: str) -> tuple[Memo, Callable]:
    """This worker's memo of word counts of a tokenizer."""

    def make() -> tuple[Memo, Callable]:
        tokenizer = load(path)
        many = lambda words: [len(e) for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return Memo(lambda word: many([word])[0]), many

    return worker_state(("counts", path), make)


def count_tokens(path: str, texts: list[str]) -> list[int]:
    """Token counts of texts whose white space is single spaces."""
    memo, many = word_counter(path)
    out: list[int] = []
    for part in slices(texts):
        counts, at, lists = memo.of([text.split(" ") for text in part], many)
        out += np.bincount(lists, np.array(counts, np.int64)[at], len(part)).astype(np.int64).tolist()
    return out


def version_digest(path: str) -> str:
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f"{tokenizers.__version__} add_special_tokens=False ".encode() + f.read()).hexdigest()


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def cached(spark: SparkSession, cache_path: str, version: str) -> DataFrame | None:
    """digest, n_tokens of one tokenizer version; None before the first run."""
    try:
        cache = spark.read.schema("tokenizer string, digest binary, n_tokens long").parquet(cache_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return cache.where(F.col("tokenizer") == version).select("digest", "n_tokens")


def fill_cache(spark: SparkSession, docs: DataFrame, path: str, cache_path: str) -> str:
    """Encodes the contents that the cache lacks and appends their counts.
    Returns the tokenizer's version digest."""
    version = version_digest(path)
    texts = docs.select(normalised(text_of(docs)).alias("text"))
    texts = texts.select(F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    if (known := cached(spark, cache_path, version)) is not None:
        texts = texts.join(known, "digest", "left_anti")
    misses = texts.groupBy("digest").agg(F.any_value("text").alias("text"))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = count_tokens(path, batch.column("text").to_pylist())
        return pa.record_batch([pa.array([version] * len(n), pa.string()), batch.column("digest"), pa.array(n, pa.int64())], ["tokenizer", "digest", "n_tokens"])

    map_batches(misses, count, "tokenizer string, digest binary, n_tokens long").write.mode("append").parquet(cache_path)
    return version


def token_counts(spark: SparkSession, docs: DataFrame, path: str, cache_path: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens for every row.  Two runs that append at the
    same time may both add a digest; its count is taken once."""
    version = fill_cache(spark, docs, path, cache_path)
    counts = cached(spark, cache_path, version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    counts = stored(spark, counts, "token_counts")
    text = text_of(docs)
    rows = docs.select(col(docs, "doc_id").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), digest_of(text).alias("digest"))
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, so each run encodes all of its contents."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    out = token_counts(spark, table(spark, sf_dir, "documents"), path, scratch_path(spark, "llm", "token_cache"))
    return out.withColumn("over_limit", F.col("n_tokens") > LIMIT)
