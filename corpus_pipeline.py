"""A training-data pipeline: toxic documents go, then poor ones, then
near-duplicates; sources are mixed to their target weights; what is left is
encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet in the shared scratch folder and reads as the next one's
``docs``.  All but the last return the columns of ``documents``; mixing repeats
rows, and the last stage returns a row for each of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkload.llm import bpe, minhash, mixing, quality_rules, toxicity
from sparkload.llm.common import stored, table

#: Words in a shingle of the near-duplicate stage; similarity 0.8 or more.
SHINGLE_WORDS = 5
VOCABULARY = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trained on the stage's input and the labels of ``sf_dir``."""
    return toxicity.drop_toxic(spark, docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean(spark, docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.dedup(spark, docs, k=SHINGLE_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(mixing.mix(spark, docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path(VOCABULARY), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("minhash_near_dedup", drop_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The network, the BPE ids and the sketches have no SQL form; tests compare
#: the run with a plain one on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
