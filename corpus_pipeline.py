"""From raw documents to token ids: quality, exact copies, near copies, benchmark passages, encoding.

Each stage takes (spark, docs, folder of the tables) and gives documents with their columns; the last gives the encoded
texts. ``run`` stores every stage's result in the shared folder, under a name of its own, and reads it for the next, so a lost
executor costs one stage's tasks at most. A stopped run begins anew; ``STAGES`` can be applied to a stored stage by hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketgrain.llm import byte_bpe, decontamination, exact_dedup, near_dedup, quality
from marketgrain.session import materialize

#: of near copies: shingles of five words, similarity of 0.8 or more
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id."""
    return exact_dedup.keep_first(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id."""
    return near_dedup.keep_one(docs, NEAR_WIDTH, NEAR_PERCENT)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents, with digests of the ids and of the decoded text."""
    return byte_bpe.round_trip(docs, keep_ids=True)


STAGES = [
    ("quality classifier", good_quality), ("exact dedup", without_copies), ("near dedup", without_near_copies),
    ("decontamination", without_benchmark), ("byte BPE", encoded),
]

#: rows of whole texts that go to a Python worker at once: both the JVM, outside its heap, and the worker hold such a batch
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: perplexity under a model fitted on the data can't be written in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(BATCH_ROWS))
    try:
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    finally:
        spark.conf.set(_BATCH, before)
    return docs
