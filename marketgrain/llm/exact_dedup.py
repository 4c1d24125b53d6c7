"""Exact deduplication with streaming state.

Rows are reduced to a digest of the normalised text, a stable identifier and a content locator. A stream groups them
by digest; its state lives on disk (RocksDB), is keyed by digest, never expires, and holds the identifier and locator
of the row that stays and the number of rows seen. Partial aggregation before the state keeps a hot digest from
reaching one task row by row. A later run on the same state folder goes on where the last one ended.

A digest that was seen before is a hit, not yet a proof: the full bytes of the row are compared with those of the row that
stays. Both are read again by identifier and digest; the locator tells rows of one identifier apart. Rows whose bytes differ are grouped among themselves by their full texts.

Texts are equal when identical after replacing each run of white space (x20, x09-x0D) by one space.

Defined results: null counts as empty, and empty texts are equal; the row with the smallest doc_id stays, a null doc_id
comes last, of rows with one doc_id the first read stays; an empty table gives no rows; other columns are ignored, or
kept by ``keep_first``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketgrain.llm.scratch import discard, scratch, stored
from marketgrain.llm.textkeys import unused
from marketgrain.session import checkpoint_root, materialize

BLANKS = r"[\x20\x09-\x0D]+"
FILES_PER_BATCH = 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def fingerprints(docs: DataFrame, digest=sha256) -> DataFrame:
    """doc_id, digest and locator (file and row number) of every row, stored in the shared folder."""
    text = normalised(F.col("text"))
    rows = docs.select(
        F.col("doc_id"), digest(text).alias("digest"), sha256(text).alias("text_sha256"),
        F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row")).alias("locator"),
    )
    return stored(rows, "fingerprints")


def absorb(spark: SparkSession, folder: str, schema, state: str) -> DataFrame:
    """Run the stream over what is new in ``folder``; the whole state: digest, first (identifier, locator), seen."""
    session = spark.newSession()
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    # else each of many small stores takes megabytes of disk in advance
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    source = session.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(folder)
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("locator"))
    grouped = source.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("seen"))
    stream = (
        grouped.writeStream.outputMode("update").format("noop").option("checkpointLocation", state)
        .trigger(availableNow=True).start()
    )
    stream.awaitTermination()
    return session.read.format("statestore").load(state).select(
        "key.digest", F.col("value.min").alias("first"), F.col("value.count").alias("seen")
    )


def groups(docs: DataFrame, digest=sha256) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    spark = docs.sparkSession
    with scratch(spark):
        return _groups(spark, docs, digest)


def _groups(spark: SparkSession, docs: DataFrame, digest) -> DataFrame:
    rows = fingerprints(docs, digest)
    folder, run = checkpoint_root(spark), uuid.uuid4().hex
    found = absorb(spark, rows.inputFiles()[0].rpartition("/")[0], rows.schema, discard(f"{folder}/dedup-state-{run}"))
    seen = discard(f"{folder}/dedup-seen-{run}")
    found.write.parquet(seen)
    seen = spark.read.parquet(seen).withColumnRenamed("digest", "_digest")
    marked = materialize(
        rows.join(seen, F.col("digest") == F.col("_digest")).select(
            "doc_id", "digest", "text_sha256", F.col("first.doc_id").alias("keep_id"), F.col("seen").alias("group_size"),
            (F.col("locator") == F.col("first.locator")).alias("kept"),
        ),
        "marked",
    )
    differing = _differing(docs, marked.where("group_size > 1"), digest)
    if differing.isEmpty():
        return marked.drop("digest")
    return _split(marked, differing).drop("digest")


def _differing(docs: DataFrame, hits: DataFrame, digest) -> DataFrame:
    """Rows whose digest was seen before and whose full text is not that of the row that stays."""
    wanted = hits.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "keep_id").distinct()
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")))
    texts = texts.select("doc_id", "keep_id", "_digest", normalised(F.col("text")).alias("text"))
    # rows that share an id may hold other texts
    texts = stored(texts.where(digest(F.col("text")) == F.col("_digest")), "hit-texts")
    stay = texts.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("_digest", F.col("text").alias("_text"))
    stay = stay.dropDuplicates(["_digest"])
    checked = texts.join(stay, "_digest").where(F.col("text") != F.col("_text"))
    return materialize(checked.select("doc_id", "_digest", "text"), "differing")


def _split(marked: DataFrame, differing: DataFrame) -> DataFrame:
    """Give rows of unequal texts with one digest groups of their own."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"))
    own = differing.groupBy("_digest", "text").agg(F.min(order)["doc_id"].alias("_keep"), F.count(F.lit(1)).alias("_size"))
    rows = differing.join(own, ["_digest", "text"]).select(
        F.col("doc_id").alias("_id"), "_digest", "_keep", "_size", sha256(F.col("text")).alias("_sha")
    ).distinct()
    lost = differing.groupBy(F.col("_digest").alias("_lost_digest")).agg(F.count(F.lit(1)).alias("_lost"))
    same_row = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")) & (
        F.col("text_sha256") == F.col("_sha"))
    joined = marked.join(rows, same_row, "left").join(lost, F.col("digest") == F.col("_lost_digest"), "left")
    moved = F.col("_size").isNotNull()
    return joined.select(
        "doc_id", "digest", "text_sha256", F.when(moved, F.col("_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(moved, F.col("_size")).otherwise(F.col("group_size") - F.coalesce("_lost", F.lit(0))).alias("group_size"),
        F.when(moved, F.col("doc_id").eqNullSafe(F.col("_keep"))).otherwise(F.col("kept")).alias("kept"),
    )


def keep_first(docs: DataFrame, digest=sha256) -> DataFrame:
    """The rows that stay, with all their columns."""
    found = groups(docs, digest)
    key = ["doc_id", "text_sha256"]
    state = materialize(found.groupBy(*key).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "kept-keys")
    dropped = state.where("not kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    sha, name = sha256(normalised(docs["text"])), unused(docs, "_sha")
    left = docs.join(dropped, docs["doc_id"].eqNullSafe(dropped["_id"]) & (sha == dropped["_sha"]), "left_anti")
    if state.where("n > 1").isEmpty():
        return left
    # rows that repeat an id and a text: one of them
    return left.withColumn(name, sha).dropDuplicates(["doc_id", name]).drop(name)
