"""Proportional stratified interleaving of rows into shards.

Rows are put in a seeded random order within each source and get the fraction (rank + 1/2) / rows of the source.
Ordered by that fraction the sources interleave in proportion, and any run of consecutive rows has nearly the
mixture of the whole. The order is cut into shards of equal row counts.

Ranks are counted without bringing a source, or all rows, to one task: rows fall into narrow buckets of their sort
value, the buckets' counts are summed up, and only rows of one bucket are ordered together. The number of buckets
follows the number of rows. Texts are never shuffled.

Defined results: a null text has no bytes (size 16, checksum 0); a null source is a source of its own; rows with the
same or a null id are ordered by checksum and size, full repeats among themselves arbitrarily; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketgrain.session import materialize

BUCKET_ROWS = 4096
CHUNK_BUCKETS = 1024
RANDOM_BITS = 48
ROW_OVERHEAD = 16


def interleave(docs: DataFrame, shards: int = 40, seed: int = 20) -> DataFrame:
    """doc_id, source, size, text_crc32, rank and fraction in the source, global position, shard and slot."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id"))), 1, RANDOM_BITS // 4), 16, 10)
    rows = materialize(docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        (F.length(body) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        draw.cast("long").alias("_draw"),
    ), "shard-rows")
    total = rows.count()
    buckets = max(1, -(-total // BUCKET_ROWS))
    ties = [F.col("_draw"), F.col("doc_id").asc_nulls_last(), F.col("text_crc32"), F.col("size")]

    spread = rows.withColumn("_bucket", _bucket(F.col("_draw"), 1 << RANDOM_BITS, buckets))
    ranked = _numbered(spread, ["source"], ties, "_rank", "_rows").withColumn(
        "fraction", (2 * F.col("_rank") + 1) / (2 * F.col("_rows"))
    )
    ranked = materialize(ranked.drop("_bucket"), "shard-ranks")

    merged = ranked.withColumn("_bucket", F.least(F.floor(F.col("fraction") * buckets), F.lit(buckets - 1)))
    order = [F.col("fraction"), *ties, F.col("source").asc_nulls_last()]
    placed = _numbered(merged, [], order, "position", "_all").drop("_bucket")
    shard = F.expr(f"(position * {int(shards)}) div _all")
    first = F.expr(f"(shard * _all + {int(shards) - 1}) div {int(shards)}")
    return placed.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("position") - first).select(
        "doc_id", "source", "size", "text_crc32", F.col("_rank").alias("source_rank"), "fraction", "position", "shard",
        "slot",
    )


def _bucket(value: Column, span: int, buckets: int) -> Column:
    """Equal ranges of a value below ``span``."""
    return F.least(F.floor(value / F.lit(span) * buckets), F.lit(buckets - 1))


def _numbered(rows: DataFrame, keys: list[str], order: list[Column], name: str, total: str) -> DataFrame:
    """Rank from 0 within ``keys`` by ``order``, which must agree with the order of ``_bucket``; and the key's rows."""
    sums = _running(rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n")), keys, total)
    within = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order)) - 1
    joined = _join(rows.withColumn("_within", within), sums, [*keys, "_bucket"])
    return joined.withColumn(name, F.col("_within") + F.col("_before")).drop("_within", "_before")


def _running(counts: DataFrame, keys: list[str], total: str) -> DataFrame:
    """Rows before each bucket, summed in chunks of buckets so that no task sees all buckets of a key."""
    counts = counts.withColumn("_chunk", F.expr(f"_bucket div {CHUNK_BUCKETS}"))
    earlier = (Window.unboundedPreceding, -1)
    near = Window.partitionBy(*keys, "_chunk").orderBy("_bucket").rowsBetween(*earlier)
    chunks = counts.groupBy(*keys, "_chunk").agg(F.sum("_n").alias("_chunk_n"))
    far = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(*earlier)
    chunks = chunks.select(
        *keys, "_chunk",
        F.coalesce(F.sum("_chunk_n").over(far), F.lit(0)).alias("_far"),
        F.sum("_chunk_n").over(Window.partitionBy(*keys)).alias(total),
    )
    counts = counts.withColumn("_near", F.coalesce(F.sum("_n").over(near), F.lit(0)))
    return _join(counts, chunks, [*keys, "_chunk"]).select(
        *keys, "_bucket", (F.col("_near") + F.col("_far")).alias("_before"), total
    )


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe equality join that keeps one set of keys."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(right, same).drop(*[f"_right_{k}" for k in keys])
