"""Sessions of a stream as fragments: every micro-batch writes what it saw, reading joins what belongs together.

Rows of one key in one slot of time, as wide as the gap, are less than a gap apart and so of one session. A
fragment is such a slot: rows, sums, first and last moment. Micro-batches write the fragments of their own rows, so their
output grows with the batch only. Fragments of a slot add up, and neighbouring slots belong to one session unless the pause
between them reaches the gap. However many rows a key has, it has one fragment for each slot of time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marketgrain.streaming.runs import read_batches


def fragments(rows: DataFrame, key: str, gap_seconds: int, values: Mapping[str, Column], ts: str = "ts") -> DataFrame:
    """Slots of a static frame: rows, first and last moment (microseconds), count and sum of each value."""
    gap = gap_seconds * 1_000_000
    moments = rows.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp"))).where(F.col("_t").isNotNull())
    slot = F.expr(f"(_t - pmod(_t, {gap})) div {gap}")
    figures = [x for n, v in values.items() for x in (F.count(v).alias(f"{n}_n"), F.sum(v).alias(f"{n}_sum"))]
    return moments.groupBy(key, slot.alias("slot")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("_t").alias("first"), F.max("_t").alias("last"), *figures)


def _added(parts: DataFrame, groups: list[str], names: list[str]) -> DataFrame:
    return parts.groupBy(*groups).agg(
        F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"),
        *[F.sum(f"{n}_{x}").alias(f"{n}_{x}") for n in names for x in ("n", "sum")])


def joined(parts: DataFrame, key: str, gap_seconds: int, names: list[str]) -> DataFrame:
    """Sessions of fragments: key, session_start, session_end (a gap after the last row), rows and figures."""
    gap = gap_seconds * 1_000_000
    slots = _added(parts, [key, "slot"], names)
    order = Window.partitionBy(key).orderBy("slot")
    opens = F.coalesce(F.col("first") - F.lag("last").over(order) >= gap, F.lit(True))
    numbered = slots.withColumn("_opens", opens.cast("int")).withColumn("session", F.sum("_opens").over(order))
    return _added(numbered, [key, "session"], names).select(
        key, F.timestamp_micros("first").alias("session_start"), F.timestamp_micros(F.col("last") + gap).alias("session_end"),
        "rows", *[f"{n}_{x}" for n in names for x in ("n", "sum")])


def fragment_batches(target: str, key: str, gap_seconds: int, values: Mapping[str, Column]) -> Callable[[DataFrame, int], None]:
    """Handler that writes the fragments of every micro-batch."""
    def handle(batch: DataFrame, number: int) -> None:
        fragments(batch, key, gap_seconds, values).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return handle


def stored_sessions(spark: SparkSession, target: str, key: str, gap_seconds: int, values: Mapping[str, Column], rows) -> DataFrame:
    """Sessions of all fragments so far; ``rows`` is the schema of the stream."""
    schema = fragments(spark.createDataFrame([], rows), key, gap_seconds, values).schema
    return joined(read_batches(spark, target, schema).drop("batch"), key, gap_seconds, list(values))
