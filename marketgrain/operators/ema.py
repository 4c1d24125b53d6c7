"""Exponential moving averages as a merge of slices.

Over a run of rows the average is fixed by a triple: the number of rows, the sum of the values weighted by how many rows of
the run come after them, and the run's first value, which seeds the average. Triples of neighbouring runs merge: the earlier
sum shrinks by the number of rows behind it. So rows are cut into slices of time; every slice of a key is a group of its own,
summed from the engine's own window over it, and the slices of a key, of which there are no more than time has, merge
by the same weights. No task holds a key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marketgrain.streaming.runs import read_batches

SLICE_SECONDS = 3600


def slice_rows(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str], value: str, seconds: int = SLICE_SECONDS) -> DataFrame:
    """keys, slice, moment, ties and value of the rows that have a value."""
    span = seconds * 1_000_000
    rows = df.where(F.col(value).isNotNull()).select(
        *keys, F.unix_micros(F.col(order).cast("timestamp")).alias("_t"), *ties, F.col(value).cast("double").alias("_x"))
    return rows.withColumn("slice", F.expr(f"coalesce((_t - pmod(_t, {span})) div {span}, -1L << 62)"))


def slices(rows: DataFrame, keys: Sequence[str], ties: Sequence[str], alpha: float) -> DataFrame:
    """keys, slice and its triple (n, weighted, seed); ``rows`` come from ``slice_rows``."""
    latest = Window.partitionBy(*keys, "slice").orderBy(F.desc("_t"), *[F.desc(t) for t in ties])
    after = rows.withColumn("_after", F.row_number().over(latest) - 1)
    return after.groupBy(*keys, "slice").agg(
        F.count(F.lit(1)).alias("n"), F.sum(alpha * F.pow(F.lit(1 - alpha), F.col("_after")) * F.col("_x")).alias("weighted"),
        F.max_by("_x", "_after").alias("seed"))


def merged(triples: DataFrame, keys: Sequence[str], alpha: float) -> DataFrame:
    """keys, n and ema of the rows of all slices."""
    order = Window.partitionBy(*keys).orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    keep = F.lit(1 - alpha)
    rows = triples.withColumn("_behind", F.coalesce(F.sum("n").over(order), F.lit(0)))
    first = F.min_by("seed", "slice")
    return rows.groupBy(*keys).agg(
        F.sum("n").alias("n"), (F.sum(F.col("weighted") * F.pow(keep, F.col("_behind"))) + first * F.pow(keep, F.sum("n"))).alias("ema"))


def ema(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str], value: str, alpha: float = 0.1,
        seconds: int = SLICE_SECONDS) -> DataFrame:
    """n and the moving average at the last row of each key; the first value seeds it."""
    return merged(slices(slice_rows(df, keys, order, ties, value, seconds), keys, ties, alpha), keys, alpha)


def ema_batches(target: str, keys: Sequence[str], order: str, ties: Sequence[str], value: str, alpha: float = 0.1,
                seconds: int = SLICE_SECONDS) -> Callable[[DataFrame, int], None]:
    """Handler that stores the rows of a micro-batch by slice and restates the slices that it touched.

    Rows of one slice may come in several micro-batches and in any order: only touched slices are read again.
    """
    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = slice_rows(batch, keys, order, ties, value, seconds)
        rows.sortWithinPartitions("slice").write.mode("overwrite").parquet(f"{target}/rows/batch={number}")
        stored = spark.read.schema(rows.schema).parquet(f"{target}/rows/batch={number}")
        touched = stored.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("slice").alias("_slice")).distinct()
        ends = stored.agg(F.min("slice"), F.max("slice")).first()
        # the range reaches the files' statistics
        every = read_batches(spark, f"{target}/rows", rows.schema).where(
            (F.col("batch") <= number) & F.col("slice").between(*ends)).drop("batch")
        same = F.col("slice") == F.col("_slice")
        for key in keys:
            same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
        triples = slices(every.join(touched, same, "left_semi"), keys, ties, alpha)
        triples.write.mode("overwrite").parquet(f"{target}/slices/batch={number}")

    return handle


def stored_ema(spark: SparkSession, target: str, keys: Sequence[str], alpha: float, kinds: str) -> DataFrame:
    """The average over all micro-batches so far; ``kinds`` are the keys with their types."""
    names = ("n", "weighted", "seed")
    schema = spark.createDataFrame([], f"{kinds}, slice long, n long, weighted double, seed double").schema
    found = read_batches(spark, f"{target}/slices", schema)
    last = found.groupBy(*keys, "slice").agg(F.max_by(F.struct(*names), "batch").alias("_last"))
    return merged(last.select(*keys, "slice", *[F.col(f"_last.{n}").alias(n) for n in names]), keys, alpha)
