"""Windows of event time as mergeable parts, with bounded state, a table of late rows and restatement.

A micro-batch adds up its own rows to one part for each window and key: counts, sums, extremes, centred squares and, where
wanted, quantile sketches. Parts of a window merge to the part of all their rows, so a stream keeps these tables:

    open      merged parts of windows that may still change; those of the newest micro-batch count
    closed    windows that the watermark has passed, as they stood then; written once and taken out of ``open``
    late      parts of rows that came after their window was closed
    progress  the newest moment seen, from which the watermark follows

The first three are folders of each micro-batch under ``parts``. ``open`` is the only state, and holds the windows within the delay. ``restated`` adds the late parts to the closed windows, and
``every`` also shows the open ones: over any number of micro-batches, with files in any order, that is what a batch job
gives over all rows. Folders are named by micro-batch, so a repeated one overwrites its own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from marketgrain.functions.numeric import count_where
from marketgrain.session import exists, remove
from marketgrain.streaming.runs import read_batches

WINDOW = ("window_start", "window_end")
#: values that a quantile sketch holds exactly; beyond, ranks are within about 0.1 %
SKETCH_SIZE = 4096


@dataclass(frozen=True)
class Parts:
    """What is added up in each window and key: figures of ``values``, and rows for which ``flags`` hold."""

    keys: Sequence[str]
    values: Mapping[str, Column]
    width: str
    slide: str | None = None
    flags: Mapping[str, Column] = field(default_factory=dict)
    sketched: bool = False
    ts: str = "ts"

    def of(self, rows: DataFrame) -> DataFrame:
        """Parts of the rows of a static frame; rows without a moment are in no window."""
        window = F.window(self.ts, self.width, self.slide) if self.slide else F.window(self.ts, self.width)
        moment = F.unix_micros(F.col(self.ts).cast("timestamp"))
        found = [F.count(F.lit(1)).alias("rows"), F.max(moment).alias("newest")]
        for name, value in self.values.items():
            x = value.cast("double")
            found += [
                F.count(x).alias(f"{name}_n"), F.coalesce(F.sum(x), F.lit(0.0)).alias(f"{name}_sum"),
                F.coalesce(F.var_pop(x) * F.count(x), F.lit(0.0)).alias(f"{name}_squares"),
                F.min(x).alias(f"{name}_low"), F.max(x).alias(f"{name}_high"),
            ]
            if self.sketched:
                found.append(F.kll_sketch_agg_double(x, F.lit(SKETCH_SIZE)).alias(f"{name}_sketch"))
        found += [count_where(test).alias(name) for name, test in self.flags.items()]
        grouped = rows.groupBy(window.alias("_w"), *self.keys).agg(*found)
        names = [n for n in grouped.columns if n != "_w"]
        return grouped.select(F.col("_w.start").alias(WINDOW[0]), F.col("_w.end").alias(WINDOW[1]), *names)

    def merged(self, parts: DataFrame) -> DataFrame:
        """One part for each window and key."""
        found = [F.sum("rows").alias("rows"), F.max("newest").alias("newest")]
        for name in self.values:
            triple = F.struct(F.col(f"{name}_n").alias("n"), F.col(f"{name}_sum").alias("sum"), F.col(f"{name}_squares").alias("squares"))
            found += [
                F.sum(f"{name}_n").alias(f"{name}_n"), F.sum(f"{name}_sum").alias(f"{name}_sum"),
                # as many as micro-batches that touched the window
                _squares(F.array_sort(F.collect_list(triple))).alias(f"{name}_squares"),
                F.min(f"{name}_low").alias(f"{name}_low"), F.max(f"{name}_high").alias(f"{name}_high"),
            ]
            if self.sketched:
                found.append(F.kll_merge_agg_double(f"{name}_sketch", F.lit(SKETCH_SIZE)).alias(f"{name}_sketch"))
        found += [F.sum(name).alias(name) for name in self.flags]
        return parts.groupBy(*WINDOW, *self.keys).agg(*found)


def _squares(triples: Column) -> Column:
    """Centred squares of several parts together, by pairs of parts."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("squares"))

    def add(a: Column, b: Column) -> Column:
        gap = b["sum"] / b["n"] - a["sum"] / a["n"]
        between = F.when((a["n"] > 0) & (b["n"] > 0), gap * gap * a["n"] * b["n"] / (a["n"] + b["n"])).otherwise(0.0)
        return F.struct(
            (a["n"] + b["n"]).alias("n"), (a["sum"] + b["sum"]).alias("sum"),
            (a["squares"] + b["squares"] + between).alias("squares"))

    return F.aggregate(triples, start, add, lambda done: done["squares"])


def mean(name: str) -> Column:
    return F.when(F.col(f"{name}_n") > 0, F.col(f"{name}_sum") / F.col(f"{name}_n"))


def deviation(name: str) -> Column:
    """Of a sample; null for fewer than two values."""
    n = F.col(f"{name}_n")
    return F.when(n > 1, F.sqrt(F.col(f"{name}_squares") / (n - 1)))


def median(name: str) -> Column:
    """The mean of the two middle values, as far as the sketch holds them; the two are one for an odd number of values."""
    sketch = F.col(f"{name}_sketch")
    # the sketch takes fixed ranks only: the first value of rank 0.5, and the first of any more
    middle = [F.kll_sketch_get_quantile_double(sketch, F.lit(rank)) for rank in (0.5, 0.5 + 1e-7)]
    return F.when(F.col(f"{name}_n") > 0, (middle[0] + middle[1]) / 2)


def _newest(spark: SparkSession, target: str, number: int) -> int | None:
    """Microseconds of the newest moment seen up to a micro-batch."""
    if number < 0:
        return None
    return spark.read.schema("newest long").parquet(f"{target}/progress/batch={number}").first()["newest"]


def window_batches(target: str, parts: Parts, delay_seconds: int = 600) -> Callable[[DataFrame, int], None]:
    """Handler that keeps the tables of this module under ``target``."""
    delay = delay_seconds * 1_000_000

    def handle(batch: DataFrame, number: int) -> None:
        spark, before = batch.sparkSession, _newest(batch.sparkSession, target, number - 1)
        made = parts.of(batch)
        made.write.mode("overwrite").parquet(f"{target}/made/batch={number}")
        made = spark.read.schema(made.schema).parquet(f"{target}/made/batch={number}")
        seen = made.agg(F.max("newest")).first()[0]
        newest = max((x for x in (before, seen) if x is not None), default=None)

        ends = F.unix_micros(F.col(WINDOW[1]))
        closed = F.lit(False) if before is None else ends <= before - delay
        state = made.where(~closed)
        if number:
            state = state.union(spark.read.schema(made.schema).parquet(_place(target, number - 1, "open")))
        passed = F.lit(False) if newest is None else ends <= newest - delay
        rows = parts.merged(state).select(*made.columns, F.when(passed, "closed").otherwise("open").alias("kind"))
        rows = rows.union(made.where(closed).withColumn("kind", F.lit("late")))
        rows.write.mode("overwrite").partitionBy("kind").parquet(f"{target}/parts/batch={number}")
        if not exists(spark, _place(target, number, "open")):
            made.where("false").write.mode("overwrite").parquet(_place(target, number, "open"))
        spark.createDataFrame([(newest,)], "newest long").coalesce(1).write.mode("overwrite").parquet(
            f"{target}/progress/batch={number}")
        # what a repeated run of this micro-batch would read stays
        remove(spark, _place(target, number - 2, "open"))
        remove(spark, f"{target}/made/batch={number - 1}")

    return handle


def _place(target: str, number: int, kind: str) -> str:
    return f"{target}/parts/batch={number}/kind={kind}"


def _tables(spark: SparkSession, target: str, kinds: Sequence[str], schema: T.StructType) -> DataFrame:
    last = spark.read.schema("newest long, batch long").parquet(f"{target}/progress").agg(F.max("batch")).first()[0]
    every = T.StructType([*schema.fields, T.StructField("batch", T.LongType()), T.StructField("kind", T.StringType())])
    rows = spark.read.schema(every).parquet(f"{target}/parts")
    kept = F.col("kind").isin(*kinds) & ((F.col("kind") != "open") | (F.col("batch") == last))
    return rows.where(kept).drop("batch", "kind")


def closed_in(spark: SparkSession, target: str, number: int, schema: T.StructType) -> DataFrame:
    """The windows that one micro-batch closed."""
    place = _place(target, number, "closed")
    return spark.read.schema(schema).parquet(place) if exists(spark, place) else spark.createDataFrame([], schema)


def first_seen(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Closed windows as they stood when they were closed."""
    return _tables(spark, target, ["closed"], schema)


def restated(spark: SparkSession, target: str, parts: Parts, schema: T.StructType) -> DataFrame:
    """Closed windows with the rows that came too late for them."""
    return parts.merged(_tables(spark, target, ["closed", "late"], schema))


def every(spark: SparkSession, target: str, parts: Parts, schema: T.StructType) -> DataFrame:
    """All windows, also those that are open."""
    return parts.merged(_tables(spark, target, ["closed", "late", "open"], schema))


def part_schema(parts: Parts, rows: T.StructType, spark: SparkSession) -> T.StructType:
    """The schema of the parts of rows with a schema."""
    return parts.of(spark.createDataFrame([], rows)).schema
