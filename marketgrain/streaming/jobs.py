"""Streaming forms of the metric, alert, drift and validation work."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketgrain import schemas as S
from marketgrain.functions.naming import c
from marketgrain.functions.numeric import ratio
from marketgrain.operators import drift, quality
from marketgrain.operators.cooldown import cooled_down
from marketgrain.operators.monitoring import violations
from marketgrain.session import remove
from marketgrain.streaming import runs
from marketgrain.streaming.windows import WINDOW, Parts, closed_in, deviation, mean, median, window_batches

def metric_windows(metrics: DataFrame, keys: Sequence[str] = ("source", "metric"), width: str = "60 seconds", slide: str | None = None) -> DataFrame:
    """Count, mean and extremes per window of event time; for streams and static frames alike."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    return metrics.groupBy(window.alias("w"), *keys).agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n", "mean", "low", "high")


def daily_parts(moment: str = "sold_at") -> Parts:
    """What the daily aggregate per item adds up over one-day windows."""
    return Parts(
        [S.ITEM], {"quantity": c(S.QUANTITY), "price": c(S.PRICE)}, "1 day", flags={"discounts": c(S.DISCOUNT) == "Yes"}, ts=moment)


def sold(sales: DataFrame, moment: str = "sold_at") -> DataFrame:
    """The rows that the daily aggregate counts."""
    return sales.where((F.lower(c(S.KIND)) == "sale") & c(moment).isNotNull() & c(S.ITEM).isNotNull())


def daily_of(parts: DataFrame) -> DataFrame:
    """The daily aggregate from merged parts."""
    total, count, price = F.col("quantity_sum"), F.col("quantity_n"), mean("price")
    return parts.select(
        F.col(WINDOW[0]).cast("date").alias(S.DATE), c(S.ITEM), total.alias("Total_Quantity"), mean("quantity").alias("Avg_Quantity"),
        count.alias("Transaction_Count"), price.alias("Avg_Price"), F.coalesce(deviation("price"), F.lit(0.0)).alias("Price_Volatility"),
        F.col("price_low").alias("Min_Price"), F.col("price_high").alias("Max_Price"), F.col("discounts").alias("Discount_Count"),
        (total * price).alias("Revenue"), ratio(F.col("discounts"), count, 0.0).alias("Discount_Rate"),
        (F.col("price_high") - F.col("price_low")).alias("Price_Range"),
    )


def metric_parts(width: str = "60 seconds", slide: str | None = None, keys: Sequence[str] = ("source", "metric")) -> Parts:
    return Parts(list(keys), {"value": F.col("value")}, width, slide)


def metrics_of(parts: DataFrame, keys: Sequence[str] = ("source", "metric")) -> DataFrame:
    """The figures of ``metric_windows`` from merged parts."""
    return parts.select(*WINDOW, *keys, F.col("value_n").alias("n"), mean("value").alias("mean"), F.col("value_low").alias("low"),
                        F.col("value_high").alias("high"))


def sessions(requests: DataFrame, key: str = "user_id", gap: str = "10 minutes") -> DataFrame:
    """Requests of one caller without a pause of ``gap``."""
    return requests.groupBy(F.session_window("ts", gap).alias("w"), key).agg(
        F.count(F.lit(1)).alias("requests"), F.avg("latency_ms").alias("mean_ms")
    ).select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "requests", "mean_ms")


# ---- alerts -----------------------------------------------------------------------------------------------
VIOLATION = ("ts", "event_id", "severity", "value")


def alert_batches(target: str, rules: DataFrame, minutes: int = 30, keys: Sequence[str] = ("alert_type", "entity")) -> Callable[[DataFrame, int], None]:
    """Handler that stores the violations of every micro-batch and at once emits those that the cooldown lets through.

    ``live`` has what was emitted when a micro-batch came, after the last emission of each key; an event that comes late
    can't take back what was emitted. ``settled`` gives what holds over all events, in any order. The state is one moment for
    each key whose cooldown still runs.
    """
    names, pause = list(keys), minutes * 60 * 1_000_000

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = violations(batch, rules).select(*names, *VIOLATION)
        rows.write.mode("overwrite").parquet(f"{target}/violations/batch={number}")
        rows = spark.read.schema(rows.schema).parquet(f"{target}/violations/batch={number}")
        moments = rows.select(*names, "ts", F.unix_micros("ts").alias("t"))
        since = moments.where("false").select(*names, "t")
        if number:
            since = spark.read.schema(since.schema).parquet(f"{target}/last/batch={number - 1}")
        live = cooled_down(rows, names, minutes, since)
        live.write.mode("overwrite").parquet(f"{target}/live/batch={number}")
        live = spark.read.schema(live.schema).parquet(f"{target}/live/batch={number}")
        emitted = rows.join(live, [*[rows[n].eqNullSafe(live[n]) for n in names], rows["event_id"] == live["event_id"]], "left_semi")
        last = since.union(emitted.select(*names, F.unix_micros("ts"))).groupBy(*names).agg(F.max("t").alias("t"))
        newest = moments.agg(F.max("t")).first()[0]
        running = F.lit(True) if newest is None else F.col("t") + 2 * pause > newest
        last.where(running).write.mode("overwrite").parquet(f"{target}/last/batch={number}")
        remove(spark, f"{target}/last/batch={number - 2}")

    return handle


def settled(spark: SparkSession, target: str, kinds: T.StructType, minutes: int = 30, keys: Sequence[str] = ("alert_type", "entity")) -> DataFrame:
    """The alerts that the cooldown lets through over all events so far; ``kinds`` is the schema of violations."""
    names = list(keys)
    rows = runs.read_batches(spark, f"{target}/violations", kinds).drop("batch")
    kept = cooled_down(rows, names, minutes)
    return rows.join(kept, [*[rows[n].eqNullSafe(kept[n]) for n in names], rows["event_id"] == kept["event_id"]], "left_semi")


# ---- micro-batch work -------------------------------------------------------------------------------------
def drift_batches(reference: DataFrame, names: Sequence[str], target: str, method: str = "statistical") -> Callable[[DataFrame, int], None]:
    """Handler that compares every micro-batch with the reference and appends the verdict and the results.

    ``reference`` is a stored profile for the statistical method, else the reference rows.
    """
    def handle(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        if method == "statistical":
            results = drift.statistical_drift(reference, drift.profile(batch, names))
        else:
            results = drift.detect(reference, batch, names, method)
        flat = results.select("feature", "drift_score", "drift_detected", F.lit(number).alias("batch"))
        flat.write.mode("overwrite").parquet(f"{target}/results/batch={number}")
        stored = batch.sparkSession.read.parquet(f"{target}/results/batch={number}")
        drift.verdict(stored).write.mode("overwrite").parquet(f"{target}/verdicts/batch={number}")

    return handle


def drift_parts(names: Sequence[str], width: str = "60 minutes", ts: str = "ts") -> Parts:
    """Mergeable profiles of numeric columns per window."""
    return Parts([], {n: c(n) for n in names}, width, sketched=True, ts=ts)


def window_profiles(parts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean, deviation and median of each window and feature from merged profiles."""
    each = [F.struct(
        F.lit(n).alias("feature"), F.col(f"{n}_n").alias("n"), mean(n).alias("mean"),
        F.greatest(F.coalesce(deviation(n), F.lit(0.0)), F.lit(drift.MIN_STD)).alias("std"), median(n).alias("median"),
    ) for n in names]
    return parts.select(*WINDOW, F.inline(F.array(*each))).where(F.col("n") > 0)


def window_verdicts(reference: DataFrame, parts: DataFrame, names: Sequence[str]) -> DataFrame:
    """The verdict of each window against a stored profile."""
    return drift.verdict(drift.profile_shift(reference, window_profiles(parts, names), WINDOW), keys=WINDOW)


def drift_window_batches(reference: DataFrame, names: Sequence[str], target: str, parts: Parts, delay_seconds: int = 600) -> Callable[[DataFrame, int], None]:
    """Handler that merges profiles per window and writes the verdict of every window when it is closed."""
    merge = window_batches(target, parts, delay_seconds)

    def handle(batch: DataFrame, number: int) -> None:
        merge(batch, number)
        closed = closed_in(batch.sparkSession, target, number, parts.of(batch).schema)
        window_verdicts(reference, closed, names).write.mode("overwrite").parquet(f"{target}/verdicts/batch={number}")

    return handle


def watch_drift(stream: DataFrame, reference: DataFrame, names: Sequence[str], target: str, checkpoint: str, interval: str = "60 minutes",
                width: str = "60 minutes", ts: str = "ts") -> StreamingQuery:
    """A continuing stream that judges every window at a fixed interval; ``reference`` is a stored profile."""
    handle = drift_window_batches(reference, names, target, drift_parts(names, width, ts))
    return runs.start_every(stream, handle, checkpoint, interval)


def validation_batches(target: str) -> Callable[[DataFrame, int], None]:
    """Handler that writes good rows and, with their errors, bad rows of every micro-batch.

    A repeated batch overwrites its own folders, so a retry leaves no duplicates.
    """
    def handle(batch: DataFrame, number: int) -> None:
        checked = quality.sale_row_errors(batch).persist()
        checked.where(F.size("errors") == 0).drop("errors").write.mode("overwrite").parquet(f"{target}/good/batch={number}")
        checked.where(F.size("errors") > 0).write.mode("overwrite").parquet(f"{target}/bad/batch={number}")
        checked.unpersist()

    return handle
