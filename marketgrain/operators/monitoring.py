"""Alerts, health and service figures from metric and request tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marketgrain.functions.numeric import count_where, ratio
from marketgrain.functions.pricing import metric_unit
from marketgrain.operators.ema import ema

# fixed values: (alert type, metric, direction, threshold, critical threshold or None, base severity)
RULES = (
    ("system_cpu", "cpu_percent", "above", 80.0, 95.0, "warning"),
    ("system_memory", "memory_percent", "above", 85.0, 95.0, "warning"),
    ("system_disk", "disk_percent", "above", 90.0, None, "critical"),
    ("model_performance", "val_mape", "above", 20.0, 30.0, "warning"),
    ("api_unavailable", "api_available", "below", 1.0, None, "critical"),
    ("api_latency", "average_latency_ms", "above", 2000.0, None, "warning"),
    ("data_quality", "quality_score", "below", 70.0, 50.0, "warning"),
    ("data_freshness", "data_freshness_hours", "above", 48.0, None, "warning"),
)
# fixed values: upper bounds in seconds of the latency histogram
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)
#: rows kept per area of the history
RETENTION = {"system": 1000, "api": 1000, "models": 500, "data_quality": 500, "alerts": 100}
RETENTION_PARTS = 64
API_ENTITY = "api_health"
RULE_SCHEMA = "alert_type string, metric string, direction string, threshold double, critical double, base string"
SERIES = ("source", "entity", "metric")


def rules_table(spark: SparkSession, rules: Sequence[tuple] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def latest_values(metrics: DataFrame, keys: Sequence[str] = SERIES, ties: Sequence[str] = ("event_id",)) -> DataFrame:
    """Newest value per series, combined before the shuffle."""
    order = F.struct("ts", *[t for t in ties if t in metrics.columns])
    return metrics.groupBy(*keys).agg(F.max_by("value", order).alias("value"), F.max("ts").alias("ts"))


def violations(values: DataFrame, rules: DataFrame) -> DataFrame:
    """Values that break a rule, with severity and message. ``rules`` is a handful of rows."""
    value, above = F.col("value"), F.col("direction") == "above"

    def beyond(limit: Column) -> Column:
        return F.when(above, value > limit).otherwise(value < limit)

    joined = values.join(F.broadcast(rules), "metric").where(beyond(F.col("threshold")))
    severity = F.when(F.coalesce(beyond(F.col("critical")), F.lit(False)), "critical").otherwise(F.col("base"))
    return joined.withColumns({
        "severity": severity,
        "message": F.format_string("%s of %s is %.2f, limit %.1f", "metric", "entity", "value", "threshold"),
    }).drop("direction", "critical", "base")


def alerts(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    return violations(latest_values(metrics), rules)


def _grade(value: Column, steps: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    graded = F.lit(otherwise)
    for condition, label in reversed(steps):
        graded = F.when(condition, label).otherwise(graded)
    return F.when(value.isNull(), "no_data").otherwise(graded)


def newest_wide(metrics: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Newest value of each named metric as columns, per key."""
    order = F.struct("ts", "event_id") if "event_id" in metrics.columns else F.col("ts")
    return metrics.groupBy(*keys).agg(*[
        F.max_by(F.when(F.col("metric") == n, F.col("value")), F.when(F.col("metric") == n, order)).alias(n) for n in names
    ])


def system_status(cpu: Column, memory: Column) -> Column:
    critical, warning = (cpu > 90) | (memory > 95), (cpu > 80) | (memory > 85)
    return _grade(cpu, [(critical, "critical"), (warning, "warning")], "healthy")


def model_status(mape: Column) -> Column:
    return _grade(mape, [(mape < 15, "healthy"), (mape < 25, "warning")], "critical")


def data_status(score: Column, hours: Column) -> Column:
    return _grade(score, [((score > 85) & (hours < 24), "healthy"), ((score > 70) & (hours < 48), "warning")], "critical")


def overall_models(metrics: DataFrame) -> DataFrame:
    """One row: how many models are in which state and the state of all."""
    latest = newest_wide(metrics.where((F.col("source") == "models") & ~_is_api()), ["entity"], ["val_mape"])
    graded = latest.withColumn("status", model_status(F.coalesce("val_mape", F.lit(0.0))))
    counts = graded.agg(
        F.count(F.lit(1)).alias("models_count"),
        *[count_where(F.col("status") == s).alias(f"{s}_models") for s in ("healthy", "warning", "critical")],
    )
    state = (
        F.when(F.col("models_count") == 0, "no_data")
        .when(F.col("critical_models") > 0, "critical")
        .when(F.col("warning_models") > F.col("models_count") * 0.5, "warning")
        .otherwise("healthy")
    )
    return counts.withColumn("status", state)


def _is_api() -> Column:
    """Rows of the service's health check, which come among the models' rows."""
    return (F.col("source") == "models") & F.col("entity").eqNullSafe(F.lit(API_ENTITY))


def api_health(metrics: DataFrame) -> DataFrame:
    """One row: the newest health check of the service; no_data where there is none."""
    latest = newest_wide(metrics.where(_is_api()), [], ["status_healthy"])
    sound = F.col("status_healthy")
    return latest.withColumn("status", _grade(sound, [(sound >= 1, "healthy")], "unhealthy"))


def health(metrics: DataFrame, freshness_hours: Column) -> DataFrame:
    """Rows (area, status) of system, models, api and data, and the worst of them as ``overall``."""
    system = newest_wide(metrics.where(F.col("source") == "system"), [], ["cpu_percent", "memory_percent"])
    data = newest_wide(metrics.where(F.col("source") == "data_quality"), [], ["quality_score"])
    areas = [
        system.select(F.lit("system").alias("area"), system_status(F.col("cpu_percent"), F.col("memory_percent")).alias("status")),
        overall_models(metrics).select(F.lit("models").alias("area"), "status"),
        api_health(metrics).select(F.lit("api").alias("area"), "status"),
        data.select(F.lit("data").alias("area"), data_status(F.col("quality_score"), freshness_hours).alias("status")),
    ]
    rows = areas[0]
    for area in areas[1:]:
        rows = rows.unionByName(area)
    return rows.unionByName(worst(rows))


def worst(rows: DataFrame) -> DataFrame:
    """Worst-of in the order no_data < healthy < warning (and unhealthy) < critical."""
    rank = (
        F.when(F.col("status") == "critical", 3).when(F.col("status").isin("warning", "unhealthy"), 2)
        .when(F.col("status") == "no_data", 0).otherwise(1)
    )
    label = F.element_at(F.array(*[F.lit(s) for s in ("no_data", "healthy", "warning", "critical")]), F.max(rank) + 1)
    return rows.agg(label.alias("status")).select(F.lit("overall").alias("area"), "status")


def indicators(metrics: DataFrame, freshness_hours: Column) -> DataFrame:
    """Dashboard words for system, models and data, whose limits differ from those of ``health``."""
    system = newest_wide(metrics.where(F.col("source") == "system"), [], ["cpu_percent", "memory_percent"])
    cpu, memory = F.col("cpu_percent"), F.col("memory_percent")
    latest = newest_wide(metrics.where((F.col("source") == "models") & ~_is_api()), ["entity"], ["val_mape"])
    models = latest.agg(F.count(F.lit(1)).alias("n"), count_where(F.col("val_mape") > 20).alias("bad"))
    down = api_health(metrics).select(F.col("status") == "unhealthy").scalar()
    data = newest_wide(metrics.where(F.col("source") == "data_quality"), [], ["quality_score"])
    score = F.col("quality_score")
    state = system_status(cpu, memory)
    return (
        system.select(
            F.lit("system").alias("area"), F.when(state == "no_data", "No Data").otherwise(F.initcap(state)).alias("indicator")
        )
        .unionByName(models.select(
            F.lit("models").alias("area"),
            F.when(down, "API Down").when(F.col("n") == 0, "No Models")
            .when(F.col("bad") > F.col("n") * 0.5, "Performance Issues").otherwise("Performing Well").alias("indicator"),
        ))
        .unionByName(data.select(
            F.lit("data").alias("area"),
            F.when((score >= 85) & (freshness_hours < 24), "Excellent")
            .when((score >= 70) & (freshness_hours < 48), "Good").otherwise("Issues").alias("indicator"),
        ))
    )


def keep_newest(history: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    """The newest rows of each area that has a limit, and all rows of other areas.

    An area is cut in parts first, so no task sorts all of it, whatever the limit.
    """
    limits = limits or RETENTION
    limit = F.try_element_at(F.create_map(*[F.lit(x) for p in limits.items() for x in p]), F.col("source"))
    newest = [F.desc("ts"), F.desc("event_id")]
    limited = history.withColumn("_limit", limit).where(F.col("_limit").isNotNull())
    parts = limited.withColumn("_part", F.pmod(F.xxhash64("event_id"), F.lit(RETENTION_PARTS)))
    near = F.row_number().over(Window.partitionBy("source", "_part").orderBy(*newest))
    parts = parts.withColumn("_rank", near).where(F.col("_rank") <= F.col("_limit"))
    far = F.row_number().over(Window.partitionBy("source").orderBy(*newest))
    kept = parts.withColumn("_rank", far).where(F.col("_rank") <= F.col("_limit")).drop("_rank", "_part", "_limit")
    return kept.unionByName(history.where(limit.isNull()))


def younger_than(history: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    return history.where(F.col("ts") >= now - F.make_dt_interval(hours=F.lit(hours)))


def uptime_minutes(metrics: DataFrame, now: Column) -> DataFrame:
    start = metrics.where(F.col("source") == "system").agg(F.min("ts").alias("first_ts"))
    return start.select("first_ts", (F.timestamp_diff("SECOND", F.col("first_ts"), now) / 60).alias("uptime_minutes"))


def fallback_quality(present: Column, expected: int, freshness_hours: Column) -> Column:
    """Quality score from file presence and age when no validation result exists."""
    base = present / expected * 80
    fresh = F.greatest(F.lit(0.0), 20 - freshness_hours)
    return F.when(present > 0, F.least(F.lit(100.0), base + fresh)).otherwise(base)


def data_quality(stored: DataFrame, fallback: DataFrame) -> DataFrame:
    """origin and quality_score: of the stored validation, or of the ``fallback`` (one row) where there is none."""
    known = stored.select(F.lit("stored").alias("origin"), F.col("total_quality_score").alias("quality_score")).limit(1)
    # one row on each side at most
    missing = fallback.select(F.lit("fallback").alias("origin"), "quality_score").join(known.select(F.lit(1).alias("_any")), how="left_anti")
    return known.unionByName(missing)


def request_counters(requests: DataFrame) -> DataFrame:
    return requests.groupBy("endpoint", "method", "status").agg(F.count(F.lit(1)).alias("requests"))


def prediction_counters(requests: DataFrame) -> DataFrame:
    outcome = F.when(F.col("status") < 400, "success").otherwise("error")
    return requests.groupBy("model_name", outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("predictions"))


def latency_histogram(requests: DataFrame, bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """Cumulative bucket counts per model: all buckets are counted in one pass and then turned into rows."""
    seconds = F.col("latency_ms") / 1000
    buckets = [F.struct(F.lit(float(b)).alias("le"), count_where(seconds <= b).alias("n")) for b in bounds]
    buckets.append(F.struct(F.lit(float("inf")).alias("le"), F.count("latency_ms").alias("n")))
    return requests.groupBy("model_name").agg(F.array(*buckets).alias("b")).select("model_name", F.inline("b"))


def latency_totals(requests: DataFrame) -> DataFrame:
    return requests.groupBy("model_name").agg(
        (F.sum("latency_ms") / 1000).alias("latency_sum"), F.count("latency_ms").alias("latency_count"),
        F.avg("latency_ms").alias("mean_ms"),
    )


def load_summary(requests: DataFrame, prediction: Column) -> DataFrame:
    """Success rate, mean latency of successes and share of plausible predictions of a load run."""
    ok = F.col("status") == 200
    plausible = ok & prediction.between(1, 1000)
    return requests.agg(
        F.count(F.lit(1)).alias("requests"), count_where(ok).alias("successful"),
        (ratio(count_where(ok), F.count(F.lit(1))) * 100).alias("success_rate"),
        F.avg(F.when(ok, F.col("latency_ms"))).alias("mean_latency_ms"), count_where(plausible).alias("plausible_predictions"),
    )


def prediction_stats(requests: DataFrame) -> DataFrame:
    """Totals, successes, moving average of latency and time of the last request per model."""
    counts = requests.groupBy("model_name").agg(
        F.count(F.lit(1)).alias("total"), count_where(F.col("status") == 200).alias("successful"), F.max("ts").alias("last_ts")
    )
    return counts.join(
        ema(requests, ["model_name"], "ts", ["request_id"], "latency_ms").select("model_name", F.col("ema").alias("average_latency")),
        "model_name", "left",
    )


def recent_alerts(alert_rows: DataFrame, limit: int = 10) -> DataFrame:
    return alert_rows.orderBy(F.desc("ts"), "alert_type", "entity").limit(limit)


def long_metrics(wide: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per numeric metric with its unit."""
    long = wide.select(*keys, *[F.col(n).cast("double").alias(n) for n in names]).unpivot(list(keys), list(names), "metric", "value")
    return long.where(F.col("value").isNotNull()).withColumn("unit", metric_unit(F.col("metric")))
