import datetime as dt
import os
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketgrain.operators import cooldown, drift, ema as E, monitoring as H
from marketgrain.sources.readers import service_figures
from marketgrain.streaming import jobs, runs, sessions as K, windows as W

START = dt.datetime(2024, 1, 1)


def metric_rows(spark, **values):
    sources = {"cpu_percent": "system", "memory_percent": "system", "disk_percent": "system", "val_mape": "models",
               "api_available": "api", "average_latency_ms": "api", "quality_score": "data_quality", "data_freshness_hours": "data_quality"}
    rows = [(START, i, sources[m], "e", m, float(v)) for i, (m, v) in enumerate(values.items())]
    return spark.createDataFrame(rows, "ts timestamp, event_id long, source string, entity string, metric string, value double")


def test_every_rule_fires(spark):
    rows = metric_rows(spark, cpu_percent=96, memory_percent=90, disk_percent=95, val_mape=25, api_available=0,
                       average_latency_ms=3000, quality_score=60, data_freshness_hours=72)
    got = {r["alert_type"]: r["severity"] for r in H.alerts(rows, H.rules_table(spark)).collect()}
    assert got == {"system_cpu": "critical", "system_memory": "warning", "system_disk": "critical", "model_performance": "warning",
                   "api_unavailable": "critical", "api_latency": "warning", "data_quality": "warning", "data_freshness": "warning"}


def test_only_the_latest_value_counts(spark):
    later = metric_rows(spark, cpu_percent=10).withColumn("ts", F.col("ts") + F.expr("interval 1 minute"))
    rows = metric_rows(spark, cpu_percent=99).unionByName(later)
    assert H.alerts(rows, H.rules_table(spark)).count() == 0


def test_health_is_worst_of(spark):
    rows = metric_rows(spark, cpu_percent=10, memory_percent=10, val_mape=30, quality_score=90)
    got = {r["area"]: r["status"] for r in H.health(rows, F.lit(1.0)).collect()}
    assert got["system"] == "healthy" and got["models"] == "critical" and got["overall"] == "critical" and got["api"] == "no_data"


def test_ema_equals_loop(spark):
    x = np.random.default_rng(0).exponential(10, 500)
    rows = [(k, START + dt.timedelta(seconds=i // 3), i, float(v)) for k in ("a", "b") for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "model_name string, ts timestamp, request_id long, latency_ms double")
    average = x[0]
    for v in x[1:]:
        average = 0.1 * v + 0.9 * average
    for row in H.ema(df, ["model_name"], "ts", ["request_id"], "latency_ms").collect():
        assert row["n"] == 500 and row["ema"] == pytest.approx(average)


def cooldown_by_hand(rows, minutes=30):
    last, kept = {}, set()
    for key, ts, event in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        if key not in last or ts - last[key] >= dt.timedelta(minutes=minutes):
            last[key] = ts
            kept.add(event)
    return kept


def alert_rows(count=400):
    rng = np.random.default_rng(1)
    return [(f"k{int(rng.integers(3))}", START + dt.timedelta(minutes=int(rng.integers(2000))), i) for i in range(count)]


def test_cooldown_equals_loop(spark):
    rows = alert_rows()
    df = spark.createDataFrame(rows, "entity string, ts timestamp, event_id long")
    assert {r["event_id"] for r in cooldown.cooled_down(df, ["entity"]).collect()} == cooldown_by_hand(rows)


def test_service_text(spark):
    text = ["# HELP api_requests_total x 5", 'api_requests_total{a="b"} 3.0', "api_requests_total 4", "prediction_latency_seconds_sum 2.0",
            "prediction_latency_seconds_count 8", "other 1"]
    row = service_figures(spark.createDataFrame([(t,) for t in text], "value string")).first()
    assert (row["total_requests"], row["prediction_count"], row["average_latency_ms"]) == (7.0, 8.0, 250.0)


# ---- streams over several micro-batches -----------------------------------------------------------------
def files_of(spark, folder, rows, schema, sizes):
    """A stream whose micro-batches are consecutive parts of ``rows``."""
    at = 0
    for k, size in enumerate(sizes):
        spark.createDataFrame(rows[at:at + size], schema).coalesce(1).write.mode("append").parquet(folder)
        new = max(Path(folder).glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
        os.utime(new, (1_700_000_000 + 10 * k,) * 2)
        at += size
    frame = spark.read.parquet(folder)
    return frame, runs.file_stream(spark, folder, "*.parquet", frame.schema, files_per_trigger=1)


def test_ema_over_batches_in_any_order(spark, tmp_path):
    rows = [("a" if i % 3 else None, START + dt.timedelta(seconds=90 * i), i, float(i % 7)) for i in range(200)]
    np.random.default_rng(4).shuffle(rows)
    schema = "model_name string, ts timestamp, request_id long, latency_ms double"
    frame, stream = files_of(spark, str(tmp_path / "in"), rows, schema, [60, 1, 99, 40])
    target = str(tmp_path / "out")
    runs.run_batches(stream, E.ema_batches(target, ["model_name"], "ts", ["request_id"], "latency_ms", seconds=600), "ema")
    got = {r["model_name"]: (r["n"], r["ema"]) for r in E.stored_ema(spark, target, ["model_name"], 0.1, "model_name string").collect()}
    for key in ("a", None):
        values = [r[3] for r in sorted((r for r in rows if r[0] == key), key=lambda r: r[1])]
        average = values[0]
        for x in values[1:]:
            average = 0.9 * average + 0.1 * x
        assert got[key] == (len(values), pytest.approx(average))
    batch = {r["model_name"]: r["ema"] for r in H.ema(frame, ["model_name"], "ts", ["request_id"], "latency_ms").collect()}
    assert batch == {k: pytest.approx(v[1]) for k, v in got.items()}
    # only touched slices are written again
    assert spark.read.parquet(f"{target}/slices/batch=1").count() == 1


@pytest.mark.parametrize("fan", [2, 32])
def test_cooldown_of_a_hot_key(spark, monkeypatch, fan):
    """A key with nine tenths of the rows, gaps of many pauses, ties, a null key, moments before 1970."""
    monkeypatch.setattr(cooldown, "FAN", fan)
    rng = np.random.default_rng(fan)
    minutes = np.concatenate([rng.integers(0, 900, 700), rng.integers(40_000, 40_300, 200), rng.integers(-2000, -1900, 60)])
    rows = [("hot" if rng.random() < 0.9 else rng.choice(["b", "", None]), dt.datetime(1970, 1, 1) + dt.timedelta(minutes=int(m)), i)
            for i, m in enumerate(minutes)]
    df = spark.createDataFrame(rows, "entity string, ts timestamp, event_id long")
    assert {r["event_id"] for r in cooldown.cooled_down(df, ["entity"]).collect()} == cooldown_by_hand(rows)
    assert cooldown.cooled_down(df.where("false"), ["entity"]).count() == 0


def test_alert_stream_over_batches(spark, tmp_path):
    rows = sorted([(START + dt.timedelta(minutes=7 * i), i, "system", "e", "cpu_percent", 99.0) for i in range(40)])
    schema = "ts timestamp, event_id long, source string, entity string, metric string, value double"
    kinds = H.violations(spark.createDataFrame([], schema), H.rules_table(spark)).select("alert_type", "entity", *jobs.VIOLATION).schema
    wanted = cooldown_by_hand([("e", r[0], r[1]) for r in rows])
    shuffled = [rows[i] for i in np.random.default_rng(1).permutation(40)]
    for name, given in (("ordered", rows), ("shuffled", shuffled)):
        _, stream = files_of(spark, str(tmp_path / name), given, schema, [10, 1, 19, 10])
        target = str(tmp_path / f"{name}-out")
        runs.run_batches(stream, jobs.alert_batches(target, H.rules_table(spark)), "alerts")
        assert {r["event_id"] for r in jobs.settled(spark, target, kinds).collect()} == wanted
        live = {r["event_id"] for r in spark.read.parquet(f"{target}/live").collect()}
        assert live == wanted if name == "ordered" else len(live) > 3
    assert not Path(f"{target}/last/batch=0").exists() and Path(f"{target}/last/batch=3").exists()


METRICS = "source string, metric string, ts timestamp, value double"


def test_windows_close_and_are_restated(spark, tmp_path):
    """Rows in any order: open windows leave the state, late rows are told and corrected."""
    rng = np.random.default_rng(5)
    rows = [("s", "m" if i % 4 else None, START + dt.timedelta(seconds=17 * i), float(rng.normal(1e6, 1))) for i in range(900)]
    late = [rows[i] for i in rng.choice(500, 60, replace=False)] + [("new", "late", START, None)]
    given = [*[r for r in rows if r not in late], *late, ("s", "m", None, 1.0)]
    frame, stream = files_of(spark, str(tmp_path / "in"), given, METRICS, [300, 300, len(given) - 640, 40])
    parts, target = jobs.metric_parts(), str(tmp_path / "out")
    runs.run_batches(stream, W.window_batches(target, parts), "windows")
    schema = W.part_schema(parts, frame.schema, spark)

    def rounded(df):
        return sorted(tuple(round(x, 3) if isinstance(x, float) else str(x) for x in r) for r in df.collect())

    batch = jobs.metric_windows(frame)
    assert rounded(jobs.metrics_of(W.every(spark, target, parts, schema))) == rounded(batch)
    newest = frame.agg(F.max("ts")).first()[0]
    closed = F.col("window_end") <= F.lit(newest - dt.timedelta(minutes=10))
    restated = W.restated(spark, target, parts, schema)
    assert rounded(jobs.metrics_of(restated)) == rounded(batch.where(closed)) != rounded(jobs.metrics_of(W.first_seen(spark, target, schema)))
    spread = F.sqrt(F.try_divide("value_squares", "value_n")).alias("spread")
    exact = parts.of(frame).where(closed).select("window_start", "source", "metric", spread)
    assert rounded(restated.select("window_start", "source", "metric", spread)) == rounded(exact)
    told = spark.read.parquet(f"{target}/parts").where("kind = 'late'")
    assert told.agg(F.sum("rows")).first()[0] == 61
    held = spark.read.schema(schema).parquet(f"{target}/parts/batch=3/kind=open")
    assert held.count() < 30 and held.agg(F.min("window_end")).first()[0] > newest - dt.timedelta(minutes=10)
    assert not Path(f"{target}/parts/batch=1/kind=open").exists() and Path(f"{target}/parts/batch=2/kind=open").exists()


def test_drift_verdict_of_each_window_at_an_interval(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(START + dt.timedelta(minutes=int(m)), float(rng.normal(10 + (m > 400) * 5, 2))) for m in rng.permutation(600)]
    frame, stream = files_of(spark, str(tmp_path / "in"), rows, "ts timestamp, x double", [100, 250, 250])
    reference = [(float(v),) for v in rng.normal(10, 2, 500)]
    drift.profile(spark.createDataFrame(reference, "x double"), ["x"]).write.parquet(str(tmp_path / "profile"))
    stored, target = spark.read.parquet(str(tmp_path / "profile")), str(tmp_path / "out")
    watch = jobs.watch_drift(stream, stored, ["x"], target, str(tmp_path / "state"), "1 second")
    try:
        watch.processAllAvailable()
    finally:
        watch.stop()
    parts = jobs.drift_parts(["x"])
    got = jobs.window_verdicts(stored, W.every(spark, target, parts, W.part_schema(parts, frame.schema, spark)), ["x"]).collect()
    ref = np.array([r[0] for r in reference])
    for row in got:
        x = np.array([v for t, v in rows if row["window_start"] <= t < row["window_end"]])
        score = (abs(x.mean() - ref.mean()) + abs(x.std(ddof=1) - ref.std(ddof=1)) + abs(np.median(x) - np.median(ref))) / ref.std(ddof=1) / 3
        assert row["drift_score"] == pytest.approx(score) and row["overall_drift_detected"] == (score > 0.25)
    assert len(got) == 10 and spark.read.parquet(f"{target}/verdicts").count() == 9  # the last window is open


def test_sessions_from_fragments_of_batches(spark, tmp_path):
    minutes = [0, 3, 12, 22, 31, 31, 60, 69, 79]
    rows = [(u, START + dt.timedelta(minutes=m), float(m)) for u in ("u", None) for m in minutes]
    np.random.default_rng(2).shuffle(rows)
    frame, stream = files_of(spark, str(tmp_path / "in"), rows, "user_id string, ts timestamp, latency_ms double", [5, 5, 8])
    target, values = str(tmp_path / "out"), {"ms": F.col("latency_ms")}
    runs.run_batches(stream, K.fragment_batches(target, "user_id", 600, values), "sessions")
    got = K.stored_sessions(spark, target, "user_id", 600, values, frame.schema)
    found = sorted((str(r[0]), r[1], r[2], r[3], r[5]) for r in got.collect())
    # a pause of exactly ten minutes ends a session
    one = [(0, 3, 12), (22, 31, 31), (60, 69), (79,)]
    assert found == sorted(
        (u, START + dt.timedelta(minutes=s[0]), START + dt.timedelta(minutes=s[-1] + 10), len(s), float(sum(s))) for u in ("u", "None") for s in one)
    assert spark.read.parquet(f"{target}/batch=1").agg(F.sum("rows")).first()[0] == 5


def test_retention_keeps_areas_without_a_limit(spark):
    areas = spark.range(3000).select(
        F.explode(F.array(F.lit("feature_store"), F.lit("system"), F.lit("alerts"), F.lit(None).cast("string"))).alias("source"),
        F.timestamp_seconds(F.col("id")).alias("ts"), F.col("id").alias("event_id"))
    got = {r["source"]: (r["n"], r["first"]) for r in H.keep_newest(areas, {"system": 2000, "alerts": 100}).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first")).collect()}
    assert got == {"feature_store": (3000, 0), None: (3000, 0), "system": (2000, 1000), "alerts": (100, 2900)}


@pytest.mark.parametrize(("check", "state", "word"), [(1.0, "healthy", "Performing Well"), (0.0, "unhealthy", "API Down"), (None, "no_data", "Performing Well")])
def test_api_state_comes_from_its_health_check(spark, check, state, word):
    rows = metric_rows(spark, cpu_percent=10, memory_percent=10, val_mape=10, average_latency_ms=5000, quality_score=90)
    if check is not None:
        rows = rows.unionByName(spark.createDataFrame([(START, 50, "models", "api_health", "status_healthy", check)], rows.schema))
    got = {r["area"]: r["status"] for r in H.health(rows, F.lit(1.0)).collect()}
    assert got["api"] == state
    assert H.overall_models(rows).first()["models_count"] == 1
    assert {r["area"]: r["indicator"] for r in H.indicators(rows, F.lit(1.0)).collect()}["models"] == word
