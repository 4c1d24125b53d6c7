"""Sinks. Every table is its own folder, so that a catalog table can be laid over it."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from marketgrain.operators import bi, split
from marketgrain.sources.catalog import feature_metadata
from marketgrain.sources.readers import path_exists


def write_features(features: DataFrame, folder: str, how: str = "time") -> dict[str, str]:
    """The complete table (by year), its three splits and the metadata; returns the paths.

    The complete table is written first and the rest is derived from the files, so features are computed once.
    """
    paths = {n: f"{folder}/{n}" for n in ("features_complete", "train", "validation", "test", "metadata")}
    features.write.mode("overwrite").partitionBy("Year").parquet(paths["features_complete"])
    stored = features.sparkSession.read.parquet(paths["features_complete"]).select(*[f"`{n}`" for n in features.columns])
    marked = split.split_by_rows(stored) if how == "rows" else split.split_by_time(stored)
    for name, part in split.parts(marked).items():
        part.write.mode("overwrite").parquet(paths[name])
    feature_metadata(marked).write.mode("overwrite").json(paths["metadata"])
    return paths


def write_dashboard(features: DataFrame, folder: str, components: list[str] | None = None) -> None:
    """One JSON row set per dataset under ``component=…/dataset=…``.

    Only the folders of the written components are replaced; the others stay.
    """
    for component in components or bi.COMPONENTS:
        parts = None
        for dataset, build in bi.COMPONENTS[component].items():
            rows = build(features)
            packed = rows.select(
                F.lit(component).alias("component"), F.lit(dataset).alias("dataset"),
                F.to_json(F.struct(*[F.col(f"`{n}`") for n in rows.columns])).alias("row"),
            )
            parts = packed if parts is None else parts.unionByName(packed)
        parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("component", "dataset").json(folder)


def read_dashboard(spark: SparkSession, folder: str, component: str, dataset: str, schema) -> DataFrame:
    rows = spark.read.schema("row string, component string, dataset string").json(folder)
    kept = rows.where((F.col("component") == component) & (F.col("dataset") == dataset))
    return kept.select(F.from_json("row", schema).alias("r")).select("r.*")


def dashboard_datasets(spark: SparkSession, folder: str) -> DataFrame:
    """Which datasets are there, rows (component, dataset)."""
    return spark.read.schema("row string, component string, dataset string").json(folder).select("component", "dataset").distinct()


def write_report(features: DataFrame, path: str) -> None:
    """The daily report as text lines. A report has some twenty lines, so one file is right."""
    report = bi.daily_report(features).coalesce(1).sortWithinPartitions("section", "position")
    report.select("line").write.mode("overwrite").text(path)


def save_validation(results: dict[str, DataFrame], folder: str) -> None:
    """The parts of a validation, each in its folder; the summary is written last, so that it stands for a whole run."""
    for name in sorted(results, key=lambda n: (n == "summary", n)):
        results[name].write.mode("overwrite").json(f"{folder}/{name}")


def append_alerts(alerts: DataFrame, path: str) -> None:
    alerts.write.mode("append").json(path)


def export_metrics(metrics: DataFrame, alerts: DataFrame, folder: str) -> None:
    metrics.write.mode("overwrite").json(f"{folder}/metrics")
    alerts.write.mode("overwrite").json(f"{folder}/alerts")


# ---- drift state -----------------------------------------------------------------------------------------
def save_drift_state(profile: DataFrame, baseline: DataFrame, thresholds: dict[str, float], folder: str) -> None:
    profile.write.mode("overwrite").parquet(f"{folder}/reference_stats")
    baseline.write.mode("overwrite").parquet(f"{folder}/baseline_performance")
    rows = profile.sparkSession.createDataFrame([(json.dumps(thresholds),)], "thresholds string")
    rows.write.mode("overwrite").json(f"{folder}/thresholds")


def load_drift_state(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, dict[str, float]]:
    if not path_exists(spark, f"{folder}/reference_stats"):
        raise FileNotFoundError(f"no drift state in {folder}")
    text = spark.read.schema("thresholds string").json(f"{folder}/thresholds").first()[0]
    return (
        spark.read.parquet(f"{folder}/reference_stats"), spark.read.parquet(f"{folder}/baseline_performance"), json.loads(text)
    )


# ---- fitted models ----------------------------------------------------------------------------------------
def save_models(models: dict[str, PipelineModel], metrics: DataFrame, inputs: Sequence[str], folder: str) -> None:
    """Fitted models with their evaluation and the list of their inputs."""
    for name, model in models.items():
        model.write().overwrite().save(f"{folder}/models/{name}")
    metrics.write.mode("overwrite").parquet(f"{folder}/evaluation")
    listed = metrics.sparkSession.createDataFrame(list(enumerate(inputs)), "position int, feature string")
    listed.write.mode("overwrite").parquet(f"{folder}/inputs")


def load_models(spark: SparkSession, folder: str, names: Sequence[str]) -> tuple[dict[str, PipelineModel], DataFrame, list[str]]:
    """The named models, their evaluation and inputs."""
    if not path_exists(spark, f"{folder}/models"):
        raise FileNotFoundError(f"no models in {folder}")
    inputs = [r["feature"] for r in spark.read.parquet(f"{folder}/inputs").orderBy("position").collect()]
    models = {name: PipelineModel.load(f"{folder}/models/{name}") for name in names}
    return models, spark.read.parquet(f"{folder}/evaluation"), inputs
