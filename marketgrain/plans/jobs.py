"""Whole jobs: validation, feature build, training, drift check and dashboard."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketgrain import schemas as S
from marketgrain.operators import drift, modeling as M, quality as Q, split
from marketgrain.plans.features import feature_table
from marketgrain.session import materialize
from marketgrain.sources import readers, writers


def validate(spark: SparkSession, folder: str, target: str | None = None) -> dict[str, DataFrame]:
    """Manifest, schema findings, quality scores, rules and the summary of a raw folder, stored in ``target`` if there is one."""
    manifest = readers.source_manifest(spark, folder)
    # the checks read each table some ten times; its text is parsed once
    tables = {name: materialize(df, f"raw-{name}") for name, df in readers.read_raw(spark, folder).items()}
    out = {"manifest": manifest}
    if not tables:
        return out
    out["columns"] = reduce(
        DataFrame.unionByName, [Q.check_columns(df, S.RAW_SCHEMAS[name]) for name, df in tables.items()]
    )
    scores = reduce(DataFrame.unionByName, [Q.quality_score(df, name) for name, df in tables.items()])
    out["scores"] = materialize(scores, "scores")
    out["rules"] = Q.business_rules(tables)
    out["summary"] = Q.run_summary(out["scores"], len(tables) == len(S.RAW_FILES))
    if target:
        writers.save_validation(out, target)
    return out


def build_features(spark: SparkSession, folder: str, target: str, how: str = "time", **options) -> dict[str, str]:
    """Raw CSV folder to the feature folders."""
    tables = readers.read_raw(spark, folder)
    if "sales" not in tables:
        raise ValueError(f"no sales file in {folder}")
    table = feature_table(
        tables["sales"], tables.get("wholesale"), tables.get("items"), tables.get("loss_rates"), **options
    )
    return writers.write_features(table, target, how)


def train(parts: dict[str, DataFrame], horizon: int = 1, names=M.MODELS) -> tuple[dict, DataFrame]:
    """Fit the models on the training part; returns them and the metrics per model and split.

    Medians are fitted on the training part and used for all.
    """
    rows = {n: parts[n] for n in ("train", "validation", "test") if n in parts}
    fitted = M.fit_medians(*[M.labelled(df, horizon) for df in rows.values()])
    ready = {n: M.prepare(df, horizon, fitted) for n, df in rows.items()}
    # the fits read the training rows many times
    ready["train"] = materialize(ready["train"], "train")
    models = M.fit_all(ready["train"], names)
    scored = reduce(
        DataFrame.unionByName, [M.predictions(models, df.withColumn("split", F.lit(n))) for n, df in ready.items()]
    )
    return models, materialize(M.metrics(scored, ["model", "split"]), "metrics")
