"""Model versions as a table: comparing, gating, promoting and retiring them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketgrain import schemas as S
from marketgrain.functions.numeric import ratio

PROTECTED = ("Production", "Staging")


def _present(df: DataFrame, *names: str) -> Column:
    have = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*have) if have else F.lit(None).cast("double")


def gate(df: DataFrame, limits: dict[str, float] | None = None) -> Column:
    """Whether a row of metrics meets the limits; the test metric counts before the validation metric and a
    metric that is absent does not fail."""
    limits = limits or S.GATE_LIMITS
    fails = [
        _present(df, "test_mape", "val_mape") > limits["mape"],
        _present(df, "test_rmse", "val_rmse") > limits["rmse"],
        _present(df, "test_r2", "val_r2") < limits["r2"],
    ]
    ok = F.lit(True)
    for fail in fails:
        ok = ok & ~F.coalesce(fail, F.lit(False))
    return ok


def compare_versions(long: DataFrame, left: Column | int | str, right: Column | int | str) -> DataFrame:
    """Two versions side by side per (model, metric): improvement in percent and the better version.

    ``long`` has rows (model, version, metric, value). Lower is better for errors; equal goes to the first.
    """
    a = long.where(F.col("version") == left).select("model", "metric", F.col("version").alias("v1"), F.col("value").alias("v1_value"))
    b = long.where(F.col("version") == right).select("model", "metric", F.col("version").alias("v2"), F.col("value").alias("v2_value"))
    v1, v2 = F.col("v1_value"), F.col("v2_value")
    lower_wins = F.col("metric").rlike("mape|rmse|mae|mse")
    better = F.when(lower_wins, v2 < v1).otherwise(v2 > v1)
    gain = F.when(lower_wins, v1 - v2).otherwise(v2 - v1)
    return a.join(b, ["model", "metric"]).select(
        "model", "metric", "v1_value", "v2_value", (ratio(gain, v1) * 100).alias("improvement_pct"),
        F.when(better, F.col("v2")).otherwise(F.col("v1")).alias("better_version"),
    )


def latest_version(versions: DataFrame) -> DataFrame:
    """Per model the newest Production version, else the newest Staging version."""
    stage = F.when(F.col("stage") == "Production", 2).when(F.col("stage") == "Staging", 1)
    order = F.struct(stage, F.col("version").cast("long"))
    return versions.where(stage.isNotNull()).groupBy("model").agg(
        F.max_by("version", order).alias("version"), F.max_by("stage", order).alias("stage")
    )


def _newest_first(versions: DataFrame):
    return Window.partitionBy("model").orderBy(F.desc("created"), F.desc("version"))


def retained(versions: DataFrame, keep: int = 5) -> DataFrame:
    """Versions marked ``keep``: protected stages always, of the others the newest ``keep``."""
    open_rows = ~F.col("stage").isin(*PROTECTED)
    rank = F.sum(open_rows.cast("int")).over(_newest_first(versions).rowsBetween(Window.unboundedPreceding, 0))
    return versions.withColumn("keep", ~open_rows | (rank <= keep))


def promote(versions: DataFrame, chosen: DataFrame, stage: str = "Production") -> DataFrame:
    """New snapshot of the table after a stage change.

    ``chosen`` has rows (model, version) to move. For Production only versions with ``passed`` move, and the
    version that held the stage is archived; Staging has no gate.
    """
    picked = chosen.select("model", F.col("version").alias("_chosen"))
    joined = versions.join(picked, "model", "left")
    mine = F.coalesce(F.col("version") == F.col("_chosen"), F.lit(False))
    if stage == "Production":
        allowed = F.coalesce(F.max(F.when(mine, F.col("passed"))).over(Window.partitionBy("model")), F.lit(False))
        moved = F.when(~allowed, F.col("stage")).when(mine, stage).when(F.col("stage") == stage, "Archived")
    else:
        moved = F.when(mine, stage)
    return joined.withColumn("stage", F.coalesce(moved, F.col("stage"))).drop("_chosen")


def staging_candidates(metrics: DataFrame, versions: DataFrame, details: dict[str, str] | None = None) -> DataFrame:
    """Models that pass the gate, at their highest version number.

    Version numbers are compared as numbers, so 10 comes after 9.
    """
    newest = versions.groupBy("model").agg(F.max(F.col("version").cast("long")).alias("version"))
    rows = metrics.withColumn("passed", gate(metrics)).join(newest, "model")
    extra = {k: F.lit(v) for k, v in (details or {}).items()}
    return rows.withColumns(extra) if extra else rows
