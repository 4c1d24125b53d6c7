"""Encoding of categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from marketgrain import schemas as S
from marketgrain.functions.naming import c
from marketgrain.functions.numeric import flag


def one_hot(df: DataFrame, name: str, levels: Sequence[str]) -> DataFrame:
    """0/1 columns for fixed levels (the first level of the source is left out), replacing ``name``."""
    return df.withColumns({f"{name}_{level}": flag(c(name) == level) for level in levels}).drop(name)


def label_table(df: DataFrame, name: str, out: str) -> DataFrame:
    """Distinct values numbered from 0 in alphabetical order.

    The window runs over the distinct category names, whose number is that of the item master's categories
    and does not grow with the rows.
    """
    return df.select(F.coalesce(c(name), F.lit("None")).alias(name)).distinct().withColumn(
        out, (F.row_number().over(Window.orderBy(name)) - 1).cast("long")
    )


def label_encode(df: DataFrame, name: str, out: str, source: DataFrame | None = None) -> DataFrame:
    """Add the label of ``name``; ``source`` may be a smaller table that holds the same values."""
    labels = label_table(df if source is None else source, name, "_label").withColumnRenamed(name, "_value")
    joined = df.join(labels, F.coalesce(c(name), F.lit("None")) == F.col("_value"), "left")
    return joined.withColumnRenamed("_label", out).drop("_value")


def encode_features(df: DataFrame) -> DataFrame:
    if "Season" in df.columns:
        df = one_hot(df, "Season", [d.removeprefix("Season_") for d in S.SEASON_DUMMIES])
    if "Loss_Rate_Category" in df.columns:
        df = one_hot(df, "Loss_Rate_Category", [d.removeprefix("Loss_Rate_Category_") for d in S.LOSS_DUMMIES])
    if S.CATEGORY_NAME in df.columns:
        df = label_encode(df, S.CATEGORY_NAME, S.CATEGORY_ENCODED)
    return df
