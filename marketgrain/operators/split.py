"""Train, validation and test parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketgrain import schemas as S
from marketgrain.functions.order_stats import running_total
from marketgrain.functions.naming import c

TRAIN_SHARE, VALIDATION_SHARE = 0.70, 0.85


def _part(position: Column, total: Column) -> Column:
    return (
        F.when(position < F.floor(total * TRAIN_SHARE), "train")
        .when(position < F.floor(total * VALIDATION_SHARE), "validation")
        .otherwise("test")
    )


def split_by_rows(df: DataFrame) -> DataFrame:
    """Consecutive 70/15/15 split of the table ordered by (item, date), as column ``split``.

    The global row number is the item's row number plus the rows of all smaller items, so no task sorts
    the whole table.
    """
    per_item = df.groupBy(S.ITEM).agg(F.count(F.lit(1)).alias("_rows"))
    before = running_total(per_item, [], S.ITEM, {"_rows": "_upto"}).select(
        S.ITEM, (F.col("_upto") - F.col("_rows")).alias("_before")
    )
    total = per_item.agg(F.sum("_rows")).scalar()
    row = F.row_number().over(Window.partitionBy(S.ITEM).orderBy(S.DATE)) - 1
    numbered = df.join(before, S.ITEM).withColumn("_row", F.col("_before") + row)
    return numbered.withColumn("split", _part(F.col("_row"), total)).drop("_before", "_row")


def split_by_time(df: DataFrame) -> DataFrame:
    """70/15/15 by date: a date belongs to the part in which its first row falls.

    The running count is over calendar days, a small table whatever the number of rows.
    """
    per_day = df.groupBy(S.DATE).agg(F.count(F.lit(1)).alias("_rows"))
    total = per_day.agg(F.sum("_rows")).scalar()
    days = running_total(per_day, [], S.DATE, {"_rows": "_upto"}).select(
        S.DATE, _part(F.col("_upto") - F.col("_rows"), total).alias("split")
    )
    return df.join(days, S.DATE)


def parts(df: DataFrame, target: str | None = None) -> dict[str, DataFrame]:
    """The three parts as frames; rows without the first target are dropped."""
    first = target or next((n for n in df.columns if "Target" in n), None)
    kept = df.where(c(first).isNotNull()) if first else df
    return {name: kept.where(F.col("split") == name).drop("split") for name in ("train", "validation", "test")}
