"""Row-based window features of each item's daily series.

All windows share one partitioning and one ordering, so a plan with all of them shuffles and sorts once. An
item has at most one row per calendar day, which bounds every window partition whatever the number of sales.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from marketgrain import schemas as S
from marketgrain.functions.numeric import ratio


def item_window(keys: Sequence[str] = (S.ITEM,), order: Sequence[str] = (S.DATE,)) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def _trailing(window: WindowSpec, rows: int) -> WindowSpec:
    return window.rowsBetween(-(rows - 1), 0)


def add_lags(df: DataFrame, window: WindowSpec | None = None) -> DataFrame:
    w = window or item_window()
    return df.withColumns({f"{name}_Lag_{k}": F.lag(name, k).over(w) for k in S.LAGS for name in S.LAGGED})


def add_rolling(df: DataFrame, window: WindowSpec | None = None) -> DataFrame:
    """Trailing means, deviations and extremes; a window is as long as the rows allow, at least one."""
    w = window or item_window()
    columns: dict[str, Column] = {}
    for rows in S.WINDOWS:
        frame = _trailing(w, rows)
        for name in S.LAGGED:
            columns[f"{name}_MA_{rows}"] = F.avg(name).over(frame)
        for name in ("Avg_Price", "Total_Quantity"):
            columns[f"{name}_Std_{rows}"] = F.stddev_samp(name).over(frame)
        columns[f"Avg_Price_Min_{rows}"] = F.min("Avg_Price").over(frame)
        columns[f"Avg_Price_Max_{rows}"] = F.max("Avg_Price").over(frame)
    return df.withColumns(columns)


def add_targets(df: DataFrame, window: WindowSpec | None = None) -> DataFrame:
    """Price, price change in percent and quantity some rows ahead."""
    w = window or item_window()
    price = F.col("Avg_Price")
    columns: dict[str, Column] = {}
    for h in S.HORIZONS:
        ahead = F.lead("Avg_Price", h).over(w)
        columns[f"Avg_Price_Target_{h}d"] = ahead
        columns[f"Price_Change_Target_{h}d"] = ratio(ahead - price, price) * 100
        columns[f"Quantity_Target_{h}d"] = F.lead("Total_Quantity", h).over(w)
    return df.withColumns(columns)


def with_target_inputs(df: DataFrame) -> DataFrame:
    """Make sure the columns that targets are built from exist, from raw columns or fixed defaults."""
    sources = {
        "Total_Quantity": (S.QUANTITY, F.lit(100.0)),
        "Avg_Price": (S.PRICE, F.lit(15.0)),
        S.ITEM: (None, F.lit(1).cast("long")),
    }
    missing = {
        name: F.col(f"`{raw}`") if raw in df.columns else default
        for name, (raw, default) in sources.items()
        if name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def add_changes(df: DataFrame, changes: dict[str, str], window: WindowSpec | None = None) -> DataFrame:
    """Relative change to the row before; gaps are padded with the last known value first."""
    w = window or item_window()
    padded = {f"_pad_{out}": F.last(F.col(f"`{name}`"), ignorenulls=True).over(w) for name, out in changes.items()}
    rates = {
        out: ratio(F.col(f"_pad_{out}"), F.lag(f"_pad_{out}").over(w)) - 1 for out in changes.values()
    }
    return df.withColumns(padded).withColumns(rates).drop(*padded)


def forward_fill(df: DataFrame, names: Sequence[str], window: WindowSpec | None = None) -> DataFrame:
    w = (window or item_window()).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({n: F.last(F.col(f"`{n}`"), ignorenulls=True).over(w) for n in names})


def backward_fill(
    df: DataFrame, names: Sequence[str], keys: Sequence[str] = (S.ITEM,), order: Sequence[str] = (S.DATE,)
) -> DataFrame:
    """Next known value. Ordered backwards, because a frame that reaches to the end of the partition is
    evaluated anew for every row."""
    w = item_window(keys, [F.col(o).desc() for o in order]).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({n: F.last(F.col(f"`{n}`"), ignorenulls=True).over(w) for n in names})


def fill_both_ways(df: DataFrame, names: Sequence[str], window: WindowSpec | None = None) -> DataFrame:
    """Forward fill, then backward fill.

    After a forward fill only the rows ahead of the first known value are empty, and that first value is the
    same for all of them: a whole-partition frame finds it in the same sort order.
    """
    w = window or item_window()
    back, whole = (w.rowsBetween(Window.unboundedPreceding, last) for last in (0, Window.unboundedFollowing))
    return df.withColumns({
        n: F.coalesce(
            F.last(F.col(f"`{n}`"), ignorenulls=True).over(back), F.first(F.col(f"`{n}`"), ignorenulls=True).over(whole)
        )
        for n in names
    })


def newest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], count: int) -> DataFrame:
    """The newest ``count`` rows of each key. Spark cuts each task's rows to ``count`` before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order])
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= count).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The newest row of each key, combined before the shuffle."""
    rest = [n for n in df.columns if n not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{n}`") for n in rest]), order).alias("_row"))
    return newest.select(*keys, *[F.col("_row").getField(n).alias(n) for n in rest])
