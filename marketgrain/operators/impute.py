"""Filling of missing values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from marketgrain import schemas as S
from marketgrain.functions.naming import c
from marketgrain.functions.numeric import finite, is_numeric
from marketgrain.functions.order_stats import exact_quantiles
from marketgrain.operators.series import fill_both_ways
from marketgrain.session import materialize

# fixed values: what a missing model input means
INPUT_DEFAULTS = {
    "Price_Volatility": 0.0, "Discount_Rate": 0.0, "Price_Range": 0.0, "Retail_Wholesale_Ratio": 1.0,
    "Price_Markup": 0.0, "Price_Markup_Pct": 0.0, "Item_Revenue_Share": 0.0, "Price_Relative_to_Category": 1.0,
    S.LOSS: 10.0, "IsWeekend": 0,
}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def text_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def medians(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exact medians as rows (feature, median)."""
    long = df.select(*[finite(c(n)).alias(n) for n in names]).unpivot([], list(names), "feature", "value")
    return exact_quantiles(long, ["feature"], "value", [0.5]).select(
        "feature", F.element_at("quantiles", 1).alias("median")
    )


def median_values(df: DataFrame, names: Sequence[str]) -> dict[str, float]:
    """The medians as plain numbers, one per column of the schema."""
    return {row["feature"]: row["median"] for row in medians(df, names).collect()} if names else {}


def mode(df: DataFrame, name: str) -> Column:
    """Most frequent value as a scalar subquery, the smallest among ties."""
    counts = df.where(c(name).isNotNull()).groupBy(c(name).alias("v")).count()
    return counts.orderBy(F.desc("count"), "v").limit(1).select("v").scalar()


def _null_masks(names: Sequence[str]) -> list[Column]:
    """NULL flags of the columns as bits, 60 columns to a 64-bit integer.

    A hundred separate aggregates make a plan slow to compile; a few bit operations do not.
    """
    masks = []
    for start in range(0, len(names), 60):
        bits = [F.when(c(n).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, n in enumerate(names[start:start + 60])]
        masks.append(reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long"))
    return masks


def _named(names: Sequence[str], masks: Sequence[int | None]) -> list[str]:
    return [n for i, n in enumerate(names) if (masks[i // 60] or 0) >> (i % 60) & 1]


def columns_with_gaps(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Which columns hold a NULL, by one pass that returns a single row."""
    if not names:
        return []
    return _named(names, df.agg(*[F.bit_or(m) for m in _null_masks(names)]).first())


def _cast_like(df: DataFrame, name: str, value: float) -> Column:
    return F.lit(value).cast(df.schema[name].dataType)


def fill_medians(df: DataFrame, names: Sequence[str], fitted: dict[str, float] | None = None) -> DataFrame:
    """NULL becomes the column's median, or the given fitted value, or 0 where there is none."""
    if fitted is None:
        df = materialize(df, "inputs")
        fitted = median_values(df, columns_with_gaps(df, names))
    values = fitted
    return df.withColumns({n: F.coalesce(c(n), _cast_like(df, n, values.get(n, 0.0))) for n in names})


def _gaps_per_item(df: DataFrame, names: Sequence[str]) -> tuple[list[str], list[str]]:
    """Columns with a NULL, and of these the columns some item has no value for at all; one pass, one row."""
    if not names:
        return [], []
    masks = _null_masks(names)
    some, every = [f"some{i}" for i in range(len(masks))], [f"every{i}" for i in range(len(masks))]
    per_item = df.groupBy(S.ITEM).agg(
        *[F.bit_or(m).alias(n) for m, n in zip(masks, some)], *[F.bit_and(m).alias(n) for m, n in zip(masks, every)]
    )
    row = per_item.agg(*[F.bit_or(n) for n in some + every]).first()
    return _named(names, row[:len(masks)]), _named(names, row[len(masks):])


def fill_series(df: DataFrame, fill_targets: bool = False) -> DataFrame:
    """Numbers: forward, backward within the item, then the median. Texts: the mode, else 'Unknown'.

    The table is materialised once; windows are then built only for columns with gaps, and medians are computed
    only for columns that some item lacks altogether.
    """
    df = materialize(df, "unfilled")
    skip = () if fill_targets else tuple(n for n in df.columns if "Target" in n)
    texts = text_columns(df)
    numbers = [n for n in numeric_columns(df) if n not in skip and n != S.ITEM]
    found, lacking = _gaps_per_item(df, [*numbers, *texts])
    gaps, empty = ([n for n in group if n not in texts] for group in (found, lacking))
    filled = fill_both_ways(df, gaps) if gaps else df
    values = median_values(filled, empty)
    fills = {n: F.coalesce(c(n), _cast_like(df, n, values[n])) for n in empty if values.get(n) is not None}
    fills |= {n: F.coalesce(c(n), mode(df, n), F.lit("Unknown")) for n in found if n in texts}
    return filled.withColumns(fills) if fills else filled


def _base_name(name: str, marks: Sequence[str]) -> str | None:
    for mark in marks:
        if mark in name:
            return name.split(mark)[0]
    return None


def fill_model_inputs(df: DataFrame, fitted: dict[str, float] | None = None) -> DataFrame:
    """Model inputs: fixed defaults; lags and means fall back to today's value; then the median, then 0."""
    fills: dict[str, Column] = {}
    for name in numeric_columns(df):
        options = [c(name)]
        if name in INPUT_DEFAULTS:
            options.append(_cast_like(df, name, INPUT_DEFAULTS[name]))
        base = _base_name(name, ("_Lag_", "_MA_"))
        if base in df.columns:
            options.append(c(base).cast(df.schema[name].dataType))
        if len(options) > 1:
            fills[name] = F.coalesce(*options)
    filled = df.withColumns(fills) if fills else df
    return fill_medians(filled, numeric_columns(df), fitted)


def without_infinities(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({n: finite(c(n)) for n in names})
