"""The complete feature table as one lazy plan.

Shuffles: the aggregation on (date, item), which the wholesale join reuses; the (date, category) window; and
one exchange on item that serves changes, lags, rolling values and targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketgrain import schemas as S
from marketgrain.operators import daily as D
from marketgrain.operators import encode, enrich, impute, series


def raw_features(
    sales: DataFrame,
    wholesale: DataFrame | None = None,
    items: DataFrame | None = None,
    loss_rates: DataFrame | None = None,
    season_rule: str = "meteorological",
    dedupe: bool = True,
) -> DataFrame:
    """All features before imputation and encoding. Absent tables leave out their columns."""
    df = D.daily_aggregate(sales)
    if wholesale is not None:
        df = enrich.add_wholesale(df, wholesale, dedupe)
    if items is not None:
        df = enrich.add_category_shares(enrich.add_category(df, items))
    if loss_rates is not None:
        df = enrich.add_loss(df, loss_rates)
    # several quotes a day give several rows a day: the quote then breaks the tie
    order = [S.DATE] if dedupe or wholesale is None else [S.DATE, S.WHOLESALE]
    window = series.item_window(order=order)
    changes = {"Avg_Price": "Avg_Price_Change", S.WHOLESALE: "Wholesale_Price_Change"}
    if wholesale is not None:
        df = series.add_changes(df, changes, window)
    df = series.add_targets(series.add_rolling(series.add_lags(df, window), window), window)
    df = enrich.add_season(D.add_calendar(df), season_rule)
    df = enrich.add_interactions(df)
    extra = [n for n in ("Season", "Loss_Rate_Category") if n in df.columns]
    return df.select(*[f"`{n}`" for n in S.FEATURE_TABLE if n in df.columns], *extra)


def feature_table(
    sales: DataFrame,
    wholesale: DataFrame | None = None,
    items: DataFrame | None = None,
    loss_rates: DataFrame | None = None,
    season_rule: str = "meteorological",
    dedupe: bool = True,
    fill_targets: bool = False,
) -> DataFrame:
    """The finished table: 105 columns when all four inputs are given.

    ``season_rule='shifted'``, ``dedupe=False`` and ``fill_targets=True`` give the values of the original
    table; the defaults avoid its season shift, its row fan-out and its target leakage.
    """
    df = raw_features(sales, wholesale, items, loss_rates, season_rule, dedupe)
    df = encode.encode_features(impute.fill_series(df, fill_targets))
    return df.select(*[f"`{n}`" for n in S.FEATURE_TABLE if n in df.columns])
