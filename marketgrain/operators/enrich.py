"""Join price, category and loss information onto the daily table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marketgrain import schemas as S
from marketgrain.functions.calendar import season
from marketgrain.functions.naming import c
from marketgrain.functions.numeric import flag, ratio
from marketgrain.functions.pricing import effective_supply, loss_band


def wholesale_per_day(wholesale: DataFrame) -> DataFrame:
    """One mean quote per (date, item), so that the join keeps the daily grain."""
    return wholesale.groupBy(S.DATE, S.ITEM).agg(F.avg(c(S.WHOLESALE)).alias(S.WHOLESALE))


def add_wholesale(daily: DataFrame, wholesale: DataFrame, dedupe: bool = True) -> DataFrame:
    """Left join of quotes plus ratio and markup.

    Both sides are hashed on (date, item) by their aggregations, so the join adds no shuffle. With
    ``dedupe=False`` several quotes a day multiply the row.
    """
    quotes = wholesale_per_day(wholesale) if dedupe else wholesale.select(S.DATE, S.ITEM, S.WHOLESALE)
    quote, price = c(S.WHOLESALE), F.col("Avg_Price")
    joined = daily.join(quotes, [S.DATE, S.ITEM], "left")
    return joined.withColumns({
        "Retail_Wholesale_Ratio": ratio(price, quote, 1.0),
        "Price_Markup": F.coalesce(price - quote, F.lit(0.0)),
        "Price_Markup_Pct": F.coalesce(ratio(F.coalesce(price - quote, F.lit(0.0)), quote) * 100, F.lit(0.0)),
    })


def add_category(df: DataFrame, items: DataFrame) -> DataFrame:
    """Left join of the item master."""
    return df.join(items.select(S.ITEM, S.CATEGORY, S.CATEGORY_NAME), S.ITEM, "left")


def category_day_totals(df: DataFrame) -> DataFrame:
    """Totals per (date, category) as a table."""
    return df.where(c(S.CATEGORY).isNotNull()).groupBy(S.DATE, S.CATEGORY).agg(
        F.sum("Total_Quantity").alias("Category_Total_Quantity"),
        F.avg("Avg_Price").alias("Category_Avg_Price"),
        F.sum("Revenue").alias("Category_Revenue"),
    )


def add_category_shares(df: DataFrame) -> DataFrame:
    """Totals of the day's category on every row and the item's share in them.

    A window instead of aggregate-and-join: one shuffle, and a group is at most the items of one category on
    one day. Rows without a category get no totals.
    """
    day = Window.partitionBy(S.DATE, S.CATEGORY)
    known = c(S.CATEGORY).isNotNull()
    totals = {
        "Category_Total_Quantity": F.when(known, F.sum("Total_Quantity").over(day)),
        "Category_Avg_Price": F.when(known, F.avg("Avg_Price").over(day)),
        "Category_Revenue": F.when(known, F.sum("Revenue").over(day)),
    }
    shares = {
        "Item_Quantity_Share": ratio(F.col("Total_Quantity"), F.col("Category_Total_Quantity"), 0.0),
        "Item_Revenue_Share": ratio(F.col("Revenue"), F.col("Category_Revenue"), 0.0),
        "Price_Relative_to_Category": ratio(F.col("Avg_Price"), F.col("Category_Avg_Price"), 1.0),
    }
    return df.withColumns(totals).withColumns(shares)


def fill_loss(df: DataFrame, default: float = S.DEFAULT_LOSS_RATE) -> DataFrame:
    """Missing loss rates take the mean over their category's rows, then ``default``.

    The means are aggregated and joined back: a window over a category would sort all its rows in one task.
    """
    means = df.where(c(S.CATEGORY).isNotNull()).groupBy(S.CATEGORY).agg(F.avg(c(S.LOSS)).alias("_mean_loss"))
    filled = df.join(means, S.CATEGORY, "left").withColumn(
        S.LOSS, F.coalesce(c(S.LOSS), F.col("_mean_loss"), F.lit(default))
    )
    return filled.drop("_mean_loss")


def add_loss(df: DataFrame, loss_rates: DataFrame) -> DataFrame:
    """Left join of loss rates, filled, with supply and revenue net of loss and the loss band."""
    joined = df.join(loss_rates.select(S.ITEM, S.LOSS), S.ITEM, "left")
    if S.CATEGORY in df.columns:
        filled = fill_loss(joined)
    else:
        from marketgrain.functions.order_stats import quantile

        filled = joined.withColumn(S.LOSS, F.coalesce(c(S.LOSS), quantile(joined, S.LOSS, 0.5)))
    return (
        filled.withColumn("Effective_Supply", effective_supply(F.col("Total_Quantity"), c(S.LOSS)))
        .withColumn("Loss_Adjusted_Revenue", F.col("Effective_Supply") * F.col("Avg_Price"))
        .withColumn("Loss_Rate_Category", loss_band(c(S.LOSS)))
    )


def add_season(df: DataFrame, rule: str = "meteorological") -> DataFrame:
    return df.withColumn("Season", season(F.col("Month"), rule))


def add_interactions(df: DataFrame) -> DataFrame:
    """Products of price, quantity, season and holidays. Needs ``Season`` and the calendar columns."""
    price, quantity = F.col("Avg_Price"), F.col("Total_Quantity")
    columns = {
        "Price_Quantity_Interaction": price * quantity,
        "Price_Volatility_Quantity": F.col("Price_Volatility") * quantity,
    }
    for name in S.SEASONS:
        columns[f"{name}_Price"] = price * flag(F.col("Season") == name)
    columns["Holiday_Demand"] = quantity * (F.col("IsNationalDay") + F.col("IsLaborDay"))
    return df.withColumns(columns)
