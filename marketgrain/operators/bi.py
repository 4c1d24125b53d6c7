"""Business reports over the feature table.

Every report takes the feature table (or any table with the columns it names) and returns a small table. Column
lookup ignores case, as the report columns of a catalog table come in lower case.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketgrain import schemas as S
from marketgrain.functions.calendar import day_type, period_text, season
from marketgrain.functions.naming import c
from marketgrain.functions.pricing import loss_band, price_band


def resolve(df: DataFrame, name: str) -> str | None:
    """The column of ``df`` that equals ``name`` up to case, or None."""
    return {n.lower(): n for n in df.columns}.get(name.lower())


def _earning(df: DataFrame) -> DataFrame:
    """Rows with revenue; NULL fails the comparison too."""
    return df.where(F.col("Revenue") > 0)


def _optional(df: DataFrame, **measures: tuple[str, Callable[[str], Column]]) -> list[Column]:
    """Aggregates of columns that may be absent."""
    return [fn(name).alias(out) for out, (name, fn) in measures.items() if resolve(df, name)]



def _count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def total_records(df: DataFrame) -> DataFrame:
    return df.agg(_count("total_records"))


def total_revenue(df: DataFrame) -> DataFrame:
    return _earning(df).agg(
        F.sum("Revenue").alias("total_revenue"), F.avg("Revenue").alias("avg_revenue"), _count("transaction_count")
    )


def date_range(df: DataFrame) -> DataFrame:
    year, month = F.col("Year"), F.col("Month")
    return df.where(year.isNotNull() & month.isNotNull()).agg(
        F.min(period_text(year, month, "01")).alias("earliest_date"),
        F.max(period_text(year, month, "28")).alias("latest_date"),
    )


def unique_items(df: DataFrame) -> DataFrame:
    return df.where(c(S.ITEM).isNotNull()).agg(F.count_distinct(c(S.ITEM)).alias("unique_items"))


def monthly_revenue(df: DataFrame) -> DataFrame:
    return (
        _earning(df)
        .where(F.col("Year").isNotNull() & F.col("Month").isNotNull())
        .groupBy(F.col("Year").alias("year"), F.col("Month").alias("month"))
        .agg(
            F.sum("Revenue").alias("monthly_revenue"), _count("transaction_count"),
            *_optional(df, avg_price=("Avg_Price", F.avg)),
        )
        .orderBy("year", "month")
    )


def seasonal_revenue(df: DataFrame) -> DataFrame:
    return (
        _earning(df)
        .where(F.col("Month").isNotNull())
        .groupBy(season(F.col("Month")).alias("season"))
        .agg(F.sum("Revenue").alias("seasonal_revenue"), _count("seasonal_transactions"))
        .orderBy(F.desc("seasonal_revenue"))
    )


def _category(df: DataFrame) -> str:
    return resolve(df, S.CATEGORY_NAME) or resolve(df, S.CATEGORY_ENCODED) or resolve(df, S.CATEGORY)


def top_categories(df: DataFrame, limit: int = 15) -> DataFrame:
    name = _category(df)
    return (
        _earning(df)
        .where(c(name).isNotNull())
        .groupBy(c(name).alias("category_name"))
        .agg(
            F.sum("Revenue").alias("total_revenue"), _count("transaction_count"),
            *_optional(df, avg_price=("Avg_Price", F.avg), total_quantity=("Total_Quantity", F.sum)),
        )
        .orderBy(F.desc("total_revenue"), "category_name")
        .limit(limit)
    )


def price_distribution(df: DataFrame) -> DataFrame:
    return (
        _earning(df)
        .where(F.col("Avg_Price") > 0)
        .groupBy(price_band(F.col("Avg_Price")).alias("price_range"))
        .agg(_count("transaction_count"), F.sum("Revenue").alias("range_revenue"), F.avg("Avg_Price").alias("avg_price_in_range"))
        .orderBy("avg_price_in_range")
    )


def top_performers(df: DataFrame, by: str | None = None, limit: int = 20) -> DataFrame:
    """By category, or by any other column such as the item."""
    name = by or _category(df)
    out = "item_code" if name == S.ITEM else "category_name"
    return (
        _earning(df)
        .where(c(name).isNotNull())
        .groupBy(c(name).alias(out))
        .agg(
            F.sum("Revenue").alias("total_revenue"), _count("trading_days"),
            *_optional(df, avg_price=("Avg_Price", F.avg)),
        )
        .orderBy(F.desc("total_revenue"), out)
        .limit(limit)
    )


def weekend_vs_weekday(df: DataFrame) -> DataFrame:
    return (
        _earning(df)
        .where(F.col("IsWeekend").isNotNull())
        .groupBy(day_type(F.col("IsWeekend")).alias("day_type"))
        .agg(
            _count("transaction_count"), F.sum("Revenue").alias("total_revenue"),
            *_optional(df, avg_price=("Avg_Price", F.avg)),
        )
    )


def category_prices_since(df: DataFrame, year: int = 2023, limit: int = 30) -> DataFrame:
    name = _category(df)
    return (
        df.where(c(name).isNotNull() & (c(S.DATE) >= F.lit(date(year, 1, 1))) & (F.col("Avg_Price") > 0))
        .groupBy(c(name).alias("category_name"))
        .agg(F.avg("Avg_Price").alias("avg_price"), _count("data_points"))
        .orderBy(F.desc("avg_price"), "category_name")
        .limit(limit)
    )


def daily_revenue_trend(df: DataFrame, days: int = 90) -> DataFrame:
    """Revenue per day over the last ``days`` days; the newest day is read first, so old files can be skipped."""
    newest = df.agg(F.max(S.DATE)).first()[0]
    since = F.lit(newest - timedelta(days=days)) if newest else F.lit(None)
    return (
        df.where(c(S.DATE) > since)
        .groupBy(S.DATE)
        .agg(F.sum("Revenue").alias("daily_revenue"))
        .orderBy(S.DATE)
    )


def category_growth(df: DataFrame, largest: int = 5) -> DataFrame:
    name = _category(df)
    yearly = df.where(c(name).isNotNull()).groupBy(c(name).alias("category_name"), F.col("Year").alias("year")).agg(
        F.sum("Revenue").alias("yearly_revenue")
    )
    totals = yearly.groupBy("category_name").agg(F.sum("yearly_revenue").alias("_total"))
    top = totals.orderBy(F.desc("_total"), "category_name").limit(largest)
    return yearly.join(top, "category_name", "left_semi")


def category_seasonality(df: DataFrame) -> DataFrame:
    """Revenue by category and season as a wide table; a fixed season list needs no extra pass."""
    name = _category(df)
    pivoted = (
        df.where(c(name).isNotNull())
        .groupBy(c(name).alias("category_name"))
        .pivot("Season", list(S.SEASONS))
        .agg(F.sum("Revenue"))
    )
    return pivoted.na.fill(0.0)


def seasonal_revenue_by_category(df: DataFrame) -> DataFrame:
    name = _category(df)
    return df.where(c(name).isNotNull()).groupBy(c(name).alias("category_name"), F.col("Season").alias("season")).agg(
        F.sum("Revenue").alias("seasonal_revenue")
    )


def price_trends_by_month(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("Year").alias("year"), F.col("Month").alias("month")).agg(
        F.avg("Avg_Price").alias("avg_monthly_price"),
        F.min("Avg_Price").alias("min_monthly_price"),
        F.max("Avg_Price").alias("max_monthly_price"),
    )


def most_volatile_items(df: DataFrame, limit: int = 15) -> DataFrame:
    return (
        df.groupBy(S.ITEM).agg(F.avg("Price_Volatility").alias("avg_volatility"))
        .orderBy(F.desc("avg_volatility"), S.ITEM).limit(limit)
    )


def holiday_impact(df: DataFrame) -> DataFrame:
    label = F.when(F.col("IsNationalDay") == 1, "National Day").when(F.col("IsLaborDay") == 1, "Labor Day").otherwise("Regular Day")
    return df.groupBy(label.alias("day_type")).agg(F.sum("Revenue").alias("total_revenue"))


def loss_rate_impact(df: DataFrame) -> DataFrame:
    return df.groupBy(loss_band(c(S.LOSS)).alias("loss_category")).agg(
        F.count_distinct(c(S.ITEM)).alias("item_count"), F.sum("Revenue").alias("total_revenue")
    )


def top_items_by_quantity(df: DataFrame, limit: int = 10) -> DataFrame:
    return (
        df.groupBy(S.ITEM).agg(F.avg("Total_Quantity").alias("avg_quantity"))
        .orderBy(F.desc("avg_quantity"), S.ITEM).limit(limit)
    )


def daily_revenue(df: DataFrame) -> DataFrame:
    return df.groupBy(S.DATE).agg(F.sum("Revenue").alias("total_revenue")).orderBy(S.DATE)


def summary(df: DataFrame, insights: int = 3) -> DataFrame:
    """Key figures and the first categories as ranked rows."""
    ranked = top_categories(df, insights).withColumn(
        "rank", F.row_number().over(Window.orderBy(F.desc("total_revenue"), "category_name"))
    )
    money, span = total_revenue(df), date_range(df)
    return ranked.select(
        "rank", "category_name", F.col("total_revenue").alias("category_revenue"),
        F.col("transaction_count").alias("category_transactions"),
        total_records(df).scalar().alias("total_records"),
        money.select("total_revenue").scalar().alias("total_revenue"),
        span.select("earliest_date").scalar().alias("earliest_date"),
        span.select("latest_date").scalar().alias("latest_date"),
    )


def daily_report(df: DataFrame) -> DataFrame:
    """The daily report as numbered text lines, sections in order."""
    def line(section: int, position, text: Column) -> list[Column]:
        return [F.lit(section).alias("section"), position.alias("position"), text.alias("line")]

    def money(name: str, digits: int) -> Column:
        return F.format_number(F.col(name), digits)

    one = F.lit(1)
    revenue, span = total_revenue(df), date_range(df)
    last = monthly_revenue(df).orderBy(F.desc("year"), F.desc("month")).limit(3)
    ranked = top_categories(df, 5).withColumn(
        "rank", F.row_number().over(Window.orderBy(F.desc("total_revenue"), "category_name"))
    )
    lines = [
        revenue.select(*line(1, one, F.concat(F.lit("Total Revenue: "), money("total_revenue", 2), F.lit(" RMB")))),
        revenue.select(*line(1, F.lit(2), F.concat(F.lit("Total Transactions: "), money("transaction_count", 0)))),
        revenue.select(*line(1, F.lit(3), F.concat(
            F.lit("Average Revenue per Transaction: "), F.format_string("%.2f", "avg_revenue"), F.lit(" RMB")))),
        total_records(df).select(*line(1, F.lit(4), F.concat(F.lit("Total Records Processed: "), money("total_records", 0)))),
        span.select(*line(1, F.lit(5), F.concat(F.lit("Data Coverage: "), "earliest_date", F.lit(" to "), "latest_date"))),
        ranked.select(*line(2, F.col("rank"), F.concat(
            F.col("rank").cast("string"), F.lit(". "), "category_name", F.lit(": "), money("total_revenue", 0),
            F.lit(" RMB, "), money("transaction_count", 0), F.lit(" transactions")))),
        last.select(*line(3, F.col("year") * 100 + F.col("month"), F.concat(
            F.format_string("%d-%02d: ", "year", "month"), money("monthly_revenue", 0), F.lit(" RMB ("),
            money("transaction_count", 0), F.lit(" transactions)")))),
        weekend_vs_weekday(df).select(*line(4, F.when(F.col("day_type") == "Weekday", 1).otherwise(2), F.concat(
            "day_type", F.lit(": "), money("total_revenue", 0), F.lit(" RMB, "), money("transaction_count", 0),
            F.lit(" transactions, average price "), F.format_string("%.2f", "avg_price"), F.lit(" RMB")))),
    ]
    return reduce(DataFrame.unionByName, lines).orderBy("section", "position")


#: component -> dataset -> function of the feature table
COMPONENTS: dict[str, dict[str, Callable[[DataFrame], DataFrame]]] = {
    "overview": {
        "total_records": total_records, "total_revenue": total_revenue, "date_range": date_range,
        "unique_items": unique_items, "summary": summary,
    },
    "revenue_trends": {
        "monthly_revenue": monthly_revenue, "seasonal_revenue": seasonal_revenue, "daily_revenue_trend": daily_revenue_trend,
    },
    "category_analysis": {
        "top_categories_by_revenue": top_categories, "category_growth": category_growth,
        "category_seasonality": seasonal_revenue_by_category,
    },
    "price_analysis": {
        "price_distribution": price_distribution, "price_trends_by_month": price_trends_by_month,
        "most_volatile_items": most_volatile_items,
    },
    "market_insights": {
        "top_performing_items": top_performers, "weekend_vs_weekday": weekend_vs_weekday,
        "holiday_impact": holiday_impact, "loss_rate_impact": loss_rate_impact,
    },
    "forecasting_features": {
        "feature_correlations": category_prices_since, "top_items_by_quantity": top_items_by_quantity,
        "daily_revenue": daily_revenue,
    },
}
