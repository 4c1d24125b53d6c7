"""From sale records to one row per day and item."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketgrain import schemas as S
from marketgrain.functions.calendar import calendar_columns, parse_date
from marketgrain.functions.naming import c
from marketgrain.functions.numeric import count_where, ratio
from marketgrain.functions.pricing import gross_sales


def with_date(df: DataFrame, column: str = S.DATE) -> DataFrame:
    """Parse a text date column; a date or timestamp is cast, bad text becomes NULL."""
    kind = dict(df.dtypes)[column]
    parsed = parse_date(F.col(column)) if kind == "string" else F.col(column).cast("date")
    return df.withColumn(column, parsed)


def sale_rows(sales: DataFrame) -> DataFrame:
    """Sales without returns and without undated rows."""
    return sales.where((F.lower(c(S.KIND)) == "sale") & c(S.DATE).isNotNull())


def daily_aggregate(sales: DataFrame) -> DataFrame:
    """Quantity, price and discount figures per (date, item).

    One hash aggregation. Every measure is combined before the shuffle, so a hot item sends one row per task
    and day. Spark's own grouping keeps a NULL key; the source drops it.
    """
    quantity, price = c(S.QUANTITY), c(S.PRICE)
    grouped = sale_rows(sales).where(c(S.ITEM).isNotNull()).groupBy(S.DATE, S.ITEM).agg(
        F.coalesce(F.sum(quantity), F.lit(0.0)).alias("Total_Quantity"),
        F.avg(quantity).alias("Avg_Quantity"),
        F.count(quantity).alias("Transaction_Count"),
        F.avg(price).alias("Avg_Price"),
        F.coalesce(F.stddev_samp(price), F.lit(0.0)).alias("Price_Volatility"),
        F.min(price).alias("Min_Price"),
        F.max(price).alias("Max_Price"),
        count_where(c(S.DISCOUNT) == "Yes").alias("Discount_Count"),
    )
    return grouped.select(
        "*",
        (F.col("Total_Quantity") * F.col("Avg_Price")).alias("Revenue"),
        ratio(F.col("Discount_Count"), F.col("Transaction_Count"), 0.0).alias("Discount_Rate"),
        (F.col("Max_Price") - F.col("Min_Price")).alias("Price_Range"),
    )


def add_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar_columns(F.col(S.DATE)))


def market_series(sales: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Daily mean price, quantity, record count and revenue, over all records or per key."""
    return (
        sales.where(c(S.DATE).isNotNull())
        .groupBy(*keys, S.DATE)
        .agg(
            F.avg(c(S.PRICE)).alias("Avg_Price"),
            F.coalesce(F.sum(c(S.QUANTITY)), F.lit(0.0)).alias("Total_Quantity"),
            F.count(c(S.ITEM)).alias("Transaction_Count"),
        )
        .withColumn("Revenue", F.col("Avg_Price") * F.col("Total_Quantity"))
    )


def with_gross_sales(sales: DataFrame) -> DataFrame:
    return sales.withColumn("gross_sales", gross_sales(c(S.QUANTITY), c(S.PRICE)))
