"""Exploratory summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marketgrain import schemas as S
from marketgrain.functions.calendar import season
from marketgrain.functions.naming import c
from marketgrain.functions.numeric import percent, ratio
from marketgrain.functions.order_stats import wide_quantiles
from marketgrain.functions.pricing import gross_sales


def rows() -> Column:
    return F.count(F.lit(1))


def describe(df: DataFrame, names: Sequence[str], labels: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column."""
    labels = list(labels or names)
    values = {l: c(n).cast("double") for n, l in zip(names, labels)}
    basic = df.agg(F.array(*[F.struct(
        F.lit(l).alias("column"), F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
    ) for l, v in values.items()]).alias("rows")).select(F.inline("rows"))
    quartiles = wide_quantiles(df, values, [0.25, 0.5, 0.75]).select(
        F.col("name").alias("column"), *[F.element_at("quantiles", i).alias(p) for i, p in enumerate(("p25", "p50", "p75"), 1)]
    )
    # one row per column of the schema
    return basic.join(F.broadcast(quartiles), "column", "left")


def value_counts(df: DataFrame, value: Column, label: str) -> DataFrame:
    """Frequency of each value and its share in percent."""
    counts = df.groupBy(value.cast("string").alias("value")).agg(rows().alias("n"))
    total = df.agg(rows()).scalar()
    return counts.select(F.lit(label).alias("column"), "value", "n", percent(F.col("n"), total).alias("pct"))


def top_and_others(df: DataFrame, name: str, keep: int = 8) -> DataFrame:
    """The most frequent values and one row for all others, if there are any."""
    counts = df.groupBy(c(name).cast("string").alias("value")).agg(rows().alias("n"))
    top = counts.orderBy(F.desc("n"), "value").limit(keep)
    others = counts.join(top.select("value"), "value", "left_anti").agg(F.sum("n").alias("n"))
    return top.unionByName(others.where(F.col("n") > 0).select(F.lit("Others").alias("value"), "n"))


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """Counts in equal-width bins between the extremes; empty bins are absent."""
    data = df.select(value.cast("double").alias("v")).where(F.col("v").isNotNull())
    low, high = data.agg(F.min("v")).scalar(), data.agg(F.max("v")).scalar()
    place = F.coalesce(F.floor(ratio((F.col("v") - low) * bins, high - low)), F.lit(0))
    return data.groupBy(F.least(place, F.lit(bins - 1)).alias("bin")).agg(rows().alias("n"))


def records_per_day(sales: DataFrame) -> DataFrame:
    return sales.where(c(S.DATE).isNotNull()).groupBy(S.DATE).agg(rows().alias("n"))


def records_per_hour(df: DataFrame, moment: str) -> DataFrame:
    return df.where(c(moment).isNotNull()).groupBy(F.hour(moment).alias("hour")).agg(rows().alias("n"))


def wholesale_by_month(quotes: DataFrame) -> DataFrame:
    return quotes.groupBy(F.trunc(c(S.DATE), "MM").alias("month")).agg(
        F.avg(c(S.WHOLESALE)).alias("mean_price"), F.stddev_samp(c(S.WHOLESALE)).alias("std_price"), rows().alias("n")
    )


def wholesale_by_month_of_year(quotes: DataFrame) -> DataFrame:
    return quotes.groupBy(F.month(c(S.DATE)).alias("month")).agg(F.avg(c(S.WHOLESALE)).alias("mean_price"))


def price_comparison(sales: DataFrame, wholesale: DataFrame) -> DataFrame:
    """Retail mean of all records against the quote, for days and items that have both."""
    retail = sales.groupBy(S.DATE, S.ITEM).agg(
        F.avg(c(S.PRICE)).alias("Retail_Price"), F.coalesce(F.sum(c(S.QUANTITY)), F.lit(0.0)).alias("Quantity")
    )
    quote = c(S.WHOLESALE)
    joined = retail.join(wholesale, [S.DATE, S.ITEM]).withColumns({
        "Price_Ratio": ratio(F.col("Retail_Price"), quote), "Price_Markup": F.col("Retail_Price") - quote
    })
    return joined.withColumn("Markup_Percentage", ratio(F.col("Price_Markup"), quote) * 100)


def monthly_price_ratio(comparison: DataFrame) -> DataFrame:
    return comparison.groupBy(F.trunc(c(S.DATE), "MM").alias("month")).agg(F.avg("Price_Ratio").alias("mean_ratio"))


def top_revenue_items(sales: DataFrame, items: DataFrame, limit: int = 10) -> DataFrame:
    """Aggregate on the item first, then join the names: the join sees one row per item."""
    per_item = sales.groupBy(S.ITEM).agg(F.sum(gross_sales(c(S.QUANTITY), c(S.PRICE))).alias("gross_sales"))
    named = per_item.join(items.select(S.ITEM, S.ITEM_NAME, S.CATEGORY_NAME), S.ITEM)
    named = named.where(c(S.ITEM_NAME).isNotNull() & c(S.CATEGORY_NAME).isNotNull())
    return named.orderBy(F.desc("gross_sales"), S.ITEM).limit(limit)


def price_variation(quotes: DataFrame, items: DataFrame, limit: int = 5) -> DataFrame:
    """Items with the largest coefficient of variation of their quotes."""
    per_item = quotes.groupBy(S.ITEM).agg(
        F.avg(c(S.WHOLESALE)).alias("mean_price"), F.stddev_samp(c(S.WHOLESALE)).alias("std_price")
    )
    named = per_item.join(items.select(S.ITEM, S.ITEM_NAME), S.ITEM).where(c(S.ITEM_NAME).isNotNull())
    return named.withColumn("cv", ratio(F.col("std_price"), F.col("mean_price"))).orderBy(F.desc("cv"), S.ITEM).limit(limit)


def most_expensive_items(quotes: DataFrame, items: DataFrame, limit: int = 10) -> DataFrame:
    per_item = quotes.groupBy(S.ITEM).agg(F.avg(c(S.WHOLESALE)).alias("mean_price"))
    named = per_item.join(items.select(S.ITEM, S.ITEM_NAME), S.ITEM).where(c(S.ITEM_NAME).isNotNull())
    return named.orderBy(F.desc("mean_price"), S.ITEM).limit(limit)


def seasonal_gross_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy(season(F.month(c(S.DATE))).alias("season")).agg(
        F.sum(gross_sales(c(S.QUANTITY), c(S.PRICE))).alias("gross_sales")
    )


def loss_impact(sales: DataFrame, loss_rates: DataFrame) -> DataFrame:
    """Value lost at the item's rate, in total and per cent of sales; a missing rate takes the mean over rows.

    Both sums are linear in the rate, so the records are first reduced to one row per item.
    """
    per_item = sales.groupBy(S.ITEM).agg(
        F.sum(gross_sales(c(S.QUANTITY), c(S.PRICE))).alias("sales"), rows().alias("n")
    )
    joined = per_item.join(loss_rates.select(S.ITEM, S.LOSS), S.ITEM, "left")
    known = F.when(c(S.LOSS).isNotNull(), F.col("n"))
    mean = joined.agg(F.sum(c(S.LOSS) * F.col("n")) / F.sum(known)).scalar()
    rate = F.coalesce(c(S.LOSS), mean)
    sums = joined.agg(F.sum(F.col("sales") * rate / 100).alias("potential_loss"), F.sum("sales").alias("total_sales"))
    return sums.withColumn("loss_pct", percent(F.col("potential_loss"), F.col("total_sales")))


def correlations(df: DataFrame, pairs: dict[str, tuple[str, str]], keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.corr(c(a), c(b)).alias(out) for out, (a, b) in pairs.items()])


def key_overlap(left: DataFrame, right: DataFrame, key: str, label: str) -> DataFrame:
    """How many distinct keys two tables share, and how many only one has."""
    a = left.select(c(key).alias("k")).where(F.col("k").isNotNull()).distinct().withColumn("in_left", F.lit(1))
    b = right.select(c(key).alias("k")).where(F.col("k").isNotNull()).distinct().withColumn("in_right", F.lit(1))
    counts = a.join(b, "k", "full_outer").agg(
        F.count_if(F.col("in_left").isNotNull() & F.col("in_right").isNotNull()).alias("in_both"),
        F.count_if(F.col("in_right").isNull()).alias("only_left"),
        F.count_if(F.col("in_left").isNull()).alias("only_right"),
    )
    coverage = percent(F.col("in_both"), F.col("in_both") + F.col("only_left"))
    return counts.select(F.lit(label).alias("pair"), "*", coverage.alias("coverage_pct"))
