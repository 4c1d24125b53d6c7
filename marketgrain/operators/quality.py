"""Schema checks, quality measures and business rules, all as tables of results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from marketgrain import schemas as S
from marketgrain.functions.calendar import parse_date
from marketgrain.functions.naming import c
from marketgrain.functions.numeric import count_where, is_numeric, percent, ratio
from marketgrain.functions.order_stats import quantile, wide_quantiles

# fixed values: which actual types satisfy an expected type
WIDENING = {
    "bigint": ("bigint", "int", "smallint", "tinyint"),
    "double": ("double", "float"),
    "string": ("string",),
}
# fixed values: words in the names of columns that may not be negative
SIGNED_WORDS = ("price", "quantity", "rate")


def numeric_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def check_columns(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row: missing and extra columns and whether the sets are equal."""
    want, have = set(expected.names), set(df.columns)
    row = (sorted(want - have), sorted(have - want), want == have)
    return df.sparkSession.createDataFrame(
        [row], "missing_columns array<string>, extra_columns array<string>, columns_match boolean"
    )


def check_types(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per column whose type does not fit the expected one."""
    actual = dict(df.dtypes)
    rows = [
        (f.name, f.dataType.simpleString(), actual[f.name])
        for f in expected.fields
        if f.name in actual
        and actual[f.name] not in WIDENING.get(f.dataType.simpleString(), (f.dataType.simpleString(),))
    ]
    return df.sparkSession.createDataFrame(rows, "`column` string, expected string, actual string")


def _long(df: DataFrame, measures: dict[str, Sequence[Column]], fields: Sequence[tuple[str, str]]) -> DataFrame:
    """Aggregate once and turn the single row into one row per column."""
    structs = [
        F.struct(F.lit(name).alias("column"), *[v.cast(k).alias(f) for v, (f, k) in zip(values, fields)])
        for name, values in measures.items()
    ]
    return df.agg(F.array(*structs).alias("rows")).select(F.inline("rows"))


def missing_values(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """NULL count and percentage per column in one pass."""
    rows = F.count(F.lit(1))
    measures = {}
    for name in names or df.columns:
        empty = count_where(c(name).isNull())
        measures[name] = (empty, percent(empty, rows, 2))
    return _long(df, measures, (("missing_count", "long"), ("missing_pct", "double")))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of equal rows (NULLs equal) and all rows, from one grouped pass.

    Rows are grouped by a digest of 256 bits of their JSON form, so texts are not shuffled. Equal rows collapse before
    the shuffle, so a row repeated very often is no hot group.
    """
    counts = df.groupBy(row_digest(df).alias("_row")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
    )


def row_digest(df: DataFrame) -> Column:
    """A digest that tells rows apart; NULL, empty and text forms of values differ."""
    whole = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    options = {"ignoreNullFields": "false", "timestampFormat": f"{whole}XXX", "timestampNTZFormat": whole}
    return F.unhex(F.sha2(F.to_json(F.struct(*[c(n) for n in df.columns]), options), 256))


def date_ranges(df: DataFrame) -> DataFrame:
    """First and last day and days between for every column whose name speaks of a date."""
    kinds = dict(df.dtypes)
    measures = {}
    for name in (n for n in df.columns if "date" in n.lower()):
        day = parse_date(c(name)) if kinds[name] == "string" else c(name).cast("date")
        measures[name] = (F.min(day), F.max(day), F.datediff(F.max(day), F.min(day)))
    fields = (("min_date", "date"), ("max_date", "date"), ("span_days", "long"))
    return _long(df, measures, fields).where(F.col("min_date").isNotNull())


def outliers(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Values beyond 1.5 interquartile ranges of the quartiles, per numeric column."""
    names = list(names or numeric_names(df))
    # one row per column of the schema
    measures = {}
    for row in wide_quantiles(df, {n: c(n).cast("double") for n in names}, [0.25, 0.75]).collect():
        low, high = row["quantiles"]
        lower, upper = low - (high - low) * 1.5, high + (high - low) * 1.5
        value = c(row["name"]).cast("double")
        outside = count_where((value < lower) | (value > upper))
        measures[row["name"]] = (
            outside, percent(outside, F.count(F.lit(1)), 2), F.round(F.lit(lower), 2), F.round(F.lit(upper), 2))
    fields = (("outlier_count", "long"), ("outlier_pct", "double"), ("lower_bound", "double"), ("upper_bound", "double"))
    if not measures:
        return df.sparkSession.createDataFrame([], "`column` string, outlier_count long, outlier_pct double, lower_bound double, upper_bound double")
    return _long(df, measures, fields)


def negative_values(df: DataFrame) -> DataFrame:
    """Negative counts of the numeric price, quantity and rate columns."""
    measures = {}
    for name in numeric_names(df):
        if any(word in name.lower() for word in SIGNED_WORDS):
            below = count_where(c(name) < 0)
            measures[name] = (below, percent(below, F.count(F.lit(1)), 2))
    if not measures:
        return df.sparkSession.createDataFrame([], "`column` string, negative_count long, negative_pct double")
    return _long(df, measures, (("negative_count", "long"), ("negative_pct", "double")))


def score(missing: Column, duplicates: Column, outlier: Column, negative: Column) -> Column:
    """Quality score of mean percentages, between 0 and 100."""
    raw = 100.0 - missing * 2 - duplicates * 5 - F.greatest(outlier - 5, F.lit(0.0)) * 0.5 - negative * 10
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.round(raw, 2)))


def _mean_with_zero(df: DataFrame, name: str) -> Column:
    """Mean of a list to which the source appends a zero."""
    return df.agg(F.coalesce(F.sum(name), F.lit(0.0)) / (F.count(name) + 1)).scalar()


def quality_score(df: DataFrame, label: str) -> DataFrame:
    """One row per table with its mean percentages and score."""
    duplicates = duplicate_rows(df)
    return duplicates.select(
        F.lit(label).alias("table_name"),
        "total_rows",
        missing_values(df).agg(F.avg("missing_pct")).scalar().alias("avg_missing_pct"),
        percent(F.col("duplicate_rows"), F.col("total_rows")).alias("duplicate_pct"),
        _mean_with_zero(outliers(df), "outlier_pct").alias("avg_outlier_pct"),
        _mean_with_zero(negative_values(df), "negative_pct").alias("avg_negative_pct"),
    ).withColumn(
        "quality_score",
        score(F.col("avg_missing_pct"), F.col("duplicate_pct"), F.col("avg_outlier_pct"), F.col("avg_negative_pct")),
    )


# ---- business rules -----------------------------------------------------------------------------------
def orphan_items(sales: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct sold items that the item master does not know."""
    return sales.select(S.ITEM).distinct().join(items.select(S.ITEM).distinct(), S.ITEM, "left_anti")


def rule_orphans(sales: DataFrame, items: DataFrame) -> DataFrame:
    return orphan_items(sales, items).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("Sales items exist in master data").alias("rule"),
        (F.col("n") == 0).alias("passed"),
        F.format_string("Found %d orphan items in sales data", "n").alias("details"),
    )


def rule_wholesale(wholesale: DataFrame) -> DataFrame:
    price = c(S.WHOLESALE)
    counts = wholesale.agg(
        count_where(price <= 0).alias("low"), count_where(price > 1000).alias("high"), F.count(F.lit(1)).alias("n")
    )
    return counts.select(
        F.lit("Wholesale prices are reasonable").alias("rule"),
        ((F.col("low") == 0) & (F.col("high") < F.col("n") * 0.01)).alias("passed"),
        F.format_string("Zero/negative prices: %d, Extremely high prices: %d", "low", "high").alias("details"),
    )


def rule_loss(loss_rates: DataFrame) -> DataFrame:
    rate = c(S.LOSS)
    return loss_rates.agg(count_where((rate < 0) | (rate > 100)).alias("n")).select(
        F.lit("Loss rates are valid percentages (0-100%)").alias("rule"),
        (F.col("n") == 0).alias("passed"),
        F.format_string("Invalid loss rates: %d", "n").alias("details"),
    )


def rule_quantity(sales: DataFrame) -> DataFrame:
    bad = (F.lower(c(S.KIND)) == "sale") & (c(S.QUANTITY) <= 0)
    return sales.agg(count_where(bad).alias("n")).select(
        F.lit("Sale quantities are positive").alias("rule"),
        (F.col("n") == 0).alias("passed"),
        F.format_string("Negative/zero quantities in sales: %d", "n").alias("details"),
    )


def business_rules(tables: dict[str, DataFrame]) -> DataFrame:
    """All rules whose tables are present, as rows (rule, passed, details)."""
    results = []
    if {"sales", "items"} <= tables.keys():
        results.append(rule_orphans(tables["sales"], tables["items"]))
    if "wholesale" in tables:
        results.append(rule_wholesale(tables["wholesale"]))
    if "loss_rates" in tables:
        results.append(rule_loss(tables["loss_rates"]))
    if "sales" in tables:
        results.append(rule_quantity(tables["sales"]))
    return reduce(DataFrame.unionByName, results)


def rule_summary(rules: DataFrame) -> DataFrame:
    return rules.agg(
        count_where(F.col("passed")).alias("rules_passed"), count_where(~F.col("passed")).alias("rules_failed")
    )


def run_summary(scores: DataFrame, all_present: Column | bool = True) -> DataFrame:
    """Mean score of the tables, the verdict and the recommendation."""
    present = F.lit(all_present) if isinstance(all_present, bool) else all_present
    mean = scores.agg(
        F.count(F.lit(1)).alias("tables_validated"), F.round(F.avg("quality_score"), 2).alias("total_quality_score")
    )
    return mean.select(
        "*",
        ((F.col("total_quality_score") >= 70) & present).alias("validation_passed"),
        F.when(F.col("total_quality_score") < 80, "Consider data cleaning to improve quality score").alias(
            "recommendation"
        ),
    )


def table_overview(df: DataFrame, label: str, key: str = S.ITEM) -> DataFrame:
    """Rows, columns, duplicates, overall missing share and distinct keys of one table.

    Rows are grouped once by their digest; every measure comes from the grouped counts.
    """
    names = df.columns
    empties = reduce(lambda a, b: a + b, [c(n).isNull().cast("long") for n in names])
    unique = F.count_distinct("_key") if key in names else F.lit(None).cast("long")
    held = [F.max(empties).alias("_empty"), *([F.max(c(key)).alias("_key")] if key in names else [])]
    grouped = df.groupBy(row_digest(df).alias("_row")).agg(F.count(F.lit(1)).alias("_n"), *held)
    rows = F.sum("_n")
    return grouped.agg(
        rows.alias("row_count"),
        F.lit(len(names)).cast("long").alias("column_count"),
        F.sum(F.col("_n") - 1).alias("duplicate_rows"),
        F.round(percent(F.sum(F.col("_n") * F.col("_empty")), rows * len(names)), 2).alias("missing_pct"),
        unique.alias("unique_items"),
    ).select(F.lit(label).alias("dataset"), "*")


def recommendations(sales: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Findings that ask for action, as rows (finding, value); only those that apply."""
    price, quantity = c(S.PRICE), c(S.QUANTITY)
    limit = quantile(sales, S.PRICE, 0.99)
    found = sales.agg(
        count_where(price <= 0).alias("non_positive_prices"),
        count_where(quantity <= 0).alias("non_positive_quantities"),
        count_where(price > limit * 3).alias("extreme_prices"),
    )
    counted = found.unpivot([], found.columns, "finding", "value").withColumn("value", F.col("value").cast("double"))
    shares = []
    for name, df in tables.items():
        cells = F.count(F.lit(1)) * len(df.columns)
        empty = reduce(lambda a, b: a + b, [count_where(c(n).isNull()) for n in df.columns])
        shares.append(df.agg(percent(empty, cells).alias("value")).select(F.lit(f"missing_{name}").alias("finding"), "value"))
    parts = [counted.where(F.col("value") > 0), *[s.where(F.col("value") > 5) for s in shares]]
    if {"sales", "wholesale"} <= tables.keys():
        span = F.datediff(F.max(c(S.DATE)), F.min(c(S.DATE)))
        ours, theirs = (tables[n].agg(span).scalar() for n in ("sales", "wholesale"))
        gap = sales.sparkSession.range(1).select(
            F.lit("date_span_gap").alias("finding"), F.abs(ours - theirs).cast("double").alias("value")
        )
        parts.append(gap.where(F.col("value") > 30))
    return reduce(DataFrame.unionByName, parts)


def z_score_outliers(df: DataFrame, names: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Rows further than ``limit`` standard deviations from the mean, counted per column."""
    long = df.select(*[c(n).cast("double").alias(n) for n in names]).unpivot([], list(names), "column", "value")
    stats = long.groupBy("column").agg(F.avg("value").alias("_mean"), F.stddev_samp("value").alias("_std"))
    score_of = F.abs(ratio(F.col("value") - F.col("_mean"), F.col("_std")))
    # one row per column of the schema
    return long.join(F.broadcast(stats), "column").groupBy("column").agg(
        count_where(score_of > limit).alias("outlier_count"), F.count("value").alias("value_count")
    )


def declared_limits(df: DataFrame, date: str, min_points: int = 100, max_missing: float = 0.1) -> DataFrame:
    """Declared limits on history length and missing share, one row."""
    empty = reduce(lambda a, b: a + b, [count_where(c(n).isNull()) for n in df.columns])
    row = df.agg(
        F.min(c(date)).alias("first_date"), F.max(c(date)).alias("last_date"), F.count(F.lit(1)).alias("points"),
        ratio(empty, F.count(F.lit(1)) * len(df.columns)).alias("missing_ratio"),
    )
    return row.select(
        "*", (F.col("points") >= min_points).alias("enough_points"),
        (F.col("missing_ratio") <= max_missing).alias("missing_ok"),
    )


def split_gate(df: DataFrame, names: Sequence[str], target: str, max_missing: float = 0.5) -> DataFrame:
    """Per split: missing share below the limit, no infinities, targets present."""
    empty = reduce(lambda a, b: a + b, [count_where(c(n).isNull() | F.isnan(c(n))) for n in names])
    infinite = reduce(lambda a, b: a + b, [count_where(F.abs(c(n)) == float("inf")) for n in names])
    rows = df.groupBy("split").agg(
        F.count(F.lit(1)).alias("total_rows"),
        ratio(empty, F.count(F.lit(1)) * len(names)).alias("missing_ratio"),
        infinite.alias("infinite_values"),
        F.count(c(target)).alias("targets"),
    )
    ok = (F.col("missing_ratio") < max_missing) & (F.col("infinite_values") == 0) & (F.col("targets") > 0)
    return rows.withColumn("passed", ok)


def dataset_completeness(datasets: DataFrame, spark: SparkSession) -> DataFrame:
    """Compare the datasets a dashboard has, rows (component, dataset), with what a full one has."""
    expected = spark.createDataFrame(list(S.EXPECTED_DATASETS.items()), "component string, expected long")
    counts = datasets.groupBy("component").agg(F.count_distinct("dataset").alias("actual"))
    joined = expected.join(counts, "component", "left").withColumn("actual", F.coalesce("actual", F.lit(0)))
    status = (
        F.when(F.col("actual") == 0, "MISSING").when(F.col("actual") == F.col("expected"), "COMPLETE").otherwise("PARTIAL")
    )
    overall = joined.agg(F.sum("actual") * 100.0 / F.sum("expected")).scalar()
    return joined.select("*", status.alias("status"), overall.alias("overall_pct"))


# ---- row rules for model inputs -----------------------------------------------------------------------
def input_errors(df: DataFrame) -> DataFrame:
    """Every row with its list of input errors."""
    problems: list[Column] = []
    for name in numeric_names(df):
        if "Price" in name or "Quantity" in name:
            problems.append(F.when(c(name) < 0, F.lit(f"Negative values found in {name}")))
        problems.append(F.when(F.abs(c(name)) > 1e6, F.lit(f"Extreme values found in {name}")))
    if "Month" in df.columns:
        problems.append(F.when(~c("Month").between(1, 12), F.lit("Invalid month values (must be 1-12)")))
    if "DayOfWeek" in df.columns:
        problems.append(F.when(~c("DayOfWeek").between(0, 6), F.lit("Invalid day of week values (must be 0-6)")))
    for name in ("Avg_Price", "Total_Quantity", "Month", "DayOfWeek"):
        if name not in df.columns:
            problems.append(F.lit(f"Missing required feature: {name}"))
    return df.withColumn("errors", F.array_compact(F.array(*problems)))


def input_error_counts(df: DataFrame) -> DataFrame:
    return input_errors(df).select(F.explode("errors").alias("error")).groupBy("error").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def sale_row_errors(sales: DataFrame) -> DataFrame:
    """Every sale record with its list of rule violations; for batch and streams alike."""
    price, quantity = c(S.PRICE), c(S.QUANTITY)
    return sales.withColumn("errors", F.array_compact(F.array(
        F.when(c(S.DATE).isNull(), F.lit("missing date")),
        F.when(c(S.ITEM).isNull(), F.lit("missing item")),
        F.when(price.isNull(), F.lit("missing price")),
        F.when(price < 0, F.lit("negative price")),
        F.when((F.lower(c(S.KIND)) == "sale") & (quantity <= 0), F.lit("non-positive sale quantity")),
        F.when(c(S.KIND).isNull(), F.lit("missing kind")),
    )))
