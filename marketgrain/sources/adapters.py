"""Domain tables derived from the given star schema.

A supplier's nation plays the item, its region the category; line items are sale records and order dates with
part prices give wholesale quotes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketgrain import schemas as S


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sales(spark: SparkSession, folder: str) -> DataFrame:
    return sales_of(table(spark, folder, "lineitem"), table(spark, folder, "supplier"))


def sales_of(line: DataFrame, suppliers: DataFrame) -> DataFrame:
    supplier = suppliers.select("s_suppkey", "s_nationkey")
    return line.join(supplier, line.l_suppkey == supplier.s_suppkey).select(
        F.col("l_shipdate").cast("date").alias(S.DATE),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("sale_id"),
        F.col("s_nationkey").cast("long").alias(S.ITEM),
        F.col("l_quantity").alias(S.QUANTITY),
        (F.col("l_extendedprice") / F.col("l_quantity") / 100).alias(S.PRICE),
        F.when(F.col("l_returnflag") == "R", "Return").otherwise("Sale").alias(S.KIND),
        F.when(F.col("l_discount") > 0.07, "Yes").otherwise("No").alias(S.DISCOUNT),
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("long").alias(S.ITEM),
        F.col("n_name").alias(S.ITEM_NAME),
        F.col("r_regionkey").cast("long").alias(S.CATEGORY),
        F.col("r_name").alias(S.CATEGORY_NAME),
    )


def wholesale(spark: SparkSession, folder: str) -> DataFrame:
    """One quote per line item; not yet one row per (date, item)."""
    line = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, folder, "part").select("p_partkey", "p_retailprice")
    return (
        line.join(orders, line.l_orderkey == orders.o_orderkey)
        .join(supplier, line.l_suppkey == supplier.s_suppkey)
        .join(part, line.l_partkey == part.p_partkey)
        .select(
            F.col("o_orderdate").cast("date").alias(S.DATE),
            F.col("s_nationkey").cast("long").alias(S.ITEM),
            (F.col("p_retailprice") * 0.01).alias(S.WHOLESALE),
        )
    )


def loss_rates(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    return nation.where(F.col("n_nationkey") % 7 != 3).select(
        F.col("n_nationkey").cast("long").alias(S.ITEM),
        F.col("n_name").alias(S.ITEM_NAME),
        F.round(F.col("n_nationkey") * F.lit(1.3).cast("double"), 2).alias(S.LOSS),
    )


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    return requests_of(table(spark, folder, "events"))


def requests_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("request_id"),
        F.col("event_type").alias("endpoint"),
        F.when(F.col("user_id") % 2 == 0, "POST").otherwise("GET").alias("method"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        F.concat(F.lit("m"), (F.col("user_id") % 4).cast("string")).alias("model_name"),
        F.col("user_id"),
        F.col("value").alias("latency_ms"),
    )


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    return metrics_of(table(spark, folder, "events"))


def metrics_of(events: DataFrame) -> DataFrame:
    """Long metric history: one row per measurement."""
    kind, value = F.col("event_type"), F.col("value")

    def pick(click, view, error, purchase, other):
        return (
            F.when(kind == "click", click).when(kind == "view", view).when(kind == "error", error)
            .when(kind == "purchase", purchase).otherwise(other)
        )

    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        pick("system", "system", "api", "models", "data_quality").alias("source"),
        F.concat(F.lit("e"), (F.col("user_id") % 5).cast("string")).alias("entity"),
        pick("cpu_percent", "memory_percent", "average_latency_ms", "val_mape", "quality_score").alias("metric"),
        F.when(kind == "error", value * 10)
        .when(kind == "purchase", value / 5)
        .when(kind == "signup", 100 - F.least(value, F.lit(100.0)))
        .otherwise(F.least(value * 5, F.lit(100.0)))
        .alias("value"),
    )
