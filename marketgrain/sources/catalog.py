"""Catalog tables, generated definitions and feature stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from marketgrain import schemas as S
from marketgrain.functions.naming import c, clean_name, quoted
from marketgrain.functions.numeric import is_numeric


def sql_type(name: str, kind: T.DataType) -> str:
    """SQL type of a column: names of dates, times and codes decide first, then the Spark type."""
    lowered = name.lower()
    if lowered == "date" or "time" in lowered:
        return "timestamp"
    if "code" in lowered:
        return "bigint"
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "double"
    return "bigint" if is_numeric(kind) else "string"


def feature_type(kind: T.DataType) -> str:
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "Fractional"
    return "Integral" if is_numeric(kind) or isinstance(kind, T.BooleanType) else "String"


def type_table(df: DataFrame) -> DataFrame:
    rows = [(f.name, sql_type(f.name, f.dataType)) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "`column` string, sql_type string")


def feature_definitions(df: DataFrame) -> DataFrame:
    rows = [(clean_name(f.name), feature_type(f.dataType)) for f in df.schema.fields if f.name not in (S.DATE, S.ITEM)]
    return df.sparkSession.createDataFrame(rows, "feature_name string, feature_type string")


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}")


def register_table(spark: SparkSession, database: str, name: str, path: str) -> str:
    """Drop and create an external table over a Parquet folder; returns the statement.

    The column types are those of the files: Spark's own reader needs no name rules.
    """
    fields = spark.read.parquet(path).schema.fields
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    target = f"{quoted(database)}.{quoted(name)}"
    statement = f"CREATE TABLE {target} ({columns}) USING parquet LOCATION '{path}'"
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.sql(statement)
    return statement


def register_tables(spark: SparkSession, database: str, folder: str, names=("features_complete", "train_data", "validation_data", "test_data")) -> list[str]:
    """One table per folder ``folder/name``."""
    create_database(spark, database)
    return [register_table(spark, database, name, f"{folder}/{name}") for name in names]


def smoke_figures(df: DataFrame) -> DataFrame:
    """Counts and range that show a new table can be queried, with quoted names."""
    view = "smoke_rows"
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(f"""
        SELECT count(*) AS row_count, count(DISTINCT `Item Code`) AS item_count, avg(`Loss Rate (%)`) AS mean_loss,
               min(`Date`) AS first_day, max(`Date`) AS last_day FROM {view}""")


def feature_metadata(df: DataFrame) -> DataFrame:
    """One row: column lists by kind, row count, date range, item count; split counts if there is a split."""
    numbers = [f.name for f in df.schema.fields if is_numeric(f.dataType)]
    texts = [n for n, k in df.dtypes if k == "string" and n != "split"]
    splits = {}
    if "split" in df.columns:
        splits = {f"{s}_records": F.count_if(F.col("split") == s) for s in ("train", "validation", "test")}
    row = df.agg(
        F.count(F.lit(1)).alias("total_records"), F.min(c(S.DATE)).alias("start_date"), F.max(c(S.DATE)).alias("end_date"),
        F.count_distinct(c(S.ITEM)).alias("items_count"), *[v.alias(k) for k, v in splits.items()],
    )
    names = {"feature_columns": [n for n in df.columns if n != "split"], "numeric_features": numbers, "categorical_features": texts}
    lists = {k: F.array(*[F.lit(n) for n in v]) if v else F.array().cast("array<string>") for k, v in names.items()}
    return row.withColumns(lists).withColumn("total_features", F.lit(len(names["feature_columns"])).cast("long"))


# ---- feature groups -------------------------------------------------------------------------------------
def with_event_time(df: DataFrame) -> DataFrame:
    """Record id and event time of a feature group."""
    return df.withColumnsRenamed({S.ITEM: "Item_Code"}).withColumn("EventTime", c(S.DATE).cast("timestamp"))


def append_offline(df: DataFrame, path: str) -> None:
    with_event_time(df).write.mode("append").parquet(path)


def online_view(offline: DataFrame, key: str = "Item_Code", as_of: Column | None = None) -> DataFrame:
    """Newest record per key, optionally as it was at a moment; combined before the shuffle."""
    rows = offline if as_of is None else offline.where(F.col("EventTime") <= as_of)
    rest = [n for n in rows.columns if n != key]
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*[c(n) for n in rest]), F.col("EventTime")).alias("_row"))
    return newest.select(key, *[F.col("_row").getField(n).alias(n) for n in rest])
