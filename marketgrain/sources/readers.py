"""Reading of raw files, splits, metric snapshots and service text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from marketgrain import schemas as S
from marketgrain.functions.numeric import ratio
from marketgrain.operators.daily import with_date


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern matches anything, on any file system Spark can read."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def source_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per required raw file with whether it is there."""
    rows = [(name, f"{folder}/{file}", path_exists(spark, f"{folder}/{file}")) for name, file in S.RAW_FILES.items()]
    return spark.createDataFrame(rows, "source string, path string, exists boolean")


def read_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The raw CSV tables that exist, by fixed schema, with parsed dates; an absent file is an absent table.

    Columns are matched by header name, so files with another order or fewer columns still read right.
    """
    tables = {}
    for name, file in S.RAW_FILES.items():
        if path_exists(spark, f"{folder}/{file}"):
            df = read_csv(spark, f"{folder}/{file}", S.RAW_SCHEMAS[name])
            tables[name] = with_date(df) if S.DATE in df.columns else df
    return tables


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV by header name: text columns as they stand, typed where the schema knows the name."""
    text = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    text = text.toDF(*[n.lstrip("﻿").strip() for n in text.columns])
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    columns = []
    for name in text.columns:
        col = F.col(f"`{name}`")
        columns.append((F.trim(col).try_cast(kinds[name]) if kinds.get(name, "string") != "string" else col).alias(name))
    return text.select(*columns)


def read_splits(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    names = ("train", "validation", "test", "features_complete")
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names if path_exists(spark, f"{folder}/{n}")}


def read_first(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The first of several places that exists; Parquet folders, or CSV by file name."""
    for path in paths:
        if path_exists(spark, path):
            return spark.read.option("header", True).csv(path) if path.endswith(".csv") else spark.read.parquet(path)
    raise FileNotFoundError(f"none of these exists: {list(paths)}")


# ---- metric snapshots -----------------------------------------------------------------------------------
def _entry(*names: str) -> str:
    return "array<struct<timestamp: string, " + ", ".join(f"{n}: double" for n in names) + ">>"


SYSTEM_FIELDS = ("cpu_percent", "memory_percent", "disk_percent", "memory_available_gb", "disk_free_gb")
API_FIELDS = ("total_requests", "prediction_count", "average_latency_ms", "error_count", "api_response_time_ms", "api_available")
QUALITY_FIELDS = ("quality_score", "data_freshness_hours")
HEALTH_FIELDS = ("models_loaded", "uptime_seconds", "status_healthy", "response_time_ms")
MODEL_FIELDS = (*S.METRIC_NAMES, *HEALTH_FIELDS)
SNAPSHOT_SCHEMA = (
    f"system {_entry(*SYSTEM_FIELDS)}, models map<string, {_entry(*MODEL_FIELDS)}>, "
    f"api {_entry(*API_FIELDS)}, data_quality {_entry(*QUALITY_FIELDS)}"
)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot files, one object each, as long rows."""
    return long_snapshots(spark.read.schema(SNAPSHOT_SCHEMA).option("multiLine", True).json(path))


def long_snapshots(raw: DataFrame) -> DataFrame:
    """Nested metric snapshots to the long table (ts, source, entity, metric, value)."""
    def long(rows: DataFrame, source: str, fields: Sequence[str]) -> DataFrame:
        flat = rows.select(
            F.col("e.timestamp").cast("timestamp").alias("ts"), "entity", *[F.col(f"e.{n}").alias(n) for n in fields]
        )
        values = flat.unpivot(["ts", "entity"], list(fields), "metric", "value").where(F.col("value").isNotNull())
        return values.select("ts", F.lit(source).alias("source"), "entity", "metric", "value")

    def single(column: str) -> DataFrame:
        return raw.select(F.lit(column).alias("entity"), F.explode(column).alias("e"))

    models = raw.select(F.explode("models").alias("entity", "rows")).select("entity", F.explode("rows").alias("e"))
    return (
        long(single("system"), "system", SYSTEM_FIELDS)
        .unionByName(long(models, "models", MODEL_FIELDS))
        .unionByName(long(single("api"), "api", API_FIELDS))
        .unionByName(long(single("data_quality"), "data_quality", QUALITY_FIELDS))
    )


def read_evaluation(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation file to rows (model, metric, value) of the six kept metrics, 0 where a model lacks one."""
    text = spark.read.text(path, wholetext=True)
    models = text.select(F.explode(F.from_json("value", "map<string, map<string, double>>")).alias("model", "m"))
    names = F.explode(F.array(*[F.lit(n) for n in S.METRIC_NAMES]))
    return models.select("model", "m", names.alias("metric")).select(
        "model", "metric", F.coalesce(F.try_element_at("m", F.col("metric")), F.lit(0.0)).alias("value")
    )


def service_figures(lines: DataFrame, value: str = "value", keys: Sequence[str] = ()) -> DataFrame:
    """Requests, predictions and mean latency from exposition text; comment lines are skipped."""
    text = F.col(value)
    number = F.regexp_extract(text, r"(\S+)\s*$", 1).try_cast("double")
    usable = lines.where(~text.startswith("#"))

    def total(word: str):
        return F.coalesce(F.sum(F.when(text.contains(word), number)), F.lit(0.0))

    rows = usable.groupBy(*keys).agg(
        total("api_requests_total").alias("total_requests"),
        total("prediction_latency_seconds_count").alias("prediction_count"),
        total("prediction_latency_seconds_sum").alias("_seconds"),
    )
    mean = ratio(F.col("_seconds"), F.col("prediction_count"), 0.0) * 1000
    return rows.withColumn("average_latency_ms", mean).drop("_seconds")


ALERT_SCHEMA = (
    "type string, alert_type string, severity string, message string, timestamp string, metric string, value double, "
    "threshold double, model string, _corrupt_record string"
)


def _sound_and_broken(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    broken = F.col("_corrupt_record").isNotNull()
    good = rows.where(~broken).withColumn("type", F.coalesce("type", "alert_type")).drop("_corrupt_record", "alert_type")
    return good, rows.where(broken).select("path", F.col("_corrupt_record").alias("text"))


def read_alerts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Alert files, one object each: the readable ones as rows, the broken ones as (path, text) for quarantine.

    The text is parsed here, not by the JSON reader, so a broken file keeps its whole text.
    """
    text = spark.read.text(path, wholetext=True).select("value", F.input_file_name().alias("path"))
    return _sound_and_broken(_parsed(text))


def read_alert_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The same for files with one alert per line."""
    return _sound_and_broken(_parsed(spark.read.text(path).select("value", F.input_file_name().alias("path"))))


def _parsed(text: DataFrame) -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return text.select(F.from_json("value", ALERT_SCHEMA, options).alias("a"), "path").select("a.*", "path")


def freshness_hours(df: DataFrame, now) -> DataFrame:
    """Hours since the newest input file was written, 24 when there is none."""
    newest = df.select("_metadata.file_modification_time").agg(F.max("file_modification_time").alias("t"))
    hours = F.timestamp_diff("SECOND", F.col("t"), now) / 3600
    return newest.select(F.coalesce(hours, F.lit(24.0)).alias("freshness_hours"))


VALIDATION = "tables_validated long, total_quality_score double, validation_passed boolean, recommendation string"


def stored_validation(spark: SparkSession, folder: str) -> DataFrame:
    """The summary of the last stored validation; no row where none is stored."""
    try:
        return spark.read.schema(VALIDATION).json(f"{folder}/summary")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VALIDATION)
