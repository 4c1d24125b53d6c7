"""Starting streams and collecting what they wrote."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketgrain.session import checkpoint_root


def file_stream(spark: SparkSession, folder: str, pattern: str, schema: T.StructType, files_per_trigger: int | None = 64) -> DataFrame:
    """A stream over the Parquet files of a folder that match a pattern."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType, files_per_trigger: int | None = 64) -> DataFrame:
    """A stream over a stored table, which is a file ``name``.parquet of the folder or a folder of part files of that name.

    Spark's own file system answers which of the two it is.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return file_stream(spark, f"{folder}/{name}.parquet", "*", schema, files_per_trigger)
    return file_stream(spark, folder, f"{name}.parquet", schema, files_per_trigger)


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], label: str, mode: str = "append") -> None:
    """Process all available input, handing every micro-batch to ``each``."""
    folder = fresh_folder(stream.sparkSession, label)
    query = (
        stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_batches(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The rows that a handler wrote for all micro-batches, with their number as ``batch``."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(folder)


def start_every(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, interval: str, mode: str = "append"):
    """A continuing stream with a fixed interval; returns the query."""
    return (
        stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval).start()
    )
