"""Tables of files under a manifest: readers see one version whole, whatever is written meanwhile.

A manifest is a Parquet folder of its own number that lists the files (or folders) of a version. A change writes new data beside
the old, then the next manifest, which appears at once or not at all; nothing that an earlier manifest names is touched.
``vacuum`` deletes what no kept manifest names. One writer at a time is assumed, as the sources have it.

Two tables are built on it: ``History``, rows of event time whose files expire whole, and ``OnlineView``, the newest row of each key
in hash buckets, of which an ingest rewrites only those that it touches.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketgrain.functions.naming import c
from marketgrain.session import remove


class Versioned:
    """The manifests of a folder."""

    entry = ""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _all(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(f"{self.entry}, version long").parquet(f"{self.path}/manifests")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def version(self) -> int:
        """Number of the newest manifest; 0 before the first."""
        known = self._all()
        return 0 if known is None else known.agg(F.max("version")).first()[0] or 0

    def entries(self, version: int | None = None) -> DataFrame:
        """What a manifest names, the newest one if none is asked for."""
        version = self.version() if version is None else version
        known = self._all()
        if known is None:
            return self.spark.createDataFrame([], self.entry)
        # a manifest without entries holds one row of nulls, so that it counts as a version
        return known.where((F.col("version") == version) & F.col(self.entry.split(" ")[0]).isNotNull()).drop("version")

    def _publish(self, entries: DataFrame, version: int) -> None:
        empty = self.spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in entries.schema.fields])
        kept = entries.union(empty)
        kept.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/manifests/version={version}")

    def _places(self, version: int | None = None) -> list[str]:
        """Paths of a version, which Spark's own planning lists on the driver too."""
        return sorted({r[0] for r in self.entries(version).select("place").distinct().toLocalIterator()})

    def vacuum(self, keep: int = 1) -> int:
        """Delete what the newest ``keep`` manifests don't name, and older manifests; the number of deleted places."""
        known, newest = self._all(), self.version()
        if known is None:
            return 0
        oldest = newest - keep + 1
        held = known.where((F.col("version") >= oldest) & F.col("place").isNotNull()).select("place").distinct()
        gone = known.where(F.col("place").isNotNull()).select("place").distinct().join(held, "place", "left_anti")
        count = 0
        for row in gone.toLocalIterator():
            remove(self.spark, row["place"])
            count += 1
        for row in known.where(F.col("version") < oldest).select("version").distinct().toLocalIterator():
            remove(self.spark, f"{self.path}/manifests/version={row['version']}")
        return count


class History(Versioned):
    """Rows of event time. Files hold narrow ranges of it, and leave when all of their rows are too old."""

    entry = "place string, oldest timestamp, newest timestamp, rows long"

    def __init__(self, spark: SparkSession, path: str, ts: str = "ts", span_hours: int = 24):
        super().__init__(spark, path)
        self.ts, self.span = ts, span_hours

    def append(self, rows: DataFrame) -> int:
        """Write rows to files of a span of event time each, or less; the new version."""
        place = f"{self.path}/data/{uuid.uuid4().hex}"
        slot = F.floor(F.unix_seconds(c(self.ts).cast("timestamp")) / (3600 * self.span)).alias("_slot")
        dealt = rows.select("*", slot).repartitionByRange("_slot", c(self.ts)).sortWithinPartitions("_slot")
        dealt.write.partitionBy("_slot").parquet(place)
        written = self.spark.read.schema(rows.schema).parquet(place)
        bounds = written.select(F.col("_metadata.file_path").alias("place"), c(self.ts).cast("timestamp").alias("_ts")).groupBy("place").agg(
            F.min("_ts").alias("oldest"), F.max("_ts").alias("newest"), F.count(F.lit(1)).alias("rows"))
        version = self.version()
        self._publish(self.entries(version).union(bounds), version + 1)
        return version + 1

    def expire(self, now: Column, hours: int = 24) -> int:
        """A version without the files whose rows are all older than ``hours``; files with younger rows stay whole."""
        limit = now - F.make_dt_interval(hours=F.lit(hours))
        version = self.version()
        self._publish(self.entries(version).where(F.col("newest").isNull() | (F.col("newest") >= limit)), version + 1)
        return version + 1

    def read(self, schema, version: int | None = None) -> DataFrame:
        """The rows of a version."""
        places = self._places(version)
        return self.spark.read.schema(schema).parquet(*places) if places else self.spark.createDataFrame([], schema)


class OnlineView(Versioned):
    """The newest row of each key. Keys are dealt into buckets; an ingest reads and writes the buckets of its own keys."""

    entry = "place string, bucket int"

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: str, buckets: int = 64):
        super().__init__(spark, path)
        self.keys, self.order, self.buckets = list(keys), order, buckets

    def _newest(self, rows: DataFrame, names: Sequence[str]) -> DataFrame:
        """Of each key the row with the largest order; of equal ones that of the later ingest, then the largest row."""
        rest = F.struct(*[c(n) for n in names if n not in self.keys])
        best = F.max(F.struct(c(self.order).alias("_order"), F.col("_ingest").alias("_ingest"), rest.alias("_row")))
        found = rows.groupBy("bucket", *[c(k) for k in self.keys]).agg(best.alias("_best"))
        return found.select(*[c(n) if n in self.keys else F.col(f"_best._row.`{n}`").alias(n) for n in names], "bucket", F.col("_best._ingest").alias("_ingest"))

    def ingest(self, rows: DataFrame) -> int:
        """Append rows to the log and merge them into their buckets; the new version."""
        version = self.version()
        log = f"{self.path}/log/{version + 1}-{uuid.uuid4().hex}"
        rows.write.parquet(log)
        logged = self.spark.read.schema(rows.schema).parquet(log)
        bucket = F.pmod(F.xxhash64(*[c(k) for k in self.keys]), F.lit(self.buckets)).cast("int")
        fresh = self._newest(logged.withColumns({"bucket": bucket, "_ingest": F.lit(version + 1)}), rows.columns)
        touched = [r[0] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        known = self.entries(version)
        old = [r[0] for r in known.where(F.col("bucket").isin(touched)).select("place").collect()]
        merged = fresh
        if old:
            merged = self._newest(fresh.unionByName(self.spark.read.schema(fresh.schema).parquet(*old).withColumn(
                "bucket", bucket)), rows.columns)
        folder = f"{self.path}/data/{version + 1}-{uuid.uuid4().hex}"
        # a bucket is one folder, of as many files as it has salts
        merged.withColumn("_salt", F.pmod(F.xxhash64(*[c(k) for k in self.keys], F.lit(1)), F.lit(4))).repartition("bucket", "_salt").drop(
            "_salt").write.partitionBy("bucket").parquet(folder)
        made = self.spark.createDataFrame([(f"{folder}/bucket={b}", b) for b in touched], self.entry)
        self._publish(known.where(~F.col("bucket").isin(touched)).union(made), version + 1)
        return version + 1

    def read(self, schema, version: int | None = None) -> DataFrame:
        """The newest row of every key, in a version."""
        places = self._places(version)
        return self.spark.read.schema(schema).parquet(*places) if places else self.spark.createDataFrame([], schema)
