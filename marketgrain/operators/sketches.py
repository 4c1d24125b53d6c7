"""Stored sketches: distinct counts, key overlaps and quantiles of any range of days without reading rows again.

A table of sketches has a row for each day (and key): the number of rows, a HyperLogLog and a theta sketch of every
identifier column, a KLL sketch of every number. Sketches of days merge to those of a range. New rows are sketched alone and
appended, also for days that are there already; a range is answered from rows of sketches, whose number follows the days.

Errors: distinct counts have a relative standard error of 1.04 / sqrt(2 ** LOG_ENTRIES) (HyperLogLog) and 1 / sqrt(2 ** LOG_ENTRIES)
(theta, exact below 2 ** LOG_ENTRIES values); quantiles are off by about 0.1 % in rank (exact up to KLL_SIZE values).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marketgrain.functions.naming import c

LOG_ENTRIES, KLL_SIZE = 12, 4096
#: one standard error of a distinct count
ERROR = 1.04 / 2 ** (LOG_ENTRIES / 2)


def day_sketches(rows: DataFrame, day: str, ids: Sequence[str] = (), numbers: Sequence[str] = (), keys: Sequence[str] = ()) -> DataFrame:
    """A row for each day and key, combined before the shuffle."""
    found = [F.count(F.lit(1)).alias("n")]
    for name in ids:
        found += [F.hll_sketch_agg(c(name), F.lit(LOG_ENTRIES)).alias(f"{name}_hll"),
                  F.theta_sketch_agg(c(name), F.lit(LOG_ENTRIES)).alias(f"{name}_theta")]
    found += [F.kll_sketch_agg_double(c(name).cast("double"), F.lit(KLL_SIZE)).alias(f"{name}_kll") for name in numbers]
    return rows.groupBy(c(day).alias("day"), *[c(k) for k in keys]).agg(*found)


def append(sketches: DataFrame, path: str) -> None:
    sketches.write.mode("append").parquet(path)


def merged(sketches: DataFrame, keys: Sequence[Column | str] = ()) -> DataFrame:
    """One row for all rows of sketches, or for each of ``keys``."""
    found = [F.sum("n").alias("n")]
    for name in sketches.columns:
        if name.endswith("_hll"):
            found.append(F.hll_union_agg(c(name)).alias(name))
        elif name.endswith("_theta"):
            found.append(F.theta_union_agg(c(name), F.lit(LOG_ENTRIES)).alias(name))
        elif name.endswith("_kll"):
            found.append(F.kll_merge_agg_double(c(name), F.lit(KLL_SIZE)).alias(name))
    return sketches.groupBy(*keys).agg(*found)


def between(sketches: DataFrame, first: Column, last: Column) -> DataFrame:
    """Sketches of the days of a range, both ends included."""
    return sketches.where(F.col("day").between(first, last))


def distinct(name: str) -> Column:
    return F.hll_sketch_estimate(c(f"{name}_hll"))


def quantile(name: str, share: float) -> Column:
    return F.kll_sketch_get_quantile_double(c(f"{name}_kll"), F.lit(float(share)))


def rank(name: str, value: float) -> Column:
    """Share of values up to a fixed one."""
    return F.kll_sketch_get_rank_double(c(f"{name}_kll"), F.lit(float(value)))


def overlap(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """Identifiers in both, only left, only right, and the left ones' share in both; each side is one merged row."""
    a, b = F.col("_a"), F.col("_b")
    # one row on each side
    pair = left.select(F.lit(1).alias("_one"), c(f"{name}_theta").alias("_a")).join(
        right.select(F.lit(1).alias("_one"), c(f"{name}_theta").alias("_b")), "_one")
    counted = pair.select(
        F.theta_sketch_estimate(F.theta_intersection(a, b)).alias("in_both"),
        F.theta_sketch_estimate(F.theta_difference(a, b)).alias("only_left"),
        F.theta_sketch_estimate(F.theta_difference(b, a)).alias("only_right"), F.theta_sketch_estimate(a).alias("left"))
    share = F.when(F.col("left") > 0, F.col("in_both") * 100.0 / F.col("left"))
    return counted.select("in_both", "only_left", "only_right", share.alias("coverage_pct"))
