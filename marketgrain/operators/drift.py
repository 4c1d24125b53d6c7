"""Drift between a reference and a current table.

Every method works on the long form (feature, value) of both tables and returns one row per feature with
``drift_score`` and ``drift_detected``. The number of features is that of the schema, so per-feature tables
are small and may be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from marketgrain.functions.lattice import exact_tail
from marketgrain.functions.naming import c
from marketgrain.functions.numeric import count_where, is_numeric, ratio, to_number
from marketgrain.functions.order_stats import running_total, slot_counts, wide_quantiles
from marketgrain.functions.pricing import drift_severity, ks_text, psi_text
from marketgrain.session import materialize

THRESHOLD = 0.25
DRIFTED_SHARE = 0.3
PERFORMANCE_THRESHOLD = 0.15
MIN_STD = 1e-8
EMPTY_BIN = 1e-4
#: values a side up to which the Kolmogorov-Smirnov p-value is exact
EXACT_ROWS = 10_000


def wide_numbers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns as finite doubles, NULL where there is no number."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[to_number(c(n), kinds[n]).alias(n) for n in names])


def numbers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same as a long table (feature, value)."""
    return wide_numbers(df, names).unpivot([], list(names), "feature", "value")


def stored_sides(reference: DataFrame, current: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The compared columns of both tables, written once; several methods read each side some ten times."""
    return tuple(materialize(df.select(*[c(n) for n in names]), "side") for df in (reference, current))


def shared_features(reference: DataFrame, current: DataFrame) -> list[str]:
    """Numeric columns of both tables."""
    ours = {f.name for f in current.schema.fields if is_numeric(f.dataType)}
    return [f.name for f in reference.schema.fields if is_numeric(f.dataType) and f.name in ours]


def profile(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Moments, exact quartiles and missing rate per feature."""
    wide = wide_numbers(df, names)

    def moments(name: str) -> Column:
        value = c(name)
        shaped = (F.count(value) > 3) & (F.var_pop(value) > 1e-10)
        return F.struct(
            F.lit(name).alias("feature"), F.count(value).alias("n"), F.avg(value).alias("mean"),
            F.greatest(F.coalesce(F.stddev_samp(value), F.lit(0.0)), F.lit(MIN_STD)).alias("std"),
            F.min(value).alias("min"), F.max(value).alias("max"),
            *[F.coalesce(F.when(shaped, m(value)), F.lit(0.0)).alias(k) for k, m in (("skewness", F.skewness), ("kurtosis", F.kurtosis))],
            ratio(count_where(value.isNull()), F.count(F.lit(1))).alias("missing_rate"),
        )

    found = wide.agg(F.array(*[moments(n) for n in names]).alias("rows")).select(F.inline("rows"))
    quartiles = wide_quantiles(wide, {n: c(n) for n in names}, [0.25, 0.5, 0.75]).select(
        F.col("name").alias("feature"), *[F.element_at("quantiles", i).alias(n) for i, n in enumerate(("q25", "median", "q75"), 1)]
    )
    # one row per feature of the schema
    return found.join(F.broadcast(quartiles), "feature")


def statistical_drift(reference: DataFrame, current: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Shift of mean, deviation and median in reference deviations; arguments are profiles."""
    stats = ("mean", "std", "median", "skewness", "kurtosis")
    ours = current.select("feature", F.struct(*stats).alias("current_stats"))
    theirs = reference.select(
        "feature", F.struct(*stats, "q25", "q75", "min", "max", "missing_rate").alias("reference_stats")
    )

    def shift(stat: str) -> Column:
        gap = F.abs(F.col(f"current_stats.{stat}") - F.col(f"reference_stats.{stat}"))
        return gap / F.greatest(F.col("reference_stats.std"), F.lit(MIN_STD))

    shifts = {f"{stat}_drift": shift(stat) for stat in ("mean", "std", "median")}
    joined = theirs.join(ours, "feature").withColumns(shifts)
    scored = joined.withColumn("drift_score", reduce(lambda a, b: a + b, [F.col(n) for n in shifts]) / 3)
    return scored.withColumn("drift_detected", F.col("drift_score") > threshold)


def profile_shift(reference: DataFrame, current: DataFrame, keys: Sequence[str], threshold: float = THRESHOLD) -> DataFrame:
    """The same score for profiles of many windows (keys, feature, mean, std, median) against one reference profile."""
    theirs = reference.select(F.col("feature").alias("_feature"), *[F.col(n).alias(f"_{n}") for n in ("mean", "std", "median")])
    # one row per feature of the schema
    joined = current.join(F.broadcast(theirs), F.col("feature") == F.col("_feature"))
    gaps = [F.abs(F.col(n) - F.col(f"_{n}")) / F.greatest(F.col("_std"), F.lit(MIN_STD)) for n in ("mean", "std", "median")]
    scored = joined.withColumn("drift_score", reduce(lambda a, b: a + b, gaps) / 3)
    return scored.select(*keys, "feature", "drift_score", (F.col("drift_score") > threshold).alias("drift_detected"))


def _pair(reference: DataFrame, current: DataFrame, names: Sequence[str]) -> DataFrame:
    """Both tables in long form with 0/1 columns that say where a value comes from."""
    a, b = (numbers(df, names).where(F.col("value").isNotNull()) for df in (reference, current))
    return a.select("*", F.lit(1).alias("r"), F.lit(0).alias("c")).unionByName(
        b.select("*", F.lit(0).alias("r"), F.lit(1).alias("c"))
    )


def distributions(reference: DataFrame, current: DataFrame, names: Sequence[str]) -> DataFrame:
    """Both empirical distribution functions at every distinct value.

    Values are counted before the shuffle and the running sums are built in slices of the value axis, so a
    feature with very many values spreads over all tasks. The counts are read several times and therefore
    written once.
    """
    counts = _pair(reference, current, names).groupBy("feature", "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    counts = materialize(counts, "counts")
    sizes = counts.groupBy("feature").agg(F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))
    running = running_total(counts, ["feature"], "value", {"r": "_r", "c": "_c"}, following="next_value")
    return running.join(F.broadcast(sizes), "feature").where((F.col("n_ref") > 0) & (F.col("n_cur") > 0)).select(
        "feature", "value", "next_value", "n_ref", "n_cur",
        (F.col("_r") / F.col("n_ref")).alias("cdf_ref"), (F.col("_c") / F.col("n_cur")).alias("cdf_cur"),
    )


def kolmogorov_tail(t: Column, terms: int = 100) -> Column:
    """Asymptotic tail of the Kolmogorov distribution."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * t * t),
    )
    # the series converges slowly near 0, where the tail is 1
    return F.when(t < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * series)))


@F.pandas_udf(T.DoubleType())
def _exact_tails(gap: pd.Series, n_ref: pd.Series, n_cur: pd.Series) -> pd.Series:
    return pd.Series([exact_tail(d, m, n) for d, m, n in zip(gap, n_ref, n_cur)])


def distances(reference: DataFrame, current: DataFrame, names: Sequence[str]) -> DataFrame:
    """Largest gap and area between the distribution functions: one stored row per feature, for ``ks_drift`` and ``wasserstein_drift``."""
    gap = F.abs(F.col("cdf_ref") - F.col("cdf_cur"))
    return materialize(distributions(reference, current, names).groupBy("feature").agg(
        F.max(gap).alias("gap"), F.coalesce(F.sum(gap * (F.col("next_value") - F.col("value"))), F.lit(0.0)).alias("area"),
        F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"),
    ), "distances")


def ks_drift(
    reference: DataFrame, current: DataFrame, names: Sequence[str], alpha: float = 0.05, exact_rows: int = EXACT_ROWS,
    found: DataFrame | None = None,
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test; the p-value is exact where both sides have at most ``exact_rows`` values, else asymptotic.

    ``found``: the ``distances`` of the two tables, if they are there already.
    """
    found = distances(reference, current, names) if found is None else found
    gaps = found.select("feature", F.col("gap").alias("drift_score"), "n_ref", "n_cur")
    effective = F.sqrt(F.col("n_ref") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur")))
    asymptotic = kolmogorov_tail(effective * F.col("drift_score"))
    if exact_rows:
        small = F.greatest("n_ref", "n_cur") <= exact_rows
        # one row per feature of the schema
        exact = _exact_tails(F.col("drift_score"), F.when(small, F.col("n_ref")).otherwise(0), F.when(small, F.col("n_cur")).otherwise(0))
        gaps = gaps.withColumn("p_value", F.when(small, exact).otherwise(asymptotic))
    tested = gaps if exact_rows else gaps.withColumn("p_value", asymptotic)
    return tested.withColumns({
        "drift_detected": F.col("p_value") < alpha,
        "interpretation": ks_text(F.col("drift_score"), F.col("p_value")),
    })


def wasserstein_drift(
    reference: DataFrame, current: DataFrame, names: Sequence[str], threshold: float = 0.1, found: DataFrame | None = None
) -> DataFrame:
    """Area between the distribution functions in reference deviations; ``found`` as in ``ks_drift``."""
    found = distances(reference, current, names) if found is None else found
    areas = found.select("feature", F.col("area").alias("distance"))
    rows = [F.struct(F.lit(n).alias("feature"), F.stddev_pop(c(n)).alias("std")) for n in names]
    spread = wide_numbers(reference, names).agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
    scored = areas.join(F.broadcast(spread), "feature").withColumn(
        "drift_score", F.col("distance") / F.greatest(F.col("std"), F.lit(1e-3))
    )
    return scored.withColumn("drift_detected", F.col("drift_score") >= threshold)


def _binned(
    reference: DataFrame, current: DataFrame, names: Sequence[str], bins: int
) -> tuple[DataFrame, DataFrame]:
    """Rows (feature, bin, ref_share, cur_share), and the features that have values on both sides.

    Both sides are counted by slots of the edges, which the driver adds up to bins: one number per column of the schema and bin.
    """
    spark, names, sides = reference.sparkSession, list(names), [wide_numbers(df, names) for df in (reference, current)]
    quantiles = wide_quantiles(sides[0], {n: c(n) for n in names}, [i / bins for i in range(bins + 1)]).select("name", "quantiles")
    found = {name: sorted(set(values)) for name, values in quantiles.collect()}
    edges = [found.get(n, []) for n in names]
    shares, both = [], []
    for name, own, *counts in zip(names, edges, *[slot_counts(side, edges) for side in sides], strict=True):
        sizes = [sum(count) for count in counts]
        if all(sizes):
            both.append((name,))
        for at in range(1, len(own)):
            # from an edge on and below the next; the last bin has its upper edge too
            slots = slice(2 * at - 1, 2 * at + 1 + (at == len(own) - 1))
            shares.append((name, at, *[sum(count[slots]) / size if size else None for count, size in zip(counts, sizes, strict=True)]))
    table = spark.createDataFrame(shares, "feature string, bin int, ref_share double, cur_share double")
    return table, spark.createDataFrame(both, "feature string")


def binned_shares(reference: DataFrame, current: DataFrame, names: Sequence[str], bins: int = 10) -> DataFrame:
    """Share of both tables in the reference's quantile bins, rows (feature, bin, ref_share, cur_share).

    Values outside the reference range are in no bin but count in the total. A feature with a single edge
    has no bins.
    """
    return _binned(reference, current, names, bins)[0]


def psi_drift(
    reference: DataFrame, current: DataFrame, names: Sequence[str], bins: int = 10, threshold: float = 0.25
) -> DataFrame:
    """Population stability index; 0 for a feature that has one edge. A feature without values on a side is left out."""
    def filled(name: str) -> Column:
        return F.when(F.col(name) == 0, F.lit(EMPTY_BIN)).otherwise(F.col(name))

    r, n = filled("ref_share"), filled("cur_share")
    table, both = _binned(reference, current, names, bins)
    scores = table.groupBy("feature").agg(F.sum((n - r) * F.ln(n / r)).alias("drift_score"))
    scored = both.join(scores, "feature", "left").withColumn("drift_score", F.coalesce("drift_score", F.lit(0.0)))
    return scored.withColumns({
        "drift_detected": F.col("drift_score") > threshold, "interpretation": psi_text(F.col("drift_score"))
    })


def jensen_shannon(reference: DataFrame, current: DataFrame, names: Sequence[str], bins: int = 10) -> DataFrame:
    """Jensen-Shannon distance over the reference's quantile bins; features without values on a side are left out."""
    p, q = F.col("ref_share"), F.col("cur_share")
    middle = (p + q) / 2

    def part(share: Column) -> Column:
        return F.when(share > 0, share * F.ln(share / middle)).otherwise(0.0)

    table, both = _binned(reference, current, names, bins)
    scores = table.groupBy("feature").agg(
        F.sqrt(F.greatest(F.sum((part(p) + part(q)) / 2), F.lit(0.0))).alias("drift_score"))
    return scores.join(both, "feature", "left_semi")


def chi_square(reference: DataFrame, current: DataFrame, names: Sequence[str]) -> DataFrame:
    """Chi-square statistic of the current category counts against the reference's shares.

    Categories the reference never showed have no expected count and are left out, as are empty ones. Features without
    values on one of the two sides have nothing to compare and are left out.
    """
    def long(df: DataFrame, side: int) -> DataFrame:
        rows = df.select(*[c(n).cast("string").alias(n) for n in names]).unpivot([], list(names), "feature", "value")
        return rows.select("*", F.lit(1 - side).alias("r"), F.lit(side).alias("c"))

    counts = long(reference, 0).unionByName(long(current, 1)).where(F.col("value").isNotNull()).groupBy(
        "feature", "value"
    ).agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    sizes = counts.groupBy("feature").agg(F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))
    sizes = sizes.where((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
    expected = F.col("r") * F.col("n_cur") / F.col("n_ref")
    return (
        counts.join(F.broadcast(sizes), "feature")
        .where(F.col("r") > 0)
        .groupBy("feature")
        .agg(
            F.sum((F.col("c") - expected) ** 2 / expected).alias("drift_score"),
            (F.count(F.lit(1)) - 1).alias("degrees_of_freedom"),
        )
    )


# ---- verdicts ------------------------------------------------------------------------------------------
METHODS = ("statistical", "evidently", "ks_test", "population_stability")


def detect(
    reference: DataFrame, current: DataFrame, names: Sequence[str] | None = None, method: str = "statistical",
    exact_rows: int = EXACT_ROWS, found: DataFrame | None = None,
) -> DataFrame:
    """One of the four methods; ``evidently`` is the normalised Wasserstein distance over all rows.

    Without ``names``, the numeric columns that both tables have are compared. ``found``: the ``distances`` of the two
    tables, which ``evidently`` and ``ks_test`` share.
    """
    names = shared_features(reference, current) if names is None else names
    if method == "statistical":
        return statistical_drift(profile(reference, names), profile(current, names))
    if method == "evidently":
        return wasserstein_drift(reference, current, names, found=found)
    if method == "ks_test":
        return ks_drift(reference, current, names, exact_rows=exact_rows, found=found)
    if method == "population_stability":
        return psi_drift(reference, current, names)
    raise ValueError(f"unknown drift method {method!r}, expected one of {METHODS}")


def verdict(results: DataFrame, threshold: float = THRESHOLD, keys: Sequence[str] = ()) -> DataFrame:
    """One row (or one for each of ``keys``): drifted features, their share, the mean score and whether the whole drifted."""
    counted = results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_features"),
        count_where(F.col("drift_detected")).alias("drifted_features"),
        F.avg("drift_score").alias("drift_score"),
        F.max("drift_score").alias("max_drift_score"),
        F.min("drift_score").alias("min_drift_score"),
    )
    share = ratio(F.col("drifted_features"), F.col("total_features"), 0.0)
    return counted.withColumn("drift_ratio", share).withColumn(
        "overall_drift_detected",
        F.coalesce((F.col("drift_ratio") > DRIFTED_SHARE) | (F.col("drift_score") > threshold), F.lit(False)),
    )


def severity_counts(results: DataFrame) -> DataFrame:
    label = drift_severity(F.col("drift_score"))
    return results.agg(*[count_where(label == s).alias(f"{s}_drift") for s in ("high", "medium", "low", "none")])


def ranked(results: DataFrame, limit: int | None = None) -> DataFrame:
    rows = results.select("feature", "drift_score", "drift_detected", drift_severity(F.col("drift_score")).alias("severity"))
    rows = rows.orderBy(F.desc("drift_score"), "feature")
    return rows.limit(limit) if limit else rows


def alert(summary: DataFrame, method: str, alert_type: str = "data_drift") -> DataFrame:
    """An alert row, only if the verdict is drift."""
    text = F.format_string(
        "drift detected: score %.3f, %d of %d features drifted (%.2f%%), method " + method,
        F.col("drift_score"), F.col("drifted_features"), F.col("total_features"), F.col("drift_ratio") * 100,
    )
    return summary.where(F.col("overall_drift_detected")).select(
        F.lit(alert_type).alias("alert_type"), F.lit(method).alias("method"), "drift_score", text.alias("message")
    )


def prediction_errors(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MAE, MSE, RMSE and MAPE per key; zero actuals are left out of the MAPE."""
    gap = F.col("actual") - F.col("predicted")
    return df.where(gap.isNotNull()).groupBy(*keys).agg(
        F.avg(F.abs(gap)).alias("mae"), F.avg(gap * gap).alias("mse"),
        F.coalesce(F.avg(F.abs(ratio(gap, F.col("actual")))) * 100, F.lit(0.0)).alias("mape"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"), F.count(F.lit(1)).alias("sample_size"),
    )


def performance_drift(current: DataFrame, baseline: DataFrame, key: str, threshold: float = PERFORMANCE_THRESHOLD) -> DataFrame:
    """Growth of the MAPE over the baseline's; a model without a baseline becomes its own baseline."""
    known = baseline.select(key, F.col("mape").alias("_base"))
    joined = current.join(known, key, "left").withColumn("baseline_mape", F.coalesce("_base", F.col("mape"))).drop("_base")
    worse = F.when(F.col("baseline_mape") > 0, (F.col("mape") - F.col("baseline_mape")) / F.col("baseline_mape") * 100)
    return joined.withColumn("degradation_pct", F.coalesce(worse, F.lit(0.0))).withColumn(
        "performance_drift_detected", F.col("degradation_pct") > threshold * 100
    )
