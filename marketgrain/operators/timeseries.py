"""Decomposition and autocorrelation of daily series.

A series has one row per calendar day, or per key and day, which bounds every window. Many series run in
parallel when keys are given.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from marketgrain import schemas as S
from marketgrain.functions.naming import c
from marketgrain.functions.numeric import ratio

PERIOD = 365


def decompose(
    series: DataFrame, value: str, keys: Sequence[str] = (), order: str = S.DATE, period: int = PERIOD
) -> DataFrame:
    """Additive decomposition: ``trend`` (centred moving average), ``seasonal`` and ``residual``.

    The trend is empty for half a period at both ends. Keys with at most two periods of rows are left out.
    """
    by_time = Window.partitionBy(*keys).orderBy(order)
    everything = Window.partitionBy(*keys)
    half = period // 2
    centred = by_time.rowsBetween(-half, half)
    x = F.col("_x")
    if period % 2:
        mean, width = F.avg(x).over(centred), period
    else:
        # the two end points carry half a weight each
        ends = (F.lag(x, half).over(by_time) + F.lead(x, half).over(by_time)) / 2
        mean, width = (F.sum(x).over(centred) - ends) / period, period + 1
    filled = F.coalesce(
        F.last(value, ignorenulls=True).over(by_time.rowsBetween(Window.unboundedPreceding, 0)),
        F.first(value, ignorenulls=True).over(by_time.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    )
    base = series.withColumns({
        "_x": filled,
        "_at": (F.row_number().over(by_time) - 1) % period,
        "_n": F.count(F.lit(1)).over(everything),
    }).where(F.col("_n") > 2 * period)
    trended = base.withColumn("trend", F.when(F.count(x).over(centred) == width, mean))
    phase = trended.groupBy(*keys, "_at").agg(F.avg(x - F.col("trend")).alias("_phase"))
    centre = phase.groupBy(*keys).agg(F.avg("_phase").alias("_centre"))
    if keys:
        phase = phase.join(centre, list(keys)).select(*keys, "_at", (F.col("_phase") - F.col("_centre")).alias("seasonal"))
    else:
        phase = phase.select("_at", (F.col("_phase") - centre.select("_centre").scalar()).alias("seasonal"))
    joined = trended.join(phase, [*keys, "_at"])
    return joined.select(
        *keys, order, x.alias("observed"), "trend", "seasonal", (x - F.col("trend") - F.col("seasonal")).alias("residual")
    )


def strengths(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """How much of the variance season and trend explain."""
    noise = F.var_samp("residual")
    return parts.groupBy(*keys).agg(
        (1 - ratio(noise, F.var_samp(F.col("seasonal") + F.col("residual")))).alias("seasonal_strength"),
        (1 - ratio(noise, F.var_samp(F.col("trend") + F.col("residual")))).alias("trend_strength"),
    )


def acf(series: DataFrame, value: str, keys: Sequence[str] = (), order: str = S.DATE, lags: int = 40) -> DataFrame:
    """Autocorrelation around the mean of the whole series, rows (lag, acf) for lags 0 to ``lags``.

    All lags are columns of one window over one sort; they become rows after the aggregation.
    """
    by_time, everything = Window.partitionBy(*keys).orderBy(order), Window.partitionBy(*keys)
    known = series.where(c(value).isNotNull())
    centred = known.withColumn("_d", c(value) - F.avg(c(value)).over(everything))
    shifted = centred.select(*keys, "_d", *[F.lag("_d", k).over(by_time).alias(f"_{k}") for k in range(1, lags + 1)])
    sums = [F.struct(F.lit(0).alias("lag"), F.sum(F.col("_d") * F.col("_d")).alias("s"))]
    sums += [F.struct(F.lit(k).alias("lag"), F.sum(F.col("_d") * F.col(f"_{k}")).alias("s")) for k in range(1, lags + 1)]
    grouped = shifted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.array(*sums).alias("_s"))
    last = F.least(F.lit(lags), F.floor(F.col("_n") / 4).cast("int"))
    total = F.element_at("_s", 1).getField("s")
    return (
        grouped.select(*keys, last.alias("_last"), total.alias("_total"), F.explode("_s").alias("_e"))
        .where(F.col("_e.lag") <= F.col("_last"))
        .select(*keys, F.col("_e.lag").alias("lag"), ratio(F.col("_e.s"), F.col("_total")).alias("acf"))
    )


def _partial(rho: np.ndarray) -> np.ndarray:
    """Durbin-Levinson recursion on the autocorrelations of one key, at most 41 numbers."""
    out, phi = np.ones(len(rho)), np.zeros(0)
    for k in range(1, len(rho)):
        top = rho[k] - phi @ rho[k - 1:0:-1]
        last = top / (1 - phi @ rho[1:k])
        phi = np.append(phi - last * phi[::-1], last)
        out[k] = last
    return out


def pacf(series: DataFrame, value: str, keys: Sequence[str] = (), order: str = S.DATE, lags: int = 40) -> DataFrame:
    """Partial autocorrelation (Yule-Walker, bias-adjusted) from the autocorrelations."""
    counted = series.where(c(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    table = acf(series, value, keys, order, lags)
    if keys:
        table = table.join(counted, list(keys))
    else:
        table = table.withColumn("n", counted.scalar())
    fields = "".join(f"`{k}` {dict(series.dtypes)[k]}, " for k in keys)

    def per_series(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("lag").reset_index(drop=True)
        n, lag = frame["n"], frame["lag"]
        frame["pacf"] = _partial((frame["acf"] * n / (n - lag)).to_numpy())
        return frame[[*keys, "lag", "pacf"]]

    return table.groupBy(*keys).applyInPandas(per_series, f"{fields}lag int, pacf double")


def autocorrelation(
    series: DataFrame, value: str, lags: Sequence[int] = (1, 7, 30), keys: Sequence[str] = (), order: str = S.DATE
) -> DataFrame:
    """Pearson correlation of the series with itself some rows before."""
    by_time = Window.partitionBy(*keys).orderBy(order)
    known = series.where(c(value).isNotNull())
    shifted = known.select(*keys, c(value).alias("_x"), *[F.lag(c(value), k).over(by_time).alias(f"_{k}") for k in lags])
    return shifted.groupBy(*keys).agg(*[F.corr("_x", f"_{k}").alias(f"lag_{k}") for k in lags])
