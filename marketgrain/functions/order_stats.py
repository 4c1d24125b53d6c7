"""Exact order statistics and running totals that never sort a whole column in one task.

Both helpers cut the value axis of every key at approximate quantiles, total the slices (at most a few
hundred rows per key) and do the fine work inside a slice. Running totals use slices with about the same
number of distinct values; quantiles use narrow brackets around the wanted ranks. The cuts only decide how
the work is spread: results are exact for any cuts. A value that holds a third of all rows is one row after
the pre-aggregation.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from marketgrain.session import materialize

SLICES = 128
ACCURACY = 10_000
#: keys whose edges may be broadcast: SLICES doubles each, about ten megabytes
BROADCAST_KEYS = 10_000
SALTS = 64


def slice_of(edges: Column, value: Column, slices: int = SLICES) -> Column:
    """Number of edges not above ``value``, by bisection over the sorted array ``edges``."""
    jumps = F.array(*[F.lit(1 << power) for power in range(max(slices, 1).bit_length(), -1, -1)])

    def step(at: Column, jump: Column) -> Column:
        return F.when(F.try_element_at(edges, at + jump) <= value, at + jump).otherwise(at)

    return F.aggregate(jumps, F.lit(0), step)


def _edges(value: Column, slices: int) -> Column:
    grid = F.expr("array(" + ", ".join(f"{i / slices}D" for i in range(1, slices)) + ")")
    return F.array_sort(F.array_distinct(F.percentile_approx(value, grid, ACCURACY)))


def _beside(df: DataFrame, edges: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """``df`` with its key's edges, without bringing a key's rows to one task.

    The edges are stored and counted. Up to BROADCAST_KEYS keys they are broadcast; beyond that the rows are joined on
    the key and a salt drawn from the value, with the edges repeated for each salt.
    """
    edges = materialize(edges, "edges")
    if edges.count() <= BROADCAST_KEYS:
        return df.join(F.broadcast(edges), list(keys))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(value), F.lit(SALTS)).cast("int"))
    repeated = edges.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [*keys, "_salt"]).drop("_salt")


def _with_slice(df: DataFrame, keys: Sequence[str], value: Column, slices: int) -> DataFrame:
    """Add ``_slice``, the part of its key's value axis a row lies in, of about even numbers of rows.

    Without keys the edges are one array, read as a scalar subquery. With keys they are one array per key, put
    beside the rows by ``_beside``.
    """
    df = df.withColumn("_at", value)
    if not keys:
        sliced = df.withColumn("_edges", df.agg(_edges(F.col("_at"), slices)).scalar())
    else:
        sliced = _beside(df, df.groupBy(*keys).agg(_edges(F.col("_at"), slices).alias("_edges")), keys, F.col("_at"))
    return sliced.withColumn("_slice", slice_of(F.col("_edges"), F.col("_at"), slices)).drop("_edges")


def _with_brackets(df: DataFrame, keys: Sequence[str], probs: Sequence[float], accuracy: int) -> DataFrame:
    """Add ``_slice``: the part of the value axis between brackets of twice the sketch's error around the ranks.

    An edge is a slice of its own, so a value with very many rows shares its slice with no other value. The
    comparisons stay within generated code.
    """
    reach = 2 / accuracy
    grid = [min(1.0, max(0.0, p + d)) for p in probs for d in (-reach, reach)]
    cuts = F.array_sort(F.percentile_approx("_v", F.expr("array(" + ", ".join(f"{g}D" for g in grid) + ")"), accuracy))
    if not keys:
        sliced = df.withColumn("_edges", df.agg(cuts).scalar())
    else:
        sliced = _beside(df, df.groupBy(*keys).agg(cuts.alias("_edges")), keys, F.col("_v"))
    value = F.col("_v")
    if len(grid) <= 6:
        passed = []
        for i in range(len(grid)):
            edge = F.get("_edges", F.lit(i))
            passed += [(value >= edge).cast("int"), (value > edge).cast("int")]
        place = reduce(lambda a, b: a + b, passed)
    else:
        # many comparisons make a method too long to be compiled: bisect instead
        below = slice_of(F.col("_edges"), value, len(grid))
        on_edge = F.coalesce(F.try_element_at(F.col("_edges"), F.greatest(below, F.lit(1))) == value, F.lit(False))
        place = below * 2 - on_edge.cast("int")
    return sliced.withColumn("_slice", place).drop("_edges")


def running_total(
    df: DataFrame, keys: Sequence[str], order: str, totals: dict[str, str], following: str | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """Add inclusive running sums over ``order`` within ``keys``.

    ``totals`` maps a measure to the name of its running sum; ``following`` names a column for the next value
    of ``order``. ``df`` must hold one row per (keys, order) and a numeric, date or timestamp ``order``. Works
    without keys too.
    """
    kind = dict(df.dtypes)[order]
    value = F.unix_date(order) if kind == "date" else F.col(order).cast("double")
    sliced = _with_slice(df, keys, value, slices)
    per_slice = sliced.groupBy(*keys, "_slice").agg(
        F.min(order).alias("_first"), *[F.sum(m).alias(f"_sum_{m}") for m in totals]
    )
    ahead = F.lead("_first").over(Window.partitionBy(*keys).orderBy("_slice"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        *keys, "_slice", ahead.alias("_ahead"), *[F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_off_{m}") for m in totals]
    )
    sorted_slice = Window.partitionBy(*keys, "_slice").orderBy(order)
    within = sorted_slice.rowsBetween(Window.unboundedPreceding, 0)
    running = {name: F.col(f"_off_{m}") + F.sum(m).over(within) for m, name in totals.items()}
    if following:
        running[following] = F.coalesce(F.lead(order).over(sorted_slice), F.col("_ahead"))
    out = sliced.join(offsets, [*keys, "_slice"]).withColumns(running)
    return out.drop("_at", "_slice", "_ahead", *[f"_off_{m}" for m in totals])


def exact_quantiles(
    long: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per key with ``n`` and the array ``quantiles``.

    Pass one sketches the values, pass two counts rows per bracket, pass three keeps only the brackets that
    hold a wanted rank. Nothing but counts is shuffled in passes one and two, and pass three shuffles about
    ``4 / accuracy`` of the distinct values per wanted quantile.
    """
    keys = list(keys)
    base = long.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    sliced = _with_brackets(base, keys, probs, accuracy)
    per_slice = sliced.groupBy(*keys, "_slice").agg(F.count("_v").alias("_rows"))
    axis = Window.partitionBy(*keys)
    upto = axis.orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    at = F.array(*[F.lit(float(p)) * (F.col("n") - 1) for p in probs])
    ranks = F.array_distinct(F.concat(F.transform(at, lambda x: F.floor(x)), F.transform(at, lambda x: F.ceil(x))))
    # the slices that hold a wanted rank, with the ranks they hold
    wanted = (
        per_slice.withColumns({"n": F.sum("_rows").over(axis), "_end": F.sum("_rows").over(upto)})
        .withColumn("_start", F.col("_end") - F.col("_rows"))
        .withColumn("_ranks", F.filter(ranks, lambda r: (r >= F.col("_start")) & (r < F.col("_end"))))
        .where(F.size("_ranks") > 0)
        .select(*keys, "_slice", "_start", "_ranks", "n")
    )
    # at most two slices a rank; sizes that follow the keys only
    wanted = materialize(wanted, "wanted")
    if wanted.count() <= BROADCAST_KEYS * 4:
        wanted = F.broadcast(wanted)
    fine = (
        sliced.join(wanted, [*keys, "_slice"], "left_semi")
        .groupBy(*keys, "_slice", "_v")
        .agg(F.count("_v").alias("_c"))
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    hits = (
        fine.join(wanted, [*keys, "_slice"])
        .withColumn("_to", F.col("_start") + F.sum("_c").over(inside))
        .withColumn("_from", F.col("_to") - F.col("_c"))
        .withColumn("_r", F.explode(F.filter("_ranks", lambda r: (r >= F.col("_from")) & (r < F.col("_to")))))
    )
    # at most two ranks per wanted quantile
    found = hits.groupBy(*keys, "n").agg(F.map_from_entries(F.collect_list(F.struct("_r", "_v"))).alias("_at"))

    def interpolate(position: Column) -> Column:
        low = F.try_element_at("_at", F.floor(position))
        high = F.try_element_at("_at", F.ceil(position))
        return low + (high - low) * (position - F.floor(position))

    return found.select(*keys, "n", F.transform(at, interpolate).alias("quantiles"))


#: columns of one set of wide passes; their expressions stay small enough for compiled code
WIDE = 16


def wide_quantiles(df: DataFrame, values: dict[str, Column], probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """Exact quantiles of columns of the schema: one row per column with ``name``, ``n`` and the array ``quantiles``.

    The same three passes as ``exact_quantiles``, but the columns stay beside each other: the first two give a few numbers
    (columns x probabilities) that come to the driver, and nothing is stored. Rows become long in the third pass only, for
    values in the brackets that hold a wanted rank; where edges hold all, there is none.
    """
    names = list(values)
    parts = [
        _wide_quantiles(df, {n: values[n] for n in names[at:at + WIDE]}, probs, accuracy) for at in range(0, len(names), WIDE)
    ]
    return reduce(DataFrame.unionByName, parts)


def _wide_quantiles(df: DataFrame, values: dict[str, Column], probs: Sequence[float], accuracy: int) -> DataFrame:
    spark, names, reach = df.sparkSession, list(values), 2 / accuracy
    grid = [min(1.0, max(0.0, p + d)) for p in probs for d in (-reach, reach)]
    base = df.select(*[v.cast("double").alias(f"v{i}") for i, v in enumerate(values.values())])
    shares = F.expr("array(" + ", ".join(f"{g}D" for g in grid) + ")")
    cuts = base.agg(*[F.percentile_approx(f"v{i}", shares, accuracy).alias(f"v{i}") for i in range(len(names))]).first()
    edges = [sorted(set(cut or [])) for cut in cuts]
    counts = slot_counts(base, edges)
    # by column: rows, values known from edges by rank, and brackets (slot, rows before it, ranks) of the others
    rows, brackets = [], []
    for i, own in enumerate(edges):
        ends = list(accumulate(counts[i]))
        n, below, upto = ends[-1], ends[:-1:2], ends[1::2]
        ranks = sorted({r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}) if n else []
        known, open_ = {}, {}
        for r in ranks:
            place = bisect_right(upto, r)  # edges whose values all come before the rank
            if place < len(own) and below[place] <= r:
                known[r] = own[place]
            else:
                open_.setdefault(place, []).append(r)
        rows.append((i, n, known))
        brackets += [(i, 2 * k, upto[k - 1] if k else 0, r) for k, r in open_.items()]
    table = spark.createDataFrame(rows, "column int, n long, known map<long, double>").where("n > 0")
    if brackets:
        table = table.join(F.broadcast(_ranked_values(base, edges, brackets)), "column", "left").withColumn(
            "known", F.when(F.col("found").isNull(), F.col("known")).otherwise(F.map_concat("known", "found")))
    position = F.array(*[F.lit(float(p)) * (F.col("n") - 1) for p in probs])

    def interpolate(x: Column) -> Column:
        low, high = F.try_element_at("known", F.floor(x)), F.try_element_at("known", F.ceil(x))
        return low + (high - low) * (x - F.floor(x))

    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("column") + 1)
    return table.select(name.alias("name"), "n", F.transform(position, interpolate).alias("quantiles"))


def slot_counts(wide: DataFrame, edges: Sequence[Sequence[float]]) -> list[list[int]]:
    """For each double column of ``wide`` its numbers of values below its first edge, on it, between it and the next, and so on.

    ``edges`` has the sorted distinct edges of each column; NULL is in no slot. Tasks give one row per column and slot in use.
    The function of a task names nothing of this package, so that workers need not have it.
    """
    cuts = [np.array(own, np.float64) for own in edges]

    def run(batches):
        total = [np.zeros(2 * len(own) + 1, np.int64) for own in cuts]
        for batch in batches:
            for own, column, count in zip(cuts, batch.columns, total, strict=True):
                value = column.drop_null().to_numpy()
                slot = np.searchsorted(own, value) + np.searchsorted(own, value, "right")
                count += np.bincount(slot, minlength=len(count))
        for i, count in enumerate(total):
            slot = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(slot), i), pa.int32()), pa.array(slot, pa.int32()), pa.array(count[slot])], ["column", "slot", "n"])

    found = wide.mapInArrow(run, "column int, slot int, n long").groupBy("column", "slot").agg(F.sum("n").alias("n"))
    out = [[0] * (2 * len(own) + 1) for own in edges]
    for column, slot, n in found.collect():  # columns of the schema x edges
        out[column][slot] = n
    return out


def _ranked_values(base: DataFrame, edges: list[list[float]], brackets: list[tuple]) -> DataFrame:
    """column and a map from wanted ranks to values; brackets are (column, slot, rows before it, ranks)."""
    cuts = {i: np.array(edges[i], np.float64) for i, *_ in brackets}
    wanted_slots = {i: [slot for j, slot, *_ in brackets if j == i] for i in cuts}

    def run(batches):
        for batch in batches:
            for i, own in cuts.items():
                value = batch.column(i).drop_null().to_numpy()
                slot = np.searchsorted(own, value) + np.searchsorted(own, value, "right")
                inside = np.isin(slot, wanted_slots[i])
                slot, value = slot[inside], value[inside]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(slot), i), pa.int32()), pa.array(slot, pa.int32()), pa.array(value)], ["k", "slot", "v"])

    fine = base.mapInArrow(run, "k int, slot int, v double").groupBy("k", "slot", "v").agg(F.count(F.lit(1)).alias("_c"))
    # at most two a rank
    wanted = base.sparkSession.createDataFrame(brackets, "column int, _slot int, start long, ranks array<long>")
    upto = F.sum("_c").over(Window.partitionBy("k", "slot").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    hits = fine.withColumn("_upto", upto).join(F.broadcast(wanted), (F.col("k") == F.col("column")) & (F.col("slot") == F.col("_slot")))
    end = F.col("start") + F.col("_upto")
    hits = hits.withColumn("rank", F.explode(F.filter("ranks", lambda r: (r >= end - F.col("_c")) & (r < end))))
    return hits.groupBy("column").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("found"))


def quantile(df: DataFrame, col: str, prob: float) -> Column:
    """One exact quantile of a whole column as a scalar subquery."""
    return exact_quantiles(df, [], col, [prob]).select(F.element_at("quantiles", 1)).scalar()


def row_positions(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each key from 1 by (order, ties) without sorting a key in one task."""
    at_value = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("_rows"))
    starts = running_total(at_value, keys, order, {"_rows": "_upto"})
    starts = starts.select(*keys, order, (F.col("_upto") - F.col("_rows")).alias("_before"))
    same = Window.partitionBy(*keys, order).orderBy(*ties)
    return (
        df.join(starts, [*keys, order])
        .withColumn(name, F.col("_before") + F.row_number().over(same))
        .drop("_before")
    )
