"""Alerts with a cooldown: of each key the first alert, then the first one at least a pause after the alert before.

The rule is sequential within a key, but the choice needs no walk over the key's rows. Time is cut into buckets as wide as
the pause, so a bucket has one emission at most. What happens in a bucket is a step function: from the moment the key is
ready again to the moment it is ready after the bucket. FAN neighbouring buckets compose to one such function; since a
key is ready less than a pause into a bucket, a composed function has the steps of its first bucket and one more.

So functions are composed in rounds up to one for each key, every round with a fraction of the steps before, and then the
ready moments are handed down again in as many rounds. A key with nearly all rows is spread over as many tasks as it has
groups of buckets; a task holds the distinct alert times of FAN buckets of one key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marketgrain.session import materialize

FAN = 32
#: ready from the beginning
ALWAYS = np.iinfo(np.int64).min

Step = tuple[np.ndarray, np.ndarray]
_STEPS = "k string, bucket long, at long, after long"


def _groups(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, int, list[np.ndarray]]]:
    """Key, group, and the buckets, moments and what follows them, of each group of sorted frames."""
    last, held = None, []

    def whole() -> tuple[str, int, list[np.ndarray]]:
        return *last, [np.concatenate(x) for x in zip(*held)]

    for frame in frames:
        key, above, *rest = (frame[n].to_numpy() for n in ("k", "above", "bucket", "at", "after"))
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (above[1:] != above[:-1])) + 1
        for start, stop in zip([0, *cuts], [*cuts, len(key)]):
            if start == stop:
                continue
            name = key[start], int(above[start])
            if name != last:
                if held:
                    yield whole()
                last, held = name, []
            held.append([x[start:stop] for x in rest])
    if held:
        yield whole()


def _children(bucket: np.ndarray, at: np.ndarray, after: np.ndarray) -> list[tuple[int, Step]]:
    """Each bucket with its function: sorted moments and what is ready after them."""
    cuts = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    return [(int(bucket[a]), (at[a:b], after[a:b])) for a, b in zip([0, *cuts], [*cuts, len(bucket)])]


def passed(ready: np.ndarray, step: Step) -> np.ndarray:
    """Ready moments after a bucket; later ones than its last alert stay."""
    at, after = step
    place = np.searchsorted(at, ready)
    return np.where(place < len(at), after[np.minimum(place, len(at) - 1)], ready)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    """Rows of a key and arrays of one length."""
    sizes = [len(r[1]) for r in rows]
    columns = [np.concatenate([r[i] for r in rows]) for i in range(1, len(names))]
    return pd.DataFrame(dict(zip(names, [np.repeat(np.array([r[0] for r in rows], object), sizes), *columns])))


def _written(rows: Iterator[tuple], names: list[str], limit: int = 2000) -> Iterator[pd.DataFrame]:
    """Frames of the rows of up to ``limit`` groups."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= limit:
            yield _frame(held, names)
            held = []
    if held:
        yield _frame(held, names)


def _compose(frames: Iterator[pd.DataFrame], fan: int) -> Iterator[pd.DataFrame]:
    """The function of each group of ``fan`` buckets."""
    def rows() -> Iterator[tuple]:
        for key, above, arrays in _groups(frames):
            steps = _children(*arrays)
            # only the group's very first bucket is entered in its midst
            own = steps[0][1][0] if steps[0][0] == above * fan else steps[0][1][0][:1]
            points = np.concatenate([own, steps[1][1][0][:1]]) if len(steps) > 1 else own
            ready = points
            for _, step in steps:
                ready = passed(ready, step)
            yield key, np.full(len(points), above), points, ready

    return _written(rows(), ["k", "bucket", "at", "after"])


def _hand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each bucket of each group, when its key is ready; groups begin with a row of bucket -1 that says it for them."""
    def rows() -> Iterator[tuple]:
        for key, _, (bucket, at, after) in _groups(frames):
            ready, buckets, moments = at[:1], [], []
            for child, step in _children(bucket[1:], at[1:], after[1:]):
                buckets.append(child)
                moments.append(ready[0])
                ready = passed(ready, step)
            yield key, np.array(buckets, np.int64), np.array(moments, np.int64)

    return _written(rows(), ["k", "bucket", "at"])


def _emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The emissions of each group of narrowest buckets."""
    def rows() -> Iterator[tuple]:
        for key, _, (bucket, at, after) in _groups(frames):
            ready, moments = at[0], []
            for _, (times, follows) in _children(bucket[1:], at[1:], after[1:]):
                place = np.searchsorted(times, ready)
                if place < len(times):
                    moments.append(times[place])
                    ready = follows[place]
            yield key, np.array(moments, np.int64)

    return _written(rows(), ["k", "t"])


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of one key and group together and in order."""
    return rows.repartition("k", "above").sortWithinPartitions("k", "above", "bucket", "at")


def emitted(alerts: DataFrame, pause: int, since: DataFrame | None = None) -> DataFrame:
    """k and t (microseconds) of the emitted alerts of ``alerts`` (k, t); k is a key as text, never null.

    ``since`` has the last emission (k, t) of keys from an earlier run.
    """
    ends = alerts.agg(F.min("t"), F.max("t")).first()
    first, span = (0, 0) if ends[0] is None else (ends[0] // pause, ends[1] // pause - ends[0] // pause)
    bucket = F.expr(f"(t - pmod(t, {pause})) div {pause}")
    steps = [alerts.select("k", (bucket - first).alias("bucket"), F.col("t").alias("at"), (F.col("t") + pause).alias("after"))]
    above, width = F.expr(f"bucket div {FAN}").alias("above"), FAN
    while span // width:
        steps.append(materialize(_dealt(steps[-1].select("*", above)).mapInPandas(partial(_compose, fan=FAN), _STEPS), "alert-steps"))
        width *= FAN
    entries = steps[-1].select("k").distinct()
    if since is None:
        entries = entries.select("k", F.lit(0).cast("long").alias("bucket"), F.lit(ALWAYS).alias("at"))
    else:
        known = since.select(F.col("k").alias("_k"), (F.col("t") + pause).alias("_ready"))
        entries = entries.join(known, F.col("k") == F.col("_k"), "left").select(
            "k", F.lit(0).cast("long").alias("bucket"), F.coalesce("_ready", F.lit(ALWAYS)).alias("at"))
    for level in range(len(steps) - 1, -1, -1):
        entered = entries.select("k", F.col("bucket").alias("above"), F.lit(-1).cast("long").alias("bucket"), "at", F.lit(0).cast("long").alias("after"))
        inside = _dealt(steps[level].select("k", above, "bucket", "at", "after").union(entered))
        entries = inside.mapInPandas(_hand, "k string, bucket long, at long") if level else inside.mapInPandas(_emit, "k string, t long")
    return entries


def cooled_down(alerts: DataFrame, keys: Sequence[str], minutes: int = 30, since: DataFrame | None = None) -> DataFrame:
    """keys and event_id of alerts (keys, ts, event_id) that keep the pause; the first event_id of those at one moment.

    ``since`` has the last emission (keys, t) of keys from an earlier run.
    """
    names = list(keys)
    # nulls are left out of the text, names are not
    key = F.to_json(F.struct(*names)).alias("k")
    slim = alerts.select(*names, F.unix_micros("ts").alias("t"), "event_id").where(F.col("t").isNotNull())
    slim = slim.groupBy(*names, "t").agg(F.min("event_id").alias("event_id")).select(*names, key, "t", "event_id")
    slim = materialize(slim, "alert-moments")
    kept = emitted(slim, minutes * 60 * 1_000_000, since.select(key, "t") if since is not None else None)
    return slim.join(kept.withColumnsRenamed({"k": "_k", "t": "_t"}), (F.col("k") == F.col("_k")) & (F.col("t") == F.col("_t")), "left_semi").select(
        *names, "event_id")
