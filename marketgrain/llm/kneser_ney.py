"""Interpolated modified Kneser-Ney models over the bytes of texts.

An n-gram is up to ORDER bytes, packed in a number; each text begins behind ORDER - 1 start bytes. Counts come from all
given texts: tasks count their own n-grams and the sums are dealt by n-gram. Lower orders count the distinct bytes to the
left (continuation counts), contexts the counts that start with them. Probabilities of one order join those of the order
below by the n-gram without its first byte, and their contexts by the n-gram without its last; all tables are dealt by
hash, none is brought to one task. One set of texts or several (classes) can be modelled side by side; classes share
the lowest order, pooled over all classes, to which rare expressions back off.

For scoring, all probabilities and context weights go to the executors; nothing is left out. What orders from 3 on need
at a byte depends on the two bytes before it, so the tables are dealt by a hash of these two into shards of about
SHARD_ENTRIES entries, and each byte is scored by one shard. The driver collects one shard at a time, and each is a
broadcast of its own. A task looks up the distinct n-grams of a slice of text, in sorted tables and by their full bytes,
shard after shard; it keeps shards of KEPT_BYTES in memory and reads the others again for every slice. So the number of
shards grows with the model, memory does not: a shard is bounded by SHARD_ENTRIES or by the entries of one pair of bytes.
Every executor holds all shards on its disk. Order 2 has 65,536 n-grams at most and is part of the model itself.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from marketgrain.llm.scratch import scratch, stored
from marketgrain.llm.shipping import ship
from marketgrain.llm.texts import mix, slices, utf8
from marketgrain.llm.workers import released

ORDER = 5
START = 2
#: entries (n-grams and contexts of all orders from 3 on) that a shard should have
SHARD_ENTRIES = 1 << 21
#: bytes of shards that a Python worker keeps
KEPT_BYTES = 128 << 20
#: bytes of text whose n-grams a task counts at once; it needs some 30 times as much memory
COUNT_SLICE = 2 << 20
#: a part of a text that is scored at once
SLICE = 1 << 20


def padded(column: pa.Array, translate: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, each behind start bytes, and offsets of the texts with their start bytes."""
    data, offsets = utf8(column)
    if translate is not None:
        data = translate[data]
    pad = ORDER - 1
    out = np.full(len(data) + pad * len(column), START, np.uint8)
    if len(data):
        out[np.arange(len(data)) + np.repeat(np.arange(1, len(column) + 1) * pad, np.diff(offsets))] = data
    return out, offsets + np.arange(len(offsets)) * pad


def packed(data: np.ndarray, order: int) -> np.ndarray:
    """The n-gram that ends at each byte."""
    gram = np.zeros(len(data), np.uint64)
    wide = data.astype(np.uint64)
    for back in range(order):
        gram[back:] |= wide[:len(data) - back] << np.uint64(8 * back)
    return gram


def _inner(offsets: np.ndarray, size: int) -> np.ndarray:
    """Where bytes of texts, not start bytes, stand."""
    inside = np.zeros(size + 1, np.int32)
    np.add.at(inside, offsets[:-1] + ORDER - 1, 1)
    np.add.at(inside, offsets[1:], -1)
    return np.cumsum(inside[:-1]) > 0


def counts(texts: DataFrame, classes: int, translate: np.ndarray | None) -> DataFrame:
    """gram and one count per class of all n-grams of the highest order. ``texts``: text, label in 0..classes-1."""
    names = [f"c{k}" for k in range(classes)]

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", COUNT_SLICE):
                data, offsets = padded(part.column("text"), translate)
                grams = packed(data, ORDER)
                label = np.repeat(part.column("label").to_numpy(), np.diff(offsets))
                inner = _inner(offsets, len(data))
                for k in range(classes):
                    own = grams[inner & (label == k)] if classes > 1 else grams[inner]
                    own.sort()
                    at = np.flatnonzero(np.diff(own, prepend=~own[:1]))
                    found, n = own[at], np.diff(at, append=len(own))
                    columns = [pa.array(n if j == k else np.zeros(len(n), np.int64)) for j in range(classes)]
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), *columns], ["gram", *names])

    found = texts.select("text", F.col("label").cast("int").alias("label")).mapInArrow(
        released(run), ", ".join(["gram long", *[f"{n} long" for n in names]])
    )
    return found.groupBy("gram").agg(*[F.sum(n).alias(n) for n in names])


#: per order: sorted n-grams, their log probabilities by class, sorted contexts, their log weights by class
Tables = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def shard_of(context: np.ndarray, shards: int) -> np.ndarray:
    """The shard of contexts, by their last two bytes."""
    return (mix((context & np.uint64(0xFFFF)) + np.uint64(1)) % np.uint64(shards)).astype(np.int64)


def _find(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted ``known``, and whether the wanted number stands there."""
    if not len(known):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


@dataclass
class Model:
    """Log probabilities and log weights of contexts: order 2 and below here, higher orders by shard."""

    classes: int
    base: np.ndarray
    pairs: Tables
    shards: list[Broadcast]
    kept: dict[int, Tables] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"kept": {}}

    def shard(self, k: int) -> Tables:
        """The tables of a shard, from memory or from the file of its broadcast."""
        if k in self.kept:
            return self.kept[k]
        found = self.shards[k].value
        # a broadcast object keeps what it has read once
        if hasattr(self.shards[k], "_value") and getattr(self.shards[k], "_path", None):
            del self.shards[k]._value
        size = sum(a.nbytes for t in [found, *self.kept.values()] for parts in t.values() for a in parts)
        if size <= KEPT_BYTES:
            self.kept[k] = found
        return found

    def score(self, data: np.ndarray) -> np.ndarray:
        """Natural log probability of each byte given those before it, one column per class."""
        grams, inverse = np.unique(packed(data, ORDER), return_inverse=True)
        total = np.zeros((len(grams), self.classes), np.float32)
        shard = shard_of(grams >> np.uint64(8), len(self.shards)) if self.shards else np.zeros(len(grams), np.int64)
        for k in range(max(len(self.shards), 1)):
            left = np.flatnonzero(shard == k)
            if not len(left):
                continue
            tables = self.pairs | (self.shard(k) if self.shards else {})
            for order in sorted(tables, reverse=True):
                known, value, contexts, weight = tables[order]
                gram = grams[left] & np.uint64((1 << 8 * order) - 1)
                at, hit = _find(known, gram)
                total[left[hit]] += value[at[hit]]
                left = left[~hit]
                at, hit = _find(contexts, gram[~hit] >> np.uint64(8))
                total[left[hit]] += weight[at[hit]]
            total[left] += self.base[(grams[left] & np.uint64(0xFF)).astype(np.int64)]
        return total[inverse]


def fit(texts: DataFrame, classes: int = 1, translate: np.ndarray | None = None) -> Model:
    """Model of ``texts`` (text, label)."""
    with scratch(texts.sparkSession):
        return _fit(texts, classes, translate)


def _fit(texts: DataFrame, classes: int, translate: np.ndarray | None) -> Model:
    ship(texts.sparkSession)
    names = [f"c{k}" for k in range(classes)]
    table = {ORDER: stored(counts(texts, classes, translate), "ngrams")}
    for order in range(ORDER - 1, 0, -1):
        lower = F.col("gram").bitwiseAND(F.lit((1 << 8 * order) - 1))
        seen = table[order + 1].groupBy(lower.alias("gram")).agg(*[F.sum((F.col(n) > 0).cast("long")).alias(n) for n in names])
        table[order] = stored(seen, f"ngrams-{order}") if order > 1 else seen
    # the lowest order is shared by the classes and never zero
    one = np.zeros(256)
    for row in table[1].collect():  # at most 256 rows
        one[row["gram"]] = sum(row[n] for n in names)
    base = (one + 0.5) / (one.sum() + 128)
    spark = texts.sparkSession
    below = spark.createDataFrame(
        [(g, *[float(p)] * classes) for g, p in enumerate(base)], ", ".join(["gram long", *[f"p{k} double" for k in range(classes)]])
    )
    base = np.log(np.repeat(base[:, None], classes, 1)).astype(np.float32)
    pairs, entries = {}, None
    for order in range(2, ORDER + 1):
        probabilities, contexts = _interpolated(table[order], below, order, classes)
        below = stored(probabilities, f"probabilities-{order}")
        contexts = stored(contexts, f"contexts-{order}")
        found = below.select("gram", F.lit(2 * order).alias("part"), *[F.log(f"p{k}").cast("float").alias(f"v{k}") for k in range(classes)]).union(
            contexts.select("gram", F.lit(2 * order + 1), *[F.col(f"w{k}").cast("float") for k in range(classes)])
        )
        if order == 2:
            pairs = _tables(found, classes)  # at most 65,536 + 256 rows
        else:
            entries = found if entries is None else entries.union(found)
    return Model(classes, base, pairs, _shards(entries, classes))


def _shards(entries: DataFrame, classes: int) -> list[Broadcast]:
    """Broadcasts of the tables of orders from 3 on; one shard at a time is on the driver."""
    spark = entries.sparkSession

    def dealt(shards):
        def run(batches):
            for batch in batches:
                gram = batch.column("gram").to_numpy().view(np.uint64)
                plain = batch.column("part").to_numpy() % 2 == 0
                own = shard_of(np.where(plain, gram >> np.uint64(8), gram), shards)
                yield pa.RecordBatch.from_arrays([pa.array(own), *batch.columns], ["shard", *batch.schema.names])

        return run

    count = entries.count()
    if not count:
        return []
    shards = -(-count // SHARD_ENTRIES)
    kinds = ", ".join(["shard long, gram long, part int", *[f"v{k} float" for k in range(classes)]])
    rows = stored(entries.mapInArrow(released(dealt(shards)), kinds), "shards")
    return [spark.sparkContext.broadcast(_tables(rows.where(F.col("shard") == k), classes)) for k in range(shards)]


def _tables(rows: DataFrame, classes: int) -> Tables:
    found = rows.toArrow()
    gram, part = found["gram"].to_numpy().view(np.uint64), found["part"].to_numpy()
    values = np.stack([found[f"v{k}"].to_numpy() for k in range(classes)], axis=1)
    out: Tables = {}
    for order in sorted({p // 2 for p in part.tolist()}, reverse=True):
        out[order] = ()
        for own in (2 * order, 2 * order + 1):
            at = np.flatnonzero(part == own)
            at = at[np.argsort(gram[at])]
            out[order] += (gram[at], values[at])
    return out


def _interpolated(table: DataFrame, below: DataFrame, order: int, classes: int) -> tuple[DataFrame, DataFrame]:
    """Probabilities of seen n-grams and backoff weights of seen contexts, per class."""
    each = range(classes)
    # discounts of the order, from the numbers of n-grams counted once to four times
    found = table.agg(*[
        F.sum((F.col(f"c{k}") == n).cast("long")).alias(f"n{n}_{k}") for k in each for n in (1, 2, 3, 4)
    ]).first()
    discounts = [_discounts(*[found[f"n{n}_{k}"] or 0 for n in (1, 2, 3, 4)]) for k in each]

    def cut(k):
        c, d = F.col(f"c{k}"), discounts[k]
        return F.when(c == 0, 0.0).when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])

    context = F.shiftrightunsigned("gram", 8)
    contexts = table.groupBy(context.alias("context")).agg(
        *[F.sum(f"c{k}").alias(f"t{k}") for k in each], *[F.sum(cut(k)).alias(f"d{k}") for k in each]
    )
    weights = contexts.select(F.col("context").alias("gram"), *[
        F.log(F.when(F.col(f"t{k}") > 0, F.col(f"d{k}") / F.col(f"t{k}")).otherwise(1.0)).alias(f"w{k}") for k in each
    ])
    lower = below.select(F.col("gram").alias("_lower"), *[F.col(f"p{k}").alias(f"q{k}") for k in each])
    joined = table.join(contexts, context == F.col("context")).join(
        lower, F.col("gram").bitwiseAND(F.lit((1 << 8 * (order - 1)) - 1)) == F.col("_lower")
    )
    probabilities = joined.select("gram", *[
        F.when(F.col(f"t{k}") > 0, (F.col(f"c{k}") - cut(k) + F.col(f"d{k}") * F.col(f"q{k}")) / F.col(f"t{k}"))
        .otherwise(F.col(f"q{k}")).alias(f"p{k}")
        for k in each
    ])
    return probabilities, weights


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Chen and Goodman's discounts; the counts of tiny tables may not give them."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(d, 0.1), top) for d, top in zip(raw, (0.95, 1.9, 2.8), strict=True))
