"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set is the distinct shingles of its words. Its sketch has ``BINS`` coordinates that are filled in rounds
(Dahlgaard, Knudsen and Thorup, 2017): in the first BINS rounds every shingle is hashed to a bin and a value, in the
next BINS rounds to the bin of the round; a coordinate keeps the least (round, value), and rounds end when no
coordinate is empty. So every coordinate is filled whatever the size of the set, two sketches agree in a coordinate
with probability equal to the Jaccard similarity, and the number of agreements is concentrated as for independent
ones. Bands of ROWS coordinates are the candidate keys: at similarity 0.85 a pair has no common band with
probability (1 - 0.85^4)^32 < 1e-10.

Documents with the same set are one class from here on. In rounds, a band's bucket names a hub, and every class that is
not yet connected with it is compared with it, on full sets of words; these links give components. A bucket is done
when what is left of it, without its hubs, is connected. Buckets that are still open after ROUNDS hubs, or after a round
whose hubs hardly linked with anything, are compared in blocks of bounded size: sketches are drawn once for each class,
a pair is compared in the first of its common buckets only, and only links that connect something new leave a block. So
no bucket is emitted as pairs, and no link between different texts that share a band is lost. There is no cap on a bucket.

Defined results: null or empty texts have the empty set and link with nothing; fewer words than a shingle make one;
rows with one doc_id are judged one by one, each by its own text; a null doc_id ranks last and its component is the
smallest id in it, or null; an empty table gives no rows; other columns are ignored, or kept by ``keep_one``, which
leaves exactly one row of each component and all rows without shingles, whatever their ids: the smallest doc_id, of
equal or null ids the smallest class, of one id and class one row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketgrain.llm.components import connected
from marketgrain.llm.scratch import scratch, stored
from marketgrain.llm.shipping import ship
from marketgrain.llm.textkeys import BROADCAST_KEYS, text_key, unused
from marketgrain.llm.texts import WHITESPACE_WORDS, mix, shingle_hashes, slices, utf8
from marketgrain.llm.workers import released
from marketgrain.session import materialize

BINS, ROWS = 128, 4
WIDTH, PERCENT = 3, 85
BLOCK = 256
#: candidate documents (two numbers each) up to which their ids are broadcast to find the texts; more are shuffled
BROADCAST_IDS = 2_000_000
#: star rounds before what is open is compared in blocks, and the share of links in a round's stars under which it is the last
ROUNDS, LEAST_LINKED = 4, 0.05
_SEEDS = mix(np.arange(1, 2 * BINS + 1, dtype=np.uint64))


def sketch(elements: np.ndarray) -> np.ndarray:
    """Coordinates of a set of 64-bit elements; the empty set has none."""
    coordinates = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    if not len(elements):
        return coordinates[:0]
    for turn, seed in enumerate(_SEEDS):
        drawn = mix(elements ^ seed)
        value = (drawn >> np.uint64(9)) | np.uint64(turn) << np.uint64(55)
        if turn < BINS:
            np.minimum.at(coordinates, (drawn & np.uint64(BINS - 1)).astype(np.int64), value)
        else:
            coordinates[turn - BINS] = min(coordinates[turn - BINS], value.min())
        if coordinates.max() < np.uint64(turn + 1) << np.uint64(55):
            break
    return coordinates


def least_agreement(percent: int) -> int:
    """Coordinates that a pair at this similarity agrees in, but for a probability below 1e-10 (6.5 deviations)."""
    p = percent / 100
    return int(BINS * p - 6.5 * (BINS * p * (1 - p)) ** 0.5)


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    """One key for each band; empty for the empty set."""
    bands = coordinates.reshape(-1, ROWS)
    key = np.arange(1, len(bands) + 1, dtype=np.uint64)
    for row in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, row])
    return key.view(np.int64)


def sets(column: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text."""
    data, offsets = utf8(column)
    start, end, first = WHITESPACE_WORDS.find(data, offsets)
    words = WHITESPACE_WORDS.hashes(data, start, end)
    return [shingle_hashes(words[a:b], width) for a, b in zip(first[:-1], first[1:], strict=True)]


def class_of(elements: np.ndarray) -> tuple[int, int]:
    """128-bit name of a set: the node number and the rest."""
    digest = hashlib.blake2b(elements.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, text_key, n_shingles, node, tail and band keys of every document."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = sets(part.column("text"), width)
                names = [class_of(s) for s in found]
                keys = [band_keys(sketch(s)) for s in found]
                ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array([len(s) for s in found], pa.int64()),
                     pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64()),
                     pa.ListArray.from_arrays(ends, np.concatenate(keys))],
                    ["doc_id", "text_key", "n_shingles", "node", "tail", "bands"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _plain(docs).mapInArrow(
        released(run), f"doc_id {kind}, text_key binary, n_shingles long, node long, tail long, bands array<long>")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), text_key(docs).alias("text_key")
    )


def shingle_set(text: str, width: int) -> frozenset:
    """The distinct shingles themselves."""
    # without an argument, bytes split at exactly [\x20\x09-\x0D]+
    words = text.encode("utf-8", "surrogatepass").translate(WHITESPACE_WORDS.lower.tobytes()).split()
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*[words[i:] for i in range(width)], strict=False))


def alike(a: frozenset, b: frozenset, percent: int) -> bool:
    shared = len(a & b)
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def near_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document."""
    ship(docs.sparkSession)
    with scratch(docs.sparkSession):
        return _labelled(_components(docs, width, percent))


def _components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, text_key and component (null without shingles) of every row, stored."""
    signed = stored(signatures(docs, width), "signatures")
    full = signed.where(F.col("n_shingles") > 0)
    classes = full.groupBy("node", "tail").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    members = stored(
        classes.select("node", "doc_id", F.explode("bands").alias("bucket")), "buckets"
    )
    size = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(members.join(size, "bucket"), "shared-buckets")
    # a class near the middle of a group meets most of it, and is the best hub
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"), F.min("doc_id").alias("doc_id"))
    weights = stored(weights, "weights")
    texts = stored(_texts(docs, weights.select("node", "doc_id"), width), "candidate-texts")

    rows = stored(
        members.select("bucket", "node", F.col("node").alias("component")).join(weights.drop("doc_id"), "node"), "rows-0"
    )
    tied = None
    for turn in range(1, ROUNDS + 1):
        hubs = rows.groupBy(F.col("bucket").alias("_bucket")).agg(F.max(F.struct("weight", "node", "component")).alias("hub"))
        beside = rows.join(hubs, F.col("bucket") == F.col("_bucket")).where(F.col("node") != F.col("hub.node"))
        stars = stored(beside.where(F.col("component") != F.col("hub.component")).select(
            F.least("node", "hub.node").alias("node"), F.greatest("node", "hub.node").alias("hub")
        ).distinct(), "stars")
        found = stored(_verified(stars, texts, width, percent), f"links-{turn}")
        linked = found.count()
        tied = _joined(tied, found) if linked or tied is None else tied
        rows = stored(_open(beside.select("bucket", "node", "weight"), tied), f"rows-{turn}")
        if rows.isEmpty():
            return _placed(signed, tied)
        if linked < LEAST_LINKED * stars.count():
            break
    tied = _joined(tied, _between(_once_each(rows), texts, width, percent))
    return _placed(signed, tied)


def _joined(tied: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components of what is ``tied`` already and of new ``links``."""
    if tied is None:
        return connected(links)
    return connected(links.union(tied.where(F.col("node") != F.col("component"))))


def _texts(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """One text for each wanted node."""
    few = wanted.count() <= BROADCAST_IDS
    wanted = wanted.select("node", F.col("doc_id").alias("_id"))
    if few:
        wanted = F.broadcast(wanted)
    found = _plain(docs).join(wanted, F.col("doc_id").eqNullSafe(F.col("_id"))).select("node", "text")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                names = [class_of(s)[0] for s in sets(part.column("text"), width)]
                yield part.filter(pa.array(part.column("node").to_numpy() == np.array(names, np.int64)))

    # rows that repeat an id may hold other texts, or the same again
    return found.mapInArrow(released(run), "node long, text string").dropDuplicates(["node"])


def _verified(stars: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those edges between a node and a hub whose full sets are alike, as (a, b)."""
    hubs = texts.select(F.col("node").alias("hub"), F.col("text").alias("hub_text"))
    pairs = stars.join(texts, "node").join(hubs, "hub")

    def run(batches):
        known, last = None, None
        for batch in batches:
            for part in slices(batch, "text"):
                keep = []
                for hub, hub_text, text in zip(part["hub"].to_pylist(), part["hub_text"], part["text"], strict=True):
                    if hub != last:
                        last, known = hub, shingle_set(hub_text.as_py(), width)
                    keep.append(alike(known, shingle_set(text.as_py(), width), percent))
                yield part.select(["node", "hub"]).filter(pa.array(keep, pa.bool_()))

    found = pairs.select("node", "hub", "text", "hub_text").mapInArrow(released(run), "node long, hub long")
    return found.select(F.col("node").alias("a"), F.col("hub").alias("b"))


def _open(rows: DataFrame, tied: DataFrame) -> DataFrame:
    """Rows of buckets whose classes are not all connected, with their components."""
    tied = tied.select(F.col("node").alias("_node"), F.col("component"))
    rows = stored(rows.join(tied, F.col("node") == F.col("_node"), "left").select(
        "bucket", "node", "weight", F.coalesce("component", "node").alias("component")
    ), "bucket-components")
    state = rows.groupBy(F.col("bucket").alias("_bucket")).agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low != high")
    return rows.join(state, F.col("bucket") == F.col("_bucket")).select("bucket", "node", "weight", "component")


def _once_each(rows: DataFrame) -> DataFrame:
    """Of buckets with the same classes only one."""
    state = rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("xor"),
    )
    chosen = state.groupBy("n", "sum", "xor").agg(F.min("bucket").alias("bucket"))
    return rows.join(chosen.select("bucket"), "bucket")


def _drawn(rows: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Texts of the classes in ``rows`` with their band keys and the last 16 bits of their coordinates.

    Cut coordinates agree where the whole ones do, and by chance now and then; so no pair is lost.
    """
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                drawn = [sketch(s) for s in sets(part.column("text"), width)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("text"), pa.array([band_keys(d).tobytes() for d in drawn], pa.binary()),
                     pa.array([d.astype(np.uint16).tobytes() for d in drawn], pa.binary())],
                    ["node", "text", "bands", "drawn"],
                )

    wanted = texts.join(rows.select("node").distinct(), "node")
    return wanted.mapInArrow(released(run), "node long, text string, bands binary, drawn binary")


def _between(rows: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between classes of a bucket that are not connected.

    A bucket's largest component is compared with the rest, and the rest with itself, both in pairs of blocks. So
    the rows of the largest component are repeated for each block of the rest only. Pairs with a smaller common bucket
    are left to that one; if it is not open any more, they are connected or have been compared.
    """
    rows = stored(rows, "open-rows")
    texts = stored(_drawn(rows, texts, width), "open-texts")
    parts = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy(F.col("bucket").alias("_bucket")).agg(
        F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("all")
    ).select(
        "_bucket", F.col("main.component").alias("_main"),
        F.expr(f"cast(ceil(main.n / {BLOCK}) as int)").alias("_mains"),
        F.expr(f"cast(ceil((all - main.n) / {BLOCK}) as int)").alias("_rests"),
    )
    rows = rows.join(main, F.col("bucket") == F.col("_bucket")).withColumn("rest", F.col("component") != F.col("_main"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("rest"), F.col("_rests")).otherwise(F.col("_mains"))).cast("int")
    upto = F.sequence(F.lit(0), F.when(F.col("rest"), F.col("_mains")).otherwise(F.col("_rests")) - 1)
    rows = rows.withColumn("_own", own)
    columns = ["bucket", "node", "component", "rest"]
    across = rows.select("*", F.explode(upto).alias("_other")).select(
        *columns, F.lit(True).alias("across"), F.when(F.col("rest"), F.col("_own")).otherwise(F.col("_other")).alias("i"),
        F.when(F.col("rest"), F.col("_other")).otherwise(F.col("_own")).alias("j"),
    )
    within = rows.where("rest").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("_rests") - 1)).alias("_other")
    ).select(
        *columns, F.lit(False).alias("across"), F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"),
    )
    rows = across.union(within).join(texts, "node")
    least = least_agreement(percent)

    def compare(table: pa.Table) -> pa.Table:
        nodes, parent = table["node"].to_pylist(), {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        component = table["component"].to_pylist()
        rest, across = np.array(table["rest"].to_pylist()), table["across"][0].as_py()
        texts = table["text"]
        drawn = np.frombuffer(b"".join(table["drawn"].to_pylist()), np.uint16).reshape(len(nodes), -1)
        bands = np.frombuffer(b"".join(table["bands"].to_pylist()), np.int64).reshape(len(nodes), -1)
        earlier = bands < table["bucket"][0].as_py()
        known, found = {}, []
        others = np.flatnonzero(~rest) if across else np.arange(len(nodes))
        for x in np.flatnonzero(rest):
            against = others if across else others[:x]
            before = np.flatnonzero(earlier[x])
            against = against[(bands[against][:, before] != bands[x, before]).all(axis=1)]
            for y in against[(drawn[against] == drawn[x]).sum(axis=1) >= least]:
                if root(component[x]) == root(component[y]):
                    continue
                for k in (x, y):
                    if k not in known:
                        known[k] = shingle_set(texts[k].as_py(), width)
                if alike(known[x], known[y], percent):
                    found.append((nodes[x], nodes[y]))
                    parent[root(component[x])] = root(component[y])
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return rows.groupBy("bucket", "across", "i", "j").applyInArrow(compare, "a long, b long")


def _placed(signed: DataFrame, tied: DataFrame) -> DataFrame:
    tied = tied.select(F.col("node").alias("_node"), F.col("component"))
    rows = signed.drop("bands").join(tied, F.col("node") == F.col("_node"), "left").select(
        "doc_id", "n_shingles", "text_key",
        # the empty set links with nothing
        F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")).alias("component"),
    )
    return materialize(rows, "document-components")


def _labelled(rows: DataFrame) -> DataFrame:
    """Each document with the smallest id of its component."""
    least = rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("_least"))
    joined = rows.join(least.withColumnRenamed("component", "_c"), F.col("component") == F.col("_c"), "left")
    label = F.coalesce(F.col("_least"), F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", label.alias("component_id"), F.col("doc_id").eqNullSafe(label).alias("kept"))


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows that stay, one of each component, with all their columns."""
    ship(docs.sparkSession)
    with scratch(docs.sparkSession):
        rows = _components(docs, width, percent)
    rows = rows.where("component is not null")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    least = rows.groupBy("component").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    least = least.select(F.col("component").alias("_component"), "_first")
    # rows by id and text: all of them go, or one of several stays
    keys = rows.groupBy("component", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("_rows"))
    judged = keys.join(least, F.col("component") == F.col("_component")).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "_rows",
        (order == F.col("_first")).alias("_stays"),
    )
    state = materialize(judged.where("not _stays or _rows > 1"), "near-copies")
    if state.isEmpty():
        return docs
    same = docs["doc_id"].eqNullSafe(state["_id"]) & (text_key(docs) == state["_key"])
    if state.count() <= BROADCAST_KEYS:
        state = F.broadcast(state)
    left = docs.join(state, same, "left_anti")
    if state.where("_stays").isEmpty():
        return left
    name = unused(docs, "_text_key")
    several = docs.join(state.where(state["_stays"]), same, "left_semi").withColumn(name, text_key(docs))
    return left.union(several.dropDuplicates(["doc_id", name]).drop(name))
