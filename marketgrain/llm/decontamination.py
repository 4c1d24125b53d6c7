"""Benchmark decontamination by a prefix-filtered join with exact verification.

Items and documents are sequences of words. A window is ``size`` consecutive words of an item, or the whole of a
shorter one. A document holds a window if its words occur in a row. Since all words of a window must occur, one of
them is a sufficient prefix in any order: the window's rarest word, by counts over all documents. Documents are
searched for these rare words only; a find at the place where the window would have to lie (positional bound), with
room for the whole window in the document (length bound), is compared word by word, first by hashes, then by bytes.

The items may be many: they are dealt into blocks of bounded size, and the documents pass through one search for each
block. A block's index goes to the executors as a broadcast, so its size is bounded by ``block_words``. Documents are
never shuffled; what a search finds in a document stays with its row.

Defined results: null texts have no words; an item without words is never found; items that share an id are one item;
a null item id is the id ``null``; repeated rows are judged one by one; without items nothing is contaminated; an
empty table gives no rows; other columns are ignored, or kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketgrain.llm.shipping import ship
from marketgrain.llm.texts import LETTER_WORDS, slices, utf8
from marketgrain.llm.workers import released

SIZE = 10
BLOCK_WORDS = 1_000_000


class Index:
    """Windows of a block of items, found by their rarest words."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        data, offsets = utf8(pa.array([text for _, text in items], pa.string()))
        start, end, first = LETTER_WORDS.find(data, offsets)
        words = LETTER_WORDS.hashes(data, start, end)
        lower = LETTER_WORDS.lower[data].tobytes()
        self.words = np.unique(words)
        windows: dict[bytes, set[str]] = {}
        rows: dict[bytes, np.ndarray] = {}
        for (name, _), a, b in zip(items, first[:-1], first[1:], strict=True):
            for at in range(a, max(b - size, a) + 1) if b > a else ():
                stop = min(at + size, b)
                text = b"\n".join([lower[start[k]:end[k]] for k in range(at, stop)])
                windows.setdefault(text, set()).add(name)
                rows.setdefault(text, words[at:stop])
        self.texts, self.items = list(windows), [sorted(names) for names in windows.values()]
        self.length = np.array([len(rows[text]) for text in self.texts], np.int64)
        self.hashes = np.zeros((len(self.texts), size), np.uint64)
        for row, text in zip(self.hashes, self.texts, strict=True):
            row[:len(rows[text])] = rows[text]

    def order(self, counts: dict[int, int]) -> Index:
        """Choose each window's rarest word; the leftmost of equals."""
        found = np.array([counts.get(int(w), 0) for w in self.words], np.int64)
        rarity = np.full(self.hashes.shape, np.iinfo(np.int64).max)
        inside = np.arange(self.hashes.shape[1]) < self.length[:, None]
        rarity[inside] = found[np.searchsorted(self.words, self.hashes[inside])]
        offset = rarity.argmin(axis=1) if len(rarity) else np.zeros(0, np.int64)
        word = self.hashes[np.arange(len(offset)), offset]
        by = np.argsort(word, kind="stable")
        self.window, self.offset = by, offset[by]
        self.prefix, self.begin = np.unique(word[by], return_index=True)
        self.count = np.diff(np.append(self.begin, len(by)))
        self.filter = np.zeros(1 << 16, bool)
        self.filter[self.prefix >> np.uint64(48)] = True
        return self

    def search(self, data, start, end, words, first) -> tuple[np.ndarray, np.ndarray]:
        """First words and windows of all occurrences in a slice of documents."""
        at = np.flatnonzero(self.filter[words >> np.uint64(48)])
        place = np.searchsorted(self.prefix, words[at])
        hit = place < len(self.prefix)
        hit[hit] = self.prefix[place[hit]] == words[at[hit]]
        at, place = at[hit], place[hit]
        count = self.count[place]
        which = np.repeat(self.begin[place] - np.cumsum(count) + count, count) + np.arange(count.sum())
        window, begin = self.window[which], np.repeat(at, count) - self.offset[which]
        document = np.searchsorted(first, np.repeat(at, count), "right") - 1
        fits = (begin >= first[document]) & (begin + self.length[window] <= first[document + 1])
        window, begin = window[fits], begin[fits]
        same = np.ones(len(window), bool)
        for k in range(self.hashes.shape[1]):
            inside = same & (k < self.length[window])
            same[inside] = words[begin[inside] + k] == self.hashes[window[inside], k]
        window, begin = window[same], begin[same]
        lower = LETTER_WORDS.lower
        exact = [
            self.texts[w] == b"\n".join([lower[data[start[k]:end[k]]].tobytes() for k in range(b, b + self.length[w])])
            for w, b in zip(window, begin, strict=True)
        ]
        exact = np.array(exact, bool)
        return begin[exact], window[exact]


def _sliced_words(part: pa.RecordBatch):
    data, offsets = utf8(part.column("text"))
    start, end, first = LETTER_WORDS.find(data, offsets)
    return data, start, end, first, LETTER_WORDS.hashes(data, start, end)


def word_counts(docs: DataFrame, vocabulary: np.ndarray) -> dict[int, int]:
    """Counts over all documents of the words whose hashes are given; the result is bounded by them."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        vocabulary = known.value
        near = np.zeros(1 << 16, bool)
        near[vocabulary >> np.uint64(48)] = True
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                words = _sliced_words(part)[-1]
                words = words[near[words >> np.uint64(48)]]
                place = np.searchsorted(vocabulary, words)
                inside = place < len(vocabulary)
                place, words = place[inside], words[inside]
                total += np.bincount(place[vocabulary[place] == words], minlength=len(vocabulary))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["word", "n"])

    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(released(run), "word long, n long")
    rows = counts.groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    return dict(zip(vocabulary[rows["word"]].tolist(), rows["n"].tolist(), strict=True))


def blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> list[DataFrame]:
    """Items dealt into as many parts as keep each within ``block_words``, going by the number of bytes."""
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text").where(
        F.col("text").isNotNull()
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // (4 * block_words)))
    return [items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == k) for k in range(parts)]


def find_hits(
    docs: DataFrame, items: DataFrame, size: int = SIZE, block_words: int = BLOCK_WORDS, keep: Sequence[str] = ()
) -> DataFrame:
    """Struct ``row`` of the columns to keep, text, n_words, n_hit, packed spans of hit words, and ids of items."""
    spark = docs.sparkSession
    ship(spark)
    found = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{n}`") for n in keep]).alias("row"),
        F.col("text").cast("string").alias("text"),
        F.expr("cast(0 as bigint)").alias("n_words"), F.expr("cast(0 as bigint)").alias("n_hit"),
        F.expr("cast('' as binary)").alias("spans"), F.expr("cast(array() as array<string>)").alias("items"),
    )
    for block in blocks(items, block_words):
        index = Index([tuple(r) for r in block.collect()], size)
        index.order(word_counts(docs, index.words))
        found = _search(found, spark.sparkContext.broadcast(index))
    return found


def _search(found: DataFrame, index) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                data, start, end, first, words = _sliced_words(part)
                begin, window = index.value.search(data, start, end, words, first)
                document = np.searchsorted(first, begin, "right") - 1
                spans, items = part.column("spans").to_pylist(), part.column("items").to_pylist()
                hit = part.column("n_hit").to_numpy().copy()
                order = np.argsort(document, kind="stable")
                edges = np.searchsorted(document[order], np.arange(part.num_rows + 1))
                for k in np.unique(document):
                    own = order[edges[k]:edges[k + 1]]
                    pairs = np.stack([begin[own] - first[k], begin[own] - first[k] + index.value.length[window[own]]], 1)
                    union = merged(np.concatenate([np.frombuffer(spans[k], np.int64).reshape(-1, 2), pairs]))
                    spans[k], hit[k] = union.tobytes(), (union[:, 1] - union[:, 0]).sum()
                    items[k] = sorted({*items[k], *(name for w in set(window[own]) for name in index.value.items[w])})
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("text"), pa.array(np.diff(first)), pa.array(hit),
                     pa.array(spans, pa.binary()), pa.array(items, pa.list_(pa.string()))],
                    ["row", "text", "n_words", "n_hit", "spans", "items"],
                )

    return found.mapInArrow(released(run), found.schema)


def merged(spans: np.ndarray) -> np.ndarray:
    """Union of half-open spans."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    top = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate(([True], spans[1:, 0] > top[:-1]))
    at = np.flatnonzero(new)
    return np.stack([spans[at, 0], top[np.append(at[1:] - 1, len(spans) - 1)]], 1)


def report(docs: DataFrame, items: DataFrame, size: int = SIZE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every document."""
    found = find_hits(docs, items, size, block_words, keep=["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, size: int = SIZE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that hold no window, with all their columns."""
    # the text goes along once
    rest = [n for n in docs.columns if n != "text" or docs.schema[n].dataType.simpleString() != "string"]
    found = find_hits(docs, items, size, block_words, rest)
    return found.where(F.col("n_hit") == 0).select(*[
        F.col(f"row.`{n}`").alias(n) if n in rest else F.col("text") for n in docs.columns])
