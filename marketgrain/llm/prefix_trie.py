"""A trie of conversations: every distinct sequence of first turns is a node, with counts over its members and subtree.

Conversations are rows of turn ids (120 bits of a digest of role and text, as two numbers). They are sorted by range over
all tasks, so that the members of a node are neighbours, and cut into blocks of bounded size. A block is a padded matrix of
turn ids, sorted by ``numpy.lexsort``. Where a row's id differs from the row above in a column, or did in a column
before (an OR accumulated along the row), a node of that depth starts; one ``reduceat`` over the matrix by columns adds
up the nodes of all depths.

A node is complete unless it holds the first or last row of its block, whose neighbours are elsewhere. Complete nodes
are written. Of each block only the two outer rows go on, as paths with what was counted at each depth so far; they
are sorted and cut into blocks anew, in as many rounds as are needed for one last block. So a conversation that a third of
all rows repeat spreads over tasks like any other.

The ids of conversations that end at a node are one text of any length, which is hashed piece by piece: blocks join their ids,
and the pieces of a node are read in order.

Defined results: rows with a null conv_id belong to no conversation and are left out; turns go by number, null first, those
of one number by the digest of role and text; null role or text counts as empty; an empty table has no nodes; repeated
rows are turns of their own; other columns are ignored. A task holds a conversation's turn ids (28 bytes a turn) at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marketgrain.llm.scratch import scratch, stored
from marketgrain.llm.shipping import ship
from marketgrain.llm.texts import mix
from marketgrain.llm.workers import released
from marketgrain.session import materialize

#: rows x depth of a block, and the least rows of one, so that every round leaves fewer rows
CELLS, LEAST_ROWS, MOST_ROWS = 1 << 20, 16, 1 << 16
NOTHING = hashlib.sha256(b"").hexdigest()
WORDS = r"[^\x20\x09-\x0D]+"
#: of every this many conversations, the first may lend its first turns to the others
SHARED, LENT = 20, 4

_SUMS = ("counts", "kids", "leaves", "saved")
_PATH = "turns array<bigint>, words array<bigint>, firsts array<bigint>, " + ", ".join(f"{c} array<bigint>" for c in _SUMS)
_NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, parent_open boolean, key1 bigint, key2 bigint, parent1 bigint, "
    "parent2 bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
_OUT = f"kind int, {_NODE}, ids string, {_PATH}"
NODE, PIECE, PATH = 0, 1, 2


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, and a turn as struct: its place, its id as two numbers, and the words of its text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    number = [F.conv(F.substring(name, at, 15), 16, 10).cast("long") for at in (1, 16)]
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"), number[0].alias("a"),
            number[1].alias("b"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
        ).alias("turn"),
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (two numbers each) and words of every conversation, its first turns taken from another one."""
    whole = turn_rows(conversations).groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("own"))
    whole = stored(whole, "whole-conversations")
    lender = F.col("conv_id") - F.col("conv_id") % SHARED
    heads = whole.where(F.col("conv_id") % SHARED == 0).select(
        F.col("conv_id").alias("_lender"), F.slice("own", 1, LENT - 1).alias("_head"))
    lent = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENT).cast("int")
    head = F.coalesce("_head", F.slice("own", 1, 0))
    turns = F.concat(F.slice(head, F.lit(1), lent), F.slice("own", lent + 1, F.greatest(F.size("own"), F.lit(1))))
    joined = whole.join(heads, lender == F.col("_lender"), "left").select("conv_id", turns.alias("all"))
    return joined.select(
        "conv_id", F.flatten(F.transform("all", lambda t: F.array(t["a"], t["b"]))).alias("turns"),
        F.transform("all", lambda t: t["words"]).alias("words"),
    )


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _filled(values: np.ndarray, inside: np.ndarray) -> np.ndarray:
    out = np.zeros(inside.shape, np.int64)
    out[inside] = values
    return out


def _blocks(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.Table]:
    """Consecutive rows, as many as a padded matrix of CELLS holds; all rows if ``whole``."""
    held: pa.Table | None = None
    for batch in batches:
        held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held is not None else pa.Table.from_batches([batch])
        while not whole:
            depth = np.maximum.accumulate(_lists(held.column("turns"))[1] // 2 + 1)
            cells = depth * np.arange(1, len(depth) + 1)
            rows = min(max(int(np.searchsorted(cells, CELLS, "right")), LEAST_ROWS), MOST_ROWS)
            if rows >= held.num_rows:
                break
            yield held.slice(0, rows)
            held = held.slice(rows).combine_chunks()
    if held is not None and held.num_rows:
        yield held


class _Block:
    """The trie of a block's rows."""

    def __init__(self, table: pa.Table, first: bool, whole: bool):
        flat, size = _lists(table.column("turns"))
        length = size // 2
        deep = int(length.max())
        present = np.arange(deep + 1) <= length[:, None]
        a, b = (_filled(flat[k::2], present[:, 1:]) for k in (0, 1))
        words = np.zeros(present.shape, np.int64)
        if first:
            firsts = np.where(present, table.column("conv_id").to_numpy()[:, None], np.iinfo(np.int64).max)
            words[:, 1:] = _filled(_lists(table.column("words"))[0], present[:, 1:])
            sums = {c: np.zeros(present.shape, np.int64) for c in _SUMS} | {"counts": present.astype(np.int64)}
        else:
            words[present] = _lists(table.column("words"))[0]
            firsts = np.full(present.shape, np.iinfo(np.int64).max)
            firsts[present] = _lists(table.column("firsts"))[0]
            sums = {c: _filled(_lists(table.column(c))[0], present) for c in _SUMS}
        # shorter rows come before the rows that they begin
        order = np.lexsort([firsts[:, 0], *(
            key[:, j] for j in range(deep - 1, -1, -1) for key in (b, a, present[:, 1:]))])
        length, present, a, b, words, firsts = (x[order] for x in (length, present, a, b, words, firsts))
        sums = {c: x[order] for c, x in sums.items()}

        rows = len(length)
        starts = np.zeros(present.shape, bool)
        starts[1:, 1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (present[1:, 1:] != present[:-1, 1:])
        starts[0] = True
        np.logical_or.accumulate(starts, axis=1, out=starts)
        marks = starts.T.ravel()
        at = np.flatnonzero(marks)
        node = (np.cumsum(marks) - 1).reshape(deep + 1, rows)
        self.depth, self.row = at // rows, at % rows
        self.real = present.T.ravel()[at]
        self.first = np.minimum.reduceat(firsts.T.ravel(), at)
        self.sums = {c: np.add.reduceat(x.T.ravel(), at) for c, x in sums.items()}
        self.words = words.T.ravel()[at]
        self.parent = np.where(self.depth > 0, node[self.depth - 1, self.row], 0)
        self.open = np.zeros(len(at), bool)
        if not whole:
            for edge in (0, rows - 1):
                self.open[node[:length[edge] + 1, edge]] = True
        self.key = self._keys(a, b)[:, self.row, self.depth]
        self.ends = node[length, np.arange(rows)]
        self.length, self.node, self.a, self.b, self.conv = length, node, a, b, firsts[:, 0]
        self._close(deep)

    @staticmethod
    def _keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Two 64-bit names of each prefix of each row."""
        out = np.zeros((2, len(a), a.shape[1] + 1), np.uint64)
        with np.errstate(over="ignore"):
            out[0, :, 0], out[1, :, 0] = 1, 2
            for j in range(a.shape[1]):
                x, y = a[:, j].astype(np.uint64), b[:, j].astype(np.uint64)
                out[0, :, j + 1] = mix(out[0, :, j] * np.uint64(0x9E3779B97F4A7C15) + x)
                out[1, :, j + 1] = mix((out[1, :, j] ^ y) * np.uint64(0xC2B2AE3D27D4EB4F) + out[0, :, j + 1])
        return out.view(np.int64)

    def _close(self, deep: int) -> None:
        """From the deepest nodes up, add what is complete to the parents."""
        closed = np.flatnonzero(self.real & ~self.open)
        bounds = np.searchsorted(self.depth[closed], np.arange(deep + 2))
        counts, kids, leaves, saved = (self.sums[c] for c in _SUMS)
        for d in range(deep, -1, -1):
            own = closed[bounds[d]:bounds[d + 1]]
            leaves[own] += kids[own] == 0
            saved[own] += (counts[own] - 1) * self.words[own]
            if d:
                up = self.parent[own]
                np.add.at(kids, up, 1)
                np.add.at(leaves, up, leaves[own])
                np.add.at(saved, up, saved[own])
        self.closed = closed

    def end_lists(self) -> list[tuple[int, str]]:
        """Nodes at which conversations end, with their ids."""
        if not len(self.ends):
            return []
        cut = np.flatnonzero(np.diff(self.ends, prepend=-1))
        texts = self.conv.astype(str)
        return [(int(self.ends[s]), ",".join(texts[s:e])) for s, e in zip(cut, [*cut[1:], len(texts)])]

    def output(self, first: bool) -> Iterator[pa.RecordBatch]:
        yield _batch(self._nodes(first))
        if first and self.open.any():
            pieces = [(n, ids) for n, ids in self.end_lists() if self.open[n]]
            if pieces:
                at = np.array([n for n, _ in pieces])
                begin = [int(ids.split(",", 1)[0]) for _, ids in pieces]
                yield _batch({
                    "kind": np.full(len(at), PIECE, np.int32), "conv_id": begin, "depth": self.depth[at],
                    "key1": self.key[0][at], "key2": self.key[1][at], "ids": [ids for _, ids in pieces]})
        if self.open.any():
            yield _batch(self._paths())

    def _nodes(self, first: bool) -> dict:
        own, up = self.closed, self.parent[self.closed]
        out = {"kind": np.full(len(own), NODE, np.int32), "conv_id": self.first[own], "depth": self.depth[own]}
        top = self.depth[own] == 0
        out["parent_conv_id"] = pa.array(self.first[up], mask=top | self.open[up])
        out["parent_open"] = self.open[up] & ~top
        out |= {"key1": self.key[0][own], "key2": self.key[1][own], "parent1": self.key[0][up], "parent2": self.key[1][up]}
        counts, kids, leaves, saved = (self.sums[c][own] for c in _SUMS)
        out |= {"n_convs": counts, "n_children": kids, "n_leaves": leaves, "saved_tokens": saved}
        if first:
            names = {n: hashlib.sha256(ids.encode()).hexdigest() for n, ids in self.end_lists() if not self.open[n]}
            out["ends_sha256"] = [names.get(n, NOTHING) for n in own.tolist()]
        return out

    def _paths(self) -> dict:
        """The outer rows, with the sums of their nodes; what both hold is counted with the first."""
        edges = [0] if len(self.length) == 1 else [0, len(self.length) - 1]
        lists: dict[str, list] = {c: [] for c in ("turns", "words", "firsts", *_SUMS)}
        told: set[int] = set()
        for edge in edges:
            deep = self.length[edge]
            nodes = self.node[:deep + 1, edge]
            fresh = np.array([n not in told for n in nodes.tolist()])
            told.update(nodes.tolist())
            lists["turns"].append(np.stack([self.a[edge, :deep], self.b[edge, :deep]], axis=1).ravel())
            lists["words"].append(self.words[nodes])
            lists["firsts"].append(self.first[nodes])
            for c in _SUMS:
                lists[c].append(np.where(fresh, self.sums[c][nodes], 0))
        return {"kind": np.full(len(edges), PATH, np.int32)} | {
            c: pa.array(v, pa.list_(pa.int64())) for c, v in lists.items()}


def _arrow(kind: str) -> pa.DataType:
    return {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}.get(
        kind) or pa.list_(pa.int64())


_FIELDS = [(name, _arrow(kind)) for name, kind in (x.split(" ") for x in _OUT.split(", "))]


def _batch(columns: dict) -> pa.RecordBatch:
    rows = len(columns["kind"])
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[n], k) if n in columns else pa.nulls(rows, k) for n, k in _FIELDS], [n for n, _ in _FIELDS])


def _round(rows: DataFrame, first: bool, whole: bool) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches, whole):
            yield from _Block(table.combine_chunks(), first, whole).output(first)

    return stored(rows.mapInArrow(released(build), _OUT), "trie-round")


def _spelled(pieces: DataFrame) -> DataFrame:
    """Digest of the ids of each node whose ids are in several pieces, read in order; the text is never whole."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, text = None, None
        names = ["key1", "key2", "depth", "ends_sha256"]
        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in ("key1", "key2", "depth", "ids"))):
                if key == last:
                    text.update(b"," + ids.encode())
                else:
                    if last is not None:
                        done.append((*last, text.hexdigest()))
                    last, text = key, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names)
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*last, text.hexdigest())], names)

    keys = ["key1", "key2", "depth"]
    ordered = pieces.repartition(*keys).sortWithinPartitions(*keys, "conv_id").select(*keys, "ids")
    return ordered.mapInArrow(released(read), "key1 bigint, key2 bigint, depth bigint, ends_sha256 string")


def _named(rows: DataFrame, table: DataFrame, keys: list[Column], how: str) -> DataFrame:
    names = ["key1", "key2", "depth"]
    table = table.withColumnsRenamed({c: f"_of_{c}" for c in names})
    same = (keys[0] == F.col("_of_key1")) & (keys[1] == F.col("_of_key2")) & (keys[2] == F.col("_of_depth"))
    return rows.join(table, same, how).drop(*[f"_of_{c}" for c in names])


def _large(paths: DataFrame) -> int:
    """Cells of the matrix that would hold all paths."""
    rows, deep = paths.agg(F.count(F.lit(1)), F.max(F.size("words"))).first()
    return rows * (deep or 0)


def trie(rows: DataFrame, cells: int = CELLS) -> DataFrame:
    """All nodes over ``rows`` of conv_id (unique), turns (two numbers each) and words."""
    spark = rows.sparkSession
    ship(spark)
    with scratch(spark):
        rows = stored(rows, "trie-rows")
        ordered = rows.repartitionByRange("turns", "conv_id").sortWithinPartitions("turns", "conv_id")
        found = _round(ordered, True, False)
        names = [x.split(" ")[0] for x in _NODE.split(", ")]
        inner = found.where(F.col("kind") == NODE).select(*names)
        pieces, later = found.where(F.col("kind") == PIECE), []
        while True:
            paths = found.where(F.col("kind") == PATH).select(*[x.split(" ")[0] for x in _PATH.split(", ")])
            size = _large(paths)
            last = size <= cells
            shards = 1 if last else -(-size // cells)
            ordered = paths.repartition(1) if last else paths.repartitionByRange(shards, "turns").sortWithinPartitions("turns")
            found = _round(ordered, False, last)
            later.append(found.where(F.col("kind") == NODE).select(*names))
            if last:
                break
        outer = later[0]
        for more in later[1:]:
            outer = outer.union(more)
        outer = _named(outer.drop("ends_sha256"), _spelled(pieces), [F.col("key1"), F.col("key2"), F.col("depth")], "left")
        outer = stored(outer.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))).select(*names), "trie-outer")
        nodes = inner.union(outer)
        above = outer.select("key1", "key2", "depth", F.col("conv_id").alias("_above"))
        known = nodes.where("not parent_open").withColumn("_above", F.col("parent_conv_id"))
        asked = _named(nodes.where("parent_open"), above, [F.col("parent1"), F.col("parent2"), F.col("depth") - 1], "inner")
        return materialize(known.select(*names, "_above").union(asked.select(*names, "_above")).select(
            "conv_id", "depth", F.col("_above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
            "saved_tokens", "ends_sha256"), "trie")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """All nodes over the rebuilt conversations of a table of turns."""
    with scratch(conversations.sparkSession):
        return trie(stored(rebuilt(conversations), "rebuilt-conversations"))
