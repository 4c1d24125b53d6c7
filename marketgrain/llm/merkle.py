"""A Merkle manifest of a table: a leaf for each row, a tree for each group, a root over the groups, proofs for all rows.

Leaves are ranked within their group (the rank's lower bits become digit columns, the rest names a block of bounded size).
Within a block the digits are grouped away one after the other: each step gathers the nodes that differ in that digit only
as nested structs under their parent's digest. All steps have the block in their keys, so they run on one exchange.
A final transform walks the nested structs down, notes the siblings on the way, and explodes into leaves with proofs,
without a join. Blocks of leaves are the leaves of the next tier of blocks; what stands above a block is added to it
by a join of one row for each block.

Ranks need no group in one task: rows are sorted by range over all tasks, numbered in their partition, and the counts
of rows by group and partition give the rest.

A digest is SHA-256 as lowercase hex over inputs one after the other, digests as hex text. Every two consecutive nodes
become one; a node left over becomes one alone. A lone leaf is the root of its group.

Defined results: null fields are marked in the leaf and differ from empty ones; rows without a group (null) are a group,
before the others; a null identifier comes first in its group, rows of one identifier are ordered by leaf; repeated rows
are leaves of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketgrain.llm.scratch import scratch, stored
from marketgrain.session import materialize

#: levels of a block: it holds 2 ** LEVELS leaves at most
LEVELS = 8
#: rows of counts, or of groups, that may be broadcast; more are joined by a shuffle
BROADCAST_ROWS = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_BITS = 33  # of the row number in a partition, in Spark's increasing ids


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(fields: list[Column]) -> Column:
    """Digest of fields, each as length and value, or a dash where null."""
    values = [f.cast("string") for f in fields]
    return digest(F.concat(*[
        F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in values
    ]))


def _same(left: list[str], right: list[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def _looked_up(rows: DataFrame, table: DataFrame, keys: list[str], count: int) -> DataFrame:
    """``rows`` with the other columns of a stored ``table`` of ``count`` rows, one for each key."""
    table = table.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    table = F.broadcast(table) if count <= BROADCAST_ROWS else table
    return rows.join(table, _same(keys, [f"_of_{k}" for k in keys])).drop(*[f"_of_{k}" for k in keys])


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` from 0 in their group by ``order``, nulls first, and ``total``, the group's rows."""
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    # rows alike in all keys are dealt out by their place, else they would share a partition
    rows = rows.withColumn("_place", F.monotonically_increasing_id())
    placed = rows.repartitionByRange(*keys, "_place").sortWithinPartitions(*keys, "_place").drop("_place")
    placed = stored(placed.withColumn("_at", F.monotonically_increasing_id()), "merkle-sorted")
    part, at = F.shiftright("_at", _BITS), F.col("_at").bitwiseAND((1 << _BITS) - 1)
    counts = placed.groupBy(group, part.alias("_part")).agg(F.min(at).alias("_first"), F.count(F.lit(1)).alias("_n"))
    # a row for each group and partition: the window of a group holds as many as it has partitions
    whole = Window.partitionBy(group)
    before = F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = stored(counts.select(
        group, "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("total"),
    ), "merkle-counts")
    out = _looked_up(placed.withColumn("_part", part), counts, [group, "_part"], counts.count())
    return out.withColumn("rank", at + F.col("_shift")).drop("_at", "_part", "_shift")


def height(total: Column) -> Column:
    """Levels above the leaves of a tree of so many."""
    return F.when(total <= 1, 0).otherwise(F.length(F.bin(total - 1)))


def _blocks(nodes: DataFrame, group: str, kept: list[str]) -> DataFrame:
    """group, block, height and the nested node of each block; ``nodes`` have rank, height, hash and the kept columns."""
    digits = [F.shiftright("rank", level).bitwiseAND(1).cast("int").alias(f"_d{level}") for level in range(LEVELS)]
    rows = nodes.select(
        group, F.shiftright("rank", LEVELS).alias("block"), "height", *digits, F.struct("hash", *kept).alias("node"),
    ).repartition(group, "block")
    for level in range(LEVELS):
        rest = [f"_d{k}" for k in range(level + 1, LEVELS)]
        rows = rows.groupBy(group, "block", "height", *rest).agg(
            F.array_sort(F.collect_list(F.struct(F.col(f"_d{level}").alias("digit"), "node"))).alias("below"))
        run = digest(F.array_join(F.transform("below", lambda x: x["node"]["hash"]), ""))
        passed = F.element_at("below", 1)["node"]["hash"]
        rows = rows.select(group, "block", "height", *rest, F.struct(
            F.when(F.col("height") > level, run).otherwise(passed).alias("hash"), "below").alias("node"))
    return rows


def _leaves(node: Column, tall: Column, level: int, kept: list[str]) -> Column:
    """The leaves below a nested node, with the steps from each up to the node.

    A step has the sibling's digest and side; a node that is alone has a step without a sibling. Levels above the
    group's height have no step.
    """
    if not level:
        return F.array(F.struct(
            node["hash"].alias("hash"), *[node[k].alias(k) for k in kept],
            F.array().cast("array<struct<left:boolean,hash:string>>").alias("steps")))

    def step(kid: Column) -> Column:
        others = F.filter(node["below"], lambda x: x["digit"] != kid["digit"])
        other = F.struct(
            (F.element_at(others, 1)["digit"] < kid["digit"]).alias("left"),
            F.element_at(others, 1)["node"]["hash"].alias("hash"))
        alone = F.struct(F.lit(None).cast("boolean").alias("left"), F.lit(None).cast("string").alias("hash"))
        return F.when(tall < level, F.array().cast("array<struct<left:boolean,hash:string>>")).otherwise(
            F.array(F.when(F.size(others) > 0, other).otherwise(alone)))

    return F.flatten(F.transform(node["below"], lambda kid: F.transform(
        _leaves(kid["node"], tall, level - 1, kept), lambda x: F.struct(
            x["hash"].alias("hash"), *[x[k].alias(k) for k in kept], F.concat(x["steps"], step(kid)).alias("steps")))))


def climb(nodes: DataFrame, group: str, kept: list[str]) -> DataFrame:
    """group, ``kept``, leaf, steps up to the group's top, and ``top``; ``nodes`` have rank, height and hash."""
    blocks = stored(_blocks(nodes, group, kept), "merkle-blocks")
    above = blocks.select(
        group, F.col("block").alias("rank"), F.greatest(F.col("height") - LEVELS, F.lit(0)).alias("height"),
        F.col("node.hash").alias("hash"))
    if (blocks.agg(F.max("height")).first()[0] or 0) > LEVELS:
        upper = stored(climb(above.withColumn("block", F.col("rank")), group, ["block"]), "merkle-above")
        upper = upper.select(group, "block", F.col("steps").alias("_steps"), "top")
        blocks = _looked_up(blocks, upper, [group, "block"], upper.count())
    else:
        blocks = blocks.select("*", F.array().cast("array<struct<left:boolean,hash:string>>").alias("_steps"),
                               F.col("node.hash").alias("top"))
    found = _leaves(F.col("node"), F.col("height"), LEVELS, kept)
    rows = blocks.select(group, "_steps", "top", F.explode(found).alias("x"))
    return rows.select(
        group, *[F.col(f"x.{k}").alias(k) for k in kept], F.col("x.hash").alias("leaf"),
        F.concat("x.steps", "_steps").alias("steps"), "top")


def fold(start: Column, steps: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(steps, start, lambda done, s: digest(
        F.when(s["left"], F.concat(s["hash"], done)).when(~s["left"], F.concat(done, s["hash"])).otherwise(done)))


def siblings_digest(steps: Column) -> Column:
    """Digest of the siblings of a proof."""
    return digest(F.array_join(F.transform(steps, lambda s: s["hash"]), ""))


def manifest(leaves: DataFrame, group: str, order: list[str], kept: list[str]) -> DataFrame:
    """group, ``kept``, leaf, steps up to the root, subroot and root of every row of ``leaves`` (with column hash)."""
    spark = leaves.sparkSession
    with scratch(spark):
        rows = stored(leaves.select(group, *dict.fromkeys([*order, *kept]), "hash"), "merkle-leaves")
        nodes = ranked(rows, group, [*order, "hash"]).withColumn("height", height(F.col("total")))
        below = stored(climb(nodes, group, kept).withColumnRenamed("top", "subroot"), "merkle-proofs")
        # equal in all rows of a group, and few beside the rows
        tops = below.groupBy(group).agg(F.first("subroot").alias("hash")).withColumn("_all", F.lit(0))
        tops = ranked(stored(tops, "merkle-tops"), "_all", [group]).withColumn("height", height(F.col("total")))
        tops = stored(climb(tops, "_all", [group]), "merkle-roots")
        tops = tops.select(group, F.col("steps").alias("_last"), F.col("top").alias("root"))
        rows = _looked_up(below, tops, [group], tops.count())
        return materialize(rows.withColumn("steps", F.concat("steps", "_last")).drop("_last"), "merkle-manifest")


def tampered(docs: DataFrame) -> DataFrame:
    """Leaves of documents: hash, and ``changed``, the leaf of a row whose n_chars was raised by one, null if it was not."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    fields = {c: F.col(c) for c in FIELDS}
    raised = fields | {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}
    return docs.select(
        "doc_id", F.col("lang").cast("string").alias("lang"), leaf(list(fields.values())).alias("hash"),
        F.when(number % 7 == 0, leaf(list(raised.values()))).alias("changed"))


def verify(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, the digest of the proof, the root that the possibly changed row folds to, and whether equal."""
    rows = manifest(tampered(docs), "lang", ["doc_id"], ["doc_id", "changed"])
    rows = rows.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("steps")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", siblings_digest(F.col("steps")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
