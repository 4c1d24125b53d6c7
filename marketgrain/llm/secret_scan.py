"""Secret scans over an incremental ledger of blobs.

Texts are content-addressed: a blob is the SHA-256 of a text, however many paths and versions hold it. The ledger is
a Parquet folder with a row for each blob and scan: which rules, at which version, have been run over it, and what they
found. A scan works out the blobs and rule versions that the ledger lacks, reads one text for each such blob, runs only
the missing rules and appends to the ledger. Findings are then joined back to every path.

A second run over the same texts scans nothing; a rule whose version was raised is run over all blobs, the other rules
are not. The texts to read are found by an equality join on blob and identifier: Spark broadcasts the blobs where few are
new, and else splits partitions that one blob fills.

Positions come from the engine's own expressions: the pieces between the matches and the matches give the lengths that
add up to each start. They are summed in runs of ``RUN`` matches, so the work grows with the matches, not their square.

Defined results: null counts as empty; an empty text is a blob without findings; repeated rows each get the findings of
their blob; a null doc_id is a path like any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketgrain.llm.scratch import discard, scratch, stored
from marketgrain.session import checkpoint_root, materialize

RUN = 256
SPANS = "array<struct<kind:string,rank:int,start:int,stop:int>>"
LEDGER = f"blob binary, rules array<string>, findings {SPANS}"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping; those whose ``group`` is under ``least`` characters drop."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 0
    base: bool = True

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.version}"


# fixed values: patterns of the base kinds, whose lengths are tested after the match
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
    r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])" r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# a run of these classes ends where the class ends, so a shorter run has no longer one inside: the length may be in the pattern
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
RULES = (
    Rule("assign", ASSIGN, group=2, least=12),
    Rule("access", ACCESS),
    Rule("hex", HEX),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("forge", r"gh[opsru]_[A-Za-z0-9]{36,}", base=False),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", base=False),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """kind, rank, start and stop (code points, stop exclusive) of the matches of a rule in a text."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    pieces = F.zip_with(
        F.split(text, rule.pattern, -1), F.arrays_zip(whole.alias("whole"), part.alias("part")),
        lambda gap, match: F.struct(
            F.length(gap).alias("gap"), F.coalesce(F.length(match["whole"]), F.lit(0)).alias("size"),
            F.coalesce(F.length(match["part"]), F.lit(-1)).alias("tested"),
        ),
    )

    def placed(run: Column, before: Column) -> Column:
        start = F.struct(before.alias("at"), F.array().cast(SPANS).alias("out"))
        return F.aggregate(run, start, lambda done, x: F.struct(
            (done["at"] + x["gap"] + x["size"]).alias("at"),
            F.when(x["tested"] >= max(rule.least, 1), F.concat(done["out"], F.array(F.struct(
                F.lit(rule.kind).alias("kind"), F.lit(rank).alias("rank"), (done["at"] + x["gap"]).alias("start"),
                (done["at"] + x["gap"] + x["size"]).alias("stop"),
            )))).otherwise(done["out"]).alias("out"),
        ), lambda done: done["out"])

    def in_runs(rows: Column) -> Column:
        many = F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / RUN).cast("int"))
        return _let(F.transform(many, lambda k: F.slice(rows, k * RUN + 1, F.lit(RUN))), summed)

    def summed(runs: Column) -> Column:
        sizes = F.transform(runs, lambda run: F.aggregate(run, F.lit(0), lambda n, x: n + x["gap"] + x["size"]))
        before = F.aggregate(sizes, F.array(F.lit(0)), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)))
        return F.flatten(F.zip_with(runs, _let(before, lambda b: F.slice(b, F.lit(1), F.size(runs))), placed))

    return F.when(text.rlike(rule.pattern), _let(pieces, in_runs)).otherwise(F.array().cast(SPANS))


def blob(text: Column) -> Column:
    """The address of a text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All scans so far; none where the folder is not there yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def unseen(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, one doc_id that holds it, and the rules whose present version was not run over it."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"))
    blobs = versions.groupBy("blob").agg(F.min(order)["doc_id"].alias("holder"))
    seen = ledger.groupBy(F.col("blob").alias("_seen")).agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("_ran"))
    wanted = F.array(*[F.lit(r.name) for r in rules])
    missing = F.array_except(wanted, F.coalesce("_ran", F.array().cast("array<string>")))
    todo = blobs.join(seen, F.col("blob") == F.col("_seen"), "left").select("blob", "holder", missing.alias("rules"))
    return todo.where(F.size("rules") > 0)


def update(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, versions: DataFrame | None = None) -> DataFrame:
    """Scan what the ledger at ``path`` lacks for the texts of ``docs``; the ledger with it."""
    spark = docs.sparkSession
    versions = docs.select("doc_id", blob(F.col("text")).alias("blob")) if versions is None else versions
    todo = stored(unseen(versions, read_ledger(spark, path), rules), "unseen-blobs").withColumnRenamed("blob", "_blob")
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    held = texts.join(todo, (blob(F.col("text")) == F.col("_blob")) & F.col("doc_id").eqNullSafe(F.col("holder")))
    found = [
        F.when(F.array_contains("rules", rule.name), spans(F.col("text"), rule, rank)).otherwise(F.array().cast(SPANS))
        for rank, rule in enumerate(rules)
    ]
    scanned = held.select(F.col("_blob").alias("blob"), "rules", F.concat(*found).alias("findings"))
    scanned.write.mode("append").parquet(path)
    return read_ledger(spark, path)


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob and its spans by the present rules, by start and then by rule; blobs without any are left out."""
    marks = F.create_map(*[x for rank, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(r.name))])
    now = F.filter("findings", lambda x: F.array_contains("rules", marks[x["kind"]]))
    own = ledger.where(F.size("findings") > 0).select("blob", now.alias("findings"))
    ranks = F.create_map(*[x for rank, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(rank))])
    # rows that share an identifier and a text are scanned together, and rules of several scans add up
    gathered = own.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("findings"))).alias("findings"))
    ordered = F.array_sort(F.transform("findings", lambda x: F.struct(
        x["start"].alias("start"), ranks[x["kind"]].alias("rank"), x["stop"].alias("stop"), x["kind"].alias("kind"))))
    return gathered.where(F.size("findings") > 0).select("blob", ordered.alias("findings"))


def on_paths(versions: DataFrame, found: DataFrame) -> DataFrame:
    """Every version with the spans of its blob, null where there are none."""
    found = found.withColumnRenamed("blob", "_found")
    return versions.join(found, F.col("blob") == F.col("_found"), "left").drop("_found")


def joined(found: Column) -> Column:
    """kind:start:stop of spans, by comma."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def scan(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, blob and findings of every row. Without a ``ledger`` the run starts with an empty one of its own."""
    spark = docs.sparkSession
    with scratch(spark):
        versions = stored(docs.select("doc_id", blob(F.col("text")).alias("blob")), "blob-versions")
        path = ledger or discard(f"{checkpoint_root(spark)}/blob-ledger-{uuid.uuid4().hex}")
        # stored apart, so that a blob of very many paths is split in the join
        found = stored(findings(update(docs, path, rules, versions), rules), "blob-findings")
        empty = F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string>>")
        return materialize(on_paths(versions, found).withColumn("findings", F.coalesce("findings", empty)), "secrets")


def report(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """doc_id, the number of spans of each base kind, the digest of the base spans, and all spans."""
    rows, found = scan(docs, ledger), F.col("findings")
    own = [r.kind for r in RULES if r.base]

    def of(*kinds: str) -> Column:
        return F.filter(found, lambda x: x["kind"].isin(*kinds))

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in own]
    base = joined(of(*own))
    return rows.select(
        "doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), joined(found).alias("spans"),
    )
