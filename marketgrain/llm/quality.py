"""Quality classifier: perplexity under an n-gram model of trusted text, with a threshold for each language.

The model is an interpolated modified Kneser-Ney model over bytes, counted over all trusted texts but the fold that
sets the thresholds. A document's perplexity is the exponential of its mean negative log-likelihood per byte; for
short texts the mean is drawn towards the trusted mean of the language, as if PRIOR_BYTES bytes of that stood before.
A language's threshold lies SPREAD times the distance from the median to the QUANTILE of trusted documents beyond that
quantile, so that trusted text has room; languages with fewer than LEAST trusted documents use all languages' values.

Defined results: a null text counts as empty; an empty text has the mean of its language and is kept; a null or unknown
language uses all languages' values; null labels are no trust, of repeated labels of one id the largest counts;
without trusted text everything is kept with null perplexity; an empty table gives no rows; other columns are
ignored, or kept by ``keep_good``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketgrain.llm import kneser_ney
from marketgrain.llm.labelled import with_label
from marketgrain.llm.textkeys import BROADCAST_KEYS, text_key
from marketgrain.llm.texts import slices
from marketgrain.llm.toxicity import fold
from marketgrain.llm.workers import released
from marketgrain.session import materialize

PRIOR_BYTES = 100
QUANTILE, SPREAD = 0.99, 1.0
LEAST = 20


def measured(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, text_key, n_bytes, log_loss (sum over bytes) of every document, and whether it sets thresholds."""
    rows = with_label(
        docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
                    text_key(docs).alias("text_key")),
        labels, "quality",
    ).withColumn("held_out", fold(F.col("doc_id")) == 0)
    trusted = rows.where("label = 1 and not held_out").select("text", F.lit(0).alias("label"))
    model = kneser_ney.fit(trusted, 1)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", kneser_ney.SLICE):
                data, offsets = kneser_ney.padded(part.column("text"), None)
                loss = np.where(kneser_ney._inner(offsets, len(data)), -model.score(data)[:, 0], 0)
                sums = np.concatenate(([0], np.cumsum(loss, dtype=np.float64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("lang"), part.column("text_key"), pa.array(np.diff(offsets) - kneser_ney.ORDER + 1),
                     pa.array(sums[offsets[1:]] - sums[offsets[:-1]]), part.column("sets_threshold")],
                    ["doc_id", "lang", "text_key", "n_bytes", "log_loss", "sets_threshold"],
                )
        model.kept.clear()

    kind = docs.schema["doc_id"].dataType.simpleString()
    sets = F.coalesce((F.col("label") == 1) & F.col("held_out"), F.lit(False)).alias("sets_threshold")
    found = rows.select("doc_id", "lang", "text", "text_key", sets).mapInArrow(
        released(run), f"doc_id {kind}, lang string, text_key binary, n_bytes long, log_loss double, sets_threshold boolean"
    )
    return materialize(found, "losses")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_bytes, perplexity, threshold and kept of every document."""
    return _judged(docs, labels).drop("text_key")


def _judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = measured(docs, labels)
    known = rows.where("sets_threshold and n_bytes > 0")
    every = known.agg(F.sum("log_loss").alias("s"), F.sum("n_bytes").alias("n")).first()
    overall = float(every["s"] / every["n"]) if every["n"] else None
    means = known.groupBy("lang").agg((F.sum("log_loss") / F.sum("n_bytes")).alias("m"), F.count(F.lit(1)).alias("k"))
    means = means.where(F.col("k") >= LEAST).select(F.col("lang").alias("_lang"), "m")
    mean = F.coalesce(F.col("m"), F.lit(overall))
    smooth = (F.col("log_loss") + PRIOR_BYTES * mean) / (F.col("n_bytes") + PRIOR_BYTES)
    rows = rows.join(means, F.col("lang") == F.col("_lang"), "left").withColumn("smooth", smooth).drop("_lang", "m")

    def limit(df):
        ends = F.percentile_approx("smooth", [0.5, QUANTILE], 100_000)
        return df.agg(ends.alias("q"), F.count(F.lit(1)).alias("k")).withColumn(
            "limit", F.col("q")[1] + SPREAD * (F.col("q")[1] - F.col("q")[0])
        )

    held = rows.where("sets_threshold and n_bytes > 0")
    general = limit(held).first()["limit"]
    by_lang = limit(held.groupBy(F.col("lang").alias("_lang"))).where(F.col("k") >= LEAST).select("_lang", "limit")
    rows = rows.join(by_lang, F.col("lang") == F.col("_lang"), "left")
    threshold = F.coalesce(F.col("limit"), F.lit(general).cast("double"))
    return rows.select(
        "doc_id", "lang", "text_key", "n_bytes", F.exp("smooth").alias("perplexity"), F.exp(threshold).alias("threshold"),
        F.coalesce((F.col("n_bytes") == 0) | (F.col("smooth") <= threshold), F.lit(True)).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns.

    Rows are told apart by id, language and text, on which alone the verdict depends; ids may be null or repeated.
    """
    bad = _judged(docs, labels).where("not kept").select(
        F.col("doc_id").alias("_bad"), F.col("lang").alias("_lang"), F.col("text_key").alias("_key")
    ).distinct()
    bad = materialize(bad, "rejected")
    if bad.count() <= BROADCAST_KEYS:
        bad = F.broadcast(bad)
    same = docs["doc_id"].eqNullSafe(bad["_bad"]) & docs["lang"].cast("string").eqNullSafe(bad["_lang"])
    return docs.join(bad, same & (text_key(docs) == bad["_key"]), "left_anti")
