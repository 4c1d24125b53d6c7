"""Toxicity by class-conditional Kneser-Ney models.

One model of toxic and one of ordinary text, over the bytes of lowered words, with a shared lowest order. A text is
compared by the difference of its log-likelihoods under the two: for the whole text per byte, and for its single
words, because a few expressions in a long text make it toxic. Rare words back off to shorter byte sequences and at the
end to counts that both classes share, where the difference vanishes. A logistic regression on these differences gives
the score; it is fitted on labelled rows that the models have not seen.

Rows are dealt by crc32(doc_id as text) mod 5: remainder 0 is held out from everything, 1 to 3 train the models, 4 the
regression. All rows of these folds count; nothing is sampled. Identifiers, languages, sources and labels are no
inputs of a score.

Defined results: a null text counts as empty; empty texts have no difference and get the regression's value for that;
rows with null or repeated labels: null labels teach nothing, of repeated labels of one id the largest counts; a null
doc_id is held out; without labels of both classes every score is 0; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from marketgrain.llm import kneser_ney
from marketgrain.llm.labelled import with_label
from marketgrain.llm.texts import LETTER_WORDS, slices
from marketgrain.llm.workers import released
from marketgrain.session import materialize

FOLDS = 5
#: log-likelihood difference from which a word speaks for the toxic class
MARGIN = 8.0
FEATURES = ["mean_difference", "first_word", "second_word", "third_word", "marked_words"]
TRANSLATE = np.where(LETTER_WORDS.inside, LETTER_WORDS.lower, 0x20).astype(np.uint8)


def fold(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)), F.lit(0))


def differences(column: pa.Array, model: kneser_ney.Model) -> np.ndarray:
    """The features of each text."""
    data, offsets = kneser_ney.padded(column, TRANSLATE)
    found = model.score(data)
    toxic = np.where(kneser_ney._inner(offsets, len(data)), found[:, 1] - found[:, 0], 0)
    sums = np.concatenate(([0], np.cumsum(toxic, dtype=np.float64)))
    length = np.maximum(np.diff(offsets) - kneser_ney.ORDER + 1, 1)
    out = np.zeros((len(column), len(FEATURES)))
    out[:, 0] = (sums[offsets[1:]] - sums[offsets[:-1]]) / length
    plain = (data != 0x20) & (data != kneser_ney.START)
    begin = np.flatnonzero(plain & ~np.concatenate(([False], plain[:-1])))
    if not len(begin):
        return out
    words = sums[np.append(begin[1:], len(data))] - sums[begin]
    document = np.searchsorted(offsets, begin, "right") - 1
    out[:, 4] = np.log1p(np.bincount(document[words > MARGIN], minlength=len(column)))
    order = np.lexsort((-words, document))
    first = np.searchsorted(document[order], np.arange(len(column)))
    for k in range(3):
        at = first + k
        has = at < len(order)
        has[has] = document[order[at[has]]] == np.flatnonzero(has)
        out[has, 1 + k] = np.maximum(words[order[at[has]]], 0)
    return out


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, with the differences behind the score."""
    rows = with_label(docs.select("doc_id", F.col("text").cast("string").alias("text")), labels, "toxic")
    rows = rows.withColumn("fold", fold(F.col("doc_id")))
    model = kneser_ney.fit(rows.where("label in (0, 1) and fold in (1, 2, 3)").select("text", "label"), 2, TRANSLATE)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", kneser_ney.SLICE):
                found = differences(part.column("text"), model)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("fold"), part.column("label"), *map(pa.array, found.T.copy())],
                    ["doc_id", "fold", "label", *FEATURES],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, fold long, label int, " + ", ".join(f"{f} double" for f in FEATURES)
    measured = rows.select("doc_id", "text", F.col("fold").cast("long").alias("fold"), "label").mapInArrow(released(run), schema)
    measured = materialize(measured, "differences")
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(measured)
    known = vectors.where("fold = 4 and label in (0, 1)")
    if known.select("label").distinct().count() == 2:
        fitted = LogisticRegression(featuresCol="_features", labelCol="label", regParam=1e-4, maxIter=50).fit(known)
        probability = vector_to_array(F.col("_p"))[1]
        vectors = fitted.setProbabilityCol("_p").setPredictionCol("_y").setRawPredictionCol("_r").transform(vectors)
    else:
        probability = F.lit(0.0)
    return vectors.withColumn("score", probability).select(
        "doc_id", (F.col("fold") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *FEATURES,
    )
