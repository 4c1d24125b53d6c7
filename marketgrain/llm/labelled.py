"""Labels beside documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: rows of labels that may be broadcast; more are joined by a shuffle
BROADCAST_ROWS = 2_000_000


def with_label(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``docs`` with the int column ``label``, null where unknown; the largest of an id's labels counts."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).groupBy(
        F.col("doc_id").alias("_labelled")
    ).agg(F.max(F.col(column).cast("int")).alias("label"))
    if labels.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    return docs.join(known, docs["doc_id"] == known["_labelled"], "left").select(docs["*"], known["label"])
