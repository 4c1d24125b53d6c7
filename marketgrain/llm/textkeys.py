"""A short digest that tells rows of one id apart by their texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: rows of ids and digests that may be broadcast; more are joined by a shuffle
BROADCAST_KEYS = 500_000


def unused(docs: DataFrame, name: str) -> str:
    """``name``, behind as many underscores as no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_key(docs: DataFrame) -> Column:
    """The first 128 bits of the text's SHA-256; null counts as empty."""
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))
