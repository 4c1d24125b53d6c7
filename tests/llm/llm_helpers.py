"""Small tables for the tests."""

from __future__ import annotations

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, label int, n long, _id long, "
    "_bad long, _key binary, _lang string, _sha string, _text_key binary, _labelled long, _stays boolean, _digest string"
)
LONG = "wörd and other words " * 4000


def documents(spark, rows):
    """Documents with columns whose names clash with those that operators make; rows are (id, text[, source])."""
    data = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, 7, None, 1, 9, 1, 1, b"k", "en", "s", b"t", 1, True, "d") for r in rows]
    return spark.createDataFrame(data, SCHEMA)


ODD = [
    (1, None), (2, ""), (3, " "), (4, "  \t\n "), (5, "a"), (5, "a"), (None, "a b c"), (None, None), (7, LONG),
    (8, "Ünï cödé 日本語 😀 don't we'll 12 x"), (9, "▁x ▁▁ y▁"), (10, "\x00 \x7f"), (11, "tie tie tie"), (12, "tie tie tie"),
]
