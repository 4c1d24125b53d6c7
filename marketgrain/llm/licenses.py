"""License notices in texts: MinHash bands over overlapping windows find templates, exact containment verifies them.

Words are lowered runs of letters, digits, points and hyphens. Of a template with n shingles (five words each, fewer
words make one), windows of 2n shingles are laid every n shingles over a text, so that each run of n shingles lies in
one of them. A window that holds 80 % of a template's shingles has a Jaccard similarity of at least
0.8n / (2n + 0.2n) = 0.36 with it. Each of BANDS bands has one minimum hash, so such a window shares no band with
the template with probability below (1 - 0.36)^32 < 1e-6. What shares a band is verified on the shingles themselves.

A template of fewer than WIDTH words is found as a run of its own words, wherever it stands in a text; each place is a
window of its own, named by its first word, with containment 1. The bare rights notice is such a template.

Texts without any word of ``anchors`` are left out first. Anchors are words of which each template has so many
shingles that no text without them can hold 80 % of it; they are computed from the templates.

Main path: DataFrame functions only. The templates and their bands are bounded by the parameter; they are checked and
broadcast. Texts are never shuffled; windows of one text are processed row by row.

Defined results: a null text has no words and no license; repeated rows are scanned one by one; several licenses in a
text are several matches; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WIDTH, BANDS = 5, 32
PERCENT = 80
MAX_TEMPLATE_WORDS = 100_000

#: fixed values: notices and headings of public licenses
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "MIT": "Released under the MIT License",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "proprietary": "All rights reserved. No part of this may be reproduced",
}
#: notices of fewer than WIDTH words
SHORT = {"proprietary-notice": "All rights reserved"}

_WORD = r"[\p{L}\p{N}][\p{L}\p{N}.\-]*"


def words_of(text: Column) -> Column:
    lowered = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    found = F.regexp_extract_all(lowered, F.lit(f"({_WORD})"), 1)
    return F.transform(found, lambda w: F.rtrim(w, F.lit(".-")))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row; without the step through an array it would be computed anew
    for every element of the arrays that are built from it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def shingles_of(words: Column) -> Column:
    """Shingles in their order; none without words."""
    at = F.sequence(F.lit(1), F.greatest(F.size(words) - WIDTH + 1, F.lit(1)))
    return F.when(F.size(words) > 0, F.transform(at, lambda i: F.concat_ws(" ", F.slice(words, i, WIDTH)))).otherwise(
        F.expr("cast(array() as array<string>)")
    )


def band_hashes(hashes: Column) -> Column:
    """For each band, a hash of every shingle."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda band: F.transform(hashes, lambda h: F.xxhash64(h, band))
    )


def keys_of(bands: Column, at: Column, size: Column) -> Column:
    """For each band the key of a window of shingles: their minimum hash, with the band."""
    return F.transform(bands, lambda own, band: F.xxhash64(band, F.array_min(F.slice(own, at, size))))


def hashes_of(shingles: Column) -> Column:
    return F.transform(shingles, lambda s: F.xxhash64(s))


def plain_shingles(text: str) -> list[str]:
    """The same shingles of a short text, for checks."""
    words = [w.rstrip(".-") for w in regex.findall(_WORD, text.lower())]
    return [" ".join(words[i:i + WIDTH]) for i in range(max(len(words) - WIDTH + 1, 1))] if words else []


def short_words(text: str) -> list[str]:
    """Words of a template that is found as a run of its own words; none for other templates."""
    words = [w.rstrip(".-") for w in regex.findall(_WORD, text.lower())]
    return words if len(words) < WIDTH else []


def template_frame(spark: SparkSession, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """license, shingles (distinct) and their number n."""
    if sum(len(t.split()) for t in templates.values()) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates may have {MAX_TEMPLATE_WORDS} words together")
    rows = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    rows = once(rows, "words", words_of(F.col("text")))
    rows = once(rows, "shingles", F.array_distinct(shingles_of(F.col("words"))))
    return rows.select("license", "shingles", F.size("shingles").alias("n"))


def anchors(known: list[list[str]]) -> list[str]:
    """Words of which every text that holds PERCENT of a template's shingles has at least one.

    That is so when the shingles without any of the words are too few. Long words are taken first: they are the rarest.
    """
    chosen: set[str] = set()
    for shingles in known:
        needed = math.ceil(len(shingles) * PERCENT / 100)
        left = [s for s in (set(x.split()) for x in shingles) if not s & chosen]
        while len(left) >= needed:
            counts: dict[str, int] = {}
            for word in (w for s in left for w in s):
                counts[word] = counts.get(word, 0) + 1
            best = max(counts, key=lambda w: (len(w), counts[w], w))
            chosen.add(best)
            left = [s for s in left if best not in s]
    return sorted(chosen)


def matches(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, license, window (number of its first shingle or word), containment: every verified window."""
    if sum(len(t.split()) for t in templates.values()) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates may have {MAX_TEMPLATE_WORDS} words together")
    short = {name: words for name, text in templates.items() if (words := short_words(text))}
    found = _shingled(docs, {name: text for name, text in templates.items() if name not in short})
    return found.union(_runs(docs, short)) if short else found


def _runs(docs: DataFrame, short: dict[str, list[str]]) -> DataFrame:
    """Every place where the words of a short template stand in a row."""
    lowered = F.lower(F.col("text").cast("string"))
    some = F.lit(False)
    for words in short.values():
        every = F.lit(True)
        for word in dict.fromkeys(words):
            every = every & F.contains(lowered, F.lit(word))
        some = some | every
    texts = once(docs.where(some).select("doc_id", "text"), "_words", words_of(F.col("text"))).drop("text")

    def places(name: str, words: list[str]) -> Column:
        wanted = F.array(*map(F.lit, words))
        # positions of the first word, then the whole run
        first = F.filter(
            F.transform(F.col("_words"), lambda w, at: F.when(w == words[0], at)), lambda at: at.isNotNull()
        )
        return F.transform(
            F.filter(first, lambda at: F.slice("_words", at + 1, len(words)) == wanted),
            lambda at: F.struct(F.lit(name).alias("license"), at.alias("window")),
        )

    found = F.explode(F.concat(*[places(name, words) for name, words in sorted(short.items())]))
    rows = texts.select("doc_id", found.alias("f")).select("doc_id", "f.license", "f.window", F.lit(1.0).alias("containment"))
    return rows.distinct()


def _shingled(docs: DataFrame, templates: dict[str, str]) -> DataFrame:
    """Verified windows of templates that have shingles of WIDTH words."""
    spark = docs.sparkSession
    known = template_frame(spark, templates)
    rows = known.collect()  # bounded by MAX_TEMPLATE_WORDS
    sizes = sorted({r["n"] for r in rows if r["n"]})
    if not sizes:
        return docs.select("doc_id").where("false").selectExpr("doc_id", "'' license", "0 window", "0.0D containment")
    needed = anchors([r["shingles"] for r in rows if r["n"]])
    lowered = F.lower(F.col("text").cast("string"))
    some = F.lit(False)
    for word in needed:
        some = some | F.contains(lowered, F.lit(word))
    texts = once(docs.where(some).select("doc_id", "text"), "_words", words_of(F.col("text"))).drop("text")
    texts = once(texts, "_all", shingles_of(F.col("_words"))).drop("_words")
    texts = once(texts, "_hashes", hashes_of(F.col("_all")))
    texts = once(texts, "_bands", band_hashes(F.col("_hashes"))).drop("_hashes")

    def laid(n: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size("_all") - 1, F.lit(0)), F.lit(n))
        return F.transform(starts, lambda at: F.struct(
            F.lit(n).alias("n"), at.alias("window"), F.slice("_all", at + 1, F.lit(2 * n)).alias("_window"),
            keys_of(F.col("_bands"), at + 1, F.lit(2 * n)).alias("_keys"),
        ))

    windows = texts.select("doc_id", F.explode(F.concat(*[laid(n) for n in sizes])).alias("w")).select("doc_id", "w.*")
    banded = windows.select("doc_id", "n", "window", "_window", F.posexplode("_keys").alias("band", "key"))
    of_templates = once(known.where("n > 0"), "_hashes", hashes_of(F.col("shingles")))
    of_templates = once(of_templates, "_bands", band_hashes(F.col("_hashes"))).select(
        "license", F.col("n").alias("_n"), "shingles",
        F.posexplode(keys_of(F.col("_bands"), F.lit(1), F.col("n"))).alias("_band", "_key"),
    )
    same = (F.col("n") == F.col("_n")) & (F.col("band") == F.col("_band")) & (F.col("key") == F.col("_key"))
    held = F.size(F.array_intersect("_window", "shingles"))
    found = banded.join(F.broadcast(of_templates), same).select(
        "doc_id", "license", "window", (held / F.col("n")).alias("containment")
    )
    return found.where(F.col("containment") * 100 >= PERCENT).distinct()


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES | SHORT) -> DataFrame:
    """doc_id, license, n_windows that verify it, the first one and the highest containment."""
    return matches(docs, templates).groupBy("doc_id", "license").agg(
        F.count(F.lit(1)).alias("n_windows"), F.min("window").cast("long").alias("first_window"),
        F.max("containment").alias("containment"),
    )
