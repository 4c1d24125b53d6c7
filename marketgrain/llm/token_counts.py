"""Exact token counts of whole texts: pieces are counted once per distinct pre-token, never listed.

No piece of the vocabulary crosses from other characters into a space, so merges never do: a text is cut before each
run of spaces and the counts of the parts add up. For each slice of texts the distinct parts are encoded once, their
piece counts are joined to the parts' occurrences by document, and summed. Distinct parts, counts and frequencies
of a slice are bounded by its bytes; nothing is shuffled.

Defined results: a null text counts as empty, an empty text has no bytes and no tokens; repeated rows are counted one
by one; an empty table gives no rows; other columns are ignored. A vocabulary with pieces that cross into a space is
refused.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from marketgrain.llm.shipping import ship
from marketgrain.llm.texts import slices, utf8
from marketgrain.llm.workers import released

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
SLICE = 16 << 20


@lru_cache(maxsize=2)
def load(path: str) -> sentencepiece.SentencePieceProcessor:
    """The model, after a check that its pieces allow cutting before spaces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for piece in (model.id_to_piece(i) for i in range(model.get_piece_size())):
        if SPACE in piece.lstrip(SPACE):
            raise ValueError(f"piece {piece!r} crosses into a space")
    return model


def _is_space(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a space or the space mark starts, and where a character after one starts."""
    blank = data == 0x20
    after = np.zeros(len(data) + 3, bool)
    after[1:-2] = blank
    if len(data) > 2:
        mark = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
        blank[:-2] |= mark
        after[3:-2] |= mark
    return blank, after[:len(data)]


def _pieces(model: sentencepiece.SentencePieceProcessor, parts: list[bytes]) -> np.ndarray:
    """Pieces of each part behind one space."""
    texts = [part.decode("utf-8", "replace") for part in parts]
    counts = np.fromiter(map(len, model.encode(texts, num_threads=1)), np.int64, len(texts))
    counts[[i for i, text in enumerate(texts) if not text]] = 1
    return counts


def count_slice(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and tokens of each text."""
    data, offsets = utf8(column)
    sizes = np.diff(offsets)
    blank, after = _is_space(data)
    cut = blank & ~after
    starts = offsets[:-1][sizes > 0]
    cut[starts] = True
    begins = np.flatnonzero(cut)
    if not len(begins):
        return sizes, np.zeros(len(sizes), np.int64)
    parts = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begins), [None, pa.py_buffer(np.append(begins, len(data))), pa.py_buffer(data)]
    )
    is_first = np.zeros(len(data), bool)
    is_first[starts] = True
    is_first = is_first[begins]
    model, tokens = load(path), np.zeros(len(begins), np.int64)
    for chosen, strip in ((is_first, False), (~is_first, True)):
        coded = parts.filter(pa.array(chosen)).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if strip:  # the space in front is the one that the model adds
            distinct = [p[1:] if p[:1] == b" " else p[3:] for p in distinct]
        if distinct:
            tokens[chosen] = _pieces(model, distinct)[coded.indices.to_numpy()]
    sums = np.concatenate(([0], np.cumsum(tokens)))
    edges = np.searchsorted(begins, offsets)
    return sizes, sums[edges[1:]] - sums[edges[:-1]]


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document."""
    ship(docs.sparkSession)
    path = path or public_tokenizers.path(MODEL)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                size, tokens = count_slice(part.column("text"), path)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size), pa.array(tokens)], ["doc_id", "n_bytes", "n_tokens"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        released(run), f"doc_id {kind}, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
