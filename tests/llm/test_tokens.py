import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken

from marketgrain.llm import byte_bpe, token_counts
from llm_helpers import ODD, documents


def wild_texts(n=60):
    draw = random.Random(4)
    letters = "abcdehilnorst ABZ'  \n\t012.,;-é¿日😀▁ 　\r"
    return ["".join(draw.choice(letters) for _ in range(draw.randrange(0, 300))) for _ in range(n)]


@pytest.fixture(scope="module")
def tik():
    with open(P.path(byte_bpe.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_token_counts_equal_the_library(spark):
    rows = [*ODD, *[(100 + i, t) for i, t in enumerate(wild_texts())], (99, "<s> </s> <unk> <0x0A>")]
    model = sentencepiece.SentencePieceProcessor(model_file=P.path(token_counts.MODEL))
    expected = sorted(
        (str(i), len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in rows
    )
    found = token_counts.count_tokens(documents(spark, rows))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in found.collect()) == expected
    assert token_counts.count_tokens(documents(spark, [])).count() == 0


def test_token_limit(spark):
    rows = token_counts.count_tokens(documents(spark, [(1, "a b c")]), limit=2).collect()
    assert rows[0].over_limit


def test_byte_bpe_round_trip_equals_the_library(spark, tik):
    rows = [*ODD, *[(100 + i, t) for i, t in enumerate(wild_texts())], (99, "<|endoftext|>")]
    expected = []
    for i, t in rows:
        ids = tik.encode_ordinary(t or "")
        packed = np.array(ids, "<u4").tobytes()
        expected.append((str(i), len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    found = byte_bpe.round_trip(documents(spark, rows), keep_ids=True).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == sorted(expected)
    assert all(len(r.ids) == 4 * r.n_tokens for r in found)
    assert byte_bpe.round_trip(documents(spark, [])).count() == 0


def test_transducer_on_random_bytes(tik):
    machine = byte_bpe.codec(P.path(byte_bpe.RANKS)).machine
    small = byte_bpe.Transducer(machine.merges, max_states=50)
    draw = random.Random(2)
    for alphabet in (b"ab", b"aeinorst", bytes(range(97, 123)), bytes(range(256)), " =-".encode()):
        for _ in range(40):
            text = bytes(draw.choice(alphabet) for _ in range(draw.randrange(1, 60)))
            whole = tik._encode_single_piece(text)
            assert machine.encode(text) == whole == small.encode(text)
            assert machine.merges.merge(text, 1 << 30) == whole or text in machine.merges.ranks
    assert list(machine.stream(b"hello")) == machine.merges.merge(b"hello", 1 << 30)


def test_invented_words_are_not_determinised(tik, monkeypatch):
    codec = byte_bpe.codec(P.path(byte_bpe.RANKS))
    moves, move = [], byte_bpe.Transducer._move
    monkeypatch.setattr(byte_bpe.Transducer, "_move", lambda *args: moves.append(1) or move(*args))
    draw = random.Random(6)
    parts = ["tion", "er", "an", "th", "ß", "日", "ou", "q", "x'", "0"]
    texts = [" ".join("".join(draw.choices(parts, k=draw.randrange(1, 12))) for _ in range(40)) for _ in range(50)]
    ids, ends = codec.encode(pa.array([*texts, None, ""]))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [*map(tik.encode_ordinary, texts), [], []]
    assert not moves


def test_short_and_long_matches_together(tik):
    codec = byte_bpe.codec(P.path(byte_bpe.RANKS))
    texts = ["a" * 300 + " tiny", "abcdefgh" * 31 + "abcdefg zz", "é" * 128 + " " + "é" * 129, "xyz" * 500, "", "hello"]
    ids, ends = codec.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [tik.encode_ordinary(t) for t in texts]


def test_many_pairs_share_places_of_the_store(tik, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 4)
    monkeypatch.setattr(byte_bpe, "BLOCK", 16)
    wide = byte_bpe.WideTransducer(byte_bpe.codec(P.path(byte_bpe.RANKS)).merges)
    draw = random.Random(8)
    words = [bytes(draw.choice(b"aeinorst") for _ in range(draw.randrange(1, 40))) for _ in range(200)]
    ids, ends = wide.encode(np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *map(len, words)]))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [tik._encode_single_piece(w) for w in words]


def test_tokens_are_emitted_before_the_end():
    machine = byte_bpe.codec(P.path(byte_bpe.RANKS)).machine
    text, seen = b"thequickbrownfoxjumpsoverthelazydog" * 3, []

    def reading():
        for i, byte in enumerate(text):
            seen.append(i)
            yield byte

    first = next(machine.stream(reading()))
    assert first == machine.encode(text)[0] and len(seen) < 20


def test_streaming_decoder_hands_out_whole_characters(tik):
    text = "日本語 😀 naïve"
    decoder = byte_bpe.codec(P.path(byte_bpe.RANKS)).decoder
    out = [decoder.feed(np.array([i], np.uint32)) for i in tik.encode_ordinary(text)] + [decoder.close()]
    assert "".join(part.decode("utf-8") for part in out) == text
    ids = np.array(tik.encode_ordinary(text * 50), np.uint32)
    assert decoder.decode(ids, block=3) == (text * 50).encode()


def test_matches_equal_the_pattern():
    import regex

    codec = byte_bpe.codec(P.path(byte_bpe.RANKS))
    texts = wild_texts(200) + ["it's\n'd  'd'll''s 's", "a'", "'", "'re've", " 'tis", "x's'"]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    border = np.zeros(len(points), bool)
    at = np.cumsum([0, *map(len, texts)])
    border[at[:-1][np.diff(at) > 0]] = True
    starts = np.flatnonzero(byte_bpe.match_starts(points, border))
    expected = [at[k] + m.start() for k, t in enumerate(texts) for m in regex.finditer(P.PATTERN, t)]
    assert starts.tolist() == expected
    assert codec.encode(pa.array([], pa.string()))[0].size == 0
