import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import LONG, documents

from marketgrain.llm import kneser_ney, quality, sharding, toxicity


def brute_model(texts, order=kneser_ney.ORDER):
    """Interpolated modified Kneser-Ney by dictionaries."""
    top = Counter()
    for t in texts:
        data = bytes([kneser_ney.START] * (order - 1)) + t.encode()
        for i in range(order - 1, len(data)):
            top[data[i - order + 1:i + 1]] += 1
    tables = {order: top}
    for n in range(order - 1, 0, -1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])
    total = sum(tables[1].values())
    cuts, contexts = {}, {}
    for n in range(2, order + 1):
        c = Counter(tables[n].values())
        cuts[n] = kneser_ney._discounts(c[1], c[2], c[3], c[4])
        contexts[n] = defaultdict(lambda: [0, 0.0])
        for g, k in tables[n].items():
            contexts[n][g[:-1]][0] += k
            contexts[n][g[:-1]][1] += cuts[n][min(k, 3) - 1]

    def p(g):
        if len(g) == 1:
            return (tables[1][g] + 0.5) / (total + 128)
        below, n = p(g[1:]), len(g)
        if g[:-1] not in contexts[n]:
            return below
        t, d = contexts[n][g[:-1]]
        k = tables[n][g]
        return (k - (cuts[n][min(k, 3) - 1] if k else 0) + d * below) / t

    return p


def texts_of(seed, letters="abc d", n=40):
    draw = random.Random(seed)
    return ["".join(draw.choice(letters) for _ in range(draw.randrange(1, 80))) for _ in range(n)]


def test_model_equals_brute_force_and_sums_to_one(spark):
    texts = texts_of(1)
    frame = spark.createDataFrame([(t, 0) for t in texts] + [(None, 0), ("", 0)], "text string, label int")
    model = kneser_ney.fit(frame, 1)
    p = brute_model(texts)
    column = pa.array(["abca dd b", "zq", "", None, "é"])
    data, offsets = kneser_ney.padded(column, None)
    found = model.score(data)[:, 0]
    raw = data.tobytes()
    for a, b in zip(offsets[:-1], offsets[1:]):
        for i in range(a + kneser_ney.ORDER - 1, b):
            assert found[i] == pytest.approx(math.log(p(raw[i - kneser_ney.ORDER + 1:i + 1])), abs=1e-4)
    context = b"abca"
    assert sum(p(context + bytes([b])) for b in range(256)) == pytest.approx(1)


def test_no_ngram_is_lost_in_large_models(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "SHARD_ENTRIES", 30_000)
    monkeypatch.setattr(kneser_ney, "KEPT_BYTES", 600_000)
    draw = random.Random(4)
    texts = ["".join(chr(draw.randrange(33, 127)) for _ in range(400)) for _ in range(120)]
    model = kneser_ney.fit(spark.createDataFrame([(t, 0) for t in texts], "text string, label int"), 1)
    p = brute_model(texts)
    data, offsets = kneser_ney.padded(pa.array([*texts, "unseen " + texts[0][::-1]]), None)
    inner, raw = kneser_ney._inner(offsets, len(data)), data.tobytes()
    wanted = [math.log(p(raw[i - kneser_ney.ORDER + 1:i + 1])) for i in np.flatnonzero(inner)]
    for _ in range(2):  # from the broadcasts and from memory
        assert np.abs(model.score(data)[inner, 0] - wanted).max() < 1e-3
    assert len(model.shards) > 3 and 0 < len(model.kept) < len(model.shards)
    copy = spark.createDataFrame([("".join(texts[:5]),)], "text string")

    def run(batches):
        for batch in batches:
            part, at = kneser_ney.padded(batch.column("text"), None)
            yield pa.RecordBatch.from_arrays([pa.array([float(model.score(part)[kneser_ney._inner(at, len(part)), 0].sum())])], ["s"])

    part, at = kneser_ney.padded(pa.array(["".join(texts[:5])]), None)
    on_driver = model.score(part)[kneser_ney._inner(at, len(part)), 0].sum()
    assert copy.mapInArrow(run, "s double").first().s == pytest.approx(float(on_driver), rel=1e-4)


def test_classes_share_the_lowest_order(spark):
    rows = [(t, 0) for t in texts_of(1)] + [(t, 1) for t in texts_of(2, "abx y")]
    model = kneser_ney.fit(spark.createDataFrame(rows, "text string, label int"), 2)
    data, _ = kneser_ney.padded(pa.array(["qqqqqq", "xxyx"]), None)
    found = model.score(data)
    assert np.allclose(found[5:10, 0], found[5:10, 1])  # nothing known: both back off to the same
    assert found[-3:, 1].sum() > found[-3:, 0].sum()


def labelled(spark, n=240):
    draw = random.Random(9)
    ordinary = ["der", "the", "of", "lorem", "ipsum", "dolor", "amet", "and", "house"]
    rows, labels = [], []
    for i in range(n):
        words = [draw.choice(ordinary) for _ in range(draw.randrange(5, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                words.insert(draw.randrange(len(words)), draw.choice(["scumbag", "idiotic", "moronzz"]))
        junk = i % 7 == 0
        text = " ".join(words)
        rows.append((i, text.upper().replace("E", "#%") if junk and not toxic else text))
        labels.append((i, int(not junk), int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = labelled(spark)
    rows += [(1001, None), (1002, ""), (None, "scumbag idiotic"), (1003, "the of " * 9000 + "scumbag idiotic moronzz"), (1003, "the")]
    truth = {i: t for i, _, t in labels}
    extra = [(5, None, None), (6, 1, 0), (None, 1, 1), (9999, 0, 1)]
    frame = spark.createDataFrame([*labels, *extra], "doc_id long, quality int, toxic int")
    found = toxicity.score(documents(spark, rows), frame).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 25 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9
    assert all(r.predicted == (r.score >= 0.5) for r in found)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found if r.doc_id is not None)
    none = frame.limit(0)
    assert {r.score for r in toxicity.score(documents(spark, rows[:5]), none).collect()} == {0.0}
    assert toxicity.score(documents(spark, []), frame).count() == 0


def test_quality_keeps_clean_and_drops_junk(spark):
    rows, labels = labelled(spark)
    rows += [(1001, None), (1002, ""), (1003, "the house of " * 5000), (1004, "#%% $$ @@@ ||| " * 20), (None, LONG)]
    frame = spark.createDataFrame([*labels, (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    found = {r.doc_id: r for r in quality.judge(docs, frame).collect()}
    assert len(found) == len(rows)
    assert all(found[i].kept for i, q, t in labels if q or t)
    assert all(found[i].kept for i in (1001, 1002, 1003)) and not found[1004].kept
    bad = [i for i, q, t in labels if not q and not t]
    assert np.mean([not found[i].kept for i in bad]) > 0.9
    left = quality.keep_good(docs, frame)
    assert left.columns == docs.columns and left.count() == sum(r.kept for r in found.values())
    none = quality.judge(documents(spark, rows[:3]), frame.limit(0)).collect()
    assert all(r.kept and r.perplexity is None for r in none)
    assert quality.judge(documents(spark, []), frame).count() == 0


def test_keep_good_decides_by_row_not_by_id(spark):
    rows, labels = labelled(spark)
    junk = "#%% $$ @@@ ||| " * 20
    rows += [(None, junk), (None, "the house of lorem ipsum"), (2001, junk), (2001, "the house and the ipsum"), (None, None)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    left = {(r.doc_id, r.text) for r in quality.keep_good(documents(spark, rows), frame).where("doc_id is null or doc_id = 2001").collect()}
    assert left == {(None, "the house of lorem ipsum"), (2001, "the house and the ipsum"), (None, None)}


def test_sharding_law_mixture_and_slots(spark, monkeypatch):
    import zlib

    monkeypatch.setattr(sharding, "BUCKET_ROWS", 16)
    monkeypatch.setattr(sharding, "CHUNK_BUCKETS", 4)
    draw = random.Random(1)
    rows = [(i, f"text {i % 50}", draw.choice(["a", "a", "a", "b", "c", None])) for i in range(700)]
    rows += [(None, None, "a"), (None, "x", None), (3, "text 3", "b"), (3, "text 3", "b"), (900, LONG, "d")]
    found = sharding.interleave(documents(spark, rows), 40).collect()
    assert len(found) == len(rows)
    by = defaultdict(list)
    for r in found:
        by[r.shard].append(r)
    assert sorted(by) == list(range(40)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    share = Counter(r[2] for r in rows)
    for source, n in share.items():
        for v in by.values():
            assert abs(sum(r.source == source for r in v) - n * len(v) / len(rows)) <= 2.5
    text = {(r[0], r[1]) for r in rows}
    assert {(r.size, r.text_crc32) for r in found} == {
        (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in text}
    # ranks within each source, and positions, are gapless
    for source in share:
        ranks = sorted(r.source_rank for r in found if r.source == source)
        assert ranks == list(range(len(ranks)))
    order = sorted(found, key=lambda r: r.position)
    assert [r.position for r in order] == list(range(len(rows)))
    assert all(x.fraction <= y.fraction for x, y in zip(order, order[1:]))
    assert sharding.interleave(documents(spark, []), 40).count() == 0
    assert len({r.shard for r in sharding.interleave(documents(spark, rows[:3]), 40).collect()}) == 3
