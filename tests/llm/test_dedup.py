import hashlib
import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from marketgrain.llm import components, exact_dedup, near_dedup
from llm_helpers import ODD, documents


def exact_brute(rows):
    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for i, t in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((str(i), str(keep), len(ids), hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out)


def spaced(rows):
    return [*rows, (20, "x  y"), (21, "x\ty"), (19, "x y"), (22, "x y "), (23, "x y")]


def test_exact_groups(spark):
    rows = spaced(ODD)
    found = exact_dedup.groups(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in found) == exact_brute(rows)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.text_sha256 for r in found}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)
    assert exact_dedup.groups(documents(spark, [])).count() == 0


def test_hits_are_proved_on_full_texts(spark):
    """With a digest that collides all the time the result is the same."""
    rows = [(i, t) for i, t in spaced(ODD) if i is not None and i != 5]
    weak = lambda text: F.length(text).cast("string")
    found = exact_dedup.groups(documents(spark, rows), digest=weak).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in found) == exact_brute(rows)


def test_keep_first_keeps_columns_and_one_row_each(spark):
    docs = documents(spark, spaced(ODD))
    left = exact_dedup.keep_first(docs)
    assert left.columns == docs.columns
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in left.collect()]
    assert len(norm) == len(set(norm)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in spaced(ODD)})


def test_state_goes_on_with_new_files(spark, tmp_path):
    state, folder = str(tmp_path / "state"), str(tmp_path / "in")
    first = exact_dedup.fingerprints(documents(spark, [(4, "a"), (5, "b")]))
    first.write.parquet(folder)
    assert exact_dedup.absorb(spark, folder, first.schema, state).count() == 2
    exact_dedup.fingerprints(documents(spark, [(3, "a"), (6, "c")])).write.mode("append").parquet(folder)
    rows = exact_dedup.absorb(spark, folder, first.schema, state).collect()
    assert sorted((r.first.doc_id, r.seen) for r in rows) == [(3, 2), (5, 1), (6, 1)]


def near_brute(rows, width, percent):
    def shingles(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        if not words:
            return set()
        return {tuple(words[i:i + width]) for i in range(max(len(words) - width + 1, 1))}

    all_sets = [(i, shingles(t)) for i, t in rows]
    head = {i: i for i, _ in all_sets}

    def root(x):
        while head[x] != x:
            x = head[x]
        return x

    for a, (i, x) in enumerate(all_sets):
        for j, y in all_sets[:a]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((root(i), root(j)))
                head[hi] = lo
    return sorted((i, len(s), root(i)) for i, s in all_sets)


def edited(seed=1):
    """Chains of copies with edits, so that members of a component differ from its first by far."""
    draw = random.Random(seed)
    rows, at = [], 1000
    for length in (3, 8, 40, 200):
        for _ in range(6):
            words = [f"w{draw.randrange(500)}" for _ in range(length)]
            for _ in range(7):
                rows.append((at, " ".join(words)))
                at += 1
                for _ in range(max(1, length // 45)):
                    words[draw.randrange(len(words))] = f"w{draw.randrange(500)}"
    draw.shuffle(rows)
    return rows


def test_near_components_equal_brute_force(spark):
    rows = [*[(i, t) for i, t in ODD if i is not None and i != 5], (30, "A b C d"), (31, "a  B c\nd"), *edited()]
    for width, percent in ((3, 85), (5, 80)):
        found = near_dedup.near_components(documents(spark, rows), width, percent).collect()
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found)
        assert got == near_brute(rows, width, percent)
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_odd_rows_and_columns(spark):
    docs = documents(spark, ODD)
    found = near_dedup.near_components(docs).collect()
    assert len(found) == len(ODD)
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by[12].component_id == 11 and not by[12].kept and by[2].kept and by[2].n_shingles == 0
    left = near_dedup.keep_one(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} >= {1, 2, 3, 11}
    assert near_dedup.near_components(documents(spark, [])).count() == 0


def test_near_components_of_text_ids(spark):
    rows = [("b", "one two three four five six"), ("a", "one two  three four five six"), ("c", "x"), (None, "y"), (None, "y")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_components(docs).collect()}
    assert found == {("a", "a", True), ("b", "a", False), ("c", "c", True), (None, None, True)}
    assert {r.doc_id for r in near_dedup.keep_one(docs).collect()} == {"a", "c", None}


def test_keep_one_decides_by_row_not_by_id(spark):
    draw = random.Random(2)
    base = [" ".join(f"{k}w{draw.randrange(900)}" for _ in range(60)) for k in range(5)]
    rows = [
        (3, base[0]), (7, base[0] + " more"), (7, base[1]),  # one text of id 7 is a copy
        (None, base[0] + " other"), (None, base[2]),  # a null-id copy beside a null-id unique text
        (None, base[3]), (None, base[3] + " more"),  # near copies that all have null ids
        (9, base[4]), (9, base[4]), (None, None), (None, ""),  # one id and text twice; empty texts link with nothing
    ]
    left = sorted((str(r.doc_id), r.text or "") for r in near_dedup.keep_one(documents(spark, rows)).collect())
    third = [r for r in left if r[1].startswith(base[3])]
    assert len(third) == 1
    assert sorted(r for r in left if r not in third) == sorted(
        [("3", base[0]), ("7", base[1]), ("None", base[2]), ("9", base[4]), ("None", ""), ("None", "")])


def test_open_buckets_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rows = edited(5)
    got = near_dedup.near_components(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == near_brute(rows, 3, 85)


def test_pairs_are_compared_in_their_first_common_bucket(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LEAST_LINKED", 2)  # all but the first hubs' links are found in blocks
    rows = edited(6)
    for block in (4, 256):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        got = near_dedup.near_components(documents(spark, rows)).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == near_brute(rows, 3, 85)


def test_hubs_end_when_they_link_nothing(spark, monkeypatch):
    rounds, verified = [], near_dedup._verified
    monkeypatch.setattr(near_dedup, "_verified", lambda *args: rounds.append(1) or verified(*args))
    draw = random.Random(9)
    common = [f"c{i}" for i in range(75)]
    rows = [(i, " ".join(common + [f"w{draw.randrange(10**6)}" for _ in range(25)])) for i in range(14)]
    rows += [(20, rows[3][1] + " more"), (21, rows[5][1] + " more")]
    got = near_dedup.near_components(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == near_brute(rows, 3, 85)
    assert len(rounds) < near_dedup.ROUNDS


def test_sketch_is_full_and_estimates_similarity():
    draw = np.random.default_rng(3)
    for size in (1, 2, 5, 50, 400, 5000):
        own = draw.integers(0, 1 << 63, size, np.uint64)
        full = near_dedup.sketch(own)
        assert len(full) == near_dedup.BINS and full.max() < np.iinfo(np.uint64).max
    shared = draw.integers(0, 1 << 63, 3000, np.uint64)
    rest = draw.integers(0, 1 << 63, 1000, np.uint64)
    agreement = (near_dedup.sketch(shared) == near_dedup.sketch(np.concatenate([shared, rest]))).mean()
    assert abs(agreement - 0.75) < 0.17


def test_components(spark):
    draw = random.Random(7)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(5, None), (None, None), (9, 9)]
    found = components.connected(spark.createDataFrame(edges, "a long, b long")).collect()
    head = {x: x for e in edges for x in e if None not in e and e[0] != e[1]}

    def root(x):
        while head[x] != x:
            x = head[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            lo, hi = sorted((root(a), root(b)))
            head[hi] = lo
    assert sorted((r.node, r.component) for r in found) == sorted((x, root(x)) for x in head)
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stars_are_components_already(spark, monkeypatch):
    steps, stored = [], components.stored
    monkeypatch.setattr(components, "stored", lambda *args: steps.append(1) or stored(*args))
    edges = spark.createDataFrame([(1, 2), (3, 1), (1, 9), (7, 8), (8, 7)], "a long, b long")
    found = components.connected(edges).collect()
    assert sorted(map(tuple, found)) == [(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 1)] and len(steps) == 1
