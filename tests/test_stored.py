"""Stored sketches, versioned tables, tuning and exact p-values."""

import datetime as dt
from itertools import combinations
from math import comb
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketgrain.functions.lattice import exact_tail
from marketgrain.operators import drift, sketches, tuning
from marketgrain.sources.versions import History, OnlineView

START = dt.datetime(2024, 1, 1)


def test_any_range_from_stored_sketches(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(START.date() + dt.timedelta(days=int(d)), int(k), float(x), f"u{int(k) % 700}")
            for d, k, x in zip(rng.integers(0, 40, 30_000), rng.integers(0, 9000, 30_000), rng.gamma(2, 9, 30_000))]
    df = spark.createDataFrame(rows, "day date, id long, x double, `user name` string")
    path = str(tmp_path / "sketches")
    for part in range(3):
        sketches.append(sketches.day_sketches(df.where(F.col("id") % 3 == part), "day", ["id", "user name"], ["x"]), path)
    stored = spark.read.parquet(path)
    for first, last in ((0, 39), (5, 5), (10, 24)):
        ends = [F.lit(START.date() + dt.timedelta(days=k)) for k in (first, last)]
        one = sketches.merged(sketches.between(stored, *ends)).select(
            "n", sketches.distinct("id"), sketches.distinct("user name"), sketches.quantile("x", 0.9), sketches.rank("x", 12.0)).first()
        inside = [r for r in rows if first <= (r[0] - START.date()).days <= last]
        ids, users, x = {r[1] for r in inside}, {r[3] for r in inside}, np.array([r[2] for r in inside])
        assert one[0] == len(inside)
        assert abs(one[1] - len(ids)) <= 4 * sketches.ERROR * len(ids) and abs(one[2] - len(users)) <= 4 * sketches.ERROR * len(users)
        assert abs((x <= one[3]).mean() - 0.9) < 0.005 and abs((x <= 12.0).mean() - one[4]) < 0.005
    early, late = (sketches.merged(sketches.between(stored, F.lit(START.date() + dt.timedelta(days=a)), F.lit(START.date() + dt.timedelta(days=b))))
                   for a, b in ((0, 3), (2, 9)))
    got = sketches.overlap(early, late, "user name").first()
    sides = [{r[3] for r in rows if a <= (r[0] - START.date()).days <= b} for a, b in ((0, 3), (2, 9))]
    assert (got[0], got[1], got[2]) == (len(sides[0] & sides[1]), len(sides[0] - sides[1]), len(sides[1] - sides[0]))  # exact below 4096


def test_online_view_after_many_ingests(spark, tmp_path):
    rng = np.random.default_rng(8)
    schema = "k string, v long, t timestamp, x double"
    view = OnlineView(spark, str(tmp_path / "view"), ["k"], "t", buckets=8)
    assert view.read(schema).count() == 0 and view.version() == 0
    seen, wanted = [], {}
    for number in range(1, 5):
        rows = [(f"k{int(k)}" if k else None, number, START + dt.timedelta(hours=int(h)), float(h))
                for k, h in zip(rng.integers(0, 40, 25), rng.integers(0, 50, 25))] if number < 4 else [("k1", 4, START, 1.0)]
        before = {r["bucket"]: r["place"] for r in view.entries().collect()}
        assert view.ingest(spark.createDataFrame(rows, schema)) == number
        for row in rows:  # of equal moments the later ingest, then the largest row
            best = wanted.get(row[0])
            if best is None or (row[2], row[1], row[3]) >= (best[2], best[1], best[3]):
                wanted[row[0]] = row
        seen.append(sorted(map(str, wanted.values())))
        after = {r["bucket"]: r["place"] for r in view.entries().collect()}
        if number == 4:  # one key: its bucket alone is new
            assert sum(before.get(b) != p for b, p in after.items()) == 1
    for number, rows in enumerate(seen, 1):
        assert sorted(str(tuple(r)) for r in view.read(schema, number).collect()) == rows
    old = view.read(schema, 3).count()
    gone = view.vacuum(keep=2)
    assert gone > 0 and view.read(schema, 3).count() == old and sorted(str(tuple(r)) for r in view.read(schema).collect()) == seen[-1]


def test_files_expire_whole_and_readers_see_one_version(spark, tmp_path):
    rows = spark.range(0, 480).select((F.lit(START) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ts"), "id")
    history = History(spark, str(tmp_path / "history"))
    history.append(rows.where("id < 240"))
    history.append(rows.where("id >= 240"))
    reader = history.read(rows.schema)
    version = history.expire(F.lit(START + dt.timedelta(hours=480)), hours=100)
    ids = {r["id"] for r in history.read(rows.schema).collect()}
    assert ids >= set(range(380, 480)) and len(ids) < 300  # files with younger rows stay whole
    assert reader.count() == 480 == history.read(rows.schema, version - 1).count()
    files = {r["place"] for r in history.entries(version).collect()}
    assert history.vacuum() > 0 and {r["id"] for r in history.read(rows.schema).collect()} == ids
    assert {p.name for p in Path(tmp_path / "history" / "data").rglob("*.parquet")} == {f.rsplit("/", 1)[1] for f in files}
    history.expire(F.lit(START + dt.timedelta(days=900)))
    assert history.read(rows.schema).count() == 0 and history.append(rows) == version + 2


def test_ridge_tuned_from_products(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(1e4, 1, (600, 3)) * [1, 1, 0]
    y = x @ [2.0, -1.0, 0] + rng.normal(0, 0.5, 600) + 1e5
    fold = rng.integers(0, 4, 600)
    rows = [(None if f == 0 else int(f), *map(float, v), float(w)) for f, v, w in zip(fold, x, y)] + [(1, None, 0.0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "test_fold int, `a b` double, b double, c double, label double").repartition(5)
    penalties, best = [0.0, 0.1, 10.0], {}
    got = {(r["fold"], r["penalty"]): r for r in tuning.tune_ridge(df, ["a b", "b", "c"], penalties, folds=4).collect()}
    for k in (1, 2, 3):
        train, test = fold < k, fold == k
        m, s = x[train].mean(axis=0), x[train].std(axis=0)
        z = (x[train] - m)[:, :2] / s[:2]
        for p in penalties:
            beta = np.linalg.solve(z.T @ z / train.sum() + p * np.eye(2), z.T @ (y[train] - y[train].mean()) / train.sum())
            error = y[test] - y[train].mean() - ((x[test] - m)[:, :2] / s[:2]) @ beta
            assert got[k, p]["rmse"] == pytest.approx(np.sqrt((error**2).mean()), rel=1e-6) and got[k, p]["n"] == test.sum()
            best.setdefault(p, []).append(np.sqrt((error**2).mean()))
    assert len(got) == 9 and {p for (_, p), r in got.items() if r["chosen"]} == {min(best, key=lambda p: np.mean(best[p]))}


def test_search_drops_out_the_worse_half():
    calls = []

    def score(candidate, fold):
        calls.append((candidate, fold))
        return abs(candidate - 6) + fold / 10

    found = tuning.search({str(k): k for k in range(8)}, score, folds=[1, 2, 3])
    assert len(calls) == 8 + 4 + 2 and [r[0] for r in found if r[3]] == ["6"]
    assert {r[0]: r[1] for r in found} == {"6": 3, "5": 3, "7": 2, "4": 2, "3": 1, "2": 1, "1": 1, "0": 1}


def test_exact_p_value_counts_paths(spark):
    for m, n in ((1, 1), (1, 5), (3, 4), (4, 4), (5, 3)):
        gaps = []
        for up in combinations(range(m + n), m):
            i = j = most = 0
            for k in range(m + n):
                i, j = (i + 1, j) if k in up else (i, j + 1)
                most = max(most, abs(i * n - j * m))
            gaps.append(most)
        for height in range(1, m * n + 1):
            assert exact_tail(height / (m * n), m, n) == pytest.approx(sum(g >= height for g in gaps) / comb(m + n, m), abs=1e-12)
    assert exact_tail(0.02, 10_000, 10_000) == pytest.approx(0.0366, abs=1e-3)
    a = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "x double")
    b = spark.createDataFrame([(float(v),) for v in (3, 5, 6)], "x double")
    exact = drift.ks_drift(a, b, ["x"]).first()
    assert exact["p_value"] == pytest.approx(exact_tail(exact["drift_score"], 4, 3))
    assert drift.ks_drift(a, b, ["x"], exact_rows=0).first()["p_value"] != exact["p_value"]
    assert drift.detect(a.withColumn("y", F.lit("t")), b.withColumn("y", F.lit("t")), method="ks_test").count() == 1
