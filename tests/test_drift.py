import numpy as np
import pytest
from pyspark.sql import functions as F

from marketgrain.operators import drift


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


def one(df):
    return df.first().asDict()


def test_equal_tables_do_not_drift(spark):
    a = frame(spark, range(100))
    for method in drift.METHODS:
        assert one(drift.detect(a, a, ["x"], method))["drift_score"] == pytest.approx(0, abs=1e-12)
    assert one(drift.ks_drift(a, a, ["x"]))["p_value"] == 1.0


def test_disjoint_tables(spark):
    a, b = frame(spark, range(50)), frame(spark, range(100, 150))
    row = one(drift.ks_drift(a, b, ["x"]))
    assert row["drift_score"] == 1.0 and row["p_value"] < 1e-6 and row["drift_detected"]
    psi = one(drift.psi_drift(a, b, ["x"]))["drift_score"]
    assert np.isfinite(psi) and psi > 0.25
    assert one(drift.wasserstein_drift(a, b, ["x"]))["distance"] == pytest.approx(100)


def test_constant_column(spark):
    a = frame(spark, [3.0] * 20)
    assert one(drift.psi_drift(a, frame(spark, [4.0] * 5), ["x"]))["drift_score"] == 0.0
    row = one(drift.profile(a, ["x"]))
    assert row["std"] == drift.MIN_STD and row["skewness"] == 0.0


def test_profile_moments(spark):
    row = one(drift.profile(frame(spark, [1, 2, 3, 10, None]), ["x"]))
    assert row["mean"] == 4.0 and row["q25"] == 1.75 and row["median"] == 2.5 and row["missing_rate"] == 0.2
    assert row["skewness"] == pytest.approx(1.018, abs=1e-3) and row["kurtosis"] == pytest.approx(-0.7696, abs=1e-4)


def test_ks_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(0, 1, 400).round(2), rng.normal(0.2, 1.1, 300).round(2)
    grid = np.unique(np.concatenate([a, b]))
    expect = max(abs((a <= g).mean() - (b <= g).mean()) for g in grid)
    assert one(drift.ks_drift(frame(spark, a), frame(spark, b), ["x"]))["drift_score"] == pytest.approx(expect)


def test_psi_equals_numpy(spark):
    rng = np.random.default_rng(6)
    a, b = rng.normal(0, 1, 500), rng.normal(0.5, 1, 300)
    edges = np.unique(np.percentile(a, np.linspace(0, 100, 11)))
    p, q = (np.histogram(v, edges)[0] / len(v) for v in (a, b))
    p, q = (np.where(v == 0, 1e-4, v) for v in (p, q))
    assert one(drift.psi_drift(frame(spark, a), frame(spark, b), ["x"]))["drift_score"] == pytest.approx(np.sum((q - p) * np.log(q / p)))


def test_performance_drift_sets_baseline(spark):
    rows = spark.createDataFrame([("m", 10.0, 12.0), ("m", 0.0, 1.0), ("n", 10.0, 11.0)], "model string, actual double, predicted double")
    now = drift.prediction_errors(rows, ["model"])
    base = spark.createDataFrame([("m", 10.0)], "model string, mape double")
    got = {r["model"]: r for r in drift.performance_drift(now, base, "model").collect()}
    assert got["m"]["mape"] == pytest.approx(20) and got["m"]["degradation_pct"] == pytest.approx(100) and got["m"]["performance_drift_detected"]
    assert got["n"]["degradation_pct"] == 0.0 and not got["n"]["performance_drift_detected"]


def test_no_alert_without_drift(spark):
    a = frame(spark, range(100))
    assert drift.alert(drift.verdict(drift.detect(a, a, ["x"])), "statistical").count() == 0


def test_features_without_values_are_left_out(spark):
    full = spark.createDataFrame([(float(i), 1.0, float(i)) for i in range(50)], "x double, one double, y double")
    empty = full.withColumn("y", F.lit(None).cast("double"))
    for a, b in ((full, empty), (empty, full)):
        psi = {r["feature"]: r["drift_score"] for r in drift.psi_drift(a, b, ["x", "one", "y"]).collect()}
        assert set(psi) == {"x", "one"} and psi["one"] == 0.0
        assert "y" not in {r["feature"] for r in drift.jensen_shannon(a, b, ["x", "y"]).collect()}


def test_chi_square_leaves_out_features_without_values_on_a_side(spark):
    full = spark.createDataFrame([("a", "p"), ("b", "q"), ("a", None)], "x string, y string")
    empty = full.withColumn("y", F.lit(None).cast("string"))
    for reference, current in ((full, empty), (empty, full)):
        got = {r["feature"]: r["drift_score"] for r in drift.chi_square(reference, current, ["x", "y"]).collect()}
        assert got == {"x": pytest.approx(0.0)}
    assert drift.chi_square(full, full.where("false"), ["x", "y"]).count() == 0


def test_methods_share_the_distributions(spark, monkeypatch):
    rng = np.random.default_rng(7)
    a, b = frame(spark, [*rng.normal(0, 1, 200), None]), frame(spark, rng.normal(0.3, 1, 150))
    alone = {m: one(drift.detect(a, b, ["x"], m))["drift_score"] for m in drift.METHODS}
    found = drift.distances(a, b, ["x"])

    def again(*_):
        raise AssertionError("the distribution functions were built again")

    monkeypatch.setattr(drift, "distributions", again)
    sides = drift.stored_sides(a, b, ["x"])
    assert all(f.endswith(".parquet") for side in sides for f in side.inputFiles())
    shared = {m: one(drift.detect(*sides, ["x"], m, found=found))["drift_score"] for m in drift.METHODS}
    assert shared == pytest.approx(alone)


def test_bins_of_odd_columns(spark):
    schema = "a double, b double, d double"
    reference = spark.createDataFrame([(float(i % 7), None, 2.0) for i in range(70)], schema)
    current = spark.createDataFrame([(float(i), 1.0, None) for i in (-1, 0, 6, 6, 9)], schema)
    rows = drift.binned_shares(reference, current, ["a", "b", "d"], 3).orderBy("feature", "bin").collect()
    # edges 0, 2, 4, 6: the last bin has both ends, values outside count in the total
    assert [(r["feature"], r["bin"], round(r["ref_share"] * 7), r["cur_share"]) for r in rows] == [
        ("a", 1, 2, 0.2), ("a", 2, 2, 0.0), ("a", 3, 3, 0.4)]
    assert [r["feature"] for r in drift.psi_drift(reference, current, ["a", "b", "d"], 3).collect()] == ["a"]
