import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketgrain import schemas as S
from marketgrain.operators import modeling as M, registry as R, serving


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([("m", 10.0, 12.0), ("m", 20.0, 18.0), ("m", 0.0, 1.0)], "model string, actual double, predicted double")
    row = M.metrics(df, ["model"]).first()
    assert row["mae"] == pytest.approx(5 / 3) and row["mse"] == pytest.approx(3.0)
    assert row["mape"] == pytest.approx(15.0) and row["r2"] == pytest.approx(1 - 9 / 200)


def test_ridge_equals_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 2)) * [1, 5]
    y = x @ [2.0, -1.0] + rng.normal(size=60)
    rows = spark.createDataFrame([(float(a), float(b), float(v)) for (a, b), v in zip(x, y)], "a double, b double, label double")
    z = (x - x.mean(0)) / x.std(0)
    beta = np.linalg.solve(z.T @ z + np.eye(2), z.T @ (y - y.mean()))
    model = M.fit("ridge", rows, ["a", "b"])
    got = np.array([r["prediction"] for r in model.transform(rows).collect()])
    assert np.allclose(got, z @ beta + y.mean(), atol=1e-8)


def test_gate(spark):
    df = spark.createDataFrame([(10.0, 1.0, 0.9, None), (10.0, 1.0, 0.9, 20.0), (16.0, 1.0, 0.9, None), (10.0, 6.0, 0.9, None), (10.0, 1.0, 0.6, None)],
                               "val_mape double, val_rmse double, val_r2 double, test_mape double")
    assert [r["ok"] for r in df.select(R.gate(df).alias("ok")).collect()] == [True, False, False, False, False]


def test_compare_versions(spark):
    df = spark.createDataFrame([("m", 1, "mape", 10.0), ("m", 2, "mape", 8.0), ("m", 1, "r2", 0.8), ("m", 2, "r2", 0.8)], "model string, version int, metric string, value double")
    got = {r["metric"]: (r["improvement_pct"], r["better_version"]) for r in R.compare_versions(df, 1, 2).collect()}
    assert got == {"mape": (20.0, 2), "r2": (0.0, 1)}


def test_versions_kept_and_promoted(spark):
    stages = {1: "None", 2: "Production", 3: "None", 4: "None", 5: "Staging"}
    rows = [("m", v, dt.date(2024, 1, v), s, v != 3) for v, s in stages.items()]
    df = spark.createDataFrame(rows, "model string, version int, created date, stage string, passed boolean")
    assert {r["version"] for r in R.retained(df, 1).where("keep").collect()} == {2, 4, 5}
    pick = lambda v: spark.createDataFrame([("m", v)], "model string, version int")
    after = {r["version"]: r["stage"] for r in R.promote(df, pick(4)).collect()}
    assert after[4] == "Production" and after[2] == "Archived" and after[5] == "Staging"
    assert {r["version"]: r["stage"] for r in R.promote(df, pick(3)).collect()} == stages
    assert R.latest_version(df).first()["version"] == 2


def test_confidence_range(spark):
    df = spark.createDataFrame([(1.0, 0.0), (99.0, 0.0), (10.0, 0.9), (None, 0.0)], "m double, s double")
    got = [r[0] for r in df.select(M.confidence(F.col("m"), F.col("s"))).collect()]
    assert got == pytest.approx([0.95, 0.1, 0.6, 0.8])


def test_serving_expansion(spark):
    df = spark.createDataFrame([(7, 18.5, 30.0)], f"Month int, Avg_Price double, `{S.LOSS}` double")
    out = serving.expand(df)
    assert tuple(out.columns) == serving.SERVING_ORDER and len(out.columns) == 90
    row = out.first()
    assert row["Season_Summer"] == 1 and row["Summer_Price"] == 18.5 and row["Total_Quantity"] == 100.0
    assert row["Loss_Rate_Category_High"] == 1 and row["Loss_Rate_Category_Very_High"] == 1
    assert serving.expand(df, cumulative_bands=False).first()["Loss_Rate_Category_High"] == 0


def test_payload_forms(spark):
    bodies = ['{"instances": [{"a": 1}, {"a": 2}]}', '{"features": {"a": 3}}', '{"a": 4}', '[{"a": 5}, {"a": 6}]']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert sorted(r["a"] for r in serving.parse_payloads(df, "body", {"a": "bigint"}).collect()) == [1, 2, 3, 4, 5, 6]
    text = spark.createDataFrame([("a,b\n1,x\n2,y\n",)], "body string")
    assert [tuple(r) for r in serving.parse_csv_payloads(text, "body", {"a": "bigint", "b": "string"}).collect()] == [(1, "x"), (2, "y")]


def test_derived_only_if_absent(spark):
    df = spark.createDataFrame([(10.0, 2.0, 99.0, 0, 3)], "Total_Quantity double, Avg_Price double, Revenue double, Transaction_Count int, Month int")
    row = serving.derive_missing(df).first()
    assert row["Revenue"] == 99.0 and row["Avg_Quantity"] == 10.0 and row["DayOfYear"] == 74 and row["Discount_Rate"] == 0.0


def test_folds_are_disjoint_in_time(spark):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i),) for i in range(100)]
    folds = M.rolling_folds(spark.createDataFrame(days, f"`{S.DATE}` date"), 2, 30).collect()
    for k in (1, 2):
        tested = [r[S.DATE] for r in folds if r["test_fold"] == k]
        trained = [r[S.DATE] for r in folds if k in r["train_folds"]]
        assert len(tested) == 30 and max(trained) < min(tested)
