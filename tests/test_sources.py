import datetime as dt
import json

from pyspark.sql import functions as F

from marketgrain import schemas as S
from marketgrain.operators import bi, quality
from marketgrain.plans import jobs
from marketgrain.sources import catalog, readers, writers


def write_raw(folder, days=30):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "annex1.csv").write_text("Item Code,Item Name,Category Code,Category Name\n1,a,10,leaf\n2,b,20,root\n")
    lines = [f"{S.DATE},{S.TIME},{S.ITEM},{S.QUANTITY},{S.PRICE},{S.KIND},{S.DISCOUNT}"]
    for d in range(days):
        day = dt.date(2021, 5, 1) + dt.timedelta(days=d)
        lines += [f"{day},09:30,{i},{1 + (d + k) % 5},{3 + i + k / 2 + d % 4},sale,No" for i in (1, 2) for k in (0, 1)]
    (folder / "annex2.csv").write_text("\n".join(lines) + "\n")
    (folder / "annex3.csv").write_text(f"{S.DATE},{S.ITEM},{S.WHOLESALE}\n2021-05-01,1,2.5\nbad,2,2.0\n")
    (folder / "annex4.csv").write_bytes(b"\xef\xbb\xbfItem Code,Item Name,Loss Rate (%)\n1,a,4.39  \n2,b,30\n")
    return str(folder)


def test_raw_reading(spark, tmp_path):
    tables = readers.read_raw(spark, write_raw(tmp_path))
    assert [r[S.LOSS] for r in tables["loss_rates"].orderBy(S.ITEM).collect()] == [4.39, 30.0]
    assert tables["wholesale"].where(F.col(S.DATE).isNull()).count() == 1
    assert quality.check_columns(tables["sales"], S.RAW_SCHEMAS["sales"]).first()["columns_match"]
    (tmp_path / "annex3.csv").rename(tmp_path / "other.csv")
    assert "wholesale" not in readers.read_raw(spark, str(tmp_path))
    assert {r["source"]: r["exists"] for r in readers.source_manifest(spark, str(tmp_path)).collect()} == {
        "items": True, "sales": True, "wholesale": False, "loss_rates": True}


def test_columns_go_by_name(spark, tmp_path):
    (tmp_path / "annex1.csv").write_text("Category Name,Item Code\nleaf,7\n")
    df = readers.read_raw(spark, str(tmp_path))["items"]
    assert df.first().asDict() == {"Category Name": "leaf", "Item Code": 7}


def test_validation_job(spark, tmp_path):
    out = jobs.validate(spark, write_raw(tmp_path))
    row = out["summary"].first()
    assert row["tables_validated"] == 4 and row["validation_passed"]
    assert out["rules"].count() == 4


def test_validation_parses_text_once(spark, tmp_path, monkeypatch):
    read, score = [], quality.quality_score
    monkeypatch.setattr(quality, "quality_score", lambda df, name: read.extend(df.inputFiles()) or score(df, name))
    out = jobs.validate(spark, write_raw(tmp_path))
    assert read and all(f.endswith(".parquet") for f in [*read, *out["rules"].inputFiles()])


def test_features_job_and_reports(spark, tmp_path):
    paths = jobs.build_features(spark, write_raw(tmp_path / "raw"), str(tmp_path / "out"))
    parts = readers.read_splits(spark, str(tmp_path / "out"))
    assert parts["features_complete"].count() == 60 and set(parts["features_complete"].columns) == set(S.FEATURE_TABLE)
    newest = {n: parts[n].agg(F.max(S.DATE)).first()[0] for n in ("train", "validation", "test")}
    assert newest["train"] < newest["validation"] < newest["test"]
    meta = spark.read.json(paths["metadata"]).first()
    assert meta["total_features"] == 105 and meta["total_records"] == 60 and meta["categorical_features"] == [S.CATEGORY_NAME]

    table = parts["features_complete"].withColumn("Season", F.lit("Spring"))
    writers.write_dashboard(table, str(tmp_path / "board"))
    names = writers.dashboard_datasets(spark, str(tmp_path / "board"))
    status = {r["component"]: r["status"] for r in quality.dataset_completeness(names, spark).collect()}
    # the sales end in 2021: the dataset of prices since 2023 has no rows, and a dataset without rows is not stored
    assert status.pop("forecasting_features") == "PARTIAL" and set(status.values()) == {"COMPLETE"}
    writers.write_report(table, str(tmp_path / "report"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert lines[0].startswith("Total Revenue: ") and any(x.startswith("Weekend: ") for x in lines)


def test_external_tables(spark, tmp_path):
    spark.createDataFrame([(1, 2.0)], f"`{S.ITEM}` long, `{S.LOSS}` double").write.parquet(str(tmp_path / "t"))
    catalog.create_database(spark, "shop")
    statement = catalog.register_table(spark, "shop", "t", str(tmp_path / "t"))
    assert "`Loss Rate (%)` double" in statement
    assert spark.sql("SELECT `Loss Rate (%)` FROM shop.t").first()[0] == 2.0
    assert spark.sql("SHOW TABLES IN shop").count() == 1


def test_type_rules(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1), 1, 1.0, "x", True)], "`Date` date, `Item Code` int, Avg_Price double, name string, ok boolean")
    assert {r[0]: r[1] for r in catalog.type_table(df).collect()} == {
        "Date": "timestamp", "Item Code": "bigint", "Avg_Price": "double", "name": "string", "ok": "boolean"}
    assert {r[0]: r[1] for r in catalog.feature_definitions(df).collect()} == {"Avg_Price": "Fractional", "name": "String", "ok": "Integral"}


def test_broken_alert_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"type": "x", "severity": "warning", "message": "m", "value": 1.5}))
    (tmp_path / "b.json").write_text('{\n  "alert_type": "data_drift",\n  "drift_results": {\n    "timest')
    good, broken = readers.read_alerts(spark, str(tmp_path))
    assert [r["type"] for r in good.collect()] == ["x"]
    assert [r["text"].startswith("{") and r["path"].endswith("b.json") for r in broken.collect()] == [True]


def test_snapshots_and_evaluation(spark, tmp_path):
    snapshot = {"system": [{"timestamp": "2024-01-01T00:00:00", "cpu_percent": 5.0}], "api": [], "data_quality": [],
                "models": {"m": [{"timestamp": "2024-01-01T00:00:00", "val_mape": 3.0}]}}
    (tmp_path / "s.json").write_text(json.dumps(snapshot, indent=1))
    rows = {(r["source"], r["entity"], r["metric"]): r["value"] for r in readers.read_snapshots(spark, str(tmp_path / "s.json")).collect()}
    assert rows == {("system", "system", "cpu_percent"): 5.0, ("models", "m", "val_mape"): 3.0}
    (tmp_path / "e.json").write_text(json.dumps({"m": {"val_mape": 2.0, "train_mae": 1}}))
    got = {r["metric"]: r["value"] for r in readers.read_evaluation(spark, str(tmp_path / "e.json")).collect()}
    assert got["val_mape"] == 2.0 and got["test_r2"] == 0.0 and len(got) == 6


def test_resolver(spark):
    df = spark.createDataFrame([(1,)], "`Category Code` int")
    assert bi.resolve(df, "category code") == "Category Code" and bi.resolve(df, "x") is None
