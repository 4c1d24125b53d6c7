"""A part of the registered queries against their checks on the smallest tables; tools/compare.py runs all."""

from pathlib import Path

import pandas as pd
import pytest

import __spark_entry__ as entry
from tools.compare import rows_of

FOLDER = "/root/testdata/sf0.001"
NAMES = (
    "a1_daily_aggregate", "a4_monthly_revenue", "a14_summary", "f1_all_features", "w8_row_split", "i1_series_fill", "v6_outliers",
    "v8_quality_score", "d2_statistical_drift", "d3_ks", "d4_psi", "t1_decompose", "m7_metrics", "m17_promote", "h1_alerts", "w13_ema",
    "a28_sketch_ranges", "t4_pacf", "m15_tuned_ridge", "s14_ingest", "h4_expiry", "r2_drift_windows", "s10_type_table",
    "r1_metric_windows", "r3_alert_stream", "p24_serving_expansion", "s21_payloads",
)


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are absent")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        db.sql(f"create view {path.stem} as select * from read_parquet('{path}')")
    df = entry.queries()[name](spark, FOLDER)
    got = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns)
    rel = db.sql(entry.oracle_sql()[name])
    expect = pd.DataFrame(rel.fetchall(), columns=rel.columns)
    assert sorted(got.columns) == sorted(expect.columns)
    assert rows_of(got) == rows_of(expect)
