import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from marketgrain import schemas as S
from marketgrain.functions import calendar, pricing
from marketgrain.functions.naming import c
from marketgrain.operators import daily, encode, enrich, impute, series, split
from marketgrain.plans.features import feature_table

SALE = f"`{S.DATE}` date, `{S.ITEM}` long, `{S.QUANTITY}` double, `{S.PRICE}` double, `{S.KIND}` string, `{S.DISCOUNT}` string"
D1, D2 = dt.date(2021, 1, 1), dt.date(2021, 1, 3)


def make_sales(spark, days=40, items=(1, 2, 3)):
    rows = [
        (D1 + dt.timedelta(days=d), i, 1.0 + (d * i) % 7, 2.0 + i + (d % 5) / 10 + s, "sale", "Yes" if d % 3 == 0 else "No")
        for d in range(days) for i in items for s in (0.0, 0.5)
    ]
    return spark.createDataFrame(rows, SALE)


def test_daily_aggregate_by_hand(spark):
    sales = spark.createDataFrame([
        (D1, 1, 2.0, 4.0, "Sale", "Yes"), (D1, 1, 3.0, 6.0, "SALE", "yes"), (D1, 1, 9.0, 9.0, "return", "Yes"),
        (D2, 1, 1.0, 5.0, "sale", "No"), (None, 1, 1.0, 5.0, "sale", "No"), (D1, None, 1.0, 5.0, "sale", "No"),
    ], SALE)
    first, second = daily.daily_aggregate(sales).orderBy(S.DATE).collect()
    assert (first["Total_Quantity"], first["Avg_Quantity"], first["Transaction_Count"]) == (5.0, 2.5, 2)
    assert (first["Avg_Price"], first["Min_Price"], first["Max_Price"], first["Price_Range"]) == (5.0, 4.0, 6.0, 2.0)
    assert first["Price_Volatility"] == pytest.approx(math.sqrt(2))
    assert (first["Discount_Count"], first["Discount_Rate"], first["Revenue"]) == (1, 0.5, 25.0)
    assert second["Price_Volatility"] == 0.0


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("2021-02-30",), ("x",), ("2021-02-03",)], f"`{S.DATE}` string")
    assert [r[0] for r in daily.with_date(df).collect()] == [None, None, dt.date(2021, 2, 3)]


def test_lags_do_not_cross_items(spark):
    rows = [(D1, 1, 10.0, 1.0, 10.0), (D2, 1, 20.0, 2.0, 40.0), (D1, 2, 30.0, 3.0, 90.0)]
    df = spark.createDataFrame(rows, f"`{S.DATE}` date, `{S.ITEM}` long, Avg_Price double, Total_Quantity double, Revenue double")
    out = {(r[S.DATE], r[S.ITEM]): r for r in series.add_targets(series.add_rolling(series.add_lags(df))).collect()}
    assert out[(D2, 1)]["Avg_Price_Lag_1"] == 10.0 and out[(D1, 2)]["Avg_Price_Lag_1"] is None
    assert out[(D1, 1)]["Avg_Price_Target_1d"] == 20.0 and out[(D1, 1)]["Price_Change_Target_1d"] == 100.0
    assert out[(D1, 1)]["Avg_Price_Std_7"] is None and out[(D2, 1)]["Avg_Price_MA_7"] == 15.0


def test_fills_stay_within_items(spark):
    rows = [(1, 1, None), (1, 2, 5.0), (1, 3, None), (2, 1, None), (2, 2, None), (3, 1, 7.0)]
    df = spark.createDataFrame([(D1 + dt.timedelta(days=d), i, v) for i, d, v in rows], f"`{S.DATE}` date, `{S.ITEM}` long, v double")
    both = [r["v"] for r in series.fill_both_ways(df, ["v"]).orderBy(S.ITEM, S.DATE).collect()]
    assert both == [5.0, 5.0, 5.0, None, None, 7.0]
    back = [r["v"] for r in series.backward_fill(df, ["v"]).orderBy(S.ITEM, S.DATE).collect()]
    assert back == [5.0, 5.0, None, None, None, 7.0]
    filled = [r["v"] for r in impute.fill_series(df).orderBy(S.ITEM, S.DATE).collect()]
    assert filled == [5.0, 5.0, 5.0, 5.0, 5.0, 7.0]


def test_change_pads_gaps(spark):
    df = spark.createDataFrame([(D1 + dt.timedelta(days=i), 1, v) for i, v in enumerate([10.0, None, 15.0, 0.0, 3.0])],
                               f"`{S.DATE}` date, `{S.ITEM}` long, v double")
    assert [r["d"] for r in series.add_changes(df, {"v": "d"}).orderBy(S.DATE).collect()] == [None, 0.0, 0.5, -1.0, None]


def test_ratio_of_missing_and_zero_quotes(spark):
    base = spark.createDataFrame([(D1, 1, 10.0), (D1, 2, 10.0), (D1, 3, 10.0)], f"`{S.DATE}` date, `{S.ITEM}` long, Avg_Price double")
    quotes = spark.createDataFrame([(D1, 2, 0.0), (D1, 3, 4.0), (D1, 3, 6.0)], f"`{S.DATE}` date, `{S.ITEM}` long, `{S.WHOLESALE}` double")
    got = {r[S.ITEM]: (r["Retail_Wholesale_Ratio"], r["Price_Markup"], r["Price_Markup_Pct"]) for r in enrich.add_wholesale(base, quotes).collect()}
    assert got == {1: (1.0, 0.0, 0.0), 2: (1.0, 10.0, 0.0), 3: (2.0, 5.0, 100.0)}
    assert enrich.add_wholesale(base, quotes, dedupe=False).count() == 4


def test_loss_bands_are_right_closed(spark):
    values = [0.0, 5.0, 5.01, 15.0, 25.0, 100.0, 101.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(pricing.loss_band(F.col("v"))).collect()] == [None, "Low", "Medium", "Medium", "High", "Very_High", None, None]


def test_season_rules(spark):
    df = spark.range(1, 13).select(F.col("id").alias("m"))
    plain = [r[0] for r in df.orderBy("m").select(calendar.season(F.col("m"))).collect()]
    shifted = [r[0] for r in df.orderBy("m").select(calendar.season(F.col("m"), "shifted")).collect()]
    assert plain == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]
    assert shifted == ["Spring"] * 2 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"] * 3 + ["Spring"]


def test_row_split_sizes(spark):
    rows = [(D1 + dt.timedelta(days=d), i) for i, n in ((1, 4), (2, 3), (3, 3)) for d in range(n)]
    df = spark.createDataFrame(rows, f"`{S.DATE}` date, `{S.ITEM}` long")
    marked = [r["split"] for r in split.split_by_rows(df).orderBy(S.ITEM, S.DATE).collect()]
    assert marked == ["train"] * 7 + ["validation"] + ["test"] * 2


def test_time_split_keeps_days_together(spark):
    rows = [(D1 + dt.timedelta(days=d), i) for i in (1, 2) for d in range(10)]
    df = split.split_by_time(spark.createDataFrame(rows, f"`{S.DATE}` date, `{S.ITEM}` long"))
    per_day = df.groupBy(S.DATE).agg(F.count_distinct("split").alias("n"))
    assert per_day.agg(F.max("n")).first()[0] == 1
    assert {r[0]: r[1] for r in df.groupBy("split").count().collect()} == {"train": 14, "validation": 4, "test": 2}


def test_labels_are_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], f"`{S.CATEGORY_NAME}` string")
    got = {r[0]: r[1] for r in encode.label_encode(df, S.CATEGORY_NAME, "code").select(c(S.CATEGORY_NAME), "code").collect()}
    assert got == {None: 0, "a": 1, "b": 2, "c": 3}


@pytest.fixture(scope="module")
def table(spark):
    sales = make_sales(spark)
    items = spark.createDataFrame([(1, "x", 10, "leaf"), (2, "y", 10, "leaf"), (3, "z", 20, "root")],
                                  f"`{S.ITEM}` long, `{S.ITEM_NAME}` string, `{S.CATEGORY}` long, `{S.CATEGORY_NAME}` string")
    quotes = sales.where(c(S.ITEM) < 3).select(S.DATE, S.ITEM, (c(S.PRICE) / 2).alias(S.WHOLESALE))
    loss = spark.createDataFrame([(1, 8.0)], f"`{S.ITEM}` long, `{S.LOSS}` double")
    return feature_table(sales, quotes, items, loss).cache()


def test_complete_table(table):
    assert tuple(table.columns) == S.FEATURE_TABLE and len(table.columns) == 105
    assert table.count() == 120 == table.select(S.DATE, S.ITEM).distinct().count()
    filled = [n for n in table.columns if "Target" not in n]
    assert impute.columns_with_gaps(table, filled) == []
    assert table.where(F.col("Avg_Price_Target_1d").isNull()).count() == 3


def test_shares_sum_to_one(table):
    sums = table.groupBy(S.DATE, S.CATEGORY).agg(F.sum("Item_Quantity_Share").alias("s"))
    assert sums.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_loss_takes_category_mean_then_default(table):
    rates = {r[0]: r[1] for r in table.select(S.ITEM, c(S.LOSS)).distinct().collect()}
    assert rates == {1: 8.0, 2: 8.0, 3: 10.0}


def test_absent_tables_leave_out_columns(spark):
    df = feature_table(make_sales(spark, days=3), fill_targets=True)
    assert S.WHOLESALE not in df.columns and "Category_Revenue" not in df.columns and "Season_Summer" in df.columns
