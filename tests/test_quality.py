import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketgrain import schemas as S
from marketgrain.functions.naming import clean_name, clean_name_expr
from marketgrain.operators import quality as Q


def test_clean_table_scores_100(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(20)], f"`{S.ITEM}` long, `{S.PRICE}` double")
    assert Q.quality_score(df, "x").first()["quality_score"] == 100.0


def test_score_by_hand(spark):
    rows = [(1.0, "a")] * 2 + [(-1.0, "b"), (None, "c")]
    df = spark.createDataFrame(rows, "price double, name string")
    row = Q.quality_score(df, "x").first()
    assert row["avg_missing_pct"] == 12.5 and row["duplicate_pct"] == 25.0 and row["avg_negative_pct"] == 12.5
    assert row["quality_score"] == 0.0


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "a long, b string")
    assert tuple(Q.duplicate_rows(df).first()) == (2, 4)


def test_schema_findings(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "`Item Code` int, extra double, `Item Name` string")
    row = Q.check_columns(df, S.RAW_SCHEMAS["items"]).first()
    assert row["missing_columns"] == [S.CATEGORY, S.CATEGORY_NAME] and row["extra_columns"] == ["extra"] and not row["columns_match"]
    assert Q.check_types(df, S.RAW_SCHEMAS["items"]).count() == 0
    wrong = T.StructType([T.StructField("extra", T.LongType())])
    assert tuple(Q.check_types(df, wrong).first()) == ("extra", "bigint", "double")


@pytest.mark.parametrize("name, clean", [
    ("Item Code", "Item_Code"), ("Loss Rate (%)", "Loss_Rate_pct"), ("Wholesale Price (RMB/kg)", "Wholesale_Price_RMB_kg"),
    ("123invalid", "123invalid"), ("__a__b__", "a_b"), ("()", "unnamed_feature"), ("x" * 70, "x" * 64), ("a@b#c", "a_atb_numc"),
])
def test_names(spark, name, clean):
    assert clean_name(name) == clean
    assert spark.range(1).select(clean_name_expr(F.lit(name))).first()[0] == clean


def test_input_errors(spark):
    df = spark.createDataFrame([(-1.0, 5.0, 13, 0), (1.0, 2e6, 1, 7), (1.0, 1.0, 1, 1)], "Avg_Price double, Total_Quantity double, Month int, DayOfWeek int")
    got = [r["errors"] for r in Q.input_errors(df).collect()]
    assert got[0] == ["Negative values found in Avg_Price", "Invalid month values (must be 1-12)"]
    assert got[1] == ["Extreme values found in Total_Quantity", "Invalid day of week values (must be 0-6)"]
    assert got[2] == []


def test_rules(spark):
    sales = spark.createDataFrame([(1, -1.0, "SALE"), (9, 1.0, "return")], f"`{S.ITEM}` long, `{S.QUANTITY}` double, `{S.KIND}` string")
    items = spark.createDataFrame([(1,)], f"`{S.ITEM}` long")
    loss = spark.createDataFrame([(100.0,), (0.0,)], f"`{S.LOSS}` double")
    quotes = spark.createDataFrame([(5.0,)] * 3, f"`{S.WHOLESALE}` double")
    rules = Q.business_rules({"sales": sales, "items": items, "loss_rates": loss, "wholesale": quotes})
    assert [r["passed"] for r in rules.collect()] == [False, True, True, False]
    assert tuple(Q.rule_summary(rules).first()) == (2, 2)
