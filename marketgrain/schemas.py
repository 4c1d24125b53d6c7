"""Column names, raw schemas and the fixed values that decide results."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- column names of the raw tables -------------------------------------------------------------
DATE = "Date"
TIME = "Time"
ITEM = "Item Code"
ITEM_NAME = "Item Name"
CATEGORY = "Category Code"
CATEGORY_NAME = "Category Name"
QUANTITY = "Quantity Sold (kilo)"
PRICE = "Unit Selling Price (RMB/kg)"
KIND = "Sale or Return"
DISCOUNT = "Discount (Yes/No)"
WHOLESALE = "Wholesale Price (RMB/kg)"
LOSS = "Loss Rate (%)"


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


RAW_SCHEMAS: dict[str, T.StructType] = {
    "items": _schema(
        (ITEM, T.LongType()), (ITEM_NAME, T.StringType()), (CATEGORY, T.LongType()), (CATEGORY_NAME, T.StringType())
    ),
    "sales": _schema(
        (DATE, T.StringType()), (TIME, T.StringType()), (ITEM, T.LongType()), (QUANTITY, T.DoubleType()),
        (PRICE, T.DoubleType()), (KIND, T.StringType()), (DISCOUNT, T.StringType()),
    ),
    "wholesale": _schema((DATE, T.StringType()), (ITEM, T.LongType()), (WHOLESALE, T.DoubleType())),
    "loss_rates": _schema((ITEM, T.LongType()), (ITEM_NAME, T.StringType()), (LOSS, T.DoubleType())),
}

RAW_FILES: dict[str, str] = {
    "items": "annex1.csv",
    "sales": "annex2.csv",
    "wholesale": "annex3.csv",
    "loss_rates": "annex4.csv",
}

# ---- steps of the feature table -----------------------------------------------------------------
LAGS = (1, 7, 14, 30)
WINDOWS = (7, 14, 30)
HORIZONS = (1, 7, 14, 30)
LAGGED = ("Avg_Price", "Total_Quantity", "Revenue")

DAILY_COLUMNS = (
    DATE, ITEM, "Total_Quantity", "Avg_Quantity", "Transaction_Count", "Avg_Price", "Price_Volatility", "Min_Price",
    "Max_Price", "Discount_Count", "Revenue", "Discount_Rate", "Price_Range",
)
CALENDAR_COLUMNS = (
    "Year", "Month", "Quarter", "DayOfYear", "DayOfWeek", "WeekOfYear", "IsWeekend", "Month_Sin", "Month_Cos",
    "DayOfYear_Sin", "DayOfYear_Cos", "DayOfWeek_Sin", "DayOfWeek_Cos", "IsNationalDay", "IsLaborDay",
    "Days_Since_Epoch",
)
PRICE_COLUMNS = (
    WHOLESALE, "Retail_Wholesale_Ratio", "Price_Markup", "Price_Markup_Pct", "Avg_Price_Change",
    "Wholesale_Price_Change",
)
CATEGORY_COLUMNS = (
    CATEGORY, CATEGORY_NAME, "Category_Total_Quantity", "Category_Avg_Price", "Category_Revenue",
    "Item_Quantity_Share", "Item_Revenue_Share", "Price_Relative_to_Category",
)
LOSS_COLUMNS = (LOSS, "Effective_Supply", "Loss_Adjusted_Revenue")
LAG_COLUMNS = tuple(f"{c}_Lag_{k}" for k in LAGS for c in LAGGED)
ROLLING_COLUMNS = tuple(
    f"{c}_{k}"
    for k in WINDOWS
    for c in (
        "Avg_Price_MA", "Total_Quantity_MA", "Revenue_MA", "Avg_Price_Std", "Total_Quantity_Std", "Avg_Price_Min",
        "Avg_Price_Max",
    )
)
INTERACTION_COLUMNS = (
    "Price_Quantity_Interaction", "Price_Volatility_Quantity", "Spring_Price", "Summer_Price", "Autumn_Price",
    "Winter_Price", "Holiday_Demand",
)
TARGET_COLUMNS = tuple(
    f"{c}_Target_{h}d" for h in HORIZONS for c in ("Avg_Price", "Price_Change")
) + tuple(f"Quantity_Target_{h}d" for h in HORIZONS)
SEASON_DUMMIES = ("Season_Spring", "Season_Summer", "Season_Winter")
LOSS_DUMMIES = ("Loss_Rate_Category_Medium", "Loss_Rate_Category_High", "Loss_Rate_Category_Very_High")
CATEGORY_ENCODED = f"{CATEGORY_NAME}_Encoded"

#: the 105 columns of the complete feature table, in order
FEATURE_TABLE = (
    DAILY_COLUMNS + CALENDAR_COLUMNS + PRICE_COLUMNS + CATEGORY_COLUMNS + LOSS_COLUMNS + LAG_COLUMNS
    + ROLLING_COLUMNS + INTERACTION_COLUMNS + TARGET_COLUMNS + SEASON_DUMMIES + LOSS_DUMMIES + (CATEGORY_ENCODED,)
)

#: the 90 columns a model is trained on
MODEL_INPUTS = tuple(c for c in FEATURE_TABLE if c not in (DATE, ITEM, CATEGORY_NAME) and "Target" not in c)

# ---- fixed values ---------------------------------------------------------------------------------
SEASONS = ("Spring", "Summer", "Autumn", "Winter")
#: (label, lower bound exclusive, upper bound inclusive)
LOSS_BANDS = (("Low", 0, 5), ("Medium", 5, 15), ("High", 15, 25), ("Very_High", 25, 100))
#: (label, upper bound exclusive); the last band has no upper bound
PRICE_BANDS = (
    ("Low (< 5 RMB)", 5), ("Medium (5-15 RMB)", 15), ("High (15-30 RMB)", 30), ("Premium (> 30 RMB)", None)
)
EPOCH = "2020-01-01"
DEFAULT_LOSS_RATE = 10.0
#: datasets a complete dashboard has, by component
EXPECTED_DATASETS = {
    "overview": 5, "revenue_trends": 3, "category_analysis": 3, "price_analysis": 3, "market_insights": 4,
    "forecasting_features": 3,
}
METRIC_NAMES = ("val_mape", "val_rmse", "val_r2", "test_mape", "test_rmse", "test_r2")
#: limits a model must meet before it may be promoted
GATE_LIMITS = {"mape": 15.0, "rmse": 5.0, "r2": 0.7}
