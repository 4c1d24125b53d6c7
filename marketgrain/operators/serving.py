"""From requests to model inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marketgrain import schemas as S
from marketgrain.functions.calendar import approx_day_of_year, cyclic, is_labor_day, is_national_day, season
from marketgrain.functions.naming import c
from marketgrain.functions.numeric import finite, flag, is_numeric
from marketgrain.functions.pricing import effective_supply

# fixed values: defaults of the nineteen request fields
REQUEST_DEFAULTS: dict[str, float | int] = {
    "Total_Quantity": 100.0, "Avg_Price": 15.0, "Transaction_Count": 10, "Price_Volatility": 1.0, "Min_Price": 12.0,
    "Max_Price": 18.0, "Discount_Count": 2, "Revenue": 1500.0, "Discount_Rate": 0.1, "Price_Range": 6.0,
    S.WHOLESALE: 12.0, S.LOSS: 8.0, "Month": 6, "DayOfWeek": 1, "IsWeekend": 0, "Year": 2024, "Quarter": 2,
    "DayOfYear": 180, "WeekOfYear": 26,
}
# fixed values: names of request fields that differ from the feature names
REQUEST_NAMES = {"Wholesale_Price": S.WHOLESALE, "Loss_Rate": S.LOSS, "Category_Code": S.CATEGORY, "Item_Code": S.ITEM}
# fixed values: means of the random factors that stand in for a missing history
CATEGORY_QUANTITY_FACTOR, CATEGORY_CODE = 4.5, 2
PRICE_CHANGE, WHOLESALE_CHANGE = 0.02, 0.015
# fixed values: optional fields as a share of the average price, and their constants
PRICE_SHARES = {"Min_Price": 0.85, "Max_Price": 1.15, "Wholesale_Price": 0.75}
CONSTANT_DEFAULTS = {"Price_Volatility": 1.0, "Discount_Count": 2, "Loss_Rate": 8.5, "Category_Code": 1, "Item_Code": 101}

_FIRST = S.DAILY_COLUMNS[2:] + (S.WHOLESALE, S.LOSS) + S.CALENDAR_COLUMNS + S.PRICE_COLUMNS[1:] + S.LAG_COLUMNS + S.ROLLING_COLUMNS
_REST = (S.CATEGORY,) + S.CATEGORY_COLUMNS[2:] + S.LOSS_COLUMNS[1:] + S.INTERACTION_COLUMNS + S.SEASON_DUMMIES + S.LOSS_DUMMIES
#: order of the inputs that the service sends to a model
SERVING_ORDER = _FIRST + _REST + (S.CATEGORY_ENCODED,)


def rename_fields(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(REQUEST_NAMES)


def field_defaults(df: DataFrame) -> DataFrame:
    """Optional request fields: shares of the average price, or constants."""
    have = set(df.columns)

    def filled(name: str, default: Column) -> Column:
        return F.coalesce(c(name), default) if name in have else default

    columns = {n: filled(n, F.col("Avg_Price") * k) for n, k in PRICE_SHARES.items()}
    columns |= {n: filled(n, F.lit(v)) for n, v in CONSTANT_DEFAULTS.items()}
    return df.withColumns(columns)


def field_errors(df: DataFrame) -> DataFrame:
    """Every request with the list of fields outside their allowed range."""
    positive = ("Total_Quantity", "Avg_Price", "Transaction_Count", "Min_Price", "Max_Price", "Wholesale_Price")
    checks: dict[str, Column] = {n: c(n) > 0 for n in positive if n in df.columns}
    ranges = {"Month": (1, 12), "DayOfWeek": (0, 6), "IsWeekend": (0, 1), "Loss_Rate": (0, 100)}
    checks |= {n: c(n).between(*r) for n, r in ranges.items() if n in df.columns}
    checks |= {n: c(n) >= 0 for n in ("Price_Volatility", "Discount_Count") if n in df.columns}
    checks |= {n: c(n) >= 1 for n in ("Category_Code", "Item_Code") if n in df.columns}
    required = {"Total_Quantity", "Avg_Price", "Transaction_Count", "Month", "DayOfWeek", "IsWeekend"}
    bad = [F.when(~F.coalesce(ok, F.lit(n not in required)), F.lit(n)) for n, ok in checks.items()]
    return df.withColumn("invalid_fields", F.array_compact(F.array(*bad)))


def derive_missing(df: DataFrame) -> DataFrame:
    """Derived columns, each only if the table lacks it and has what it is made of."""
    have = set(df.columns)
    count = F.greatest(F.col("Transaction_Count"), F.lit(1)) if "Transaction_Count" in have else None
    options: dict[str, tuple[tuple[str, ...], Column | None]] = {
        "Revenue": (("Total_Quantity", "Avg_Price"), F.col("Total_Quantity") * F.col("Avg_Price")),
        "Discount_Rate": (("Discount_Count", "Transaction_Count"), F.col("Discount_Count") / count if count is not None else None),
        "Price_Range": (("Max_Price", "Min_Price"), F.col("Max_Price") - F.col("Min_Price")),
        "Avg_Quantity": (("Total_Quantity", "Transaction_Count"), F.col("Total_Quantity") / count if count is not None else None),
        "Quarter": (("Month",), F.floor((F.col("Month") - 1) / 3) + 1),
        "DayOfYear": (("Month",), approx_day_of_year(F.col("Month"))),
    }
    columns = {n: col for n, (needs, col) in options.items() if n not in have and have.issuperset(needs)}
    if "Discount_Rate" not in have and "Discount_Rate" not in columns:
        columns["Discount_Rate"] = F.lit(0.0)
    df = df.withColumns(columns) if columns else df
    have = set(df.columns)
    waves: dict[str, Column] = {}
    for name, period in (("Month", 12), ("DayOfWeek", 7), ("DayOfYear", 365)):
        if name in have:
            waves[f"{name}_Sin"], waves[f"{name}_Cos"] = cyclic(F.col(name), period)
    if "DayOfYear" in have:
        waves["WeekOfYear"] = F.floor(F.col("DayOfYear") / 7) + 1
    waves = {n: col for n, col in waves.items() if n not in have}
    return df.withColumns(waves) if waves else df


def with_required(df: DataFrame, names: Sequence[str] = S.MODEL_INPUTS) -> DataFrame:
    """Add the inputs that are absent: ratios as 1, everything else as 0."""
    absent = [n for n in names if n not in df.columns]
    cyclic_name = ("Sin", "Cos")
    fills = {
        n: F.lit(1.0 if ("Ratio" in n or "Relative" in n) and not any(w in n for w in cyclic_name) else 0.0) for n in absent
    }
    return df.withColumns(fills) if fills else df


def select_inputs(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Inputs in the given order, then the other numeric columns; ids and names are left out."""
    skip = {S.DATE, S.ITEM, S.CATEGORY_NAME, S.CATEGORY, S.ITEM_NAME, "DateTime", S.TIME}
    numbers = [f.name for f in df.schema.fields if f.name not in skip and is_numeric(f.dataType)]
    wanted = [n for n in names or () if n in df.columns and n not in skip]
    return df.select(*[c(n) for n in [*wanted, *[n for n in numbers if n not in wanted]]])


def expand(df: DataFrame, keep: Sequence[str] = (), cumulative_bands: bool = True) -> DataFrame:
    """Nineteen request fields to the ninety inputs, as one projection.

    History that a request cannot know takes the mean of the random factors the source used: lags and means
    equal today's value, the category sells 4.5 times the item. ``cumulative_bands`` marks a very high loss as
    high too, as the service does; training marks one band.
    """
    given = set(df.columns)
    base = {
        n: F.coalesce(c(n).cast("double"), F.lit(float(v))) if n in given else F.lit(float(v))
        for n, v in REQUEST_DEFAULTS.items()
    }
    df = df.select(*[c(n) for n in keep], *[v.alias(n) for n, v in base.items()])
    price, quantity, count = F.col("Avg_Price"), F.col("Total_Quantity"), F.greatest(F.col("Transaction_Count"), F.lit(1.0))
    derived: dict[str, Column] = {"Avg_Quantity": quantity / count, S.CATEGORY: F.lit(1.0)}
    if "Revenue" not in given:
        derived["Revenue"] = quantity * price
    if "Price_Range" not in given:
        derived["Price_Range"] = F.col("Max_Price") - F.col("Min_Price")
    if "Discount_Rate" not in given:
        derived["Discount_Rate"] = F.col("Discount_Count") / count
    for name, period in (("Month", 12), ("DayOfYear", 365), ("DayOfWeek", 7)):
        derived[f"{name}_Sin"], derived[f"{name}_Cos"] = cyclic(F.col(name), period)
    month, doy = F.col("Month"), F.col("DayOfYear")
    derived["IsNationalDay"], derived["IsLaborDay"] = is_national_day(month, doy), is_labor_day(month, doy)
    # the day of the year is read as a day of 2024
    derived["Days_Since_Epoch"] = F.datediff(F.lit("2024-01-01").cast("date"), F.lit(S.EPOCH).cast("date")) + doy - 1
    quote = F.greatest(c(S.WHOLESALE), F.lit(0.1))
    derived["Retail_Wholesale_Ratio"] = price / quote
    derived["Price_Markup"] = price - c(S.WHOLESALE)
    derived["Price_Markup_Pct"] = (price - c(S.WHOLESALE)) / quote * 100
    derived["Avg_Price_Change"], derived["Wholesale_Price_Change"] = F.lit(PRICE_CHANGE), F.lit(WHOLESALE_CHANGE)
    for k in S.LAGS:
        derived |= {f"Avg_Price_Lag_{k}": price, f"Total_Quantity_Lag_{k}": quantity, f"Revenue_Lag_{k}": price * quantity}
    for k in S.WINDOWS:
        derived |= {
            f"Avg_Price_MA_{k}": price, f"Total_Quantity_MA_{k}": quantity, f"Revenue_MA_{k}": price * quantity,
            f"Avg_Price_Std_{k}": F.col("Price_Volatility"), f"Total_Quantity_Std_{k}": quantity * 0.1,
            f"Avg_Price_Min_{k}": F.col("Min_Price"), f"Avg_Price_Max_{k}": F.col("Max_Price"),
        }
    df = df.withColumns(derived).withColumn("Season", F.coalesce(season(F.col("Month").cast("int")), F.lit("Summer")))
    rate, supply = c(S.LOSS), effective_supply(quantity, c(S.LOSS))
    category_quantity = quantity * CATEGORY_QUANTITY_FACTOR
    very_high = rate > 25
    final: dict[str, Column] = {
        "Category_Total_Quantity": category_quantity,
        "Category_Avg_Price": price,
        "Category_Revenue": category_quantity * price,
        "Item_Quantity_Share": quantity / F.greatest(category_quantity, F.lit(1.0)),
        "Item_Revenue_Share": F.col("Revenue") / F.greatest(category_quantity * price, F.lit(1.0)),
        "Price_Relative_to_Category": price / F.greatest(price, F.lit(0.1)),
        S.CATEGORY_ENCODED: F.lit(CATEGORY_CODE),
        "Effective_Supply": supply,
        "Loss_Adjusted_Revenue": supply * price,
        "Loss_Rate_Category_Medium": flag((rate > 5) & (rate <= 15)),
        "Loss_Rate_Category_High": flag(rate > 15) if cumulative_bands else flag((rate > 15) & ~very_high),
        "Loss_Rate_Category_Very_High": flag(very_high),
        "Price_Quantity_Interaction": price * quantity,
        "Price_Volatility_Quantity": F.col("Price_Volatility") * quantity,
        "Holiday_Demand": quantity * (F.col("IsNationalDay") + F.col("IsLaborDay")),
    }
    final |= {f"{s}_Price": price * flag(F.col("Season") == s) for s in S.SEASONS}
    final |= {d: flag(F.col("Season") == d.removeprefix("Season_")) for d in S.SEASON_DUMMIES}
    df = df.withColumns(final)
    return df.select(
        *[c(n) for n in keep], *[F.coalesce(finite(c(n)), F.lit(0.0)).alias(n) for n in SERVING_ORDER]
    )


def with_history(requests: DataFrame, features: DataFrame, key: str = S.ITEM) -> DataFrame:
    """Requests joined with the newest history row of their item, instead of stand-in values."""
    names = [n for n in S.LAG_COLUMNS + S.ROLLING_COLUMNS + S.CATEGORY_COLUMNS[2:5] if n in features.columns]
    newest = features.groupBy(key).agg(F.max_by(F.struct(*[c(n) for n in names]), c(S.DATE)).alias("_h"))
    kept = [n for n in requests.columns if n not in names]
    return requests.select(*[c(n) for n in kept]).join(newest, key, "left").select(
        *[c(n) for n in kept], *[F.col("_h").getField(n).alias(n) for n in names]
    )


# ---- payloads -------------------------------------------------------------------------------------------
def payload_schema(fields: dict[str, str]) -> str:
    return ", ".join(f"`{n}` {k}" for n, k in fields.items())


def parse_payloads(df: DataFrame, body: str, fields: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """JSON bodies of any accepted form to one row per instance.

    Forms: ``{"instances": [...]}``, ``{"features": {...}}``, a bare object, a bare list.
    """
    one = payload_schema(fields)
    inner = ", ".join(f"`{n}`: {k}" for n, k in fields.items())
    text = F.trim(F.col(body))
    wrapped = F.from_json(text, f"instances array<struct<{inner}>>, features struct<{inner}>")
    rows = (
        F.when(text.startswith("["), F.from_json(text, f"array<struct<{inner}>>"))
        .when(wrapped["instances"].isNotNull(), wrapped["instances"])
        .when(wrapped["features"].isNotNull(), F.array(wrapped["features"]))
        .otherwise(F.array(F.from_json(text, one)))
    )
    return df.select(*[c(n) for n in keep], F.explode(rows).alias("_r")).select(*[c(n) for n in keep], "_r.*")


def parse_csv_payloads(df: DataFrame, body: str, fields: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """CSV bodies with a header line, in the order of ``fields``."""
    lines = F.filter(F.slice(F.split(F.col(body), "\r?\n"), 2, 1 << 30), lambda x: F.trim(x) != "")
    rows = df.select(*[c(n) for n in keep], F.explode(lines).alias("_l"))
    return rows.select(*[c(n) for n in keep], F.from_csv("_l", payload_schema(fields)).alias("_r")).select(
        *[c(n) for n in keep], "_r.*"
    )
