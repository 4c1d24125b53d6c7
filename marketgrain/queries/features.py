"""Queries over sales records and the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketgrain import schemas as S
from marketgrain.functions import calendar as cal
from marketgrain.functions import pricing
from marketgrain.functions.naming import c
from marketgrain.functions.numeric import ratio, safe_bool, safe_float, to_number
from marketgrain.functions.order_stats import quantile
from marketgrain.operators import daily as D
from marketgrain.operators import encode, enrich, impute, series, split
from marketgrain.plans.features import feature_table, raw_features
from marketgrain.queries.base import BAND_SQL, SEASON_SQL, query, r, rounded_column

KEY = (S.DATE, S.ITEM)


def keyed(df, *names):
    return df.select(*[c(n) for n in (*KEY, *names)])


def lower(names) -> str:
    return " ".join(n.lower() for n in names)


DAILY_SQL = (
    "sale_date, item_code, transaction_count, discount_count, "
    + r("total_quantity avg_quantity avg_price price_volatility min_price max_price discount_rate price_range")
    + ", r2(revenue) as revenue"
)


@query("s2_coerce_date", """
    select d as sale_date_text, cast(d as date) as parsed, count(*) as n
    from (select case when sale_id % 50 = 0 then null else cast(sale_date as varchar) end as d from sales) t
    group by d, cast(d as date)""")
def coerce_date(t):
    text = F.when(F.col("sale_id") % 50 == 0, "no date").otherwise(c(S.DATE).cast("string"))
    df = t.sales.select(text.alias("d")).withColumn("parsed", cal.parse_date(F.col("d")))
    shown = F.when(F.col("parsed").isNotNull(), F.col("d"))
    return df.groupBy(shown.alias("sale_date_text"), "parsed").agg(F.count(F.lit(1)).alias("n"))


@query("s3_date_and_time", """
    select ts as sale_time, count(*) as n
    from (select cast(strftime(ts, '%Y-%m-%d %H:%M:%S') as timestamp) as ts from events) t group by ts""")
def date_and_time(t):
    text = t.raw("events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("d"), F.date_format("ts", "HH:mm:ss").alias("h")
    )
    moment = cal.parse_datetime(F.col("d"), F.col("h")).cast("timestamp_ntz")
    return text.groupBy(moment.alias("sale_time")).agg(F.count(F.lit(1)).alias("n"))


@query("a1_daily_aggregate", f"select {DAILY_SQL} from daily", revenue=2)
def daily_aggregate(t):
    return t.daily


@query("p1_sale_filter", """
    select item_code, count(*) as rows_kept from sales
    where lower(sale_or_return) = 'sale' and sale_date is not null group by item_code""")
def sale_filter(t):
    return D.sale_rows(t.sales).groupBy(S.ITEM).agg(F.count(F.lit(1)).alias("rows_kept"))


@query("p2_calendar", """
    select distinct sale_date, year, month, quarter, dayofyear, dayofweek, weekofyear, isweekend from calendar""")
def calendar(t):
    parts = cal.calendar_columns(c(S.DATE))
    names = ("Year", "Month", "Quarter", "DayOfYear", "DayOfWeek", "WeekOfYear", "IsWeekend")
    return D.sale_rows(t.sales).select(S.DATE).distinct().select(S.DATE, *[parts[n].alias(n) for n in names])


_CYCLIC = ("Month_Sin", "Month_Cos", "DayOfYear_Sin", "DayOfYear_Cos", "DayOfWeek_Sin", "DayOfWeek_Cos")


@query("p3_cyclic", f"select distinct sale_date, {r(lower(_CYCLIC), 6)} from calendar", digits=6)
def cyclic(t):
    parts = cal.calendar_columns(c(S.DATE))
    return D.sale_rows(t.sales).select(S.DATE).distinct().select(S.DATE, *[parts[n].alias(n) for n in _CYCLIC])


@query("p4_holidays", """
    select sale_date, item_code, isnationalday, islaborday, r4(total_quantity) as total_quantity
    from calendar where isnationalday + islaborday > 0""")
def holidays(t):
    df = D.add_calendar(t.daily).where(F.col("IsNationalDay") + F.col("IsLaborDay") > 0)
    return keyed(df, "IsNationalDay", "IsLaborDay", "Total_Quantity")


@query("p5_season_shifted", """
    select season, count(*) as n, r2(sum(total_quantity)) as total_quantity
    from (select total_quantity, case when month(sale_date) in (12, 1, 2) then 'Spring'
                 when month(sale_date) in (3, 4, 5) then 'Summer' when month(sale_date) in (6, 7, 8) then 'Autumn'
                 else 'Winter' end as season from daily) t group by season""", digits=2)
def season_shifted(t):
    label = cal.season(F.month(c(S.DATE)), "shifted")
    return t.daily.groupBy(label.alias("season")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("Total_Quantity").alias("total_quantity")
    )


@query("p6_season", f"""
    select season, count(*) as n, r2(sum(total_quantity)) as total_quantity
    from (select total_quantity, {SEASON_SQL.format(m="month(sale_date)")} as season from daily) t
    group by season""", digits=2)
def season(t):
    return t.daily.groupBy(cal.season(F.month(c(S.DATE))).alias("season")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("Total_Quantity").alias("total_quantity")
    )


@query("p7_days_since_epoch", "select distinct sale_date, days_since_epoch from calendar")
def days_since_epoch(t):
    day = cal.calendar_columns(c(S.DATE))["Days_Since_Epoch"]
    return D.sale_rows(t.sales).select(S.DATE).distinct().select(S.DATE, day.alias("days_since_epoch"))


_PRICE = "wholesale_price retail_wholesale_ratio price_markup price_markup_pct"


@query("p8_price_ratio_markup", f"select sale_date, item_code, {r(_PRICE)} from priced")
def price_ratio(t):
    df = enrich.add_wholesale(t.daily, t.quotes)
    return keyed(df, S.WHOLESALE, "Retail_Wholesale_Ratio", "Price_Markup", "Price_Markup_Pct")


@query("j1_daily_left_wholesale", """
    select d.sale_date, d.item_code, r4(d.avg_price) as avg_price, r4(w.wholesale_price) as wholesale_price
    from daily d left join wholesale w on d.sale_date = w.sale_date and d.item_code = w.item_code""")
def daily_left_wholesale(t):
    return keyed(t.daily.join(t.wholesale, list(KEY), "left"), "Avg_Price", S.WHOLESALE)


@query("j1_fan_out", """
    select d.sale_date, d.item_code, count(*) as copies, r4(min(w.wholesale_price)) as lowest_quote
    from daily d left join quotes w on d.sale_date = w.sale_date and d.item_code = w.item_code
    group by d.sale_date, d.item_code""")
def fan_out(t):
    df = enrich.add_wholesale(t.daily, t.quotes, dedupe=False)
    return df.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"), F.min(c(S.WHOLESALE)).alias("lowest_quote"))


@query("j2_daily_left_items", """
    select d.sale_date, d.item_code, i.category_code, i.category_name, r4(d.total_quantity) as total_quantity
    from daily d left join items i on d.item_code = i.item_code""")
def daily_left_items(t):
    return keyed(enrich.add_category(t.daily, t.items), S.CATEGORY, S.CATEGORY_NAME, "Total_Quantity")


_CAT = "category_total_quantity category_avg_price"
_CAT_COLUMNS = ("Category_Total_Quantity", "Category_Avg_Price", "Category_Revenue")


@query("j3_category_totals_on_rows", f"""
    select sale_date, item_code, {r(_CAT)}, r2(category_revenue) as category_revenue from categorised""",
       category_revenue=2)
def category_totals_on_rows(t):
    df = enrich.add_category_shares(enrich.add_category(t.daily, t.items))
    return keyed(df, *_CAT_COLUMNS)


@query("a2_category_day_totals", f"""
    select sale_date, category_code, r4(sum(total_quantity)) as category_total_quantity,
           r4(avg(avg_price)) as category_avg_price, r2(sum(revenue)) as category_revenue
    from daily d join items i on d.item_code = i.item_code group by sale_date, category_code""", category_revenue=2)
def category_day_totals(t):
    return enrich.category_day_totals(enrich.add_category(t.daily, t.items))


_SHARES = ("Item_Quantity_Share", "Item_Revenue_Share", "Price_Relative_to_Category")


@query("w5_category_shares", f"select sale_date, item_code, {r(lower(_SHARES), 6)} from categorised", digits=6)
def category_shares(t):
    return keyed(enrich.add_category_shares(enrich.add_category(t.daily, t.items)), *_SHARES)


def _with_loss(t):
    return enrich.add_loss(enrich.add_category(t.daily, t.items), t.loss_rates)


@query("j4_daily_left_loss", """
    select d.sale_date, d.item_code, r4(l.loss_rate) as loss_rate
    from daily d left join loss_rates l on d.item_code = l.item_code""")
def daily_left_loss(t):
    return keyed(t.daily.join(t.loss_rates, S.ITEM, "left"), S.LOSS)


@query("j5_category_mean_loss", """
    select category_code, r4(avg(loss_rate)) as mean_loss, count(*) as n
    from daily d left join items i on d.item_code = i.item_code left join loss_rates l on d.item_code = l.item_code
    group by category_code""")
def category_mean_loss(t):
    df = enrich.add_category(t.daily, t.items).join(t.loss_rates.select(S.ITEM, S.LOSS), S.ITEM, "left")
    return df.groupBy(S.CATEGORY).agg(F.avg(c(S.LOSS)).alias("mean_loss"), F.count(F.lit(1)).alias("n"))


@query("i3_loss_fill", "select sale_date, item_code, r4(loss_rate) as loss_rate from lossy")
def loss_fill(t):
    return keyed(_with_loss(t), S.LOSS)


@query("p9_loss_adjusted", """
    select sale_date, item_code, r4(effective_supply) as effective_supply,
           r2(loss_adjusted_revenue) as loss_adjusted_revenue from lossy""", loss_adjusted_revenue=2)
def loss_adjusted(t):
    return keyed(_with_loss(t), "Effective_Supply", "Loss_Adjusted_Revenue")


@query("p10_loss_band", f"""
    select item_code, {BAND_SQL.format(x="loss_rate")} as band, count(*) as n
    from (select d.item_code, l.loss_rate from daily d left join loss_rates l on d.item_code = l.item_code) t
    group by item_code, {BAND_SQL.format(x="loss_rate")}""")
def loss_band(t):
    df = t.daily.join(t.loss_rates, S.ITEM, "left")
    return df.groupBy(S.ITEM, pricing.loss_band(c(S.LOSS)).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("p11_interactions", f"""
    select sale_date, item_code, {r("price_quantity_interaction price_volatility_quantity holiday_demand", 2)},
           {r("spring_price summer_price autumn_price winter_price", 4)}
    from features""", price_quantity_interaction=2, price_volatility_quantity=2, holiday_demand=2)
def interactions(t):
    df = enrich.add_interactions(enrich.add_season(D.add_calendar(t.daily)))
    return keyed(df, *S.INTERACTION_COLUMNS)


@query("p12_row_revenue", """
    select item_code, r2(sum(quantity * unit_price)) as gross_sales from sales group by item_code""", digits=2)
def row_revenue(t):
    return D.with_gross_sales(t.sales).groupBy(S.ITEM).agg(F.sum("gross_sales").alias("gross_sales"))


@query("p13_price_band", """
    select case when avg_price < 5 then 'Low (< 5 RMB)' when avg_price < 15 then 'Medium (5-15 RMB)'
                when avg_price < 30 then 'High (15-30 RMB)' else 'Premium (> 30 RMB)' end as price_range,
           count(*) as n from daily where avg_price is not null group by 1""")
def price_band(t):
    priced = t.daily.where(F.col("Avg_Price").isNotNull())
    return priced.groupBy(pricing.price_band(F.col("Avg_Price")).alias("price_range")).agg(F.count(F.lit(1)).alias("n"))


@query("p14_day_type", """
    select case when isweekend = 1 then 'Weekend' else 'Weekday' end as day_type, count(*) as n
    from calendar group by 1""")
def day_type(t):
    df = D.add_calendar(t.daily)
    return df.groupBy(cal.day_type(F.col("IsWeekend")).alias("day_type")).agg(F.count(F.lit(1)).alias("n"))


@query("p15_period_text", """
    select distinct cast(year as varchar) || '-' || lpad(cast(month as varchar), 2, '0') || '-01' as period_start,
           cast(year as varchar) || '-' || lpad(cast(month as varchar), 2, '0') || '-28' as period_end
    from calendar""")
def period_text(t):
    month, year = F.month(c(S.DATE)), F.year(c(S.DATE))
    months = t.daily.select(year.alias("y"), month.alias("m")).distinct()
    text = {n: cal.period_text(F.col("y"), F.col("m"), d) for n, d in (("period_start", "01"), ("period_end", "28"))}
    return months.withColumns(text).drop("y", "m")


@query("p16_first_of_month", """
    select make_date(year, month, 1) as month_date, count(*) as n from calendar group by 1""")
def first_of_month(t):
    day = cal.first_of_month(F.year(c(S.DATE)), F.month(c(S.DATE)))
    return t.daily.groupBy(day.alias("month_date")).agg(F.count(F.lit(1)).alias("n"))


@query("p17_hour", "select hour(ts) as hour, count(*) as n from events group by 1")
def hour(t):
    return t.raw("events").groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@query("p18_month_period", """
    select cast(date_trunc('month', sale_date) as date) as month, strftime(sale_date, '%Y-%m') as period,
           count(*) as n from sales group by 1, 2""")
def month_period(t):
    return t.sales.groupBy(
        F.trunc(c(S.DATE), "MM").alias("month"), F.date_format(c(S.DATE), "yyyy-MM").alias("period")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("p19_log_quantity", """
    select r4(log10(quantity + 1)) as log_quantity, count(*) as n from sales
    where quantity > 0 and quantity < (select quantile_cont(quantity, 0.95) from sales) group by 1""")
def log_quantity(t):
    quantity = c(S.QUANTITY)
    kept = t.sales.where((quantity > 0) & (quantity < quantile(t.sales, S.QUANTITY, 0.95)))
    return kept.groupBy(rounded_column(F.log10(quantity + 1), 4).alias("log_quantity")).agg(F.count(F.lit(1)).alias("n"))


@query("p20_numeric_coercion", """
    select event_type, count(*) as n, count(try_cast(json_extract_string(props, '$.k') as double)) as numbers,
           r2(sum(try_cast(json_extract_string(props, '$.k') as double))) as total,
           cast(floor(min(epoch(ts))) as bigint) as first_second
    from events group by event_type""", digits=2)
def numeric_coercion(t):
    events = t.raw("events").withColumn("k", F.get_json_object("props", "$.k"))
    kinds = {f.name: f.dataType for f in events.schema.fields}
    df = events.select("event_type", to_number(F.col("k"), kinds["k"]).alias("k"), to_number(F.col("ts"), kinds["ts"]).alias("ts"))
    return df.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("k").alias("numbers"), F.sum("k").alias("total"),
        F.floor(F.min("ts")).alias("first_second"),
    )


@query("p31_safe_values", """
    select event_type, r2(sum(coalesce(try_cast(case when event_id % 11 = 0 then 'bad' else cast(value as varchar) end
           as double), 0))) as total, cast(count_if(coalesce(user_id % 3 = 0, false)) as bigint) as yes
    from events group by event_type""", digits=2)
def safe_values(t):
    text = F.when(F.col("event_id") % 11 == 0, "bad").otherwise(F.col("value").cast("string"))
    flag = safe_bool((F.col("user_id") % 3 == 0).cast("string"))
    df = t.raw("events").select("event_type", safe_float(text).alias("v"), flag.alias("f"))
    return df.groupBy("event_type").agg(F.sum("v").alias("total"), F.count_if("f").alias("yes"))


@query("p32_json_field", """
    select cast(json_extract_string(props, '$.k') as bigint) as k, count(*) as n from events group by 1""")
def json_field(t):
    k = F.from_json("props", "k long").getField("k")
    return t.raw("events").groupBy(k.alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("w1_lags", f"select sale_date, item_code, {r(lower(S.LAG_COLUMNS), 3)} from features", digits=3)
def lags(t):
    return keyed(series.add_lags(t.daily), *S.LAG_COLUMNS)


@query("w2_rolling", f"select sale_date, item_code, {r(lower(S.ROLLING_COLUMNS), 3)} from features", digits=3)
def rolling(t):
    return keyed(series.add_rolling(t.daily), *S.ROLLING_COLUMNS)


@query("w3_targets", f"select sale_date, item_code, {r(lower(S.TARGET_COLUMNS), 3)} from features", digits=3)
def targets(t):
    return keyed(series.add_targets(t.daily), *S.TARGET_COLUMNS)


@query("w4_price_changes", f"""
    select sale_date, item_code, {r("avg_price_change wholesale_price_change")} from features""")
def price_changes(t):
    df = t.daily.join(t.wholesale, list(KEY), "left")
    changes = {"Avg_Price": "Avg_Price_Change", S.WHOLESALE: "Wholesale_Price_Change"}
    return keyed(series.add_changes(df, changes), *changes.values())


_FFILL = "last_value({x} ignore nulls) over (partition by item_code order by sale_date {d} rows between unbounded preceding and current row)"


@query("w6_forward_fill", f"""
    select sale_date, item_code, r4({_FFILL.format(x="wholesale_price", d="")}) as wholesale_price from priced""")
def forward_fill(t):
    return keyed(series.forward_fill(t.daily.join(t.wholesale, list(KEY), "left"), [S.WHOLESALE]), S.WHOLESALE)


@query("w7_backward_fill", f"""
    select sale_date, item_code, r4({_FFILL.format(x="wholesale_price", d="desc")}) as wholesale_price from priced""")
def backward_fill(t):
    return keyed(series.backward_fill(t.daily.join(t.wholesale, list(KEY), "left"), [S.WHOLESALE]), S.WHOLESALE)


@query("w8_row_split", """
    select sale_date, item_code, case when rn < floor(n * 0.7) then 'train' when rn < floor(n * 0.85) then 'validation'
           else 'test' end as split
    from (select sale_date, item_code, row_number() over (order by item_code, sale_date) - 1 as rn,
                 count(*) over () as n from daily) t""")
def row_split(t):
    return keyed(split.split_by_rows(t.daily), "split")


@query("w8_time_split", """
    select sale_date, case when before < floor(n * 0.7) then 'train' when before < floor(n * 0.85) then 'validation'
           else 'test' end as split, row_count
    from (select sale_date, c as row_count, sum(c) over (order by sale_date) - c as before, sum(c) over () as n
          from (select sale_date, count(*) as c from daily group by sale_date) x) t""")
def time_split(t):
    return split.split_by_time(t.daily).groupBy(S.DATE, "split").agg(F.count(F.lit(1)).alias("row_count"))


@query("o1_sort", f"select {DAILY_SQL} from daily order by item_code, sale_date", revenue=2)
def sort(t):
    return t.daily.orderBy(S.ITEM, S.DATE)


@query("o2_top_k", """
    select sale_date, item_code, r2(revenue) as revenue from daily
    order by revenue desc, sale_date, item_code limit 20""", digits=2)
def top_k(t):
    return keyed(t.daily, "Revenue").orderBy(F.desc("Revenue"), S.DATE, S.ITEM).limit(20)


@query("o3_sample", """
    select sale_id, item_code, sale_date, r4(quantity) as quantity, r4(unit_price) as unit_price from sales
    order by md5(cast(sale_id as varchar)), sale_id, sale_date, unit_price, quantity, item_code limit 5000""")
def sample(t):
    key = F.md5(F.col("sale_id").cast("string"))
    rows = t.sales.select("sale_id", S.ITEM, S.DATE, S.QUANTITY, S.PRICE)
    return rows.orderBy(key, "sale_id", S.DATE, c(S.PRICE), c(S.QUANTITY), S.ITEM).limit(5000)


@query("o4_union", """
    select 'sales' as source, item_code, count(*) as n from sales group by item_code
    union all select 'wholesale', item_code, count(*) from wholesale group by item_code""")
def union(t):
    def counts(df, name):
        return df.groupBy(S.ITEM).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("source"), S.ITEM, "n")

    return counts(t.sales, "sales").unionByName(counts(t.wholesale, "wholesale"))


@query("o5_key_sets", """
    select 'both' as part, item_code from (select item_code from sales intersect select item_code from loss_rates) a
    union all
    select 'sales_only', item_code from (select item_code from sales except select item_code from loss_rates) b""")
def key_sets(t):
    left, right = t.sales.select(S.ITEM), t.loss_rates.select(S.ITEM)
    both = left.intersect(right).select(F.lit("both").alias("part"), S.ITEM)
    return both.unionByName(left.subtract(right).select(F.lit("sales_only").alias("part"), S.ITEM))


@query("o6_pivot_category_season", f"""
    select category_name, {", ".join(f"r2(coalesce(sum(case when season = '{s}' then revenue end), 0)) as {s.lower()}" for s in S.SEASONS)}
    from calendar d join items i on d.item_code = i.item_code group by category_name""", digits=2)
def pivot_category_season(t):
    from marketgrain.operators.bi import category_seasonality

    return category_seasonality(_bi(t))


def _bi(t):
    return enrich.add_season(D.add_calendar(enrich.add_category(t.daily, t.items)))


@query("o7_drop_missing_target", """
    select item_code, count(*) as n from features where avg_price_target_1d is not null group by item_code""")
def drop_missing_target(t):
    df = series.add_targets(t.daily).na.drop(subset=["Avg_Price_Target_1d"])
    return df.groupBy(S.ITEM).agg(F.count(F.lit(1)).alias("n"))


_HOT = ", ".join(
    [f"cast(case when season = '{x}' then 1 else 0 end as bigint) as season_{x.lower()}" for x in ("Spring", "Summer", "Winter")]
    + [f"cast(case when loss_rate_category = '{x}' then 1 else 0 end as bigint) as loss_rate_category_{x.lower()}"
       for x in ("Medium", "High", "Very_High")]
)


@query("o8_one_hot", f"select sale_date, item_code, {_HOT} from lossy")
def one_hot(t):
    df = enrich.add_season(D.add_calendar(_with_loss(t)))
    df = encode.one_hot(df, "Season", ["Spring", "Summer", "Winter"])
    df = encode.one_hot(df, "Loss_Rate_Category", ["Medium", "High", "Very_High"])
    return keyed(df, *S.SEASON_DUMMIES, *S.LOSS_DUMMIES)


@query("o9_label_encode", """
    select d.sale_date, d.item_code, i.category_name, k.code as category_name_encoded
    from daily d join items i on d.item_code = i.item_code
    join (select category_name, dense_rank() over (order by category_name) - 1 as code
          from (select distinct category_name from items) x) k on i.category_name = k.category_name""")
def label_encode(t):
    df = encode.label_encode(enrich.add_category(t.daily, t.items), S.CATEGORY_NAME, S.CATEGORY_ENCODED, t.items)
    return keyed(df, S.CATEGORY_NAME, S.CATEGORY_ENCODED)


_I1 = "wholesale_price avg_price_lag_7 avg_price_std_7 wholesale_price_change"


@query("i1_series_fill", f"""
    with f as (select sale_date, item_code, {", ".join(
        f"coalesce({_FFILL.format(x=x, d='')}, first_value({x} ignore nulls) over (partition by item_code order by sale_date "
        f"rows between unbounded preceding and unbounded following)) as {x}" for x in _I1.split())}
        from features)
    select sale_date, item_code, {", ".join(
        f"r3(coalesce({x}, (select quantile_cont({x}, 0.5) from f))) as {x}" for x in _I1.split())} from f""", digits=3)
def series_fill(t):
    names = (S.WHOLESALE, "Avg_Price_Lag_7", "Avg_Price_Std_7", "Wholesale_Price_Change")
    return impute.fill_series(keyed(t.features, *names))


@query("i2_mode_fill", f"""
    with x as (select sale_date, item_code, {BAND_SQL.format(x="loss_rate")} as band from (
        select d.sale_date, d.item_code, l.loss_rate from daily d left join loss_rates l on d.item_code = l.item_code) y)
    select sale_date, item_code, coalesce(band, (select band from x where band is not null group by band
        order by count(*) desc, band limit 1), 'Unknown') as band from x""")
def mode_fill(t):
    df = t.daily.join(t.loss_rates, S.ITEM, "left").select(*KEY, pricing.loss_band(c(S.LOSS)).alias("band"))
    return df.withColumn("band", F.coalesce("band", impute.mode(df, "band"), F.lit("Unknown")))


_I4 = ("avg_price_lag_1", "avg_price_lag_30", "revenue_ma_7", "avg_price_std_7", "wholesale_price", "price_markup")


@query("i4_model_input_fill", """
    with m as (select sale_date, item_code, avg_price, revenue, price_markup, wholesale_price, revenue_ma_7,
                      avg_price_std_7, coalesce(avg_price_lag_1, avg_price) as avg_price_lag_1,
                      coalesce(avg_price_lag_30, avg_price) as avg_price_lag_30 from features)
    select sale_date, item_code, r4(avg_price_lag_1) as avg_price_lag_1, r4(avg_price_lag_30) as avg_price_lag_30,
           r2(revenue_ma_7) as revenue_ma_7,
           r4(coalesce(avg_price_std_7, (select quantile_cont(avg_price_std_7, 0.5) from m), 0)) as avg_price_std_7,
           r4(coalesce(wholesale_price, (select quantile_cont(wholesale_price, 0.5) from m), 0)) as wholesale_price,
           r4(price_markup) as price_markup from m""", revenue_ma_7=2)
def model_input_fill(t):
    names = ("Avg_Price_Lag_1", "Avg_Price_Lag_30", "Revenue_MA_7", "Avg_Price_Std_7", S.WHOLESALE, "Price_Markup")
    df = impute.fill_model_inputs(keyed(t.features, "Avg_Price", "Revenue", *names))
    return keyed(df, *names)


@query("i5_infinite_to_median", """
    with x as (select sale_date, item_code, avg_price / nullif(price_range, 0) as ratio from daily)
    select sale_date, item_code, r4(coalesce(ratio, (select quantile_cont(ratio, 0.5) from x))) as ratio from x""")
def infinite_to_median(t):
    divided = F.when(F.col("Price_Range") == 0, F.lit(float("inf"))).otherwise(ratio(F.col("Avg_Price"), F.col("Price_Range")))
    df = impute.without_infinities(t.daily.select(*KEY, divided.alias("ratio")), ["ratio"])
    return impute.fill_medians(df, ["ratio"])


@query("i6_divisor_floor", """
    select item_code, r2(avg_price / greatest(price_volatility, 1e-8)) as scaled, count(*) as n
    from daily group by 1, 2""", digits=2)
def divisor_floor(t):
    """Days without any spread divide by the floor."""
    scaled = rounded_column(F.col("Avg_Price") / F.greatest(F.col("Price_Volatility"), F.lit(1e-8)), 2)
    return t.daily.groupBy(S.ITEM, scaled.alias("scaled")).agg(F.count(F.lit(1)).alias("n"))


@query("i7_target_inputs", """
    select item_code, count(*) as n, r2(sum(quantity)) as total_quantity, r2(sum(unit_price)) as avg_price
    from sales group by item_code""", digits=2)
def target_inputs(t):
    df = series.with_target_inputs(t.sales)
    return df.groupBy(S.ITEM).agg(
        F.count(F.lit(1)).alias("n"), F.sum("Total_Quantity").alias("total_quantity"), F.sum("Avg_Price").alias("avg_price")
    )


_INTS = {"Transaction_Count", "Discount_Count", "Year", "Month", "Quarter", "DayOfYear", "DayOfWeek", "WeekOfYear",
         "IsWeekend", "IsNationalDay", "IsLaborDay", "Days_Since_Epoch", S.CATEGORY}
_TEXTS = {S.CATEGORY_NAME}
_WIDE = [n for n in S.FEATURE_TABLE[2:] if not n.startswith(("Season_", "Loss_Rate_Category")) and n != S.CATEGORY_ENCODED]
_SQL_NAMES = {S.WHOLESALE: "wholesale_price", S.LOSS: "loss_rate", S.CATEGORY: "category_code", S.CATEGORY_NAME: "category_name"}
_WIDE_SQL = ", ".join(
    (n2 if n in _INTS | _TEXTS else f"r2({n2}) as {n2}")
    for n in _WIDE for n2 in [_SQL_NAMES.get(n, n.lower())]
)


@query("f1_all_features", f"select sale_date, item_code, {_WIDE_SQL} from features", digits=2)
def all_features(t):
    """Every feature before imputation and encoding, in one plan."""
    return keyed(t.features, *_WIDE)


@query("f2_feature_table")
def finished_table(t):
    """The finished table of 105 columns."""
    return feature_table(t.sales, t.quotes, t.items, t.loss_rates)


@query("v20_split_gate", """
    with x as (select split, avg_price_lag_7 as v, avg_price_target_1d as y from (
        select *, case when rn < floor(n * 0.7) then 'train' when rn < floor(n * 0.85) then 'validation' else 'test' end as split
        from (select *, row_number() over (order by item_code, sale_date) - 1 as rn, count(*) over () as n from features) a) b)
    select split, count(*) as total_rows, r4(sum(case when v is null then 1 else 0 end) / cast(count(*) as double)) as missing_ratio,
           cast(0 as bigint) as infinite_values, count(y) as targets,
           sum(case when v is null then 1 else 0 end) / cast(count(*) as double) < 0.5 and count(y) > 0 as passed
    from x group by split""")
def split_gate(t):
    from marketgrain.operators.quality import split_gate as gate

    return gate(split.split_by_rows(t.features), ["Avg_Price_Lag_7"], "Avg_Price_Target_1d")
