"""Business reports and exploratory queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from marketgrain import schemas as S
from marketgrain.functions.naming import c
from marketgrain.operators import bi, daily as D, eda, enrich, sketches, timeseries as ts
from marketgrain.queries.base import BAND_SQL, SEASON_SQL, Tables, query, r
from marketgrain.streaming.runs import fresh_folder


def feature_rows(t: Tables) -> DataFrame:
    """The columns that reports read."""
    return enrich.add_season(D.add_calendar(enrich.add_loss(enrich.add_category(t.daily, t.items), t.loss_rates)))


def plain_rows(t: Tables) -> DataFrame:
    return D.add_calendar(t.daily)


def category_rows(t: Tables) -> DataFrame:
    return enrich.add_season(D.add_calendar(enrich.add_category(t.daily, t.items)))


SPAN = """min(cast(year as varchar) || '-' || lpad(cast(month as varchar), 2, '0') || '-01') as earliest_date,
          max(cast(year as varchar) || '-' || lpad(cast(month as varchar), 2, '0') || '-28') as latest_date"""


@query("a3a_total_records", "select count(*) as total_records from daily")
def total_records(t):
    return bi.total_records(t.daily)


@query("a3b_total_revenue", """
    select r2(sum(revenue)) as total_revenue, r2(avg(revenue)) as avg_revenue, count(*) as transaction_count
    from daily where revenue > 0""", digits=2)
def total_revenue(t):
    return bi.total_revenue(t.daily)


@query("a3c_date_range", f"select {SPAN} from calendar")
def date_range(t):
    return bi.date_range(plain_rows(t))


@query("a3d_unique_items", "select count(distinct item_code) as unique_items from daily")
def unique_items(t):
    return bi.unique_items(t.daily)


@query("a4_monthly_revenue", """
    select year, month, r2(sum(revenue)) as monthly_revenue, count(*) as transaction_count, r4(avg(avg_price)) as avg_price
    from calendar where revenue > 0 group by year, month""", monthly_revenue=2)
def monthly_revenue(t):
    return bi.monthly_revenue(plain_rows(t))


@query("a5_seasonal_revenue", """
    select season, r2(sum(revenue)) as seasonal_revenue, count(*) as seasonal_transactions
    from calendar where revenue > 0 group by season""", digits=2)
def seasonal_revenue(t):
    return bi.seasonal_revenue(plain_rows(t))


@query("a5_seasonal_gross_sales", f"""
    select {SEASON_SQL.format(m="month(sale_date)")} as season, r2(sum(quantity * unit_price)) as gross_sales
    from sales group by 1""", digits=2)
def seasonal_gross_sales(t):
    return eda.seasonal_gross_sales(t.sales)


@query("a6_top_categories", """
    select category_name, r2(sum(revenue)) as total_revenue, count(*) as transaction_count, r4(avg(avg_price)) as avg_price,
           r4(sum(total_quantity)) as total_quantity
    from daily d join items i on d.item_code = i.item_code where revenue > 0
    group by category_name order by total_revenue desc, category_name limit 15""", total_revenue=2)
def top_categories(t):
    return bi.top_categories(category_rows(t))


@query("a7_price_distribution", """
    select case when avg_price < 5 then 'Low (< 5 RMB)' when avg_price < 15 then 'Medium (5-15 RMB)'
                when avg_price < 30 then 'High (15-30 RMB)' else 'Premium (> 30 RMB)' end as price_range,
           count(*) as transaction_count, r2(sum(revenue)) as range_revenue, r4(avg(avg_price)) as avg_price_in_range
    from daily where avg_price > 0 and revenue > 0 group by 1""", range_revenue=2)
def price_distribution(t):
    return bi.price_distribution(t.daily)


@query("a8_top_performers", """
    select category_name, r2(sum(revenue)) as total_revenue, count(*) as trading_days, r4(avg(avg_price)) as avg_price
    from daily d join items i on d.item_code = i.item_code where revenue > 0
    group by category_name order by total_revenue desc, category_name limit 20""", total_revenue=2)
def top_performers(t):
    return bi.top_performers(category_rows(t))


@query("a8_top_items", """
    select item_code, r2(sum(revenue)) as total_revenue, count(*) as trading_days, r4(avg(avg_price)) as avg_price
    from daily where revenue > 0 group by item_code order by total_revenue desc, item_code limit 20""", total_revenue=2)
def top_items(t):
    return bi.top_performers(t.daily, S.ITEM)


@query("a9_weekend_vs_weekday", """
    select case when isweekend = 1 then 'Weekend' else 'Weekday' end as day_type, count(*) as transaction_count,
           r2(sum(revenue)) as total_revenue, r4(avg(avg_price)) as avg_price
    from calendar where revenue > 0 group by 1""", total_revenue=2)
def weekend_vs_weekday(t):
    return bi.weekend_vs_weekday(plain_rows(t))


@query("a10_category_prices_since", """
    select category_name, r4(avg(avg_price)) as avg_price, count(*) as data_points
    from daily d join items i on d.item_code = i.item_code where year(sale_date) >= 1998 and avg_price > 0
    group by category_name order by avg_price desc, category_name limit 30""")
def category_prices_since(t):
    return bi.category_prices_since(category_rows(t), 1998)


@query("a11a_daily_revenue_trend", """
    select sale_date, r2(sum(revenue)) as daily_revenue from daily
    where sale_date > (select max(sale_date) from daily) - interval 90 day group by sale_date""", digits=2)
def daily_revenue_trend(t):
    return bi.daily_revenue_trend(t.daily)


@query("a11b_category_growth", """
    with y as (select category_name, year(sale_date) as year, sum(revenue) as v
               from daily d join items i on d.item_code = i.item_code group by 1, 2)
    select category_name, year, r2(v) as yearly_revenue from y
    where category_name in (select category_name from y group by category_name order by sum(v) desc, category_name limit 3)""",
       digits=2)
def category_growth(t):
    return bi.category_growth(category_rows(t), 3)


@query("j9_rows_of_top_categories", """
    with y as (select d.*, i.category_name from daily d join items i on d.item_code = i.item_code)
    select category_name, count(*) as n from y
    where category_name in (select category_name from y group by category_name order by sum(revenue) desc, category_name limit 2)
    group by category_name""")
def rows_of_top_categories(t):
    rows = category_rows(t)
    top = bi.top_categories(rows, 2).select(F.col("category_name").alias(S.CATEGORY_NAME))
    kept = rows.join(top, S.CATEGORY_NAME, "left_semi")
    return kept.groupBy(c(S.CATEGORY_NAME).alias("category_name")).agg(F.count(F.lit(1)).alias("n"))


@query("a11c_category_seasonality", """
    select category_name, season, r2(sum(revenue)) as seasonal_revenue
    from calendar d join items i on d.item_code = i.item_code group by category_name, season""", digits=2)
def category_seasonality(t):
    return bi.seasonal_revenue_by_category(category_rows(t))


@query("a11d_price_trends_by_month", """
    select year, month, r4(avg(avg_price)) as avg_monthly_price, r4(min(avg_price)) as min_monthly_price,
           r4(max(avg_price)) as max_monthly_price from calendar group by year, month""")
def price_trends_by_month(t):
    return bi.price_trends_by_month(plain_rows(t))


@query("a11e_most_volatile_items", """
    select item_code, r4(avg(price_volatility)) as avg_volatility from daily group by item_code
    order by avg_volatility desc, item_code limit 15""")
def most_volatile_items(t):
    return bi.most_volatile_items(t.daily)


@query("a11f_holiday_impact", """
    select case when isnationalday = 1 then 'National Day' when islaborday = 1 then 'Labor Day' else 'Regular Day' end
           as day_type, r2(sum(revenue)) as total_revenue from calendar group by 1""", digits=2)
def holiday_impact(t):
    return bi.holiday_impact(plain_rows(t))


@query("a11g_loss_rate_impact", f"""
    select {BAND_SQL.format(x="loss_rate")} as loss_category, count(distinct item_code) as item_count,
           r2(sum(revenue)) as total_revenue from lossy group by 1""", digits=2)
def loss_rate_impact(t):
    return bi.loss_rate_impact(feature_rows(t))


@query("a12_daily_revenue", "select sale_date, r2(sum(revenue)) as total_revenue from daily group by sale_date", digits=2)
def daily_revenue(t):
    return bi.daily_revenue(t.daily)


@query("a12_top_items_by_quantity", """
    select item_code, r4(avg(total_quantity)) as avg_quantity from daily group by item_code
    order by avg_quantity desc, item_code limit 10""")
def top_items_by_quantity(t):
    return bi.top_items_by_quantity(t.daily)


@query("a13_quoted_columns", """
    select count(*) as row_count, count(distinct item_code) as item_count, r4(avg(loss_rate)) as mean_loss,
           min(sale_date) as first_day, max(sale_date) as last_day from lossy""")
def quoted_columns(t):
    from marketgrain.sources.catalog import smoke_figures

    return smoke_figures(feature_rows(t))


@query("a14_summary", f"""
    select row_number() over (order by category_revenue desc, category_name) as rank, category_name,
           r2(category_revenue) as category_revenue, category_transactions,
           (select count(*) from daily) as total_records,
           (select r2(sum(revenue)) from daily where revenue > 0) as total_revenue, p.*
    from (select category_name, sum(revenue) as category_revenue, count(*) as category_transactions
          from daily d join items i on d.item_code = i.item_code where revenue > 0 group by category_name
          order by 2 desc, 1 limit 3) x, (select {SPAN} from calendar) p""", digits=2)
def summary(t):
    return bi.summary(category_rows(t))



@query("s25_daily_report", """
    with m as (select sum(revenue) as s, avg(revenue) as a, count(*) as n from daily where revenue > 0),
    c as (select category_name, sum(revenue) as s, count(*) as n, row_number() over (order by sum(revenue) desc) as k
          from daily d join items i on d.item_code = i.item_code where revenue > 0 group by category_name),
    p as (select year, month, sum(revenue) as s, count(*) as n from calendar where revenue > 0 group by year, month
          order by year desc, month desc limit 3),
    w as (select isweekend, sum(revenue) as s, count(*) as n, avg(avg_price) as a from calendar where revenue > 0 group by 1),
    lines as (
    select 1 as section, 1 as position, concat('Total Revenue: ', format('{:,.2f}', s), ' RMB') as line from m
    union all select 1, 2, concat('Total Transactions: ', format('{:,.0f}', cast(n as double))) from m
    union all select 1, 3, concat('Average Revenue per Transaction: ', format('{:.2f}', a), ' RMB') from m
    union all select 1, 4, concat('Total Records Processed: ', format('{:,.0f}', cast(count(*) as double))) from daily
    union all select 1, 5, concat('Data Coverage: ', earliest_date, ' to ', latest_date) from (select """ + SPAN + """ from calendar) x
    union all select 2, k, concat(k, '. ', category_name, ': ', format('{:,.0f}', s), ' RMB, ', format('{:,.0f}', cast(n as double)),
              ' transactions') from c where k <= 5
    union all select 3, year * 100 + month, concat(year, '-', lpad(cast(month as varchar), 2, '0'), ': ', format('{:,.0f}', s),
              ' RMB (', format('{:,.0f}', cast(n as double)), ' transactions)') from p
    union all select 4, 1 + isweekend, concat(case when isweekend = 1 then 'Weekend' else 'Weekday' end, ': ',
              format('{:,.0f}', s), ' RMB, ', format('{:,.0f}', cast(n as double)), ' transactions, average price ',
              format('{:.2f}', a), ' RMB') from w)
    select cast(section as bigint) as section, cast(position as bigint) as position, line from lines""")
def daily_report(t):
    return bi.daily_report(category_rows(t))


# ---- exploratory ---------------------------------------------------------------------------------------
_STATS = """count({x}) as n, r4(avg({x})) as mean, r4(stddev_samp({x})) as std, r4(min({x})) as min, r4(max({x})) as max,
            r4(quantile_cont({x}, 0.25)) as p25, r4(quantile_cont({x}, 0.5)) as p50, r4(quantile_cont({x}, 0.75)) as p75"""


def describe_sql(table: str, *names: str) -> str:
    return " union all ".join(f"""select '{n}' as "column", {_STATS.format(x=n)} from {table}""" for n in names)


@query("a15_describe", describe_sql("sales", "unit_price", "quantity"))
def describe(t):
    return eda.describe(t.sales, [S.PRICE, S.QUANTITY], ["unit_price", "quantity"])


def counts_sql(table: str, label: str, value: str) -> str:
    return f"""select '{label}' as "column", {value} as value, count(*) as n,
               r4(count(*) * 100.0 / (select count(*) from {table})) as pct from {table} group by {value}"""


@query("a16_value_counts", " union all ".join([
    counts_sql("sales", "kind", "sale_or_return"), counts_sql("sales", "discount", "discount"),
    counts_sql("loss_rates", "loss_band", BAND_SQL.format(x="loss_rate")), counts_sql("items", "category", "category_name"),
]))
def value_counts(t):
    from marketgrain.functions.pricing import loss_band

    parts = [
        eda.value_counts(t.sales, c(S.KIND), "kind"), eda.value_counts(t.sales, c(S.DISCOUNT), "discount"),
        eda.value_counts(t.loss_rates, loss_band(c(S.LOSS)), "loss_band"),
        eda.value_counts(t.items, c(S.CATEGORY_NAME), "category"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("a17_top_and_others", """
    with n as (select item_name as value, count(*) as n from sales s join items i on s.item_code = i.item_code group by 1),
    k as (select *, row_number() over (order by n desc, value) as rn from n)
    select value, n from k where rn <= 8
    union all select 'Others', cast(sum(n) as bigint) from k where rn > 8 having sum(n) > 0""")
def top_and_others(t):
    return eda.top_and_others(t.sales.join(t.items, S.ITEM), S.ITEM_NAME)


@query("a18_histogram", """
    select least(cast(floor((unit_price - lo) * 50 / (hi - lo)) as bigint), 49) as bin, count(*) as n
    from sales, (select min(unit_price) as lo, max(unit_price) as hi from sales) b group by 1""")
def histogram(t):
    return eda.histogram(t.sales, c(S.PRICE), 50)


@query("a19_records_per_day", "select sale_date, count(*) as n from sales group by sale_date")
def records_per_day(t):
    return eda.records_per_day(t.sales)


@query("a19_records_per_hour", "select hour(ts) as hour, count(*) as n from request_log group by 1")
def records_per_hour(t):
    return eda.records_per_hour(t.requests, "ts")


@query("a20_wholesale_by_month", """
    select cast(date_trunc('month', sale_date) as date) as month, r4(avg(wholesale_price)) as mean_price,
           r4(stddev_samp(wholesale_price)) as std_price, count(*) as n from wholesale group by 1""")
def wholesale_by_month(t):
    return eda.wholesale_by_month(t.wholesale)


@query("a20_wholesale_by_month_of_year", """
    select month(sale_date) as month, r4(avg(wholesale_price)) as mean_price from wholesale group by 1""")
def wholesale_by_month_of_year(t):
    return eda.wholesale_by_month_of_year(t.wholesale)


_COMPARE = """
    select s.sale_date, s.item_code, p, p / w.wholesale_price as ratio, p - w.wholesale_price as markup,
           (p - w.wholesale_price) / w.wholesale_price * 100 as pct
    from (select sale_date, item_code, avg(unit_price) as p from sales group by sale_date, item_code) s
    join wholesale w on s.sale_date = w.sale_date and s.item_code = w.item_code"""


@query("a20_monthly_price_ratio", f"""
    select cast(date_trunc('month', sale_date) as date) as month, r4(avg(ratio)) as mean_ratio
    from ({_COMPARE}) t group by 1""")
def monthly_price_ratio(t):
    return eda.monthly_price_ratio(eda.price_comparison(t.sales, t.wholesale))


@query("j6_retail_wholesale", f"""
    select sale_date, item_code, r4(ratio) as price_ratio, r4(markup) as price_markup, r3(pct) as markup_percentage
    from ({_COMPARE}) t""", markup_percentage=3)
def retail_wholesale(t):
    df = eda.price_comparison(t.sales, t.wholesale)
    return df.select(S.DATE, S.ITEM, "Price_Ratio", "Price_Markup", "Markup_Percentage")


@query("a21_price_comparison", f"with x as ({_COMPARE}) {describe_sql('x', 'ratio', 'pct')}")
def price_comparison(t):
    return eda.describe(eda.price_comparison(t.sales, t.wholesale), ["Price_Ratio", "Markup_Percentage"], ["ratio", "pct"])


MARKET = """select sale_date, avg(unit_price) as avg_price, sum(quantity) as total_quantity, count(item_code) as transaction_count,
            avg(unit_price) * sum(quantity) as revenue from sales group by sale_date"""


@query("a22_market_series", f"""
    select sale_date, r4(avg_price) as avg_price, r4(total_quantity) as total_quantity, transaction_count, r2(revenue) as revenue
    from ({MARKET}) t""", revenue=2)
def market_series(t):
    return D.market_series(t.sales)


@query("a23_top_revenue_items", """
    select s.item_code, i.item_name, i.category_name, r2(sum(quantity * unit_price)) as gross_sales
    from sales s join items i on s.item_code = i.item_code group by 1, 2, 3 order by gross_sales desc, 1 limit 10""", digits=2)
def top_revenue_items(t):
    return eda.top_revenue_items(t.sales, t.items)


@query("j7_named_sales", """
    select i.item_name, count(*) as n, r2(sum(quantity)) as quantity
    from sales s left join (select l.* from loss_rates l) i on s.item_code = i.item_code where i.item_name is not null
    group by i.item_name""", digits=2)
def named_sales(t):
    named = t.sales.join(t.loss_rates.select(S.ITEM, S.ITEM_NAME), S.ITEM, "left").where(c(S.ITEM_NAME).isNotNull())
    return named.groupBy(S.ITEM_NAME).agg(F.count(F.lit(1)).alias("n"), F.sum(c(S.QUANTITY)).alias("quantity"))


@query("a24_price_variation", """
    select w.item_code, i.item_name, r4(avg(wholesale_price)) as mean_price, r4(stddev_samp(wholesale_price)) as std_price,
           r6(stddev_samp(wholesale_price) / avg(wholesale_price)) as cv
    from wholesale w join items i on w.item_code = i.item_code group by 1, 2 order by cv desc, 1 limit 5""", cv=6)
def price_variation(t):
    return eda.price_variation(t.wholesale, t.items)


@query("a25_loss_impact", """
    with x as (select quantity * unit_price as v, l.loss_rate from sales s left join loss_rates l on s.item_code = l.item_code),
    y as (select v, coalesce(loss_rate, (select avg(loss_rate) from x)) as rate from x)
    select r2(sum(v * rate / 100)) as potential_loss, r2(sum(v)) as total_sales, r4(sum(v * rate / 100) / sum(v) * 100) as loss_pct
    from y""", potential_loss=2, total_sales=2)
def loss_impact(t):
    return eda.loss_impact(t.sales, t.loss_rates)


@query("a26_most_expensive_items", """
    select w.item_code, i.item_name, r4(avg(wholesale_price)) as mean_price
    from wholesale w join items i on w.item_code = i.item_code group by 1, 2 order by mean_price desc, 1 limit 10""")
def most_expensive_items(t):
    return eda.most_expensive_items(t.wholesale, t.items)


@query("a27_median_and_mode", """
    select r4(quantile_cont(avg_price, 0.5)) as median_price, r4(quantile_cont(total_quantity, 0.5)) as median_quantity,
           (select transaction_count from daily group by 1 order by count(*) desc, 1 limit 1) as mode_count from daily""")
def median_and_mode(t):
    from marketgrain.operators import impute

    middle = impute.medians(t.daily, ["Avg_Price", "Total_Quantity"])
    return middle.agg(
        F.max(F.when(F.col("feature") == "Avg_Price", F.col("median"))).alias("median_price"),
        F.max(F.when(F.col("feature") == "Total_Quantity", F.col("median"))).alias("median_quantity"),
    ).withColumn("mode_count", impute.mode(t.daily, "Transaction_Count"))


@query("a28_approximate", "select sale_or_return, count(*) as n, true as median_close, true as ids_close from sales group by 1")
def approximate(t):
    """The approximate forms of quantiles and distinct counts, for very large tables, within their errors of the exact ones."""
    rough = t.sales.groupBy(c(S.KIND).alias("_kind")).agg(
        F.percentile_approx(c(S.PRICE), 0.5, 10_000).alias("_median"), F.approx_count_distinct("sale_id").alias("_ids")
    )
    # one row per kind of sale
    rows = t.sales.join(F.broadcast(rough), c(S.KIND).eqNullSafe(F.col("_kind")))
    below, upto = (F.avg((c(S.PRICE) < F.col("_median")).cast("int")), F.avg((c(S.PRICE) <= F.col("_median")).cast("int")))
    ids = F.count_distinct("sale_id")
    return rows.groupBy(c(S.KIND)).agg(
        F.count(F.lit(1)).alias("n"), ((below <= 0.5001) & (upto >= 0.4999)).alias("median_close"),
        # three standard errors of the sketch
        (F.abs(F.max("_ids") - ids) <= 0.15 * ids).alias("ids_close"),
    )


@query("a28_sketch_ranges", """
    select cast(year(sale_date) as varchar) as period, count(*) as n, true as ids_close, true as items_close, true as median_close
    from sales where sale_date is not null group by 1
    union all select 'all', count(*), true, true, true from sales where sale_date is not null""")
def sketch_ranges(t):
    """Years, and all days, answered from stored sketches of days alone, within their errors of the exact figures."""
    folder, rows = fresh_folder(t.spark, "sketches"), t.sales.where(c(S.DATE).isNotNull())
    # the second load has days of the first one too
    for part in (rows.where(c(S.DATE) < "1995-07-01"), rows.where(c(S.DATE) >= "1995-07-01")):
        for half in (F.pmod("sale_id", F.lit(2)) == 0, F.pmod("sale_id", F.lit(2)) == 1):
            sketches.append(sketches.day_sketches(part.where(half), S.DATE, ["sale_id", S.ITEM], [S.PRICE]), folder)
    stored = t.spark.read.parquet(folder)
    merged = sketches.merged(stored, [F.year("day").cast("string").alias("period")]).unionByName(
        sketches.merged(stored).withColumn("period", F.lit("all")))
    rough = merged.select(
        F.col("period").alias("_period"), F.col("n").alias("_n"), sketches.distinct("sale_id").alias("_ids"),
        sketches.distinct(S.ITEM).alias("_items"), sketches.quantile(S.PRICE, 0.5).alias("_median"))
    periods = rows.withColumn("period", F.explode(F.array(F.year(c(S.DATE)).cast("string"), F.lit("all"))))
    # one row per year
    both = periods.join(F.broadcast(rough), F.col("period") == F.col("_period"))
    below, upto = (F.avg((c(S.PRICE) < F.col("_median")).cast("int")), F.avg((c(S.PRICE) <= F.col("_median")).cast("int")))

    def close(estimate: str, exact):
        return F.abs(F.max(estimate) - exact) <= F.greatest(4 * sketches.ERROR * exact, F.lit(1))

    return both.groupBy("period").agg(
        F.max("_n").alias("n"), close("_ids", F.count_distinct("sale_id")).alias("ids_close"),
        close("_items", F.count_distinct(c(S.ITEM))).alias("items_close"),
        ((below <= 0.505) & (upto >= 0.495)).alias("median_close"))


@query("j10_sketch_overlap", """
    select unnest(['sales-items', 'wholesale-items', 'sales-loss']) as pair, true as both_close, true as left_close, true as right_close""")
def sketch_overlap(t):
    """Overlaps of keys from theta sketches, within their errors of the exact ones."""
    def sketched(df):
        return sketches.merged(sketches.day_sketches(df.withColumn("_day", F.lit(None).cast("date")), "_day", [S.ITEM]))

    pairs = [("sales-items", t.sales, t.items), ("wholesale-items", t.quotes, t.items), ("sales-loss", t.sales, t.loss_rates)]
    rows = []
    for label, a, b in pairs:
        rough = sketches.overlap(sketched(a), sketched(b), S.ITEM).withColumnsRenamed({n: f"_{n}" for n in ("in_both", "only_left", "only_right")})
        exact = eda.key_overlap(a, b, S.ITEM, label).drop("coverage_pct")
        # one row on each side
        joined = exact.withColumn("_one", F.lit(1)).join(rough.drop("coverage_pct").withColumn("_one", F.lit(1)), "_one")
        bound = F.greatest(4 * sketches.ERROR * (F.col("in_both") + F.col("only_left") + F.col("only_right")), F.lit(1))
        rows.append(joined.select("pair", *[(F.abs(F.col(f"_{n}") - F.col(n)) <= bound).alias(f"{k}_close") for n, k in (
            ("in_both", "both"), ("only_left", "left"), ("only_right", "right"))]))
    return reduce(DataFrame.unionByName, rows)


@query("a29_correlations", """
    select 'all' as category, r6(corr(avg_price, total_quantity)) as price_quantity, r6(corr(avg_price, wholesale_price))
           as retail_wholesale from categorised
    union all
    select category_name, r6(corr(avg_price, total_quantity)), r6(corr(avg_price, wholesale_price))
    from categorised group by category_name""", digits=6)
def correlations(t):
    df = enrich.add_category(t.daily.join(t.wholesale, [S.DATE, S.ITEM], "left"), t.items)
    pairs = {"price_quantity": ("Avg_Price", "Total_Quantity"), "retail_wholesale": ("Avg_Price", S.WHOLESALE)}
    overall = eda.correlations(df, pairs).select(F.lit("all").alias("category"), *pairs)
    return overall.unionByName(eda.correlations(df, pairs, [S.CATEGORY_NAME]).withColumnRenamed(S.CATEGORY_NAME, "category"))


@query("j8_anti_join_count", """
    select count(distinct item_code) as orphans from sales where item_code not in (select item_code from loss_rates)""")
def anti_join_count(t):
    from marketgrain.operators.quality import orphan_items

    return orphan_items(t.sales, t.loss_rates).agg(F.count(F.lit(1)).alias("orphans"))


def _overlap_sql(label, a, b) -> str:
    return f"""select '{label}' as pair, count(x.k is not null and y.k is not null or null) as in_both,
        count(y.k is null or null) as only_left, count(x.k is null or null) as only_right,
        r4(count(x.k is not null and y.k is not null or null) * 100.0 / count(x.k)) as coverage_pct
        from (select distinct item_code as k from {a}) x full join (select distinct item_code as k from {b}) y on x.k = y.k"""


@query("j10_key_overlap", " union all ".join([
    _overlap_sql("sales-items", "sales", "items"), _overlap_sql("wholesale-items", "wholesale", "items"),
    _overlap_sql("sales-loss", "sales", "loss_rates"),
]))
def key_overlap(t):
    parts = [("sales-items", t.sales, t.items), ("wholesale-items", t.quotes, t.items), ("sales-loss", t.sales, t.loss_rates)]
    return reduce(DataFrame.unionByName, [eda.key_overlap(a, b, S.ITEM, label) for label, a, b in parts])


# ---- time series ---------------------------------------------------------------------------------------
_DECOMPOSED = f"""
    base as (select *, row_number() over (order by sale_date) - 1 as pos, count(*) over () as n from ({MARKET}) m),
    trended as (select *, case when count(avg_price) over w = 365 then avg(avg_price) over w end as trend from base
                window w as (order by sale_date rows between 182 preceding and 182 following)),
    phase as (select pos % 365 as k, avg(avg_price - trend) as p from trended group by 1),
    parts as (select sale_date, avg_price as observed, trend, p - (select avg(p) from phase) as seasonal,
                     avg_price - trend - (p - (select avg(p) from phase)) as residual
              from trended join phase on pos % 365 = k where n > 730)"""


@query("t1_decompose", f"with {_DECOMPOSED} select sale_date, {r('observed trend seasonal residual')} from parts")
def decompose(t):
    return ts.decompose(D.market_series(t.sales), "Avg_Price")


@query("t1_decompose_even_period", f"""
    with base as (select *, row_number() over (order by sale_date) - 1 as pos from ({MARKET}) m),
    trended as (select *, case when count(total_quantity) over w = 31 then (sum(total_quantity) over w
            - (lag(total_quantity, 15) over o + lead(total_quantity, 15) over o) / 2) / 30 end as trend from base
        window w as (order by sale_date rows between 15 preceding and 15 following), o as (order by sale_date)),
    phase as (select pos % 30 as k, avg(total_quantity - trend) as p from trended group by 1)
    select sale_date, r4(total_quantity) as observed, r4(trend) as trend, r4(p - (select avg(p) from phase)) as seasonal,
           r4(total_quantity - trend - (p - (select avg(p) from phase))) as residual
    from trended join phase on pos % 30 = k""")
def decompose_even(t):
    return ts.decompose(D.market_series(t.sales), "Total_Quantity", period=30)


@query("t2_strengths", f"""
    with {_DECOMPOSED}
    select r6(1 - var_samp(residual) / var_samp(seasonal + residual)) as seasonal_strength,
           r6(1 - var_samp(residual) / var_samp(trend + residual)) as trend_strength from parts""", digits=6)
def strengths(t):
    return ts.strengths(ts.decompose(D.market_series(t.sales), "Avg_Price"))


@query("t3_acf", f"""
    with m as ({MARKET}),
    d as (select row_number() over (order by sale_date) as pos, avg_price - (select avg(avg_price) from m) as x from m),
    lags as (select cast(range as bigint) as lag from range(0, 41))
    select lag, r6(sum(a.x * b.x) / (select sum(x * x) from d)) as acf
    from lags join d a on true join d b on b.pos = a.pos - lag group by lag""", digits=6)
def acf(t):
    return ts.acf(D.market_series(t.sales), "Avg_Price")


@query("t3_acf_per_item", """
    with d as (select item_code, row_number() over (partition by item_code order by sale_date) as pos,
                      avg_price - avg(avg_price) over (partition by item_code) as x from daily),
    lags as (select cast(range as bigint) as lag from range(0, 8))
    select a.item_code, lag, r6(sum(a.x * b.x) / any_value(s.v)) as acf
    from lags join d a on true join d b on a.item_code = b.item_code and b.pos = a.pos - lag
    join (select item_code, sum(x * x) as v from d group by item_code) s on a.item_code = s.item_code
    group by a.item_code, lag""", digits=6)
def acf_per_item(t):
    return ts.acf(t.daily, "Avg_Price", [S.ITEM], lags=7)


@query("t4_pacf", f"""
    with recursive m as ({MARKET}),
    d as (select row_number() over (order by sale_date) as pos, avg_price - (select avg(avg_price) from m) as x from m),
    size as (select count(*) as n, least(40, count(*) // 4) as last from m),
    lags as (select range as lag from range(0, 41)),
    a as (select lag, sum(a.x * b.x) / (select sum(x * x) from d) as acf
          from lags join d a on true join d b on b.pos = a.pos - lag group by lag),
    rho as (select list(acf * n / (n - lag) order by lag) as r, any_value(last) as last from a, size where lag <= last),
    steps(k, phi, pacf) as (
        select 0, []::double[], 1.0::double
        union all
        select k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - value * phi[k - j + 1]), value), value
        from (select k, phi, last, (r[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k - j + 2])), 0))
                  / (1 - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j + 1])), 0)) as value
              from steps, rho where k < last) x)
    select k as lag, r6(pacf) as pacf from steps""", digits=6)
def pacf(t):
    return ts.pacf(D.market_series(t.sales), "Avg_Price")


@query("t5_autocorrelation", f"""
    with l as (select avg_price as x, lag(avg_price, 1) over o as x1, lag(avg_price, 7) over o as x7, lag(avg_price, 30) over o as x30
               from ({MARKET}) m window o as (order by sale_date))
    select r6(corr(x, x1)) as lag_1, r6(corr(x, x7)) as lag_7, r6(corr(x, x30)) as lag_30 from l""", digits=6)
def autocorrelation(t):
    return ts.autocorrelation(D.market_series(t.sales), "Avg_Price")


@query("w9_centred_average", f"""
    select sale_date, r4(trend) as trend from (select sale_date, case when count(avg_price) over w = 7 then avg(avg_price) over w end
        as trend from ({MARKET}) m window w as (order by sale_date rows between 3 preceding and 3 following)) t""")
def centred_average(t):
    return ts.decompose(D.market_series(t.sales), "Avg_Price", period=7).select(S.DATE, "trend")


@query("w10_item_autocorrelation", """
    with l as (select item_code, avg_price as x, lag(avg_price, 1) over o as x1, lag(avg_price, 7) over o as x7,
                      lag(avg_price, 30) over o as x30 from daily window o as (partition by item_code order by sale_date))
    select item_code, r6(corr(x, x1)) as lag_1, r6(corr(x, x7)) as lag_7, r6(corr(x, x30)) as lag_30 from l group by item_code""",
       digits=6)
def item_autocorrelation(t):
    return ts.autocorrelation(t.daily, "Avg_Price", keys=[S.ITEM])


@query("w11_last_months", """
    select year, month, r2(monthly_revenue) as monthly_revenue from (
        select year, month, sum(revenue) as monthly_revenue from calendar where revenue > 0 group by 1, 2) t
    order by year desc, month desc limit 6""", digits=2)
def last_months(t):
    months = bi.monthly_revenue(plain_rows(t)).select("year", "month", "monthly_revenue")
    return months.orderBy(F.desc("year"), F.desc("month")).limit(6)
