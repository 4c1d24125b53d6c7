"""Queries on metrics, alerts, requests and model inputs."""

from __future__ import annotations


from pyspark.sql import DataFrame, functions as F

from marketgrain import schemas as S
from marketgrain.functions.naming import c, clean_columns, clean_name_expr
from marketgrain.functions.pricing import metric_unit
from marketgrain.operators import daily as D, enrich, monitoring as H, quality, series, serving, split
from marketgrain.queries.base import Tables, query
from marketgrain.queries.quality import _SCORES as SCORES_SQL, _scores as table_scores
from marketgrain.sources import catalog as cat, readers, writers
from marketgrain.sources.readers import service_figures
from marketgrain.sources.versions import History, OnlineView
from marketgrain.streaming.runs import fresh_folder

NOW_SQL = "timestamp '2024-01-31 00:00:00'"


def now():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def fresh():
    return F.lit(20.0)


_RULES = "rules(alert_type, metric, direction, threshold, critical, base) as (values " + ", ".join(
    f"('{a}', '{m}', '{d}', {float(x)}, {float(y) if y is not None else 'cast(null as double)'}, '{b}')" for a, m, d, x, y, b in H.RULES
) + ")"
_LATEST = """latest as (select source, entity, metric, value, ts from (select *, row_number() over (partition by source, entity, metric
    order by ts desc, event_id desc) as k from metrics) x where k = 1)"""


def violated(table: str) -> str:
    return f"""(select v.*, alert_type, threshold, case when coalesce(case when direction = 'above' then value > critical else value < critical end, false)
        then 'critical' else base end as severity
        from {table} v join rules on v.metric = rules.metric
        where case when direction = 'above' then value > threshold else value < threshold end)"""


def naive_ts(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps without zone, as the given tables have them."""
    return df.withColumns({n: c(n).cast("timestamp_ntz") for n in names or ("ts",)})


@query("w12_latest_per_key", f"with {_LATEST} select source, entity, metric, r4(value) as value, ts from latest")
def latest_per_key(t):
    return naive_ts(H.latest_values(t.metrics))


@query("w12_latest_request", """
    select user_id, request_id, endpoint, r4(latency_ms) as latency_ms from (select *, row_number() over (partition by user_id
        order by ts desc, request_id desc) as k from request_log) x where k = 1""")
def latest_request(t):
    rows = t.requests.select("user_id", "request_id", "endpoint", "latency_ms", "ts")
    return series.latest_per_key(rows, ["user_id"], F.struct("ts", "request_id")).select("user_id", "request_id", "endpoint", "latency_ms")


@query("w11_newest_rows", """
    select source, entity, event_id, r4(value) as value from (select *, row_number() over (partition by source, entity
        order by ts desc, event_id desc) as k from metrics) x where k <= 10""")
def newest_rows(t):
    return series.newest_rows(t.metrics, ["source", "entity"], ["ts", "event_id"], 10).select("source", "entity", "event_id", "value")


@query("h1_alerts", f"""
    with {_RULES}, {_LATEST}
    select metric, source, entity, r4(value) as value, ts, alert_type, r4(threshold) as threshold, severity,
           printf('%s of %s is %.2f, limit %.1f', metric, entity, value, threshold) as message from {violated('latest')} x""")
def alerts(t):
    return naive_ts(H.alerts(t.metrics, H.rules_table(t.spark)))


@query("h1_alert_history", f"""
    with {_RULES} select alert_type, severity, count(*) as n, r2(max(value)) as highest from {violated('metrics')} x group by 1, 2""", digits=2)
def alert_history(t):
    rows = H.violations(t.metrics, H.rules_table(t.spark))
    return rows.groupBy("alert_type", "severity").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("highest"))


def _newest(source, metric) -> str:
    return f"(select value from metrics where source = '{source}' and metric = '{metric}' order by ts desc, event_id desc limit 1)"


_STATUS = f"""
    n as (select {_newest('system', 'cpu_percent')} as cpu, {_newest('system', 'memory_percent')} as mem,
                 {_newest('api', 'average_latency_ms')} as slow, {_newest('data_quality', 'quality_score')} as q),
    m as (select count(*) as c, count_if(value >= 15 and value < 25) as w, count_if(value >= 25) as x, count_if(value > 20) as bad
          from latest where source = 'models'),
    areas as (select 'system' as area, case when cpu > 90 or mem > 95 then 'critical' when cpu > 80 or mem > 85 then 'warning' else 'healthy' end as status from n
        union all select 'models', case when c = 0 then 'no_data' when x > 0 then 'critical' when w > c * 0.5 then 'warning' else 'healthy' end from m
        union all select 'api', case when slow > 2000 then 'unhealthy' else 'healthy' end from n
        union all select 'data', case when q > 85 then 'healthy' when q > 70 then 'warning' else 'critical' end from n)"""


def checked_metrics(t):
    """The metrics with a health check of the service for each measured latency; over two seconds it failed."""
    latency = t.metrics.where((F.col("source") == "api") & (F.col("metric") == "average_latency_ms"))
    checks = latency.withColumns({
        "source": F.lit("models"), "entity": F.lit(H.API_ENTITY), "metric": F.lit("status_healthy"),
        "value": (F.col("value") <= 2000).cast("double"),
    })
    return t.metrics.unionByName(checks)


@query("h2_health", f"""
    with {_LATEST}, {_STATUS}
    select * from areas union all select 'overall', case max(case status when 'critical' then 3 when 'warning' then 2 when 'unhealthy' then 2
        when 'no_data' then 0 else 1 end) when 3 then 'critical' when 2 then 'warning' when 1 then 'healthy' else 'no_data' end from areas""")
def health(t):
    return H.health(checked_metrics(t), fresh())


@query("h3_indicators", f"""
    with {_LATEST}, {_STATUS}
    select area, upper(substr(status, 1, 1)) || substr(status, 2) as indicator from areas where area = 'system'
    union all select 'models', case when slow > 2000 then 'API Down' when c = 0 then 'No Models' when bad > c * 0.5 then 'Performance Issues'
        else 'Performing Well' end from m, n
    union all select 'data', case when q >= 85 then 'Excellent' when q >= 70 then 'Good' else 'Issues' end from n""")
def indicators(t):
    return H.indicators(checked_metrics(t), fresh())


_LIMITS = " ".join(f"when '{k}' then {v}" for k, v in H.RETENTION.items())


@query("h4_retention", f"""
    select source, event_id, r4(value) as value from (select *, row_number() over (partition by source order by ts desc, event_id desc) as k
        from metrics) x where k <= case source {_LIMITS} end""")
def retention(t):
    return H.keep_newest(t.metrics).select("source", "event_id", "value")


@query("h4_younger_than", f"select source, count(*) as n from metrics where ts >= {NOW_SQL} - interval 72 hour group by source")
def younger_than(t):
    return H.younger_than(t.metrics, now(), 72).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("h4_expiry", f"""
    select source, count(*) as n, true as files_left from metrics where ts >= {NOW_SQL} - interval 72 hour group by source""")
def expiry(t):
    """Young rows of a stored history after its files that are too old have left; no row is filtered to reach that."""
    rows = t.metrics.select("source", "event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    history = History(t.spark, fresh_folder(t.spark, "history"))
    for part in (0, 1):
        history.append(rows.where(F.pmod("event_id", F.lit(2)) == part))
    before = history.entries().count()
    version = history.expire(now(), 72)
    fewer = history.entries(version).count() < before
    return H.younger_than(history.read(rows.schema), now(), 72).groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "files_left", F.lit(fewer))


@query("h5_uptime", f"""
    select min(ts) as first_ts, r4(floor(epoch({NOW_SQL}) - epoch(min(ts))) / 60.0) as uptime_minutes from metrics where source = 'system'""")
def uptime(t):
    return naive_ts(H.uptime_minutes(t.metrics, now()), "first_ts")


@query("h7_fallback_quality", """
    with x as (select user_id, count(distinct event_type) as present, max(epoch(ts)) as newest from events group by user_id)
    select user_id, r4(case when present > 0 then least(100.0, present / 5.0 * 80 + greatest(0, 20 - floor(epoch(timestamp '2024-01-31 00:00:00') - newest) / 3600.0))
           else 0 end) as quality_score from x""")
def fallback_quality(t):
    rows = t.requests.groupBy("user_id").agg(F.count_distinct("endpoint").alias("present"), F.max("ts").alias("newest"))
    hours = F.timestamp_diff("SECOND", F.col("newest"), now()) / 3600
    return rows.select("user_id", H.fallback_quality(F.col("present"), 5, hours).alias("quality_score"))


@query("h7_stored_quality", f"""
    with x as (select count(distinct event_type) as present, max(epoch(ts)) as newest from events),
    f as (select least(100.0, present / 5.0 * 80 + greatest(0, 20 - floor(epoch({NOW_SQL}) - newest) / 3600.0)) as score from x)
    select 'stored' as origin, r2(avg(quality_score)) as quality_score from ({SCORES_SQL}) s
    union all select 'fallback', r4(score) from f""")
def stored_quality(t):
    """The score of a stored validation; the fallback where no validation was stored."""
    rows = t.requests.agg(F.count_distinct("endpoint").alias("present"), F.max("ts").alias("newest"))
    hours = F.timestamp_diff("SECOND", F.col("newest"), now()) / 3600
    fallback = rows.select(H.fallback_quality(F.col("present"), 5, hours).alias("quality_score"))
    folder = fresh_folder(t.spark, "validation")
    before = H.data_quality(readers.stored_validation(t.spark, folder), fallback)
    writers.save_validation({"summary": quality.run_summary(table_scores(t), True)}, folder)
    return H.data_quality(readers.stored_validation(t.spark, folder), fallback).unionByName(before)


@query("h8_request_counters", "select endpoint, method, cast(status as bigint) as status, count(*) as requests from request_log group by 1, 2, 3")
def request_counters(t):
    return H.request_counters(t.requests)


@query("h8_prediction_counters", """
    select model_name, case when status < 400 then 'success' else 'error' end as outcome, count(*) as predictions from request_log group by 1, 2""")
def prediction_counters(t):
    return H.prediction_counters(t.requests)


@query("h9_latency_histogram", f"""
    select model_name, r4(le) as le, cast(count_if(latency_ms / 1000 <= le) as bigint) as n
    from request_log, (select unnest([{", ".join(map(str, H.LATENCY_BOUNDS))}]) as le) b group by model_name, le
    union all select model_name, 1e9, count(latency_ms) from request_log group by model_name""")
def latency_histogram(t):
    rows = H.latency_histogram(t.requests)
    return rows.withColumn("le", F.least("le", F.lit(1e9)))


@query("h9_latency_totals", """
    select model_name, r4(sum(latency_ms) / 1000) as latency_sum, count(latency_ms) as latency_count, r4(avg(latency_ms)) as mean_ms
    from request_log group by 1""")
def latency_totals(t):
    return H.latency_totals(t.requests)


@query("h10_load_summary", """
    select count(*) as requests, cast(count_if(status = 200) as bigint) as successful, r4(count_if(status = 200) * 100.0 / count(*)) as success_rate,
           r4(avg(case when status = 200 then latency_ms end)) as mean_latency_ms,
           cast(count_if(status = 200 and latency_ms * 3 between 1 and 1000) as bigint) as plausible_predictions from request_log""")
def load_summary(t):
    return H.load_summary(t.requests, F.col("latency_ms") * 3)


_EMA = """ema as (select model_name, any_value(n) as n, sum(latency_ms * case when k = 1 then power(0.9, n - 1) else 0.1 * power(0.9, n - k) end) as ema
    from (select *, row_number() over (partition by model_name order by ts, request_id) as k, count(*) over (partition by model_name) as n
          from request_log) x group by model_name)"""


@query("w13_ema", f"with {_EMA} select model_name, n, r6(ema) as ema from ema", digits=6)
def ema(t):
    return H.ema(t.requests, ["model_name"], "ts", ["request_id"], "latency_ms")


@query("h11_prediction_stats", f"""
    with {_EMA} select r.model_name, count(*) as total, cast(count_if(status = 200) as bigint) as successful, max(ts) as last_ts,
           r6(any_value(ema)) as average_latency from request_log r join ema e on r.model_name = e.model_name group by r.model_name""", digits=6)
def prediction_stats(t):
    return naive_ts(H.prediction_stats(t.requests), "last_ts")


@query("h12_recent_alerts", f"""
    with {_RULES} select alert_type, entity, ts, r4(value) as value, severity from {violated('metrics')} x order by ts desc, alert_type, entity limit 10""")
def recent_alerts(t):
    rows = H.recent_alerts(H.violations(t.metrics, H.rules_table(t.spark)))
    return naive_ts(rows.select("alert_type", "entity", "ts", "value", "severity"))


@query("p28_metric_unit", """
    select m as metric, case when m like '%mape%' or m like '%percent%' or m like '%rate%' or m like '%ratio%' or m like '%accuracy%' then 'Percent'
        when m like '%latency%' or m like '%time%' or m like '%duration%' then 'Seconds' when m like '%count%' or m like '%total%' or m like '%number%' then 'Count'
        when m like '%memory%' or m like '%disk%' or m like '%size%' then 'Bytes' else 'None' end as unit, count(*) as n
    from (select lower(metric) as m from metrics) x group by 1, 2""")
def unit(t):
    return t.metrics.groupBy("metric", metric_unit(F.col("metric")).alias("unit")).agg(F.count(F.lit(1)).alias("n"))


@query("p30_wide_to_long", """
    with w as (select model_name, cast(count(*) as double) as request_count, avg(latency_ms) as mean_latency, max(latency_ms) as max_latency
               from request_log group by 1)
    select model_name, 'request_count' as metric, r4(request_count) as value, 'Count' as unit from w
    union all select model_name, 'mean_latency', r4(mean_latency), 'Seconds' from w
    union all select model_name, 'max_latency', r4(max_latency), 'Seconds' from w""")
def wide_to_long(t):
    wide = t.requests.groupBy("model_name").agg(
        F.count(F.lit(1)).alias("request_count"), F.avg("latency_ms").alias("mean_latency"), F.max("latency_ms").alias("max_latency")
    )
    return H.long_metrics(wide, ["model_name"], ["request_count", "mean_latency", "max_latency"])


# ---- model inputs ------------------------------------------------------------------------------------------
_REQUESTS = """requests as (select sale_date, item_code, total_quantity, avg_price, transaction_count, month, dayofweek, isweekend,
    case when item_code % 3 = 0 then null else price_volatility end as price_volatility,
    case when item_code % 4 = 0 then null else min_price end as min_price, max_price, discount_count, wholesale_price,
    loss_rate from (select p.*, l.loss_rate from priced p left join loss_rates l on p.item_code = l.item_code) x)"""


def requests(t: Tables) -> DataFrame:
    """Daily rows as requests, with gaps in optional fields."""
    df = D.add_calendar(t.daily).join(t.wholesale, [S.DATE, S.ITEM], "left").join(t.loss_rates.select(S.ITEM, S.LOSS), S.ITEM, "left")
    return df.select(
        S.DATE, S.ITEM, "Total_Quantity", "Avg_Price", "Transaction_Count", "Month", "DayOfWeek", "IsWeekend",
        F.when(c(S.ITEM) % 3 != 0, F.col("Price_Volatility")).alias("Price_Volatility"),
        F.when(c(S.ITEM) % 4 != 0, F.col("Min_Price")).alias("Min_Price"), "Max_Price", "Discount_Count",
        c(S.WHOLESALE), c(S.LOSS),
    )


@query("v18_field_defaults", f"""
    with {_REQUESTS} select sale_date, item_code, r4(coalesce(min_price, avg_price * 0.85)) as min_price, r4(coalesce(max_price, avg_price * 1.15)) as max_price,
        r4(coalesce(wholesale_price, avg_price * 0.75)) as wholesale_price, r4(coalesce(price_volatility, 1)) as price_volatility,
        r4(coalesce(loss_rate, 8.5)) as loss_rate, 1 as category_code from requests""".replace("1 as category_code", "cast(1 as bigint) as category_code"))
def field_defaults(t):
    df = requests(t).withColumnsRenamed({S.WHOLESALE: "Wholesale_Price", S.LOSS: "Loss_Rate"})
    df = serving.field_defaults(df)
    return df.select(S.DATE, c(S.ITEM), "Min_Price", "Max_Price", "Wholesale_Price", "Price_Volatility", "Loss_Rate", "Category_Code")


@query("v18_field_errors", f"""
    with {_REQUESTS}, x as (select avg_price - 2 as p, month + 1 as m, coalesce(loss_rate * 4, 5) as l from requests),
    e as (select 'Avg_Price' as field, count_if(p <= 0) as n from x union all select 'Month', count_if(m > 12) from x
          union all select 'Loss_Rate', count_if(l > 100) from x)
    select field, cast(n as bigint) as row_count from e where n > 0""")
def field_errors(t):
    df = requests(t).select(
        "Total_Quantity", (F.col("Avg_Price") - 2).alias("Avg_Price"), "Transaction_Count", (F.col("Month") + 1).alias("Month"),
        "DayOfWeek", "IsWeekend", F.coalesce(c(S.LOSS) * 4, F.lit(5.0)).alias("Loss_Rate"),
    )
    bad = serving.field_errors(df).select(F.explode("invalid_fields").alias("field"))
    return bad.groupBy("field").agg(F.count(F.lit(1)).alias("row_count"))


@query("p21_derive_missing", """
    select sale_date, item_code, r2(total_quantity * avg_price) as revenue, r4(discount_count / greatest(cast(transaction_count as double), 1)) as discount_rate,
        r4(max_price - min_price) as price_range, r4(total_quantity / greatest(transaction_count, 1)) as avg_quantity,
        cast(floor((month - 1) / 3) + 1 as bigint) as quarter,
        cast(list_extract([0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334], cast(month as int)) + 15 as bigint) as dayofyear,
        r4(sin(2 * pi() * month / 12)) as month_sin, r4(cos(2 * pi() * dayofweek / 7)) as dayofweek_cos,
        cast(floor((list_extract([0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334], cast(month as int)) + 15) / 7) + 1 as bigint) as weekofyear
    from calendar""", revenue=2)
def derive_missing(t):
    base = D.add_calendar(t.daily).select(
        S.DATE, S.ITEM, "Total_Quantity", "Avg_Price", "Transaction_Count", "Discount_Count", "Max_Price", "Min_Price", "Month", "DayOfWeek"
    )
    df = serving.derive_missing(base)
    return df.select(S.DATE, S.ITEM, "Revenue", "Discount_Rate", "Price_Range", "Avg_Quantity", "Quarter", "DayOfYear", "Month_Sin",
                     "DayOfWeek_Cos", "WeekOfYear")


@query("p22_select_inputs", """
    select r4(avg_price) as avg_price, r4(total_quantity) as total_quantity, r4(avg_quantity) as avg_quantity, transaction_count,
        r4(price_volatility) as price_volatility, r4(min_price) as min_price, r4(max_price) as max_price, discount_count,
        r2(revenue) as revenue, r4(discount_rate) as discount_rate, r4(price_range) as price_range from daily""", revenue=2)
def select_inputs(t):
    """Numeric inputs in the model's order, ids and names left out."""
    return serving.select_inputs(enrich.add_category(t.daily, t.items), ["Avg_Price", "Total_Quantity"])


@query("p23_required_inputs", """
    select sale_date, item_code, r4(avg_price) as avg_price, r4(0) as month_sin, r4(1) as retail_wholesale_ratio,
           r4(1) as price_relative_to_category, r4(0) as avg_price_lag_7, r4(0) as item_quantity_share from daily""")
def required_inputs(t):
    """Daily rows with every model input present."""
    df = serving.with_required(t.daily)
    return df.select(S.DATE, S.ITEM, "Avg_Price", "Month_Sin", "Retail_Wholesale_Ratio", "Price_Relative_to_Category",
                     "Avg_Price_Lag_7", "Item_Quantity_Share")


_EXPANDED = {
    "total_quantity": "q", "avg_quantity": "q / n", "revenue": "q * p", "discount_rate": "coalesce(discount_count, 2) / n",
    "price_range": "coalesce(max_price, 18) - coalesce(min_price, 12)", "month_cos": "cos(2 * pi() * month / 12)",
    "days_since_epoch": "1461 + 180 - 1", "retail_wholesale_ratio": "p / greatest(w, 0.1)", "price_markup_pct": "(p - w) / greatest(w, 0.1) * 100",
    "avg_price_change": "0.02", "avg_price_lag_7": "p", "revenue_ma_30": "p * q", "total_quantity_std_14": "q * 0.1",
    "avg_price_min_7": "coalesce(min_price, 12)", "category_revenue": "q * 4.5 * p", "item_quantity_share": "q / greatest(q * 4.5, 1)",
    "item_revenue_share": "q * p / greatest(q * 4.5 * p, 1)", "price_relative_to_category": "p / greatest(p, 0.1)",
    "effective_supply": "q * (1 - l / 100)", "loss_rate_category_medium": "case when l > 5 and l <= 15 then 1 else 0 end",
    "loss_rate_category_high": "case when l > 15 then 1 else 0 end", "loss_rate_category_very_high": "case when l > 25 then 1 else 0 end",
    "summer_price": "case when month in (6, 7, 8) then p else 0 end", "season_winter": "case when month in (12, 1, 2) then 1 else 0 end",
    "category_name_encoded": "2", "category_code": "1", "price_volatility_quantity": "coalesce(price_volatility, 1) * q",
}


@query("p24_serving_expansion", f"""
    with {_REQUESTS}, x as (select *, total_quantity as q, avg_price as p, greatest(cast(transaction_count as double), 1) as n,
        coalesce(wholesale_price, 12) as w, coalesce(loss_rate, 8) as l from requests)
    select sale_date, item_code, {", ".join(f"r3({sql}) as {name}" for name, sql in _EXPANDED.items())} from x""", digits=3)
def serving_expansion(t):
    df = serving.expand(requests(t), [S.DATE, S.ITEM])
    wanted = {n.lower().replace(" ", "_"): n for n in serving.SERVING_ORDER}
    return df.select(S.DATE, S.ITEM, *[c(wanted[n]) for n in _EXPANDED])


@query("p25_field_names", f"""
    with {_REQUESTS} select sale_date, item_code, r4(avg_price) as avg_price, r4(wholesale_price) as wholesale_price,
        r4(loss_rate) as loss_rate from requests""")
def field_names(t):
    """Request fields under their feature names."""
    sent = requests(t).withColumnsRenamed({v: k for k, v in serving.REQUEST_NAMES.items()})
    return serving.rename_fields(sent).select(S.DATE, S.ITEM, "Avg_Price", c(S.WHOLESALE), c(S.LOSS))


@query("p24_with_history", """
    select d.sale_date, d.item_code, r4(h.avg_price_lag_1) as avg_price_lag_1, r4(h.avg_price_ma_7) as avg_price_ma_7
    from daily d join (select * from (select item_code, avg_price_lag_1, avg_price_ma_7, row_number() over (partition by item_code order by sale_date desc) as k
        from features) x where k = 1) h on d.item_code = h.item_code""")
def with_history(t):
    history = series.add_rolling(series.add_lags(t.daily))
    df = serving.with_history(t.daily, history)
    return df.select(S.DATE, S.ITEM, "Avg_Price_Lag_1", "Avg_Price_MA_7")


_FIELDS = {"k": "bigint", "value": "double"}


def _bodies(t: Tables) -> DataFrame:
    """Events as request bodies in all accepted forms."""
    one = F.to_json(F.struct(F.get_json_object("props", "$.k").cast("long").alias("k"), F.round("value", 2).alias("value")))
    form = F.col("event_id") % 5
    body = (
        F.when(form == 0, F.concat(F.lit('{"instances": ['), one, F.lit(", "), one, F.lit("]}")))
        .when(form == 1, F.concat(F.lit('{"features": '), one, F.lit("}")))
        .when(form == 2, one)
        .when(form == 3, F.concat(F.lit("["), one, F.lit("]")))
    )
    lines = F.concat(F.lit("k,value\n"), F.get_json_object("props", "$.k"), F.lit(","), F.round("value", 2).cast("string"), F.lit("\n"))
    return t.raw("events").select("event_id", body.alias("body"), F.when(form == 4, lines).alias("csv"))


@query("s21_payloads", """
    select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, r2(round(value, 2)) as value
    from events, (select unnest([0, 1]) as copy) c where copy = 0 or event_id % 5 = 0""", digits=2)
def payloads(t):
    bodies = _bodies(t)
    rows = serving.parse_payloads(bodies.where(F.col("body").isNotNull()), "body", _FIELDS, ["event_id"])
    return rows.unionByName(serving.parse_csv_payloads(bodies.where(F.col("csv").isNotNull()), "csv", _FIELDS, ["event_id"]))


@query("s20_service_text", """
    select model_name, r4(count(*)) as total_requests, r4(count(latency_ms)) as prediction_count, r4(avg(latency_ms)) as average_latency_ms
    from request_log group by model_name""")
def service_text(t):
    """Exposition text written from the request log, read back."""
    totals = t.requests.groupBy("model_name", "endpoint").agg(F.count(F.lit(1)).alias("n"), F.sum("latency_ms").alias("ms"))
    sums = totals.groupBy("model_name").agg(F.sum("n").alias("n"), (F.sum("ms") / 1000).alias("s"))
    lines = totals.select("model_name", F.array(
        F.lit("# HELP api_requests_total requests 99"),
        F.concat(F.lit('api_requests_total{endpoint="'), "endpoint", F.lit('"} '), F.col("n").cast("string")),
    ).alias("l")).unionByName(sums.select("model_name", F.array(
        F.concat(F.lit("prediction_latency_seconds_sum "), F.col("s").cast("string")),
        F.concat(F.lit("prediction_latency_seconds_count "), F.col("n").cast("string")),
    ).alias("l"))).select("model_name", F.explode("l").alias("value"))
    return service_figures(lines, keys=["model_name"])


# ---- catalog ------------------------------------------------------------------------------------------------
_NUMBERS = ("Item Code,Total_Quantity,Avg_Quantity,Transaction_Count,Avg_Price,Price_Volatility,Min_Price,Max_Price,Discount_Count,"
            "Revenue,Discount_Rate,Price_Range")


@query("s7_feature_metadata", f"""
    with s as (select *, case when before < floor(n * 0.7) then 'train' when before < floor(n * 0.85) then 'validation' else 'test' end as split
        from (select sale_date, c, sum(c) over (order by sale_date) - c as before, sum(c) over () as n
              from (select sale_date, count(*) as c from daily group by sale_date) x) y)
    select count(*) as total_records, min(sale_date) as start_date, max(sale_date) as end_date, count(distinct item_code) as items_count,
        'Date,{_NUMBERS}' as feature_columns, '{_NUMBERS}' as numeric_features, '' as categorical_features, 13 as total_features,
        (select cast(sum(c) as bigint) from s where split = 'train') as train_records,
        (select cast(sum(c) as bigint) from s where split = 'validation') as validation_records,
        (select cast(sum(c) as bigint) from s where split = 'test') as test_records
    from daily""")
def feature_metadata(t):
    found = cat.feature_metadata(split.split_by_time(t.daily))
    return found.withColumns({n: F.array_join(n, ",") for n in ("feature_columns", "numeric_features", "categorical_features")})


def _with_gaps(definitions: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Definitions of columns with the number of missing values of each."""
    gaps = quality.missing_values(df).withColumnRenamed("column", key)
    return definitions.join(gaps, key, "left")


# fixed values: names, SQL types and feature types of the columns, with the column whose gaps they have
_TYPED = """typed as (select unnest([
    struct_pack(name := 'Item Code', kind := 'bigint', sort := 'Integral', empty := item_code is null),
    struct_pack(name := 'Date', kind := 'timestamp', sort := '', empty := sale_date is null),
""" + "".join(f"""    struct_pack(name := '{n}', kind := '{k}', sort := '{s}', empty := {source} is null),
""" for n, k, s, source in [
    *[(n, "double", "Fractional", n.lower()) for n in ("Total_Quantity", "Avg_Quantity", "Avg_Price", "Price_Volatility", "Min_Price",
                                                       "Max_Price", "Revenue", "Discount_Rate", "Price_Range")],
    *[(n, "bigint", "Integral", n.lower()) for n in ("Transaction_Count", "Discount_Count")],
    *[(n, "bigint", "Integral", "sale_date") for n in ("Year", "Month", "Quarter", "DayOfYear", "DayOfWeek", "WeekOfYear", "IsWeekend",
                                                       "IsNationalDay", "IsLaborDay", "Days_Since_Epoch")],
    *[(f"{n}_{x}", "double", "Fractional", "sale_date") for n in ("Month", "DayOfYear", "DayOfWeek") for x in ("Sin", "Cos")],
]) + """    struct_pack(name := 'Category Code', kind := 'bigint', sort := 'Integral', empty := category_code is null),
    struct_pack(name := 'Category Name', kind := 'string', sort := 'String', empty := category_name is null)]) as t
    from daily left join items using (item_code))"""
_GAPS = "count(*) filter (where t.empty) as missing_count, r2(count(*) filter (where t.empty) * 100.0 / count(*)) as missing_pct from typed"


@query("s10_type_table", f"with {_TYPED} select t.name as column, t.kind as sql_type, {_GAPS} group by 1, 2")
def type_table(t):
    """SQL type of every column, with its missing values."""
    df = enrich.add_category(D.add_calendar(t.daily), t.items)
    return _with_gaps(cat.type_table(df), df, "column")


@query("s13_feature_definitions", f"""
    with {_TYPED} select replace(t.name, ' ', '_') as feature_name, t.sort as feature_type, {_GAPS}
    where t.name not in ('Date', 'Item Code') group by 1, 2""")
def feature_definitions(t):
    """Feature type of every column, with its missing values."""
    df = enrich.add_category(D.add_calendar(t.daily), t.items)
    return _with_gaps(cat.feature_definitions(df), clean_columns(df), "feature_name")


@query("s11_smoke_rows", """
    select sale_date, item_code, r4(total_quantity) as total_quantity from daily order by sale_date, item_code limit 10""")
def smoke_rows(t):
    t.daily.createOrReplaceTempView("smoke_daily")
    return t.spark.sql("SELECT `Date`, `Item Code`, Total_Quantity FROM smoke_daily ORDER BY `Date`, `Item Code` LIMIT 10")


@query("s12_clean_names", """
    with n as (select concat('  ', p_name, ' (', p_brand, ') / ', p_type, ' %') as name from part),
    a as (select name, replace(replace(replace(replace(replace(name, ' ', '_'), '(', ''), ')', ''), '/', '_'), '%', '_pct') as x from n),
    b as (select name, replace(replace(replace(replace(x, '#', '_num'), '+', '_plus'), '.', '_'), ',', '_') as x from a),
    d as (select name, trim(regexp_replace(regexp_replace(x, '[^a-zA-Z0-9_]', '_', 'g'), '_+', '_', 'g'), '_') as x from b)
    select name, rtrim(substr(x, 1, 64), '_') as clean, count(*) as n from d group by 1, 2""")
def clean_names(t):
    name = F.concat(F.lit("  "), "p_name", F.lit(" ("), "p_brand", F.lit(") / "), "p_type", F.lit(" %"))
    rows = t.raw("part").select(name.alias("name"))
    return rows.groupBy("name", clean_name_expr(F.col("name")).alias("clean")).agg(F.count(F.lit(1)).alias("n"))


_GROUP = "select item_code, max(sale_date) as newest, max_by(avg_price, sale_date) as price, max_by(total_quantity, sale_date) as quantity from daily"


@query("s14_online_view", f"""
    select item_code, newest as sale_date, r4(price) as avg_price, r4(quantity) as total_quantity from ({_GROUP} group by item_code) x""")
def online_view(t):
    offline = cat.with_event_time(t.daily.select(S.DATE, S.ITEM, "Avg_Price", "Total_Quantity"))
    return cat.online_view(offline).drop("EventTime")


@query("s14_ingest", f"""
    select item_code, newest as sale_date, r4(price) as avg_price, r4(quantity) as total_quantity from ({_GROUP} group by item_code) x""")
def ingested_view(t):
    """The online view after several ingests into its buckets, the newest days in the first of them."""
    rows = cat.with_event_time(t.daily.select(S.DATE, S.ITEM, "Avg_Price", "Total_Quantity"))
    view = OnlineView(t.spark, fresh_folder(t.spark, "online"), ["Item_Code"], "EventTime", 16)
    for low, high in (("1997-01-01", "2999-01-01"), ("1900-01-01", "1995-01-01"), ("1995-01-01", "1997-01-01")):
        view.ingest(rows.where((c(S.DATE) >= low) & (c(S.DATE) < high)))
    return view.read(rows.schema).drop("EventTime")


@query("s14_time_travel", f"""
    select item_code, newest as sale_date, r4(price) as avg_price, r4(quantity) as total_quantity
    from ({_GROUP} where sale_date <= date '1998-06-01' group by item_code) x""")
def time_travel(t):
    offline = cat.with_event_time(t.daily.select(S.DATE, S.ITEM, "Avg_Price", "Total_Quantity"))
    return cat.online_view(offline, as_of=F.lit("1998-06-01").cast("timestamp")).drop("EventTime")
