"""Queries that run a stream over the given files to its end.

A table is a file or a folder of part files, and files come in any order, in as many micro-batches as there are. Windows
are closed ten minutes behind the newest event and restated by late rows; alerts, moving averages and sessions are stored in
mergeable form. One result, the drift verdict over all rows, compares a micro-batch as a whole and reads all files at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketgrain import schemas as S
from marketgrain.functions.naming import c
from marketgrain.operators import drift, ema as E, monitoring as H
from marketgrain.operators.cooldown import cooled_down
from marketgrain.queries.base import Tables, query, r
from marketgrain.queries.drift import NAMES, STATS
from marketgrain.queries.service import _RULES, naive_ts, violated
from marketgrain.sources import adapters as A
from marketgrain.streaming import jobs as J, runs, sessions as K, windows as W


class StreamTables(Tables):
    """The same domain tables with one given table read as a stream."""

    def __init__(self, t: Tables, streamed: str, files_per_trigger: int | None = 64):
        super().__init__(t.spark, t.folder)
        self.streamed, self.files_per_trigger = streamed, files_per_trigger

    def frame(self, name: str) -> DataFrame:
        static = A.table(self.spark, self.folder, name)
        if name != self.streamed:
            return static
        return runs.table_stream(self.spark, self.folder, name, static.schema, self.files_per_trigger)


def metric_stream(t: Tables, files_per_trigger: int | None = 64) -> DataFrame:
    rows = A.metrics_of(StreamTables(t, "events", files_per_trigger).frame("events"))
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def request_stream(t: Tables, files_per_trigger: int | None = 64) -> DataFrame:
    rows = A.requests_of(StreamTables(t, "events", files_per_trigger).frame("events"))
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def sale_stream(t: Tables, files_per_trigger: int | None = 64) -> DataFrame:
    tables = StreamTables(t, "lineitem", files_per_trigger)
    sales = A.sales_of(tables.frame("lineitem"), tables.frame("supplier"))
    return sales.withColumn("sold_at", c(S.DATE).cast("timestamp"))


_WINDOW = """select {start} as window_start, {start} + {width} as window_end, source, metric, count(value) as n, r4(avg(value)) as mean,
    r4(min(value)) as low, r4(max(value)) as high from {rows} group by 1, 2, 3, 4"""
_MINUTES = _WINDOW.format(start="date_trunc('minute', ts)", width="interval 1 minute", rows="metrics")


def replayed(stream: DataFrame, parts: W.Parts, label: str) -> DataFrame:
    """Every window of a stream that has run to its end: closed ones with their late rows, and open ones."""
    spark = stream.sparkSession
    folder = runs.fresh_folder(spark, label)
    runs.run_batches(stream, W.window_batches(folder, parts), f"{label}-state")
    return W.every(spark, folder, parts, W.part_schema(parts, stream.schema, spark))


@query("r1_metric_windows", _MINUTES)
def metric_windows(t):
    return naive_ts(J.metrics_of(replayed(metric_stream(t), J.metric_parts(), "windows")), "window_start", "window_end")


@query("r1_metric_windows_batch", _MINUTES)
def metric_windows_batch(t):
    return naive_ts(J.metric_windows(t.metrics), "window_start", "window_end")


_WEEK = _WINDOW.format(start="d", width="interval 7 day",
                       rows="(select m.*, date_trunc('day', ts) - k * interval 1 day as d from metrics m, (select unnest(range(0, 7)) as k) s) x")


@query("r5_trailing_week", _WEEK)
def trailing_week(t):
    rows = replayed(metric_stream(t), J.metric_parts("7 days", "1 day"), "weeks")
    return naive_ts(J.metrics_of(rows), "window_start", "window_end")


@query("r5_trailing_week_batch", _WEEK)
def trailing_week_batch(t):
    return naive_ts(J.metric_windows(t.metrics, width="7 days", slide="1 day"), "window_start", "window_end")


@query("r7_streaming_daily", f"""
    select sale_date, item_code, transaction_count, discount_count, {r('total_quantity avg_quantity avg_price price_volatility')},
           r2(revenue) as revenue from daily""", revenue=2)
def streaming_daily(t):
    """Every day, also those that are open when the input ends."""
    out = J.daily_of(replayed(J.sold(sale_stream(t)), J.daily_parts(), "daily"))
    return out.select(S.DATE, c(S.ITEM), "Transaction_Count", "Discount_Count", "Total_Quantity", "Avg_Quantity", "Avg_Price",
                      "Price_Volatility", "Revenue")


_EARLY = "select cast(quantity as double) as quantity, cast(unit_price as double) as unit_price from sales where sale_date < date '1998-06-01'"


@query("r2_drift_windows", f"""
    with early as ({_EARLY}),
    ref as (select 'quantity' as feature, quantity as v from early union all select 'unit_price', unit_price from early),
    cur as (select sale_date, 'quantity' as feature, cast(quantity as double) as v from sales
            union all select sale_date, 'unit_price', unit_price from sales),
    rs as (select feature, {STATS} from ref group by feature),
    cs as (select sale_date, feature, {STATS} from cur group by sale_date, feature),
    scores as (select c.sale_date, c.feature, (abs(c.mean - r.mean) + abs(c.std - r.std) + abs(c.median - r.median)) / r.std / 3 as score
               from cs c join rs r on r.feature = c.feature)
    select cast(sale_date as timestamp) as window_start, cast(sale_date as timestamp) + interval 60 minute as window_end,
        count(*) as total_features, count(*) filter (where score > 0.25) as drifted_features, r6(avg(score)) as drift_score,
        r6(max(score)) as max_drift_score, r6(min(score)) as min_drift_score,
        r6(count(*) filter (where score > 0.25) / count(*)) as drift_ratio,
        count(*) filter (where score > 0.25) / count(*) > 0.3 or avg(score) > 0.25 as overall_drift_detected
    from scores group by sale_date""", digits=6)
def drift_windows(t):
    """The verdict of every window of 60 minutes (sales have days, so one a day) against the stored profile of early sales."""
    names = NAMES[:2]
    early = t.sales.where(c(S.DATE) < "1998-06-01").select(c(S.QUANTITY).alias("quantity"), c(S.PRICE).alias("unit_price"))
    folder = runs.fresh_folder(t.spark, "drift-windows")
    drift.profile(early, names).write.parquet(f"{folder}/profile")
    reference = t.spark.read.parquet(f"{folder}/profile")
    stream = sale_stream(t).select(c(S.QUANTITY).alias("quantity"), c(S.PRICE).alias("unit_price"), "sold_at")
    parts = J.drift_parts(names, ts="sold_at")
    runs.run_batches(stream, J.drift_window_batches(reference, names, folder, parts), "drift-windows-state")
    every = W.every(t.spark, folder, parts, W.part_schema(parts, stream.schema, t.spark))
    return naive_ts(J.window_verdicts(reference, every, names), "window_start", "window_end")


@query("r2_windowed_drift", f"""
    with base as (select sale_date, quantity, unit_price from sales),
    ref as (select 'quantity' as feature, quantity as v from base where sale_date < date '1998-06-01'
            union all select 'unit_price', unit_price from base where sale_date < date '1998-06-01'),
    cur as (select 'quantity' as feature, quantity as v from base union all select 'unit_price', unit_price from base),
    rs as (select feature, {STATS} from ref group by feature), cs as (select feature, {STATS} from cur group by feature)
    select r.feature, r6((abs(c.mean - r.mean) + abs(c.std - r.std) + abs(c.median - r.median)) / r.std / 3) as drift_score,
           (abs(c.mean - r.mean) + abs(c.std - r.std) + abs(c.median - r.median)) / r.std / 3 > 0.25 as drift_detected
    from rs r join cs c on r.feature = c.feature""", digits=6)
def windowed_drift(t):
    """All given sales, read as one micro-batch, compared with the stored profile of early sales."""
    early = t.sales.where(c(S.DATE) < "1998-06-01").select(c(S.QUANTITY).alias("quantity"), c(S.PRICE).alias("unit_price"))
    folder = runs.fresh_folder(t.spark, "drift")
    drift.profile(early, NAMES[:2]).write.parquet(f"{folder}/profile")
    stored = t.spark.read.parquet(f"{folder}/profile")
    stream = sale_stream(t, None).select(c(S.QUANTITY).alias("quantity"), c(S.PRICE).alias("unit_price"))
    runs.run_batches(stream, J.drift_batches(stored, NAMES[:2], folder), "drift-state")
    return t.spark.read.parquet(f"{folder}/results").drop("batch")


_COOLED = f"""
    with recursive {_RULES}, a as (select alert_type, entity, event_id, severity, value, epoch_us(ts) as t from {violated('metrics')} x),
    picked as (
        select alert_type, entity, min(t) as t from a group by 1, 2
        union all
        select p.alert_type, p.entity, (select min(a.t) from a where a.alert_type = p.alert_type and a.entity = p.entity
               and a.t >= p.t + 1800000000) as t from picked p where p.t is not null),
    firsts as (select p.alert_type, p.entity, min(a.event_id) as event_id from picked p
               join a on a.alert_type = p.alert_type and a.entity = p.entity and a.t = p.t group by p.alert_type, p.entity, p.t)"""


@query("r3_alert_stream", f"""{_COOLED}
    select f.alert_type, f.entity, f.event_id, a.severity, r4(a.value) as value
    from firsts f join a on a.alert_type = f.alert_type and a.entity = f.entity and a.event_id = f.event_id""")
def alert_stream(t):
    """Alerts with a cooldown of 30 minutes per type and entity, from a stream of violations in any order."""
    folder, stream, rules = runs.fresh_folder(t.spark, "alerts"), metric_stream(t), H.rules_table(t.spark)
    runs.run_batches(stream, J.alert_batches(folder, rules), "alerts-state")
    kinds = H.violations(t.spark.createDataFrame([], stream.schema), rules).select("alert_type", "entity", *J.VIOLATION).schema
    return J.settled(t.spark, folder, kinds).select("alert_type", "entity", "event_id", "severity", "value")


@query("r3_alert_cooldown", f"{_COOLED} select alert_type, entity, event_id from firsts")
def alert_cooldown(t):
    """The batch form of the same rule."""
    return cooled_down(H.violations(t.metrics, H.rules_table(t.spark)), ["alert_type", "entity"])


_EMA = """select model_name, any_value(n) as n, r6(sum(latency_ms * case when k = 1 then power(0.9, n - 1) else 0.1 * power(0.9, n - k) end)) as ema
    from (select *, row_number() over (partition by model_name order by ts, request_id) as k, count(*) over (partition by model_name) as n
          from request_log) x group by model_name"""


@query("r4_ema_stream", _EMA, digits=6)
def ema_stream(t):
    """The moving average per model after the last micro-batch."""
    folder, keys = runs.fresh_folder(t.spark, "ema"), ["model_name"]
    runs.run_batches(request_stream(t), E.ema_batches(folder, keys, "ts", ["request_id"], "latency_ms"), "ema-state")
    return E.stored_ema(t.spark, folder, keys, 0.1, "model_name string")


@query("r6_streaming_validation", """
    select 'good' as part, count(*) as n from sales where quantity <= 45
    union all select 'bad', count(*) from sales where quantity > 45""")
def streaming_validation(t):
    """Sales of more than 45 units are made negative, so that the rules quarantine them."""
    rows = sale_stream(t).withColumn(S.QUANTITY, F.when(c(S.QUANTITY) > 45, -c(S.QUANTITY)).otherwise(c(S.QUANTITY)))
    rows = rows.withColumn(S.KIND, F.lit("Sale")).drop("sold_at")
    folder = runs.fresh_folder(t.spark, "validation")
    runs.run_batches(rows, J.validation_batches(folder), "validation-state")
    parts = [t.spark.read.parquet(f"{folder}/{p}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(p).alias("part"), "n") for p in ("good", "bad")]
    return parts[0].unionByName(parts[1])


_SESSIONS = """
    with x as (select *, case when ts - lag(ts) over (partition by user_id order by ts) < interval 10 minute then 0 else 1 end as opens from request_log),
    y as (select *, sum(opens) over (partition by user_id order by ts, request_id rows between unbounded preceding and current row) as s from x)
    select user_id, min(ts) as session_start, max(ts) + interval 10 minute as session_end, count(*) as requests, r4(avg(latency_ms)) as mean_ms
    from y group by user_id, s"""


@query("r8_sessions_batch", _SESSIONS)
def sessions_batch(t):
    return naive_ts(J.sessions(t.requests), "session_start", "session_end")


@query("r8_sessions", _SESSIONS)
def sessions(t):
    """Every session, also those that are open when the input ends."""
    folder, stream, values = runs.fresh_folder(t.spark, "sessions"), request_stream(t), {"ms": F.col("latency_ms")}
    runs.run_batches(stream, K.fragment_batches(folder, "user_id", 600, values), "sessions-state")
    found = K.stored_sessions(t.spark, folder, "user_id", 600, values, stream.schema)
    found = found.select("user_id", "session_start", "session_end", F.col("rows").alias("requests"), W.mean("ms").alias("mean_ms"))
    return naive_ts(found, "session_start", "session_end")
