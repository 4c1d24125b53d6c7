"""Registration of named queries together with the SQL that checks them.

A query is a function of the domain tables. Its check is written over the common table expressions below,
which state the same tables in plain SQL; only the expressions a check uses are put in front of it.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from marketgrain import schemas as S
from marketgrain.functions.naming import c, clean_name
from marketgrain.operators import daily as D
from marketgrain.plans.features import raw_features
from marketgrain.sources import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Domain tables of one folder, built when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return A.table(self.spark, self.folder, name)

    @cached_property
    def sales(self) -> DataFrame:
        return A.sales(self.spark, self.folder)

    @cached_property
    def items(self) -> DataFrame:
        return A.items(self.spark, self.folder)

    @cached_property
    def quotes(self) -> DataFrame:
        return A.wholesale(self.spark, self.folder)

    @cached_property
    def wholesale(self) -> DataFrame:
        from marketgrain.operators.enrich import wholesale_per_day

        return wholesale_per_day(self.quotes)

    @cached_property
    def loss_rates(self) -> DataFrame:
        return A.loss_rates(self.spark, self.folder)

    @cached_property
    def requests(self) -> DataFrame:
        return A.request_log(self.spark, self.folder)

    @cached_property
    def metrics(self) -> DataFrame:
        return A.metrics(self.spark, self.folder)

    @cached_property
    def daily(self) -> DataFrame:
        return D.daily_aggregate(self.sales)

    @cached_property
    def features(self) -> DataFrame:
        return raw_features(self.sales, self.quotes, self.items, self.loss_rates)

    @cached_property
    def dirty_sales(self) -> DataFrame:
        """Sales with some empty, negative and repeated content, the same in both engines."""
        mark = F.col("sale_id")
        return self.sales.withColumns({
            S.PRICE: F.when(mark % 97 != 0, c(S.PRICE)),
            S.QUANTITY: F.when(mark % 89 == 0, -c(S.QUANTITY)).otherwise(c(S.QUANTITY)),
            S.KIND: F.when(mark % 83 != 0, c(S.KIND)),
        })


def rounded_column(col, digits: int):
    """Round half away from zero; values within 1e-4 of a tie count as the tie, so that both engines agree."""
    number, scale = col.cast("double"), 10.0**digits
    return F.signum(number).cast("long") * F.floor(F.abs(number) * scale + F.lit(0.5001)) / F.lit(scale)


def tidy(df: DataFrame, digits: int = 4, **by_name: int) -> DataFrame:
    """Final shape of a query: short lower-case names, 64-bit integers, rounded doubles."""
    columns = []
    for field in df.schema.fields:
        col, name = c(field.name), SHORT.get(field.name) or clean_name(field.name).lower()
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            col = rounded_column(col, by_name.get(name, digits))
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("long")
        columns.append(col.alias(name))
    return df.select(*columns)


#: short names in query results
SHORT = {
    S.DATE: "sale_date", S.QUANTITY: "quantity", S.PRICE: "unit_price", S.KIND: "sale_or_return",
    S.DISCOUNT: "discount", S.WHOLESALE: "wholesale_price", S.LOSS: "loss_rate",
}


def query(name: str, sql: str | None = None, digits: int = 4, **by_name: int):
    """Register a function of ``Tables`` under ``name``; ``sql`` is its check."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: tidy(build(Tables(spark, folder)), digits, **by_name)
        if sql is not None:
            ORACLES[name] = with_tables(rounded(sql))
        return build

    return register


def rounded(sql: str) -> str:
    """Expand ``rN(expr)`` to a double rounded to N digits, as ``rounded_column`` does."""
    while match := re.search(r"\br(\d)\(", sql):
        depth, end = 1, match.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[match.end():end - 1]
        scale = f"cast(1e{match.group(1)} as double)"
        number = f"cast({inner} as double)"
        whole = f"cast(sign({number}) as bigint) * cast(floor(abs({number}) * {scale} + 0.5001) as bigint)"
        sql = f"{sql[:match.start()]}({whole} / {scale}){sql[end:]}"
    return sql


def r(names: str, digits: int = 4) -> str:
    """Select list of rounded columns."""
    return ", ".join(f"r{digits}({n}) as {n}" for n in names.split())


def with_tables(sql: str) -> str:
    """Put the table expressions that ``sql`` uses in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                visit(TABLES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    heads = ",\n".join(f"{n} as ({TABLES[n]})" for n in needed)
    body = sql.strip()
    if body.lower().startswith("with recursive "):
        return f"with recursive {heads},\n{body[15:]}"
    if body.lower().startswith("with "):
        return f"with {heads},\n{body[5:]}"
    return f"with {heads}\n{body}"


_LAGGED = ("avg_price", "total_quantity", "revenue")
_LAG_SQL = ", ".join(f"lag({n}, {k}) over item as {n}_lag_{k}" for k in S.LAGS for n in _LAGGED)
_ROLL_SQL = ", ".join(
    f"{fn}({n}) over (partition by item_code order by sale_date rows between {k - 1} preceding and current row) as {out}_{k}"
    for k in S.WINDOWS
    for fn, n, out in (
        ("avg", "avg_price", "avg_price_ma"), ("avg", "total_quantity", "total_quantity_ma"),
        ("avg", "revenue", "revenue_ma"), ("stddev_samp", "avg_price", "avg_price_std"),
        ("stddev_samp", "total_quantity", "total_quantity_std"), ("min", "avg_price", "avg_price_min"),
        ("max", "avg_price", "avg_price_max"),
    )
)
_LEAD_SQL = ", ".join(
    f"lead(avg_price, {h}) over item as avg_price_target_{h}d, "
    f"(lead(avg_price, {h}) over item - avg_price) / nullif(avg_price, 0) * 100 as price_change_target_{h}d, "
    f"lead(total_quantity, {h}) over item as quantity_target_{h}d"
    for h in S.HORIZONS
)

SEASON_SQL = (
    "case when {m} in (3, 4, 5) then 'Spring' when {m} in (6, 7, 8) then 'Summer' "
    "when {m} in (9, 10, 11) then 'Autumn' else 'Winter' end"
)
BAND_SQL = (
    "case when {x} > 0 and {x} <= 5 then 'Low' when {x} > 5 and {x} <= 15 then 'Medium' "
    "when {x} > 15 and {x} <= 25 then 'High' when {x} > 25 and {x} <= 100 then 'Very_High' end"
)

TABLES: dict[str, str] = {
    "sales": """
        select cast(l_shipdate as date) as sale_date, cast(l_orderkey * 10 + l_linenumber as bigint) as sale_id,
               cast(s_nationkey as bigint) as item_code, l_quantity as quantity,
               l_extendedprice / l_quantity / 100 as unit_price,
               case when l_returnflag = 'R' then 'Return' else 'Sale' end as sale_or_return,
               case when l_discount > 0.07 then 'Yes' else 'No' end as discount
        from lineitem join supplier on l_suppkey = s_suppkey""",
    "dirty_sales": """
        select sale_date, sale_id, item_code,
               case when sale_id % 89 = 0 then -quantity else quantity end as quantity,
               case when sale_id % 97 <> 0 then unit_price end as unit_price,
               case when sale_id % 83 <> 0 then sale_or_return end as sale_or_return, discount
        from sales""",
    "items": """
        select cast(n_nationkey as bigint) as item_code, n_name as item_name,
               cast(r_regionkey as bigint) as category_code, r_name as category_name
        from nation join region on n_regionkey = r_regionkey""",
    "quotes": """
        select cast(o_orderdate as date) as sale_date, cast(s_nationkey as bigint) as item_code,
               p_retailprice * 0.01 as wholesale_price
        from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey
             join part on l_partkey = p_partkey""",
    "wholesale": """
        select sale_date, item_code, avg(wholesale_price) as wholesale_price
        from quotes group by sale_date, item_code""",
    "loss_rates": """
        select cast(n_nationkey as bigint) as item_code, n_name as item_name,
               cast(round(n_nationkey * 1.3, 2) as double) as loss_rate
        from nation where n_nationkey % 7 <> 3""",
    "request_log": """
        select ts, event_id as request_id, event_type as endpoint,
               case when user_id % 2 = 0 then 'POST' else 'GET' end as method,
               case when event_type = 'error' then 500 else 200 end as status,
               concat('m', cast(user_id % 4 as varchar)) as model_name, user_id, value as latency_ms
        from events""",
    "metrics": """
        select ts, event_id,
               case event_type when 'click' then 'system' when 'view' then 'system' when 'error' then 'api'
                               when 'purchase' then 'models' else 'data_quality' end as source,
               concat('e', cast(user_id % 5 as varchar)) as entity,
               case event_type when 'click' then 'cpu_percent' when 'view' then 'memory_percent'
                               when 'error' then 'average_latency_ms' when 'purchase' then 'val_mape'
                               else 'quality_score' end as metric,
               case event_type when 'error' then value * 10 when 'purchase' then value / 5
                               when 'signup' then 100 - least(value, 100) else least(value * 5, 100) end as value
        from events""",
    "daily": """
        select sale_date, item_code, coalesce(sum(quantity), 0) as total_quantity, avg(quantity) as avg_quantity,
               count(quantity) as transaction_count, avg(unit_price) as avg_price,
               coalesce(stddev_samp(unit_price), 0) as price_volatility, min(unit_price) as min_price,
               max(unit_price) as max_price,
               cast(sum(case when discount = 'Yes' then 1 else 0 end) as bigint) as discount_count,
               sum(quantity) * avg(unit_price) as revenue,
               coalesce(sum(case when discount = 'Yes' then 1 else 0 end) / nullif(cast(count(quantity) as double), 0), 0)
                   as discount_rate,
               max(unit_price) - min(unit_price) as price_range
        from sales where lower(sale_or_return) = 'sale' and sale_date is not null
        group by sale_date, item_code""",
    "calendar": f"""
        select *, year(sale_date) as year, month(sale_date) as month, quarter(sale_date) as quarter,
               dayofyear(sale_date) as dayofyear, isodow(sale_date) - 1 as dayofweek, week(sale_date) as weekofyear,
               cast(case when isodow(sale_date) >= 6 then 1 else 0 end as bigint) as isweekend,
               sin(2 * pi() * month(sale_date) / 12) as month_sin, cos(2 * pi() * month(sale_date) / 12) as month_cos,
               sin(2 * pi() * dayofyear(sale_date) / 365) as dayofyear_sin,
               cos(2 * pi() * dayofyear(sale_date) / 365) as dayofyear_cos,
               sin(2 * pi() * (isodow(sale_date) - 1) / 7) as dayofweek_sin,
               cos(2 * pi() * (isodow(sale_date) - 1) / 7) as dayofweek_cos,
               cast(case when month(sale_date) = 10 and dayofyear(sale_date) between 274 and 280 then 1 else 0 end
                   as bigint) as isnationalday,
               cast(case when month(sale_date) = 5 and dayofyear(sale_date) between 121 and 125 then 1 else 0 end
                   as bigint) as islaborday,
               {SEASON_SQL.format(m="month(sale_date)")} as season,
               date_diff('day', date '2020-01-01', sale_date) as days_since_epoch
        from daily""",
    "priced": """
        select d.*, w.wholesale_price, coalesce(avg_price / nullif(w.wholesale_price, 0), 1) as retail_wholesale_ratio,
               coalesce(avg_price - w.wholesale_price, 0) as price_markup,
               coalesce(coalesce(avg_price - w.wholesale_price, 0) / nullif(w.wholesale_price, 0) * 100, 0)
                   as price_markup_pct
        from calendar d left join wholesale w on d.sale_date = w.sale_date and d.item_code = w.item_code""",
    "categorised": """
        select *, coalesce(total_quantity / nullif(category_total_quantity, 0), 0) as item_quantity_share,
               coalesce(revenue / nullif(category_revenue, 0), 0) as item_revenue_share,
               coalesce(avg_price / nullif(category_avg_price, 0), 1) as price_relative_to_category
        from (select p.*, i.category_code, i.category_name,
                     sum(total_quantity) over (partition by p.sale_date, i.category_code) as category_total_quantity,
                     avg(avg_price) over (partition by p.sale_date, i.category_code) as category_avg_price,
                     sum(revenue) over (partition by p.sale_date, i.category_code) as category_revenue
              from priced p left join items i on p.item_code = i.item_code) x""",
    "lossy": f"""
        select *, total_quantity * (1 - loss_rate / 100) as effective_supply,
               total_quantity * (1 - loss_rate / 100) * avg_price as loss_adjusted_revenue,
               {BAND_SQL.format(x="loss_rate")} as loss_rate_category
        from (select k.*, coalesce(l.loss_rate, avg(l.loss_rate) over (partition by k.category_code), 10) as loss_rate
              from categorised k left join loss_rates l on k.item_code = l.item_code) x""",
    "features": f"""
        select *, avg_price * total_quantity as price_quantity_interaction,
               price_volatility * total_quantity as price_volatility_quantity,
               case when season = 'Spring' then avg_price else 0 end as spring_price,
               case when season = 'Summer' then avg_price else 0 end as summer_price,
               case when season = 'Autumn' then avg_price else 0 end as autumn_price,
               case when season = 'Winter' then avg_price else 0 end as winter_price,
               total_quantity * (isnationalday + islaborday) as holiday_demand,
               avg_price / nullif(lag(avg_price) over item, 0) - 1 as avg_price_change,
               padded / nullif(lag(padded) over item, 0) - 1 as wholesale_price_change,
               {_LAG_SQL}, {_ROLL_SQL}, {_LEAD_SQL}
        from (select *, last_value(wholesale_price ignore nulls) over (
                  partition by item_code order by sale_date rows between unbounded preceding and current row) as padded
              from lossy) x
        window item as (partition by item_code order by sale_date)""",
}
