"""Queries that check data quality and business rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from marketgrain import schemas as S
from marketgrain.functions.naming import c
from marketgrain.operators import enrich, quality as Q
from marketgrain.queries.base import query

COLUMNS = (
    ("Date", "sale_date"), ("sale_id", "sale_id"), (S.ITEM, "item_code"), (S.QUANTITY, "quantity"),
    (S.PRICE, "unit_price"), (S.KIND, "sale_or_return"), (S.DISCOUNT, "discount"),
)
NUMBERS = COLUMNS[1:5]
SIGNED = COLUMNS[3:5]


def _union(parts) -> str:
    return "\nunion all\n".join(parts)


def missing_sql(table: str, columns) -> str:
    return _union(
        f"""select '{label}' as "column", count(*) - count({name}) as missing_count,
            r2((count(*) - count({name})) * 100.0 / count(*)) as missing_pct from {table}"""
        for label, name in columns
    )


def outlier_sql(table: str, columns) -> str:
    return _union(
        f"""select '{label}' as "column", cast(count_if({name} < q1 - 1.5 * (q3 - q1) or {name} > q3 + 1.5 * (q3 - q1)) as bigint)
                as outlier_count,
            r2(count_if({name} < q1 - 1.5 * (q3 - q1) or {name} > q3 + 1.5 * (q3 - q1)) * 100.0 / count(*)) as outlier_pct,
            r2(any_value(q1 - 1.5 * (q3 - q1))) as lower_bound, r2(any_value(q3 + 1.5 * (q3 - q1))) as upper_bound
            from {table}, (select quantile_cont(cast({name} as double), 0.25) as q1,
                                  quantile_cont(cast({name} as double), 0.75) as q3 from {table}) b"""
        for label, name in columns
    )


def negative_sql(table: str, columns) -> str:
    return _union(
        f"""select '{label}' as "column", cast(count_if({name} < 0) as bigint) as negative_count,
            r2(count_if({name} < 0) * 100.0 / count(*)) as negative_pct from {table}"""
        for label, name in columns
    )


def score_sql(label: str, table: str, columns, numbers, signed) -> str:
    names = ", ".join(n for _, n in columns)
    return f"""
    select '{label}' as table_name, total_rows, m as avg_missing_pct, d as duplicate_pct, o as avg_outlier_pct,
           n as avg_negative_pct, greatest(0.0, least(100.0, r2(100 - m * 2 - d * 5 - greatest(o - 5, 0) * 0.5 - n * 10)))
           as quality_score
    from (select total_rows, duplicate_rows * 100.0 / total_rows as d,
              (select avg(missing_pct) from ({missing_sql(table, columns)}) x) as m,
              (select sum(outlier_pct) / (count(*) + 1) from ({outlier_sql(table, numbers)}) x) as o,
              (select coalesce(sum(negative_pct), 0) / (count(*) + 1) from (
                  {negative_sql(table, signed) if signed else 'select 0.0 as negative_pct where false'}) x) as n
          from (select cast(sum(n) as bigint) as total_rows, cast(sum(n) - count(*) as bigint) as duplicate_rows
                from (select count(*) as n from {table} group by {names}) g) t) u"""


@query("v1_columns", """
    select ['Time'] as missing_columns, ['sale_id'] as extra_columns, false as columns_match, count(*) as total_rows from sales""")
def columns(t):
    """Missing and extra columns of the sales table, with its size."""
    rows = t.sales.agg(F.count(F.lit(1))).scalar()
    return Q.check_columns(t.sales, S.RAW_SCHEMAS["sales"]).withColumn("total_rows", rows)


@query("v2_types", """
    select 'Date' as "column", 'string' as expected, 'date' as actual, count(*) - count(sale_date) as missing_count,
           r2(0) as missing_pct from sales
    union all select 'Quantity Sold (kilo)', 'bigint', 'double', count(*) - count(quantity), r2(0) from sales""", digits=2)
def types(t):
    expected = T.StructType([T.StructField(S.DATE, T.StringType()), T.StructField(S.ITEM, T.LongType()),
                             T.StructField(S.QUANTITY, T.LongType()), T.StructField(S.KIND, T.StringType())])
    gaps = Q.missing_values(t.sales)
    return Q.check_types(t.sales, expected).join(gaps, "column", "left")


@query("v3_missing", missing_sql("dirty_sales", COLUMNS), digits=2)
def missing(t):
    return Q.missing_values(t.dirty_sales, [n for n, _ in COLUMNS])


@query("v3_missing_documents", missing_sql("labelled", [(n, n) for n in ("doc_id", "lang", "quality", "toxic")]).replace(
    "from labelled", "from (select d.doc_id, d.lang, l.quality, l.toxic from documents d left join labels l on d.doc_id = l.doc_id) t"),
       digits=2)
def missing_documents(t):
    df = t.raw("documents").join(t.raw("labels"), "doc_id", "left").select("doc_id", "lang", "quality", "toxic")
    return Q.missing_values(df)


@query("v4_duplicates", """
    select cast(sum(n) - count(*) as bigint) as duplicate_rows, cast(sum(n) as bigint) as total_rows
    from (select count(*) as n from dirty_sales
          group by sale_date, item_code, quantity, sale_or_return, discount) t""")
def duplicates(t):
    return Q.duplicate_rows(t.dirty_sales.select(S.DATE, S.ITEM, S.QUANTITY, S.KIND, S.DISCOUNT))


@query("v4_duplicate_documents", """
    select cast(sum(n) - count(*) as bigint) as duplicate_rows, cast(sum(n) as bigint) as total_rows
    from (select count(*) as n from documents group by text) t""")
def duplicate_documents(t):
    return Q.duplicate_rows(t.raw("documents").select("text"))


@query("v5_date_range", """
    select 'Date' as "column", min(sale_date) as min_date, max(sale_date) as max_date,
           date_diff('day', min(sale_date), max(sale_date)) as span_days from sales""")
def date_range(t):
    return Q.date_ranges(t.sales)


@query("v6_outliers", outlier_sql("dirty_sales", NUMBERS), digits=2)
def outliers(t):
    return Q.outliers(t.dirty_sales)


@query("v7_negatives", negative_sql("dirty_sales", SIGNED), digits=2)
def negatives(t):
    return Q.negative_values(t.dirty_sales)


_ITEMS = (("Item Code", "item_code"), ("Item Name", "item_name"), ("Category Code", "category_code"), ("Category Name", "category_name"))
_QUOTES = (("Date", "sale_date"), ("Item Code", "item_code"), (S.WHOLESALE, "wholesale_price"))
_LOSS = (("Item Code", "item_code"), ("Item Name", "item_name"), (S.LOSS, "loss_rate"))
_SCORES = _union([
    f"select * from ({score_sql('sales', 'dirty_sales', COLUMNS, NUMBERS, SIGNED)}) a",
    f"select * from ({score_sql('items', 'items', _ITEMS, (_ITEMS[0], _ITEMS[2]), ())}) b",
    f"select * from ({score_sql('wholesale', 'wholesale', _QUOTES, _QUOTES[1:], _QUOTES[2:])}) c",
    f"select * from ({score_sql('loss_rates', 'loss_rates', _LOSS, (_LOSS[0], _LOSS[2]), _LOSS[2:])}) d",
])


def _scores(t) -> DataFrame:
    tables = {"sales": t.dirty_sales, "items": t.items, "wholesale": t.wholesale, "loss_rates": t.loss_rates}
    return reduce(DataFrame.unionByName, [Q.quality_score(df, name) for name, df in tables.items()])


@query("v8_quality_score", f"""
    select table_name, total_rows, r4(avg_missing_pct) as avg_missing_pct, r4(duplicate_pct) as duplicate_pct,
           r4(avg_outlier_pct) as avg_outlier_pct, r4(avg_negative_pct) as avg_negative_pct, r4(quality_score) as quality_score
    from ({_SCORES}) s""")
def quality_score(t):
    return _scores(t)


def _known_items(t):
    """The items with a loss rate, so that some sold items are unknown."""
    return t.items.join(t.loss_rates.select(S.ITEM), S.ITEM, "left_semi")


_KNOWN = "(select i.* from items i join loss_rates l on i.item_code = l.item_code)"
_ORPHANS = f"""
    select 'Sales items exist in master data' as rule, count(*) = 0 as passed,
           concat('Found ', cast(count(*) as varchar), ' orphan items in sales data') as details
    from (select distinct item_code from dirty_sales where item_code not in (select item_code from {_KNOWN} k)) t"""
_WHOLESALE_RULE = """
    select 'Wholesale prices are reasonable' as rule,
           count_if(wholesale_price <= 0) = 0 and count_if(wholesale_price > 1000) < count(*) * 0.01 as passed,
           concat('Zero/negative prices: ', cast(count_if(wholesale_price <= 0) as varchar),
                  ', Extremely high prices: ', cast(count_if(wholesale_price > 1000) as varchar)) as details
    from wholesale"""
_LOSS_RULE = """
    select 'Loss rates are valid percentages (0-100%)' as rule, count_if(loss_rate < 0 or loss_rate > 100) = 0 as passed,
           concat('Invalid loss rates: ', cast(count_if(loss_rate < 0 or loss_rate > 100) as varchar)) as details
    from loss_rates"""
_QUANTITY_RULE = """
    select 'Sale quantities are positive' as rule, count_if(lower(sale_or_return) = 'sale' and quantity <= 0) = 0 as passed,
           concat('Negative/zero quantities in sales: ',
                  cast(count_if(lower(sale_or_return) = 'sale' and quantity <= 0) as varchar)) as details
    from dirty_sales"""


@query("v9_orphan_items", _ORPHANS)
def orphan_items(t):
    return Q.rule_orphans(t.dirty_sales, _known_items(t))


@query("v10_wholesale_rule", _WHOLESALE_RULE)
def wholesale_rule(t):
    return Q.rule_wholesale(t.wholesale)


@query("v11_loss_rule", _LOSS_RULE)
def loss_rule(t):
    return Q.rule_loss(t.loss_rates)


@query("v12_quantity_rule", _QUANTITY_RULE)
def quantity_rule(t):
    return Q.rule_quantity(t.dirty_sales)


@query("v13_rule_summary", f"""
    select cast(count_if(passed) as bigint) as rules_passed, cast(count_if(not passed) as bigint) as rules_failed
    from ({_union(f"select * from ({x}) q{i}" for i, x in enumerate((_ORPHANS, _WHOLESALE_RULE, _LOSS_RULE, _QUANTITY_RULE)))}) r""")
def rule_summary(t):
    tables = {"sales": t.dirty_sales, "items": _known_items(t), "wholesale": t.wholesale, "loss_rates": t.loss_rates}
    return Q.rule_summary(Q.business_rules(tables))


@query("v14_run_summary", f"""
    select tables_validated, total_quality_score, total_quality_score >= 70 as validation_passed,
           case when total_quality_score < 80 then 'Consider data cleaning to improve quality score' end as recommendation
    from (select count(*) as tables_validated, r2(avg(quality_score)) as total_quality_score from ({_SCORES}) s) t""")
def run_summary(t):
    return Q.run_summary(_scores(t))


def _overview_sql(label, table, columns, unique) -> str:
    empties = " + ".join(f"(count(*) - count({n}))" for _, n in columns)
    names = ", ".join(n for _, n in columns)
    return f"""
    select '{label}' as dataset, count(*) as row_count, cast({len(columns)} as bigint) as column_count,
           (select cast(sum(n) - count(*) as bigint) from (select count(*) as n from {table} group by {names}) g) as duplicate_rows,
           r2(({empties}) * 100.0 / (count(*) * {len(columns)})) as missing_pct, count(distinct {unique}) as unique_items
    from {table}"""


@query("v15_table_overview", _union([
    _overview_sql("sales", "dirty_sales", COLUMNS, "item_code"), _overview_sql("items", "items", _ITEMS, "item_code"),
    _overview_sql("wholesale", "wholesale", _QUOTES, "item_code"), _overview_sql("loss_rates", "loss_rates", _LOSS, "item_code"),
]))
def table_overview(t):
    tables = {"sales": t.dirty_sales, "items": t.items, "wholesale": t.wholesale, "loss_rates": t.loss_rates}
    return reduce(DataFrame.unionByName, [Q.table_overview(df, name) for name, df in tables.items()])


@query("v16_recommendations", """
    with counted as (
        select 'non_positive_prices' as finding, cast(count_if(unit_price <= 0) as double) as value from dirty_sales
        union all select 'non_positive_quantities', cast(count_if(quantity <= 0) as double) from dirty_sales
        union all select 'extreme_prices', cast(count_if(unit_price > q * 3) as double)
                  from dirty_sales, (select quantile_cont(unit_price, 0.99) as q from dirty_sales) b),
    shares as (
        select 'missing_sales' as finding, ((count(*) - count(unit_price)) + (count(*) - count(sale_or_return))) * 100.0
               / (count(*) * 7) as value from dirty_sales
        union all select 'missing_wholesale', (count(*) - count(wholesale_price)) * 100.0 / (count(*) * 3) from priced),
    spans as (
        select 'date_span_gap' as finding, cast(abs((select date_diff('day', min(sale_date), max(sale_date)) from dirty_sales)
               - (select date_diff('day', min(sale_date), max(sale_date)) from wholesale)) as double) as value)
    select finding, r4(value) as value from counted where value > 0
    union all select finding, r4(value) from shares where value > 5
    union all select finding, r4(value) from spans where value > 30""")
def recommendations(t):
    known = t.daily.join(t.wholesale, [S.DATE, S.ITEM], "left").select(S.DATE, S.ITEM, c(S.WHOLESALE))
    found = Q.recommendations(t.dirty_sales, {"sales": t.dirty_sales, "wholesale": known})
    spans = Q.recommendations(t.dirty_sales, {"sales": t.dirty_sales, "wholesale": t.wholesale})
    gap = F.col("finding") == "date_span_gap"
    return found.where(~gap).unionByName(spans.where(gap))


_INPUT = "select avg_price - 5 as p, total_quantity * case when total_quantity > 150 then 1e5 else 1 end as q, month + 1 as m, dayofweek as d from calendar"


@query("v17_input_errors", f"""
    with x as ({_INPUT})
    select 'Negative values found in Avg_Price' as error, count(*) as row_count from x where p < 0 having count(*) > 0
    union all select 'Extreme values found in Total_Quantity', count(*) from x where abs(q) > 1e6 having count(*) > 0
    union all select 'Invalid month values (must be 1-12)', count(*) from x where m < 1 or m > 12 having count(*) > 0""")
def input_errors(t):
    from marketgrain.operators.daily import add_calendar

    quantity = F.col("Total_Quantity")
    df = add_calendar(t.daily).select(
        (F.col("Avg_Price") - 5).alias("Avg_Price"),
        (quantity * F.when(quantity > 150, 1e5).otherwise(1.0)).alias("Total_Quantity"),
        (F.col("Month") + 1).alias("Month"), "DayOfWeek",
    )
    return Q.input_error_counts(df)


@query("v19_z_scores", """
    select 'unit_price' as "column", cast(count_if(abs(unit_price - m) / s > 3) as bigint) as outlier_count,
           count(unit_price) as value_count
    from dirty_sales, (select avg(unit_price) as m, stddev_samp(unit_price) as s from dirty_sales) b
    union all
    select 'quantity', cast(count_if(abs(quantity - m) / s > 3) as bigint), count(quantity)
    from dirty_sales, (select avg(quantity) as m, stddev_samp(quantity) as s from dirty_sales) b""")
def z_scores(t):
    df = t.dirty_sales.select(c(S.PRICE).alias("unit_price"), c(S.QUANTITY).alias("quantity"))
    return Q.z_score_outliers(df, ["unit_price", "quantity"])


@query("v19_declared_limits", """
    select min(sale_date) as first_date, max(sale_date) as last_date, count(*) as points,
           r4((count(*) - count(wholesale_price)) / (count(*) * 3.0)) as missing_ratio, count(*) >= 100 as enough_points,
           (count(*) - count(wholesale_price)) / (count(*) * 3.0) <= 0.1 as missing_ok from priced""")
def declared_limits(t):
    return Q.declared_limits(enrich.add_wholesale(t.daily, t.quotes).select(S.DATE, S.ITEM, c(S.WHOLESALE)), S.DATE)


_EXPECTED = " union all ".join(f"select '{k}' as component, {v} as expected" for k, v in S.EXPECTED_DATASETS.items())


@query("v21_completeness", f"""
    with e as ({_EXPECTED}),
    a as (select case event_type when 'click' then 'overview' when 'view' then 'revenue_trends' when 'error' then 'price_analysis'
                 when 'purchase' then 'market_insights' else 'other' end as component, count(distinct user_id % 3) as n
          from events group by 1)
    select e.component, cast(e.expected as bigint) as expected, coalesce(a.n, 0) as actual,
           case when coalesce(a.n, 0) = 0 then 'MISSING' when a.n = e.expected then 'COMPLETE' else 'PARTIAL' end as status,
           r4((select sum(coalesce(a.n, 0)) * 100.0 / sum(e.expected) from e left join a on e.component = a.component))
               as overall_pct
    from e left join a on e.component = a.component""")
def completeness(t):
    kind = F.col("event_type")
    component = (
        F.when(kind == "click", "overview").when(kind == "view", "revenue_trends").when(kind == "error", "price_analysis")
        .when(kind == "purchase", "market_insights").otherwise("other")
    )
    datasets = t.raw("events").select(component.alias("component"), (F.col("user_id") % 3).alias("dataset"))
    return Q.dataset_completeness(datasets, t.spark)
