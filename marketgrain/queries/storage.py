"""Queries that write domain tables in the forms of the sources and read them back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from marketgrain import schemas as S
from marketgrain.functions.naming import c
from marketgrain.operators import bi, drift, monitoring as H, quality, split
from marketgrain.queries.base import Tables, query
from marketgrain.queries.drift import NAMES, _statistical, pair
from marketgrain.queries.features import DAILY_SQL
from marketgrain.queries.models import _BY_VERSION, scores
from marketgrain.queries.reports import category_rows, feature_rows
from marketgrain.queries.service import _RULES, naive_ts, violated
from marketgrain.sources import catalog as cat, readers, writers
from marketgrain.streaming.runs import fresh_folder


def write_raw(t: Tables) -> str:
    """The four domain tables as raw CSV files of the source's names."""
    folder = fresh_folder(t.spark, "raw")
    frames = {
        "sales": t.sales.select(
            c(S.DATE).cast("string").alias(S.DATE), F.lit("10:00:00").alias(S.TIME), c(S.ITEM), c(S.QUANTITY), c(S.PRICE), c(S.KIND), c(S.DISCOUNT)),
        "items": t.items, "loss_rates": t.loss_rates, "wholesale": t.wholesale.select(S.DATE, S.ITEM, c(S.WHOLESALE)),
    }
    for name, df in frames.items():
        df.write.option("header", True).csv(f"{folder}/{S.RAW_FILES[name]}")
    return folder


@query("s1_raw_files", f"select {DAILY_SQL} from daily", revenue=2)
def raw_files(t):
    """The daily aggregate over sales that went through CSV."""
    from marketgrain.operators.daily import daily_aggregate

    return daily_aggregate(readers.read_raw(t.spark, write_raw(t))["sales"])


@query("s4_manifest", " union all ".join(
    f"select '{n}' as source, true as exists, count(*) as row_count from {n}" for n in ("items", "sales", "wholesale", "loss_rates")))
def manifest(t):
    """Which raw files are there, with the rows that reading them gives."""
    folder = write_raw(t)
    rows = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("_source"), "row_count")
        for name, df in readers.read_raw(t.spark, folder).items()
    ]
    found = readers.source_manifest(t.spark, folder).select("source", "exists")
    return found.join(reduce(DataFrame.unionByName, rows), F.col("source") == F.col("_source"), "left").drop("_source")


_PARTS = """select case when before < floor(n * 0.7) then 'train' when before < floor(n * 0.85) then 'validation' else 'test' end as part,
    cast(sum(c) as bigint) as row_count
    from (select sale_date, c, k, sum(c + k) over (order by sale_date) - (c + k) as before, sum(c + k) over () as n
          from (select sale_date, count(avg_price_target_1d) as c, count(*) - count(avg_price_target_1d) as k from features group by sale_date) x) y
    group by 1"""


@query("s6_feature_folders", f"{_PARTS} union all select 'features_complete', count(*) from daily")
def feature_folders(t):
    """Feature folders written and read back: rows per part."""
    folder = fresh_folder(t.spark, "features")
    writers.write_features(t.features, folder)
    parts = readers.read_splits(t.spark, folder)
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("part"), "row_count") for name, df in parts.items()
    ])


@query("s5_existing_splits", f"""
    with p as ({_PARTS}) select p.part, row_count, true as whole from p where part in ('train', 'test')""")
def existing_splits(t):
    """The split folders that exist, of which one is missing, with all columns of the table."""
    folder, marked = fresh_folder(t.spark, "some-splits"), split.split_by_time(t.features)
    for name, part in split.parts(marked).items():
        if name != "validation":
            part.write.parquet(f"{folder}/{name}")
    found = readers.read_splits(t.spark, folder)
    whole = set(t.features.columns)
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("part"), "row_count", F.lit(whole <= set(df.columns)).alias("whole"))
        for name, df in found.items()
    ])


@query("s8_feature_parts", """
    select year(sale_date) as year, count(*) as row_count, count(distinct item_code) as items, r4(sum(avg_price)) as prices,
        (select count(*) from daily) as metadata_records from daily group by 1""")
def feature_parts(t):
    """The written table by its partitions, beside the written metadata."""
    paths = writers.write_features(t.features, fresh_folder(t.spark, "features"))
    records = t.spark.read.schema("total_records long").json(paths["metadata"]).scalar()
    rows = t.spark.read.parquet(paths["features_complete"])
    return rows.groupBy(F.col("Year").cast("long").alias("year")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct(c(S.ITEM)).alias("items"), F.sum("Avg_Price").alias("prices")).withColumn(
        "metadata_records", records)


@query("s9_catalog_tables", "select count(*) as row_count, count(distinct item_code) as item_count, r4(avg(loss_rate)) as mean_loss from lossy")
def catalog_tables(t):
    """An external table with quoted names over a Parquet folder, queried by SQL."""
    folder = fresh_folder(t.spark, "tables")
    feature_rows(t).write.parquet(f"{folder}/features_complete")
    cat.create_database(t.spark, "market")
    cat.register_table(t.spark, "market", "features_complete", f"{folder}/features_complete")
    return t.spark.sql("""SELECT count(*) AS row_count, count(DISTINCT `Item Code`) AS item_count, avg(`Loss Rate (%)`) AS mean_loss
                          FROM market.features_complete""")


@query("s17_dashboard_files", """
    select season, r2(sum(revenue)) as seasonal_revenue, count(*) as seasonal_transactions from calendar where revenue > 0 group by season""", digits=2)
def dashboard_files(t):
    """A dashboard component written twice and read back: the second write replaces the first."""
    folder, rows = fresh_folder(t.spark, "dashboard"), category_rows(t)
    for _ in range(2):
        writers.write_dashboard(rows, folder, ["revenue_trends"])
    schema = "season string, seasonal_revenue double, seasonal_transactions long"
    return writers.read_dashboard(t.spark, folder, "revenue_trends", "seasonal_revenue", schema)


@query("s18_snapshots", """
    select cast(ts as timestamp) as ts, source, case when source = 'models' then entity else source end as entity, metric, r4(value) as value
    from metrics""")
def snapshots(t):
    """All metrics written as nested snapshots and read back as long rows; each measurement is one small snapshot."""
    folder = fresh_folder(t.spark, "snapshots")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp")

    def entries(source, names):
        fields = [F.when(F.col("metric") == n, F.col("value")).alias(n) for n in names]
        return F.when(F.col("source") == source, F.array(F.struct(stamp, *fields)))

    models = F.when(F.col("source") == "models", F.create_map("entity", entries("models", readers.MODEL_FIELDS)))
    t.metrics.select(
        entries("system", readers.SYSTEM_FIELDS).alias("system"), models.alias("models"),
        entries("api", readers.API_FIELDS).alias("api"), entries("data_quality", readers.QUALITY_FIELDS).alias("data_quality"),
    ).write.json(folder)
    spark = t.spark
    raw = spark.read.schema(readers.SNAPSHOT_SCHEMA).json(folder)
    return naive_ts(readers.long_snapshots(raw).select("ts", "source", "entity", "metric", "value"))


@query("s19_evaluation", f"""
    with {_BY_VERSION} select model, version, 'val_mape' as metric, r4(mape) as value from scores
    union all select model, version, 'val_rmse', r4(rmse) from scores
    union all select model, version, m, 0 from scores, (select unnest(['val_r2', 'test_mape', 'test_rmse', 'test_r2']) as m) x""")
def evaluation(t):
    """Metrics of the naive models, all versions, written as an indented evaluation file and read back."""
    folder = fresh_folder(t.spark, "evaluation")
    by_model = scores(t).select(
        F.concat_ws("|", "model", "version").alias("name"),
        F.create_map(F.lit("val_mape"), F.col("mape"), F.lit("val_rmse"), F.col("rmse")).alias("m"))
    # one entry per model and version
    text = F.to_json(F.map_from_entries(F.collect_list(F.struct("name", "m"))), {"pretty": "true"})
    by_model.agg(text.alias("value")).coalesce(1).write.text(folder)
    rows = readers.read_evaluation(t.spark, folder)
    name = F.split("model", r"\|")
    return rows.select(name[0].alias("model"), name[1].cast("long").alias("version"), "metric", "value")


@query("s22_first_existing", f"select {DAILY_SQL} from daily", revenue=2)
def first_existing(t):
    folder = fresh_folder(t.spark, "fallback")
    t.daily.write.parquet(f"{folder}/second")
    return readers.read_first(t.spark, [f"{folder}/first", f"{folder}/second"])


@query("s23_drift_state", f"with {_statistical()} select feature, r6(drift_score) as drift_score, drift_detected from scored", digits=6)
def drift_state(t):
    """Drift of late sales against a stored and reloaded profile."""
    folder = fresh_folder(t.spark, "state")
    reference, current = pair(t)
    writers.save_drift_state(drift.profile(reference, NAMES), scores(t).select("model", "version", "mape"), {"drift": drift.THRESHOLD}, folder)
    stats, _, limits = writers.load_drift_state(t.spark, folder)
    rows = drift.statistical_drift(stats, drift.profile(current, NAMES), limits["drift"])
    return rows.select("feature", "drift_score", "drift_detected")


@query("s24_export", f"""
    with {_RULES} select 'metric' as part, source as name, count(*) as n, r4(sum(value)) as total from metrics group by source
    union all select 'alert', alert_type, count(*), r4(sum(value)) from {violated('metrics')} x group by alert_type""")
def export(t):
    """Both parts of the export, read back."""
    folder = fresh_folder(t.spark, "export")
    writers.export_metrics(t.metrics, H.violations(t.metrics, H.rules_table(t.spark)), folder)
    parts = []
    for part, name in (("metric", "source"), ("alert", "alert_type")):
        rows = t.spark.read.schema(f"{name} string, value double").json(f"{folder}/{part}s")
        parts.append(rows.groupBy(F.lit(part).alias("part"), F.col(name).alias("name")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")))
    return parts[0].unionByName(parts[1])


@query("s26_corrupt_files", f"""
    with {_RULES}, x as (select alert_type, entity, event_id, severity, row_number() over (partition by alert_type, entity
        order by ts desc, event_id desc) as k from {violated('metrics')} y)
    select case when event_id % 3 = 0 then 'quarantined' else 'good' end as part, case when event_id % 3 <> 0 then alert_type end as alert_type,
        case when event_id % 3 <> 0 then severity end as severity, count(*) as n from x where k = 1 group by 1, 2, 3""")
def corrupt_files(t):
    """A file for the newest alert of each type and entity, indented, some cut off: readable rows and quarantined files."""
    folder = fresh_folder(t.spark, "corrupt")
    rows = H.violations(t.metrics, H.rules_table(t.spark)).select(
        "alert_type", "entity", "ts", "event_id", "severity",
        F.to_json(F.struct(F.col("alert_type").alias("type"), "severity", "message", "value"), {"pretty": "true"}).alias("value"))
    newest = rows.groupBy("alert_type", "entity").agg(F.max_by(F.struct("event_id", "value"), F.struct("ts", "event_id")).alias("a"))
    cut = F.when(F.col("a.event_id") % 3 == 0, F.substring("a.value", 1, 30)).otherwise(F.col("a.value"))
    newest.select(F.concat_ws("-", "alert_type", "entity").alias("file"), cut.alias("value")).write.partitionBy("file").text(folder)
    good, broken = readers.read_alerts(t.spark, folder)
    good = good.select(F.lit("good").alias("part"), F.col("type").alias("alert_type"), "severity")
    lost = broken.where(F.col("text").startswith("{")).select(
        F.lit("quarantined").alias("part"), F.lit(None).cast("string").alias("alert_type"), F.lit(None).cast("string").alias("severity"))
    return good.unionByName(lost).groupBy("part", "alert_type", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("s27_alert_sink", f"""
    with {_RULES} select alert_type, severity, count(*) as n from {violated('metrics')} x
    group by 1, 2""")
def alert_sink(t):
    folder = fresh_folder(t.spark, "alerts")
    rows = H.violations(t.metrics, H.rules_table(t.spark)).select("alert_type", "entity", "severity", "value")
    # two appends, each of some of the alerts of every type
    for part in (0, 1):
        writers.append_alerts(rows.where(F.pmod(F.xxhash64("entity"), F.lit(2)) == part), folder)
    return t.spark.read.schema(rows.schema).json(folder).groupBy("alert_type", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("s15_resolved_columns", """
    select 'revenue' as wanted, 'Revenue' as found, count(*) - count(revenue) as missing_count from lossy
    union all select 'AVG_PRICE', 'Avg_Price', count(*) - count(avg_price) from lossy
    union all select 'category code', 'Category Code', count(*) - count(category_code) from lossy
    union all select 'isweekend', 'IsWeekend', count(*) - count(isweekend) from lossy
    union all select 'no_such_column', null, null""")
def resolved_columns(t):
    """Report columns looked up in the feature table, whatever their case."""
    df = feature_rows(t)
    wanted = ("revenue", "AVG_PRICE", "category code", "isweekend", "no_such_column")
    rows = t.spark.createDataFrame([(n, bi.resolve(df, n)) for n in wanted], "wanted string, found string")
    gaps = quality.missing_values(df).withColumnRenamed("column", "found")
    return rows.join(gaps, "found", "left").select("wanted", "found", "missing_count")


@query("h6_freshness", "select true as known, count(*) as n, count(distinct user_id) as users from events")
def freshness(t):
    """Age of the newest input file with what it covers; the age depends on the clock, so only its sign is returned."""
    events = t.raw("events")
    hours = readers.freshness_hours(events, F.current_timestamp()).select(F.col("freshness_hours") >= 0).scalar()
    return events.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users")).withColumn("known", hours)


@query("v0_validation_job", """
    select 'Sales items exist in master data' as rule, count(*) = 0 as passed,
           concat('Found ', cast(count(*) as varchar), ' orphan items in sales data') as details
    from (select distinct item_code from sales where item_code not in (select item_code from items)) t
    union all select 'Wholesale prices are reasonable', count_if(wholesale_price <= 0) = 0 and count_if(wholesale_price > 1000) < count(*) * 0.01,
           concat('Zero/negative prices: ', cast(count_if(wholesale_price <= 0) as varchar), ', Extremely high prices: ',
                  cast(count_if(wholesale_price > 1000) as varchar)) from wholesale
    union all select 'Loss rates are valid percentages (0-100%)', count_if(loss_rate < 0 or loss_rate > 100) = 0,
           concat('Invalid loss rates: ', cast(count_if(loss_rate < 0 or loss_rate > 100) as varchar)) from loss_rates
    union all select 'Sale quantities are positive', count_if(quantity <= 0 and lower(sale_or_return) = 'sale') = 0,
           concat('Negative/zero quantities in sales: ', cast(count_if(quantity <= 0 and lower(sale_or_return) = 'sale') as varchar)) from sales""")
def validation_job(t):
    """The validation job over raw files: rules with their details."""
    from marketgrain.plans.jobs import validate

    return validate(t.spark, write_raw(t))["rules"]
