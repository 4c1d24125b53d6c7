"""Queries on model metrics, versions and scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from marketgrain import schemas as S
from marketgrain.functions.naming import c
from marketgrain.functions.pricing import clamp_prediction
from marketgrain.operators import modeling as M, registry as R, split, tuning
from marketgrain.plans.features import feature_table
from marketgrain.plans.jobs import train
from marketgrain.queries.base import Tables, query, r
from marketgrain.queries.drift import PREDICTIONS
from marketgrain.sources import writers
from marketgrain.streaming.runs import fresh_folder

METRIC_SQL = """count(*) as n, avg(abs(actual - predicted)) as mae, avg(power(actual - predicted, 2)) as mse,
    sqrt(avg(power(actual - predicted, 2))) as rmse, 1 - avg(power(actual - predicted, 2)) / var_pop(actual) as r2,
    avg(abs((actual - predicted) / nullif(actual, 0))) * 100 as mape,
    avg(2 * abs(actual - predicted) / nullif(abs(actual) + abs(predicted), 0)) * 100 as smape"""
_BY_VERSION = f"{PREDICTIONS}, scores as (select model, version, {METRIC_SQL} from preds where predicted is not null group by 1, 2)"
_ROUNDED = r("mae mse rmse r2 mape smape")


def scores(t: Tables) -> DataFrame:
    return M.metrics(M.lag_predictions(t.daily), ["model", "version"])


@query("m7_metrics", f"with {_BY_VERSION} select model, version, n, {_ROUNDED} from scores")
def metrics(t):
    return scores(t)


@query("m9_best_model", f"""
    with {_BY_VERSION} select version, model, r4(mape) as best_mape from (
        select *, row_number() over (partition by version order by mape, model) as k from scores) x where k = 1""")
def best_model(t):
    return M.best_model(scores(t), F.col("mape"), ["version"])


@query("m9_first_mape", f"""
    with {_BY_VERSION}, w as (select model, max(case when version = 2000 then mape end) as val_mape,
        max(case when version = 2001 and model = 'lag_7' then mape end) as test_mape from scores group by model)
    select model, r4(coalesce(test_mape, val_mape)) as best_mape from w order by coalesce(test_mape, val_mape), model limit 1""")
def first_mape(t):
    wide = scores(t).groupBy("model").agg(
        F.max(F.when(F.col("version") == 2000, F.col("mape"))).alias("val_mape"),
        F.max(F.when((F.col("version") == 2001) & (F.col("model") == "lag_7"), F.col("mape"))).alias("test_mape"),
    )
    return M.best_model(wide, M.first_mape(wide))


@query("m10_gate", f"""
    with {_BY_VERSION} select model, version, r4(mape) as val_mape, r4(rmse) as val_rmse, r4(r2) as val_r2,
        not (mape > 400 or rmse > 150 or r2 < -0.95) as passed from scores""")
def gate(t):
    table = scores(t).select("model", "version", *[F.col(n).alias(f"val_{n}") for n in ("mape", "rmse", "r2")])
    return table.withColumn("passed", R.gate(table, {"mape": 400.0, "rmse": 150.0, "r2": -0.95}))


def _long(t: Tables) -> DataFrame:
    return scores(t).unpivot(["model", "version"], ["mape", "rmse", "r2"], "metric", "value")


_LONG = """long as (select model, version, 'mape' as metric, mape as v from scores union all
    select model, version, 'rmse', rmse from scores union all select model, version, 'r2', r2 from scores)"""


@query("m11_compare_versions", f"""
    with {_BY_VERSION}, {_LONG}
    select a.model, a.metric, r4(a.v) as v1_value, r4(b.v) as v2_value,
           r4(case when a.metric = 'r2' then (b.v - a.v) / a.v else (a.v - b.v) / a.v end * 100) as improvement_pct,
           case when a.metric = 'r2' then case when b.v > a.v then b.version else a.version end
                else case when b.v < a.v then b.version else a.version end end as better_version
    from long a join long b on a.model = b.model and a.metric = b.metric where a.version = 1999 and b.version = 2000""")
def compare_versions(t):
    return R.compare_versions(_long(t), F.lit(1999), F.lit(2000))


@query("j11_version_self_join", f"""
    with {_BY_VERSION}, {_LONG}
    select a.model, a.metric, a.version as version, r4(b.v - a.v) as change
    from long a join long b on a.model = b.model and a.metric = b.metric and b.version = a.version + 1""")
def version_self_join(t):
    long = _long(t)
    nxt = long.select("model", "metric", (F.col("version") - 1).alias("version"), F.col("value").alias("next_value"))
    return long.join(nxt, ["model", "metric", "version"]).select(
        "model", "metric", "version", (F.col("next_value") - F.col("value")).alias("change")
    )


_STAGE = "case s.version when 2000 then 'Production' when 2001 then 'Staging' when 1996 then 'Archived' else 'None' end"
_VERSIONS = f"""{_BY_VERSION}, created as (select model, version, max(sale_date) as created from preds where predicted is not null group by 1, 2),
    versions as (select s.model, s.version, s.mape, d.created, {_STAGE} as stage, s.mape <= 400 as passed
                 from scores s join created d on s.model = d.model and s.version = d.version)"""


def versions(t: Tables) -> DataFrame:
    rows = M.lag_predictions(t.daily).where(F.col("predicted").isNotNull())
    created = rows.groupBy("model", "version").agg(F.max(c(S.DATE)).alias("created"))
    v = F.col("version")
    stage = F.when(v == 2000, "Production").when(v == 2001, "Staging").when(v == 1996, "Archived").otherwise("None")
    return scores(t).join(created, ["model", "version"]).select(
        "model", "version", "mape", "created", stage.alias("stage"), (F.col("mape") <= 400).alias("passed")
    )


@query("m12_version_list", f"with {_VERSIONS} select model, version, created, stage, passed, r4(mape) as mape from versions")
def version_list(t):
    return versions(t)


@query("m12_latest_in_stage", f"""
    with {_VERSIONS} select model, version, stage from (select *, row_number() over (partition by model
        order by case stage when 'Production' then 2 else 1 end desc, version desc) as k from versions
        where stage in ('Production', 'Staging')) x where k = 1""")
def latest_in_stage(t):
    return R.latest_version(versions(t))


@query("w14_retained_versions", f"""
    with {_VERSIONS} select model, version, stage, stage in ('Production', 'Staging') or k <= 3 as keep from (
        select *, sum(case when stage in ('Production', 'Staging') then 0 else 1 end) over (partition by model
            order by created desc, version desc rows between unbounded preceding and current row) as k from versions) x""")
def retained_versions(t):
    return R.retained(versions(t), 3).select("model", "version", "stage", "keep")


@query("m17_promote", f"""
    with {_VERSIONS}, best as (select model, version, passed from (select *, row_number() over (partition by model order by mape, version) as k
        from versions where stage <> 'Production') x where k = 1)
    select v.model, v.version, case when not b.passed then v.stage when v.version = b.version then 'Production'
        when v.stage = 'Production' then 'Archived' else v.stage end as stage
    from versions v join best b on v.model = b.model""")
def promote(t):
    table = versions(t)
    best = table.where(F.col("stage") != "Production").groupBy("model").agg(
        F.min(F.struct("mape", "version")).alias("b")
    ).select("model", F.col("b.version").alias("version"))
    return R.promote(table, best).select("model", "version", "stage")


@query("m16_staging_candidates", f"""
    with {_VERSIONS}, w as (select model, max(case when version = 2001 then mape end) as test_mape, max(case when version = 2000 then rmse end) as val_rmse
        from scores group by model)
    select model, r4(test_mape) as test_mape, r4(val_rmse) as val_rmse, not (test_mape > 15 or val_rmse > 5) as passed,
           (select max(version) from versions v where v.model = w.model) as version, 'daily' as data_version from w""")
def staging_candidates(t):
    wide = scores(t).groupBy("model").agg(
        F.max(F.when(F.col("version") == 2001, F.col("mape"))).alias("test_mape"),
        F.max(F.when(F.col("version") == 2000, F.col("rmse"))).alias("val_rmse"),
    )
    return R.staging_candidates(wide, versions(t), {"data_version": "daily"})


@query("m14_naive_price", "select sale_date, item_code, r4(avg_price * 1.05) as predicted_price from daily")
def naive_price(t):
    return t.daily.select(S.DATE, S.ITEM, M.naive_price(F.col("Avg_Price")).alias("predicted_price"))


@query("m15_rolling_folds", """
    with f as (select floor(date_diff('day', sale_date, (select max(sale_date) from daily)) / 30) as back from daily),
    g as (select case when back < 5 then 5 - back end as test_fold from f)
    select cast(test_fold as bigint) as test_fold, count(*) as tested,
           cast(sum(case when test_fold is null then 5 else 5 - test_fold end) as bigint) as training_uses
    from g group by test_fold""")
def rolling_folds(t):
    folds = M.rolling_folds(t.daily)
    return folds.groupBy("test_fold").agg(F.count(F.lit(1)).alias("tested"), F.sum(F.size("train_folds")).alias("training_uses"))


@query("m15_ensemble", f"""
    with {PREDICTIONS}, e as (select sale_date, item_code, max(actual) as actual,
        sum(predicted * case model when 'lag_1' then 0.7 else 0.3 end) / sum(case when predicted is not null then
            case model when 'lag_1' then 0.7 else 0.3 end end) as predicted from preds group by 1, 2),
    s as (select {METRIC_SQL} from e where predicted is not null) select n, {_ROUNDED} from s""")
def ensemble(t):
    rows = M.ensemble(M.lag_predictions(t.daily), {"lag_1": 0.7, "lag_7": 0.3}, [S.DATE, S.ITEM])
    return M.metrics(rows, [])


@query("p26_clamped_prediction", """
    with x as (select avg_price * 2 - 60 as p, sale_date, item_code from daily)
    select sale_date, item_code, r2(case when p < 0 or p > 1000 then greatest(5.0, least(100.0, p)) else p end) as predicted_price from x""",
       digits=2)
def clamped_prediction(t):
    price = F.col("Avg_Price") * 2 - 60
    return t.daily.select(S.DATE, S.ITEM, clamp_prediction(price, digits=None).alias("predicted_price"))


@query("p27_confidence", f"""
    with {_BY_VERSION} select model, version, r6(greatest(0.1, least(0.95, greatest(0.1, least(0.95, 1 - mape / 100))
        - least(0.3, version % 4 * 0.05)))) as confidence from scores""", digits=6)
def confidence(t):
    sure = M.confidence(F.col("mape"), (F.col("version") % 4) * 0.05)
    return scores(t).select("model", "version", sure.alias("confidence"))


# ---- fitted models -----------------------------------------------------------------------------------------
def _split(t: Tables) -> dict[str, DataFrame]:
    from marketgrain.session import materialize

    table = materialize(feature_table(t.sales, t.quotes, t.items, t.loss_rates), "features")
    # the parts are read many times: the split is decided once and stored
    return split.parts(materialize(split.split_by_time(table), "split"))


def _trained(spark, folder: str, names: tuple[str, ...]):
    """Splits, models and metrics of one folder."""
    parts = _split(Tables(spark, folder))
    models, table = train(parts, 1, names)
    return parts, models, table


@query("m1_prepared", """
    select sale_date, item_code, r4(avg_price) as avg_price, r4(avg_price_target_1d) as label from features where avg_price_target_1d is not null""")
def prepared(t):
    """Rows with a label for the one-day horizon."""
    return M.prepare(t.features.select(S.DATE, S.ITEM, "Avg_Price", "Avg_Price_Lag_7", "Avg_Price_Target_1d")).select(
        S.DATE, S.ITEM, "Avg_Price", "label"
    )


@query("m2_standardised", """
    select sale_date, item_code, r4((avg_price - (select avg(avg_price) from daily)) / (select stddev_samp(avg_price) from daily)) as scaled from daily""")
def standardised(t):
    rows = t.daily.where(F.col("Avg_Price").isNotNull()).select(S.DATE, S.ITEM, "Avg_Price")
    model = M.scaler(["Avg_Price"]).fit(rows)
    return model.transform(rows).select(S.DATE, S.ITEM, vector_to_array("scaled")[0].alias("scaled"))


@query("m3_linear_model", """
    with f as (select avg_price as x, avg_price_target_1d as y from features where avg_price_target_1d is not null)
    select r6(regr_slope(y, x)) as slope, r6(regr_intercept(y, x)) as intercept, count(*) as n from f""", digits=6)
def linear_model(t):
    """Least squares of tomorrow's on today's price."""
    rows = t.features.where(F.col("Avg_Price_Target_1d").isNotNull()).select("Avg_Price", F.col("Avg_Price_Target_1d").alias("label"))
    fitted = M.fit("linear_regression", rows, ["Avg_Price"])
    scale, line = fitted.stages[1], fitted.stages[2]
    slope = float(line.coefficients[0] / scale.std[0])
    return rows.agg(
        F.lit(slope).alias("slope"), F.lit(float(line.intercept - slope * scale.mean[0])).alias("intercept"), F.count(F.lit(1)).alias("n")
    )


@query("m4_ridge_model", """
    with f as (select avg_price as x, avg_price_target_1d as y from features where avg_price_target_1d is not null)
    select r6(covar_pop(y, x) * count(*) / (count(*) + 1) / var_pop(x)) as slope, count(*) as n from f""", digits=6)
def ridge_model(t):
    """Ridge regression of tomorrow's on today's price: in standard units the slope shrinks by n / (n + alpha)."""
    rows = t.features.where(F.col("Avg_Price_Target_1d").isNotNull()).select("Avg_Price", F.col("Avg_Price_Target_1d").alias("label"))
    fitted = M.fit("ridge", rows, ["Avg_Price"])
    slope = float(fitted.stages[2].coefficients[0] / fitted.stages[1].std[0])
    return rows.agg(F.lit(slope).alias("slope"), F.count(F.lit(1)).alias("n"))


@query("m3_m4_linear_metrics")
def linear_metrics(t):
    """Linear and ridge regression on all inputs: metrics per split."""
    return _trained(t.spark, t.folder, M.LINEAR)[2]


def _priced(t: Tables) -> DataFrame:
    rows = t.features.where(F.col("Avg_Price_Target_1d").isNotNull())
    return rows.select(S.DATE, S.ITEM, "Avg_Price", F.col("Avg_Price_Target_1d").alias("label"))


@query("m3_saved_models", """
    select model, count(*) as n, true as same_scores, true as same_evaluation, 'Avg_Price' as inputs
    from features, (select unnest(['linear_regression', 'ridge']) as model) m where avg_price_target_1d is not null group by model""")
def saved_models(t):
    """Linear models trained once, saved with evaluation and inputs, loaded, and compared with the unsaved ones."""
    rows, folder, inputs = _priced(t), fresh_folder(t.spark, "models"), ["Avg_Price"]
    models = {name: M.fit(name, rows, inputs) for name in M.LINEAR}
    evaluation = M.metrics(M.predictions(models, rows), ["model"])
    writers.save_models(models, evaluation, inputs, folder)
    loaded, stored, named = writers.load_models(t.spark, folder, M.LINEAR)
    ours = M.predictions(models, rows).withColumnRenamed("predicted", "_ours")
    theirs = M.predictions(loaded, rows.select(S.DATE, S.ITEM, *named, "label")).withColumnRenamed("predicted", "_theirs")
    pairs = ours.join(theirs, ["model", S.DATE, S.ITEM])
    again = M.metrics(theirs.withColumnRenamed("_theirs", "predicted"), ["model"]).select("model", F.col("mae").alias("_mae"))
    checked = again.join(stored, "model").select("model", (F.abs(F.col("mae") - F.col("_mae")) < 1e-9).alias("same_evaluation"))
    compared = pairs.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("_ours") == F.col("_theirs")).alias("same_scores")
    )
    return compared.join(checked, "model").withColumn("inputs", F.lit(",".join(named)))


@query("m15_fold_scores", """
    with d as (select avg_price as x, avg_price_target_1d as y, sale_date from features where avg_price_target_1d is not null),
    f as (select x, y, floor(date_diff('day', sale_date, (select max(sale_date) from d)) / 30) as back from d),
    k as (select unnest(range(1, 6)) as fold),
    l as (select fold, regr_slope(y, x) as a, regr_intercept(y, x) as b from f join k on back > 5 - fold group by fold)
    select cast(l.fold as bigint) as fold, count(*) as n, r4(avg(abs(y - a * x - b))) as mae, r4(sqrt(avg(power(y - a * x - b, 2)))) as rmse
    from f join l on back = 5 - l.fold group by l.fold""")
def fold_scores(t):
    """Rolling-origin validation: for each fold a linear model of all earlier rows, scored on the fold."""
    from marketgrain.session import materialize

    # every fold reads the rows twice
    rows = materialize(M.rolling_folds(_priced(t)), "folds")
    scored = []
    for fold in range(1, 6):
        model = M.fit("linear_regression", rows.where(F.array_contains("train_folds", fold)), ["Avg_Price"])
        tested = M.predictions({"linear_regression": model}, rows.where(F.col("test_fold") == fold))
        scored.append(M.metrics(tested, ["model"]).select(F.lit(fold).alias("fold"), "n", "mae", "rmse"))
    return reduce(DataFrame.unionByName, scored)


PENALTIES = (0.0, 0.01, 0.1, 1.0)


@query("m15_tuned_ridge", f"""
    with d as (select avg_price as x, avg_price_target_1d as y, sale_date from features where avg_price_target_1d is not null),
    f as (select x, y, floor(date_diff('day', sale_date, (select max(sale_date) from d)) / 30) as back from d),
    k as (select unnest(range(1, 6)) as fold), p as (select unnest([{", ".join(map(str, PENALTIES))}]::double[]) as penalty),
    l as (select fold, penalty, regr_slope(y, x) / (1 + penalty) as b, avg(x) as mx, avg(y) as my
          from f join k on back > 5 - fold cross join p group by fold, penalty),
    e as (select fold, penalty, count(*) as n, sqrt(avg(power(y - my - b * (x - mx), 2))) as rmse
          from f join l on back = 5 - l.fold group by fold, penalty),
    m as (select *, avg(rmse) over (partition by penalty) as mean_rmse from e)
    select cast(fold as bigint) as fold, penalty, n, r4(rmse) as rmse, r4(mean_rmse) as mean_rmse,
        penalty = (select penalty from m order by mean_rmse, penalty desc limit 1) as chosen from m""")
def tuned_ridge(t):
    """The penalty of a ridge model chosen over rolling folds, all models from sums of products of one pass."""
    return tuning.tune_ridge(M.rolling_folds(_priced(t)), ["Avg_Price"], PENALTIES)


@query("m15_tree_search", "select 4 as candidates, 3 as folds, 1 as last_one_left, true as better_than_mean")
def tree_search(t):
    """Forests of several depths searched over rolling folds with drop-outs; the best beats the mean of the labels."""
    from marketgrain.session import materialize

    rows = materialize(M.rolling_folds(_priced(t), folds=3), "search-folds")
    depths = {f"depth-{k}": k for k in (1, 2, 4, 5)}

    def error(depth: int, fold: int) -> float:
        assembled = M.scaler(["Avg_Price"]).getStages()[0]
        forest = RandomForestRegressor(maxDepth=depth, numTrees=5, seed=42, featuresCol="features", labelCol="label")
        model = Pipeline(stages=[assembled, forest]).fit(rows.where(F.array_contains("train_folds", fold)))
        return M.metrics(M.predictions({"forest": model}, rows.where(F.col("test_fold") == fold)), ["model"]).first()["rmse"]

    found = tuning.search(depths, error, folds=[1, 2, 3])
    best = next(r for r in found if r[3])
    spread = rows.where("test_fold is not null").agg(F.stddev_pop("label")).first()[0]
    return t.spark.createDataFrame(
        [(len(found), max(r[1] for r in found), sum(r[1] == 3 for r in found), best[2] < spread)],
        "candidates int, folds int, last_one_left int, better_than_mean boolean")


@query("m5_random_forest")
def random_forest(t):
    """The random forest with the settings of the source: metrics per split."""
    return _trained(t.spark, t.folder, ("random_forest",))[2]


@query("m6_gradient_boosting")
def gradient_boosting(t):
    """Gradient boosting with the settings of the source: metrics per split."""
    return _trained(t.spark, t.folder, ("gradient_boosting",))[2]


@query("m5_m8_m13_bands", """
    with s as (select sale_date, case when before < floor(n * 0.7) then 'train' when before < floor(n * 0.85) then 'validation' else 'test' end as split
        from (select sale_date, sum(c) over (order by sale_date) - c as before, sum(c) over () as n
              from (select sale_date, count(*) as c from daily group by sale_date) x) y),
    c as (select split, count(*) as n from features join s using (sale_date) where avg_price_target_1d is not null group by split)
    select 'metrics of ' || split as part, n, true as passed from c
    union all select 'importances', 20, true union all select 'scores', n, true from c where split = 'test'""")
def forest_bands(t):
    """What holds of any forest: rows of each split, a fit better than the mean, importances as shares, a plausible score for every row."""
    parts, models, table = _trained(t.spark, t.folder, ("random_forest",))
    fit = F.when(F.col("split") == "train", F.col("r2") > 0).otherwise(F.col("rmse") > 0)
    checks = [table.select(F.concat(F.lit("metrics of "), "split").alias("part"), "n", fit.alias("passed"))]
    weights = M.importances(models["random_forest"], M.input_columns(parts["train"]))
    share = F.col("importance")
    checks.append(weights.agg(
        F.lit("importances").alias("part"), F.count(F.lit(1)).alias("n"),
        (F.bool_and(share.between(0, 1)) & (F.sum(share) <= 1 + 1e-9) & (F.sum(share) > 0)).alias("passed")))
    labels = parts["train"].agg(F.min("Avg_Price_Target_1d"), F.max("Avg_Price_Target_1d")).first()
    fitted = M.fit_medians(M.labelled(parts["train"]), M.labelled(parts["test"]))
    scored = M.predictions(models, M.prepare(parts["test"], 1, fitted))
    # a forest averages labels that it has seen
    checks.append(scored.agg(
        F.lit("scores").alias("part"), F.count(F.lit(1)).alias("n"), F.bool_and(F.col("predicted").between(*labels)).alias("passed")))
    return reduce(DataFrame.unionByName, checks)


@query("m8_importances")
def importance_table(t):
    """Inputs of the random forest by importance."""
    parts, models, _ = _trained(t.spark, t.folder, ("random_forest",))
    return M.importances(models["random_forest"], M.input_columns(parts["train"]))


@query("m13_batch_scores")
def batch_scores(t):
    """Test rows scored by the forest, with confidence."""
    parts, models, table = _trained(t.spark, t.folder, ("random_forest",))
    mape = table.where((F.col("model") == "random_forest") & (F.col("split") == "validation")).first()["mape"]
    fitted = M.fit_medians(M.labelled(parts["train"]), M.labelled(parts["test"]))
    return M.score(models["random_forest"], M.prepare(parts["test"], 1, fitted), "random_forest", mape)
