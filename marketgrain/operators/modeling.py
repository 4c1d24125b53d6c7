"""Regression models on the feature table with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window, functions as F

from marketgrain import schemas as S
from marketgrain.functions.naming import c
from marketgrain.functions.numeric import clamp, finite, is_numeric, ratio
from marketgrain.functions.pricing import clamp_prediction
from marketgrain.operators.impute import columns_with_gaps, median_values

# fixed values: settings of the four models
FOREST = {"numTrees": 100, "maxDepth": 10, "featureSubsetStrategy": "all", "seed": 42}
BOOSTING = {"maxIter": 100, "maxDepth": 6, "stepSize": 0.1, "seed": 42}
RIDGE_ALPHA = 1.0
MODELS = ("linear_regression", "ridge", "random_forest", "gradient_boosting")
LINEAR = ("linear_regression", "ridge")


def input_columns(df: DataFrame) -> list[str]:
    """All numeric columns but ids, targets and labels."""
    skip = {S.DATE, S.ITEM, S.CATEGORY_NAME, "split", "label"}
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in skip and "Target" not in f.name]


def labelled(df: DataFrame, horizon: int = 1) -> DataFrame:
    """Rows with a target as (keys, inputs, ``label``), infinities as NULL."""
    target = f"Avg_Price_Target_{horizon}d"
    if target not in df.columns:
        raise ValueError(f"no target column {target!r}; have {[n for n in df.columns if 'Target' in n]}")
    keys = [n for n in (S.DATE, S.ITEM) if n in df.columns]
    return df.where(c(target).isNotNull()).select(
        *keys, *[finite(c(n)).alias(n) for n in input_columns(df)], c(target).cast("double").alias("label")
    )


def fit_medians(train: DataFrame, *others: DataFrame) -> dict[str, float]:
    """Medians of the training rows for every input that has a gap in any of the frames."""
    inputs = input_columns(train)
    gaps = {n for df in (train, *others) for n in columns_with_gaps(df, inputs)}
    return median_values(train, [n for n in inputs if n in gaps])


def prepare(df: DataFrame, horizon: int = 1, fitted: dict[str, float] | None = None) -> DataFrame:
    """Labelled rows without gaps: medians of this frame, or ``fitted`` ones so that all splits use the same."""
    rows = labelled(df, horizon)
    values = fit_medians(rows) if fitted is None else fitted
    fills = {n: F.coalesce(c(n), F.lit(values[n])) for n in input_columns(rows) if values.get(n) is not None}
    return rows.withColumns(fills) if fills else rows


def _estimator(name: str, train: DataFrame):
    features = "scaled" if name in LINEAR else "features"
    common = {"featuresCol": features, "labelCol": "label"}
    if name == "linear_regression":
        return LinearRegression(regParam=0.0, solver="normal", **common)
    if name == "ridge":
        # Spark penalises the mean loss of a label in deviations: alpha * std(y) / n is alpha on the summed loss.
        # alpha refers to inputs in population deviations; the scaler uses sample deviations: factor (n - 1) / n.
        spread, n = train.agg(F.stddev_pop("label"), F.count("label")).first()
        strength = RIDGE_ALPHA * (n - 1) / n * spread / n
        return LinearRegression(regParam=strength, elasticNetParam=0.0, standardization=False, solver="normal", **common)
    if name == "random_forest":
        return RandomForestRegressor(**FOREST, **common)
    if name == "gradient_boosting":
        return GBTRegressor(**BOOSTING, **common)
    raise ValueError(f"unknown model {name!r}, expected one of {MODELS}")


def scaler(inputs: Sequence[str]) -> Pipeline:
    """Assemble the inputs and bring them to mean 0 and deviation 1."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(inputs), outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
    ])


def fit(name: str, train: DataFrame, inputs: Sequence[str]) -> PipelineModel:
    """Assemble, scale for the linear models, and fit."""
    stages = scaler(inputs).getStages()
    kept = stages if name in LINEAR else stages[:1]
    return Pipeline(stages=[*kept, _estimator(name, train)]).fit(train)


def fit_all(train: DataFrame, names: Sequence[str] = MODELS) -> dict[str, PipelineModel]:
    inputs = input_columns(train)
    return {name: fit(name, train, inputs) for name in names}


def predictions(models: dict[str, PipelineModel], data: DataFrame) -> DataFrame:
    """Rows (model, keys, actual, predicted) of all models."""
    keys = [n for n in (S.DATE, S.ITEM, "split") if n in data.columns]
    scored = [
        model.transform(data).select(
            F.lit(name).alias("model"), *keys, F.col("label").alias("actual"), F.col("prediction").alias("predicted")
        )
        for name, model in models.items()
    ]
    return reduce(DataFrame.unionByName, scored)


def metrics(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MAE, MSE, RMSE, R2, MAPE and sMAPE per key in one aggregation; zero actuals are left out of the MAPE."""
    y, p = F.col("actual"), F.col("predicted")
    gap = y - p
    mse = F.avg(gap * gap)
    return rows.where(gap.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(gap)).alias("mae"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        (1 - ratio(mse, F.var_pop(y))).alias("r2"),
        (F.avg(F.abs(ratio(gap, y))) * 100).alias("mape"),
        (F.avg(ratio(2 * F.abs(gap), F.abs(y) + F.abs(p))) * 100).alias("smape"),
    )


def importances(model: PipelineModel, inputs: Sequence[str], limit: int = 20) -> DataFrame:
    """Inputs ranked by tree importance or absolute coefficient; one row per input of the schema."""
    from pyspark.sql import SparkSession

    last: Model = model.stages[-1]
    weights = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    rows = [(n, abs(float(w))) for n, w in zip(inputs, weights.toArray())]
    table = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(limit)


def importance_spread(model: PipelineModel) -> float:
    """Deviation of the tree importances, 0 for linear models."""
    last = model.stages[-1]
    return float(last.featureImportances.toArray().std()) if hasattr(last, "featureImportances") else 0.0


# ---- choosing and scoring --------------------------------------------------------------------------------
def first_mape(df: DataFrame) -> Column:
    """Test, then validation MAPE, whichever a model has first."""
    names = [n for n in ("test_mape", "val_mape", "validation_mape") if n in df.columns]
    return F.coalesce(*[F.col(n) for n in names])


def best_model(table: DataFrame, mape: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Model with the smallest MAPE, the first name among equals."""
    scored = table.select(*keys, "model", mape.alias("best_mape")).where(F.col("best_mape").isNotNull())
    pick = F.min(F.struct("best_mape", "model")).alias("b")
    return scored.groupBy(*keys).agg(pick).select(*keys, F.col("b.model").alias("model"), F.col("b.best_mape").alias("best_mape"))


def confidence(val_mape: Column, spread: Column) -> Column:
    """Confidence of a model's predictions from its validation MAPE and the spread of its importances."""
    base = clamp(1 - F.coalesce(val_mape, F.lit(20.0)) / 100, 0.1, 0.95)
    return clamp(base - F.least(F.lit(0.3), F.coalesce(spread, F.lit(0.0))), 0.1, 0.95)


def score(model: PipelineModel, data: DataFrame, name: str, val_mape: float | None = None) -> DataFrame:
    """Batch prediction with clamped price, confidence and the name of the model."""
    keep = [n for n in (S.DATE, S.ITEM) if n in data.columns]
    sure = confidence(F.lit(val_mape).cast("double"), F.lit(importance_spread(model)))
    return model.transform(data).select(
        *keep, clamp_prediction(F.col("prediction")).alias("predicted_price"), sure.alias("confidence"), F.lit(name).alias("model_used")
    )


def naive_price(price: Column, factor: float = 1.05) -> Column:
    """Prediction when there is no model."""
    return price * factor


def lag_predictions(daily: DataFrame, lags: Sequence[int] = (1, 7)) -> DataFrame:
    """Naive models that repeat an earlier price, rows (model, version, date, item, actual, predicted)."""
    w = Window.partitionBy(S.ITEM).orderBy(S.DATE)
    shifted = daily.select(S.DATE, S.ITEM, "Avg_Price", *[F.lag("Avg_Price", k).over(w).alias(f"lag_{k}") for k in lags])
    long = shifted.unpivot([S.DATE, S.ITEM, "Avg_Price"], [f"lag_{k}" for k in lags], "model", "predicted")
    return long.select(
        "model", F.year(c(S.DATE)).alias("version"), S.DATE, S.ITEM, F.col("Avg_Price").alias("actual"), "predicted"
    )


def rolling_folds(df: DataFrame, folds: int = 5, test_days: int = 30) -> DataFrame:
    """Rolling-origin folds: fold k tests on its ``test_days`` days and trains on all earlier rows.

    Each row is tested in at most one fold; ``train_folds`` lists the folds it trains in.
    """
    newest = df.agg(F.max(S.DATE)).scalar()
    back = F.floor(F.datediff(newest, c(S.DATE)) / test_days)
    test_fold = F.when(back < folds, folds - back)
    return df.withColumn("test_fold", test_fold).withColumn(
        "train_folds",
        F.filter(
            F.sequence(F.lit(1), F.lit(folds)),
            lambda k: k > F.coalesce(F.col("test_fold"), F.lit(0)),
        ),
    )


def ensemble(rows: DataFrame, weights: dict[str, float], keys: Sequence[str]) -> DataFrame:
    """Weighted mean of the models' predictions; a missing model's weight goes to the others."""
    weight = F.try_element_at(F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]), F.col("model"))
    known = F.when(F.col("predicted").isNotNull(), weight)
    return rows.groupBy(*keys).agg(
        F.max("actual").alias("actual"), ratio(F.sum(F.col("predicted") * weight), F.sum(known)).alias("predicted")
    )
