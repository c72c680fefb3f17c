"""Training, evaluation, choice, storage and explanation of price models."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelframe.plans import features
from parcelframe.plans.features import FeaturePreset
from parcelframe.session import work_folder

SEED = 42

# Full training settings per model.
FULL_SETTINGS: dict[str, dict] = {
    "linear": {"maxIter": 100},
    "tree": {"maxDepth": 10},
    "forest": {"numTrees": 200, "maxDepth": 8, "seed": SEED},
    "boosted": {"maxIter": 200, "maxDepth": 6, "seed": SEED},
}
QUICK_BOOSTED = {"maxIter": 10, "seed": SEED}

_REGRESSORS = {
    "linear": LinearRegression,
    "tree": DecisionTreeRegressor,
    "forest": RandomForestRegressor,
    "boosted": GBTRegressor,
}


def regressor(name: str, preset: FeaturePreset, settings: Mapping | None = None):
    settings = FULL_SETTINGS[name] if settings is None else settings
    return _REGRESSORS[name](featuresCol="scaled_features", labelCol=preset.label, **settings)


def _use_shared_checkpoints(df: DataFrame) -> None:
    """Long tree training cuts its lineage in the shared folder, so that a lost executor costs little."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(work_folder(df.sparkSession, "training"))


def labelled(df: DataFrame, preset: FeaturePreset) -> DataFrame:
    """The rows a model can learn from: those with a label. Their number against the table's tells what is left out."""
    label = F.col(preset.label).cast("double")
    return df.filter(label.isNotNull() & ~F.isnan(label))


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores where the table has fewer partitions: training passes over them thousands of times.

    Such a table is small, as its files or stages are below the session's partition size. A larger one stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def train_models(
    train: DataFrame, preset: FeaturePreset, settings: Mapping[str, Mapping] = FULL_SETTINGS, fit_on: DataFrame | None = None
) -> dict[str, PipelineModel]:
    """One complete model (features and regressor) per name; the features are fitted once.

    Rows without a label are not learned from; every other row is. Medians are those of the training rows, or of
    ``fit_on``.

    What is kept for the repeated passes are the narrow input columns. The feature vectors, dense once
    they are centred, are made again on the way into each regressor.
    """
    _use_shared_checkpoints(train)
    inputs = labelled(train, preset).select(*preset.inputs, preset.label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        prepared = features.fit_features(inputs, preset, fit_on)
        scaled = prepared.transform(spread(inputs)).select("scaled_features", preset.label)
        return {
            name: PipelineModel([*prepared.stages, regressor(name, preset, chosen).fit(scaled)])
            for name, chosen in settings.items()
        }
    finally:
        inputs.unpersist()


def predictions_long(models: Mapping[str, PipelineModel], test: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Predictions of several models as rows of (model, kept columns, prediction)."""
    parts = [
        model.transform(test).select(F.lit(name).alias("model"), *keep, "prediction") for name, model in models.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def regression_metrics(
    predictions: DataFrame, actual: str = "price_per_m2", log_label: bool = True, keys: Sequence[str] = ("model",)
) -> DataFrame:
    """RMSE, MSE, MAE and R2 per model on the price scale, as (model, metric, value) rows, in one pass."""
    y = F.col(actual).cast("double")
    guess = F.expm1("prediction") if log_label else F.col("prediction")
    mse = F.avg((y - guess) * (y - guess))
    wide = (
        predictions.filter(y.isNotNull() & F.col("prediction").isNotNull())
        .groupBy(*keys)
        .agg(mse.alias("MSE"), F.avg(F.abs(y - guess)).alias("MAE"), F.var_pop(y).alias("_spread"))
        .withColumn("RMSE", F.sqrt("MSE"))
        .withColumn("R2", F.when(F.col("_spread") > 0, 1 - F.col("MSE") / F.col("_spread")))
    )
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("RMSE", "MSE", "MAE", "R2")]
    return wide.select(*keys, F.inline(F.array(*cells)))


def select_best(metrics: DataFrame) -> DataFrame:
    """The model with the highest R2, ties by name."""
    ranked = metrics.filter(F.col("metric") == "R2").orderBy(F.desc_nulls_last("value"), "model")
    return ranked.limit(1).select("model", F.col("value").alias("r2"))


def train_and_choose(
    train: DataFrame, test: DataFrame, preset: FeaturePreset, settings: Mapping[str, Mapping] = FULL_SETTINGS
) -> tuple[str, dict[str, PipelineModel], DataFrame]:
    """(best model's name, all models, metrics table)."""
    models = train_models(train, preset, settings)
    held_out = test.select(*{*preset.inputs, "price_per_m2"}).persist(StorageLevel.MEMORY_AND_DISK)
    metrics = regression_metrics(
        predictions_long(models, held_out, ["price_per_m2"]), log_label=preset.log_label
    )
    # Four numbers per model: this is the only result of the data that the choice has to see.
    metrics = train.sparkSession.createDataFrame(metrics.collect(), metrics.schema)
    held_out.unpersist()
    return select_best(metrics).first()["model"], models, metrics


def save_model(model: PipelineModel, path: str) -> None:
    """Features and regressor together, readable as one object."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_importance(model: PipelineModel, transformed: DataFrame, top: int = 20) -> DataFrame:
    """The most important vector slots of a tree model by name. Linear models have none."""
    fitted = model.stages[-1]
    if not hasattr(fitted, "featureImportances"):
        raise ValueError(f"{type(fitted).__name__} does not report feature importances")
    weights = fitted.featureImportances
    rows = list(zip(features.slot_names(transformed), weights.toArray().tolist(), strict=True))
    table = transformed.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)


def tune(
    train: DataFrame, preset: FeaturePreset, name: str, grid: Mapping[str, Sequence], settings: Mapping | None = None
) -> tuple[PipelineModel, DataFrame]:
    """Search a parameter grid on a held-out part; (best model, tried settings with their RMSE).

    What the grid does not vary comes from ``settings``, by default the model's full ones.
    """
    _use_shared_checkpoints(train)
    estimator = regressor(name, preset, settings)
    builder = ParamGridBuilder()
    for parameter, values in grid.items():
        builder = builder.addGrid(estimator.getParam(parameter), list(values))
    maps = builder.build()
    search = TrainValidationSplit(
        estimator=estimator,
        estimatorParamMaps=maps,
        evaluator=RegressionEvaluator(labelCol=preset.label, metricName="rmse"),
        trainRatio=0.8,
        seed=SEED,
    )
    inputs = labelled(train, preset).select(*preset.inputs, preset.label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        prepared = features.fit_features(inputs, preset)
        found = search.fit(prepared.transform(spread(inputs)).select("scaled_features", preset.label))
    finally:
        inputs.unpersist()
    tried = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda x: x[0].name)), float(rmse))
        for m, rmse in zip(maps, found.validationMetrics, strict=True)
    ]
    table = train.sparkSession.createDataFrame(tried, "setting string, rmse double")
    return PipelineModel([*prepared.stages, found.bestModel]), table


def train_one(train: DataFrame, preset: FeaturePreset, name: str, settings: Mapping | None = None) -> PipelineModel:
    """One model; its narrow inputs are kept for the passes of all stages."""
    return train_models(train, preset, {name: FULL_SETTINGS[name] if settings is None else settings})[name]
