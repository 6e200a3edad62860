"""One gradient-boosted model per horizon, with errors per split and feature importance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, OneHotEncoderModel, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators.stats import regression_errors


def category_stages(categories: Sequence[str]) -> list:
    """Stages that turn each category into a one-hot vector `__name`, by falling frequency; unknown ones have a place of their own."""
    return [
        stage
        for c in categories
        for stage in (StringIndexer(inputCol=c, outputCol=f"__{c}_index", handleInvalid="keep"), OneHotEncoder(inputCol=f"__{c}_index", outputCol=f"__{c}", handleInvalid="keep"))
    ]


def forecaster(features: Sequence[str], target: str, categories: Sequence[str] = (), trees: int = 300, rate: float = 0.05, depth: int = 5, seed: int = 42) -> Pipeline:
    """Numbers are imputed by mean; categories are indexed (unknown ones kept as their own) and one-hot encoded."""
    numbers = [c for c in features if c not in categories]
    stages = [Imputer(strategy="mean", inputCols=numbers, outputCols=[f"__{c}" for c in numbers])]
    stages += category_stages(categories)
    stages += [
        VectorAssembler(inputCols=[f"__{c}" for c in [*numbers, *categories]], outputCol="__features"),
        GBTRegressor(featuresCol="__features", labelCol=target, predictionCol="prediction", maxIter=trees, stepSize=rate, maxDepth=depth, subsamplingRate=0.9, featureSubsetStrategy="0.9", seed=seed),
    ]
    return Pipeline(stages=stages)


def fit_horizon(df: DataFrame, features: Sequence[str], target: str, categories: Sequence[str] = (), **options) -> tuple[PipelineModel, DataFrame]:
    """The model of rows with split 'train', and mae, rmse, mape by split."""
    rows = df.where(F.col(target).isNotNull()).select(*(F.col(c).cast("double") if c not in categories else F.col(c) for c in features), F.col(target).cast("double"), "split")
    model = forecaster(features, target, categories, **options).fit(rows.where("split = 'train'"))
    return model, regression_errors(model.transform(rows), target, "prediction", ["split"])


def importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """feature, importance, greatest first; the parts of a category are summed."""
    assembler, trees = model.stages[-2], model.stages[-1]
    # With unknown categories kept and the last one dropped, a category is as wide as its known values.
    wide = {s.getOutputCol(): s.categorySizes[0] for s in model.stages if isinstance(s, OneHotEncoderModel)}
    values = trees.featureImportances.toArray()
    rows, at = [], 0
    for name in assembler.getInputCols():
        width = wide.get(name, 1)
        rows.append((name.removeprefix("__"), float(values[at : at + width].sum())))
        at += width
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def predicted(model: PipelineModel, df: DataFrame, key: str = "hour") -> DataFrame:
    """key and prediction of each row, without its target."""
    return model.transform(df).select(key, "prediction")


def run_record(spark: SparkSession, name: str, horizon: int, errors: DataFrame, path: str) -> DataFrame:
    """One row of a model's registry: its name, horizon, path, time and errors by split."""
    by = errors.groupBy().agg(*(F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}") for s in ("validation", "test") for m in ("mae", "rmse", "mape")))
    return by.select(F.lit(name).alias("model_name"), F.lit(horizon).alias("horizon_hours"), F.lit(path).alias("model_path"), F.current_timestamp().alias("trained_at"), "*")


def train_horizons(df: DataFrame, features: Sequence[str], horizons: Sequence[int], folder: str, target: str = "pm25_next_{}h", categories: Sequence[str] = (), name: str = "boosted_trees", **options) -> DataFrame:
    """A model for every horizon, saved below `folder` with its importances as CSV; gives the registry's rows.

    One model is fitted after another, each by all executors.
    """
    rows = None
    for n in horizons:
        model, errors = fit_horizon(df, features, target.format(n), categories, **options)
        path = f"{folder.rstrip('/')}/{name}_{n}h"
        model.write().overwrite().save(f"{path}/model")
        importance(df.sparkSession, model).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/importance")  # one row per feature
        row = run_record(df.sparkSession, name, n, errors, f"{path}/model")
        rows = row if rows is None else rows.unionByName(row)
    return rows


def newest_model(registry: DataFrame, name: str, horizon: int) -> PipelineModel:
    """The model of this name and horizon that was trained last."""
    row = registry.where((F.col("model_name") == name) & (F.col("horizon_hours") == horizon)).orderBy(F.desc("trained_at"), "model_path").select("model_path").first()
    if row is None:
        raise LookupError(f"no model {name} for {horizon} hours")
    return PipelineModel.load(row["model_path"])
