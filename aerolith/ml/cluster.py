"""Clusters of trajectories by KMeans on their anchor places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.operators.stats import non_null_counts


def clusters(df: DataFrame, features: Sequence[str], k: int = 6, k_min: int = 3, k_max: int = 10, seed: int = 42, iterations: int = 100) -> DataFrame:
    """`df` with cluster_id: mean imputation, standard scores, KMeans with k within [k_min, k_max] and the rows.

    With fewer than two rows or two features that have values, every row is in cluster 0.
    """
    known = non_null_counts(df, features).first().asDict()
    used = [c for c in features if known[c]]
    rows = df.count()
    if rows < 2 or len(used) < 2:
        return df.withColumn("cluster_id", F.lit(0))
    low = max(2, min(k_min, rows))
    high = max(low, min(k_max, rows))
    model = Pipeline(stages=[*_scaled(used), KMeans(k=min(max(k, low), high), seed=seed, maxIter=iterations, featuresCol="__scaled", predictionCol="cluster_id")]).fit(df)
    return model.transform(df).drop("__raw", "__scaled", *(f"__{c}" for c in used))


def cluster_points(points: DataFrame, labels: DataFrame, keys: Sequence[str] = ("traj_id", "direction")) -> DataFrame:
    """All points of the labelled trajectories with their cluster and the place of their start (age 0; of several, the first in time)."""
    start = F.min_by(F.struct("lat", "lon", "alt_m"), F.struct("timestamp", "lat", "lon")).alias("__start")
    source = points.where("age_h = 0").groupBy(*keys).agg(start)
    rows = points.join(labels.select(*keys, "cluster_id"), list(keys)).join(source, list(keys), "left")
    return rows.select("*", *(F.col(f"__start.{c}").alias(f"source_{c}") for c in ("lat", "lon", "alt_m"))).drop("__start")


def cost_by_k(df: DataFrame, features: Sequence[str], ks: Sequence[int], seed: int = 42, iterations: int = 40) -> list[tuple[int, float]]:
    """Within-cluster sums of squares for each k, to choose one by."""
    scaled = Pipeline(stages=_scaled(list(features))).fit(df).transform(df).select("__scaled").persist()
    try:
        return [(k, KMeans(k=k, seed=seed, maxIter=iterations, featuresCol="__scaled").fit(scaled).summary.trainingCost) for k in ks]
    finally:
        scaled.unpersist()


def _scaled(features: list[str]) -> list:
    filled = [f"__{c}" for c in features]
    return [
        Imputer(strategy="mean", inputCols=features, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="__raw"),
        StandardScaler(inputCol="__raw", outputCol="__scaled", withMean=True, withStd=True),
    ]


def scaled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """`df` with its features as the clusters see them: missing ones are the mean, then each is centred and divided by its sample deviation."""
    from pyspark.ml.functions import vector_to_array

    out = Pipeline(stages=_scaled(list(features))).fit(df).transform(df)
    return out.withColumns({c: vector_to_array("__scaled")[i] for i, c in enumerate(features)}).drop("__raw", "__scaled", *(f"__{c}" for c in features))
