"""K-means and distance-based outliers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlens.functions.columns import array_distance, distance, name
from rowlens.operators.profile import top_k

#: The defaults of the outlier report.
K, MAX_ITERATIONS, SEED, REPORT_ROWS = 10, 100, 1234, 20

#: Numbers that a task of a fit holds in memory, a row counting its vector and ten more. It bounds the size of tasks, not what is read.
TASK_NUMBERS = 16_000_000


def _in_even_tasks(points: DataFrame, features: str) -> DataFrame:
    """Rows over as many tasks as their number and width need, as compressed files of one task may hold any number of rows."""
    size = points.agg(F.count("*").alias("n"), F.max(F.size(vector_to_array(name(features)))).alias("width")).first()
    tasks = math.ceil(size.n * ((size.width or 0) + 10) / TASK_NUMBERS)
    return points.repartition(max(tasks, points.sparkSession.sparkContext.defaultParallelism)) if tasks > 1 else points


def fit_kmeans(
    df: DataFrame,
    features: str = "features",
    k: int = K,
    max_iterations: int = MAX_ITERATIONS,
    seed: int = SEED,
    weight: str | None = None,
) -> KMeansModel:
    """The fit reads its rows many times from memory, so they are divided by number and width first."""
    points = _in_even_tasks(df.select(name(features), *([name(weight)] if weight else [])), features)
    estimator = KMeans(featuresCol=features, k=k, maxIter=max_iterations, seed=seed)
    if weight:
        estimator = estimator.setWeightCol(weight)
    return estimator.fit(points)


def assign(model: KMeansModel, df: DataFrame) -> DataFrame:
    """Add ``prediction`` (the cluster) and ``distance`` (to its centre, which is the nearest).

    The distance is a column of the row itself: nothing is collected or joined by
    position. The k centres are literals of the plan.
    """
    centres = F.array(*(F.array(*(F.lit(float(v)) for v in c)) for c in model.clusterCenters()))
    scored = model.transform(df)
    point = vector_to_array(F.col(model.getFeaturesCol()))
    return scored.withColumn("distance", array_distance(point, centres[F.col("prediction")]))


def nearest_center(df: DataFrame, columns: Sequence[str], centres: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``center`` (number of the nearest fixed centre, lowest on ties) and ``distance``."""
    points = [name(c).cast("double") for c in columns]
    gaps: list[Column] = [distance(points, centre) for centre in centres]
    named = df.withColumns({f"_d{i}": gap for i, gap in enumerate(gaps)})
    best = F.least(*(F.col(f"_d{i}") for i in range(len(gaps)))) if len(gaps) > 1 else F.col("_d0")
    which = F.coalesce(*(F.when(F.col(f"_d{i}") == F.col("distance"), i) for i in range(len(gaps))))
    scored = named.withColumn("distance", best).withColumn("center", which)
    return scored.drop(*(f"_d{i}" for i in range(len(gaps))))


def outliers(assigned: DataFrame, k: int = REPORT_ROWS, ties: Sequence[str] = ()) -> DataFrame:
    """The rows farthest from their centre."""
    return top_k(assigned, "distance", k, ties)
