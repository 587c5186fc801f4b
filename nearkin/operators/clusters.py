"""Clustering: training, assignment, cost, sizes and the model."""

from __future__ import annotations

import datetime
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nearkin.functions import vectors
from nearkin.functions.once import computed_once
from nearkin.operators.features import (
    FeatureStats,
    feature_vector,
    fit_stats,
    valid_items,
    with_point,
    z_names,
)
from nearkin.schema import DEFAULT_K, DEFAULT_MAX_ITER, DEFAULT_SEED, SONG_FEATURES


@dataclass(frozen=True)
class ClusterModel:
    """Centers in z-score space and what is needed to get there.

    ``k`` is the number asked for; ``centers`` may hold fewer. The model is
    k x d numbers and lives on the driver, as MLlib's models do.
    """

    stats: FeatureStats
    centers: tuple[tuple[float, ...], ...]
    k: int
    wssse: float = math.nan
    n_items: int = 0
    created_at: datetime.datetime = field(default_factory=datetime.datetime.now)

    @property
    def features(self) -> tuple[str, ...]:
        return self.stats.features


def _entries(point: Sequence[str] | str) -> Sequence[str] | str:
    return point if isinstance(point, str) else [vectors.quoted(name) for name in point]


def assign_nearest(
    df: DataFrame, point: Sequence[str] | str, centers, cluster: str = "cluster"
) -> DataFrame:
    """Add the index of the nearest center; ties go to the lowest index.

    ``point`` is a list of column names or the name of an array column. A vector
    without a nearest center (see ``vectors.nearest_center``) gets NULL.
    """
    nearest = vectors.nearest_center(_entries(point), centers).getField("cluster")
    return computed_once(df.withColumn(cluster, nearest), cluster)


def assign_items(df: DataFrame, model: ClusterModel, cluster: str = "cluster") -> DataFrame:
    """Add the cluster to every item with valid features; other rows go."""
    names = z_names(model.stats)
    placed = with_point(valid_items(df, model.features), model.stats)
    return assign_nearest(placed, names, model.centers, cluster).drop(*names)


def total_cost(df: DataFrame, point: Sequence[str] | str, centers) -> DataFrame:
    """``wssse``: the sum of squared distances to the nearest center, where there is one."""
    cost = vectors.nearest_center(_entries(point), centers).getField("cost")
    return df.agg(F.sum(cost).alias("wssse"))


def cluster_sizes(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Items per cluster, in the order of the clusters; those without items do not appear."""
    return assigned.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_items")).orderBy(cluster)


def centers_table(spark: SparkSession, model: ClusterModel) -> DataFrame:
    """cluster, center."""
    rows = [(i, list(map(float, c))) for i, c in enumerate(model.centers)]
    return spark.createDataFrame(rows, "cluster int, center array<double>")


def report_of_sizes(sizes: DataFrame, model: ClusterModel, cluster: str = "cluster") -> DataFrame:
    """:func:`cluster_report` for sizes that are known."""
    centers = centers_table(sizes.sparkSession, model).select(
        F.col("cluster").alias(cluster),
        F.transform("center", lambda x: F.round(x, 3)).alias("center"),
    )
    # Both sides have at most k rows.
    return sizes.join(F.broadcast(centers), cluster).orderBy(cluster)


def cluster_report(assigned: DataFrame, model: ClusterModel, cluster: str = "cluster") -> DataFrame:
    """Per cluster, in order: size and center, the center rounded to 3 digits."""
    return report_of_sizes(cluster_sizes(assigned, cluster), model, cluster)


def assign_observed(
    df: DataFrame, model: ClusterModel, observation: Observation, cluster: str = "cluster"
) -> DataFrame:
    """:func:`assign_items`; whoever reads the rows also takes ``cost`` and the sizes ``n0``, ``n1``, ..."""
    names, cost = z_names(model.stats), vectors.unused(df, "_cost")
    placed = with_point(valid_items(df, model.features), model.stats)
    nearest = vectors.nearest_center(_entries(names), model.centers)
    split = placed.select(*[F.col(vectors.quoted(c)) for c in df.columns], F.inline(F.array(nearest)).alias(cost, cluster))
    sizes = [F.count_if(F.col(cluster) == i).alias(f"n{i}") for i in range(len(model.centers))]
    return split.observe(observation, F.sum(cost).alias("cost"), *sizes).drop(cost)


def fit_kmeans(
    df: DataFrame,
    features: Sequence[str] = SONG_FEATURES,
    k: int = DEFAULT_K,
    max_iter: int = DEFAULT_MAX_ITER,
    seed: int = DEFAULT_SEED,
    with_cost: bool = True,
) -> ClusterModel:
    """Train K-Means on the z-scores of the valid items.

    The cost is taken against the final centers, if it is asked for. The centers depend on how the
    input is partitioned as well as on the seed. The table is read once: the
    valid feature columns are kept for statistics, training and cost.
    """
    columns = feature_vector(df, features)
    valid = valid_items(df.select(*columns), features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stats = fit_stats(valid, features)
        placed = with_point(valid, stats)
        names = z_names(stats)
        trainer = KMeans(
            k=k, maxIter=max_iter, tol=1e-4, initMode="k-means||", initSteps=2, solver="row",
            seed=seed, featuresCol="point",
        )
        trained = trainer.fit(placed.select(array_to_vector(F.array(*names)).alias("point")))
        centers = tuple(tuple(map(float, c)) for c in trained.clusterCenters())
        wssse = total_cost(placed, names, centers).first()["wssse"] if with_cost else math.nan
    finally:
        valid.unpersist()
    return ClusterModel(stats, centers, k, float(wssse), stats.n)


def lloyd(
    df: DataFrame,
    point: Sequence[str],
    starts: Sequence[Sequence[float]],
    steps: int = 50,
    tolerance: float = 1e-6,
) -> tuple[tuple[float, ...], ...]:
    """Move given centers to the means of their items, up to ``steps`` times.

    An empty cluster keeps its center. Stops when the centers together move
    less than ``tolerance``. A step is one aggregate with partial means per
    task; k x d numbers come back to the driver. Of the table only the columns
    of the point are kept between the steps.
    """
    centers = [tuple(map(float, start)) for start in starts]
    points = df.select(*[F.col(vectors.quoted(name)) for name in point])
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for _ in range(steps):
            assigned = assign_nearest(points, point, centers, "_cluster")
            assigned = assigned.filter(F.col("_cluster").isNotNull())
            averages = [F.avg(vectors.quoted(name)).alias(name) for name in point]
            means = assigned.groupBy("_cluster").agg(*averages)
            moved = 0.0
            for row in means.collect():
                mean = tuple(row[name] for name in point)
                moved += math.dist(mean, centers[row["_cluster"]])
                centers[row["_cluster"]] = mean
            if moved < tolerance:
                break
    finally:
        points.unpersist()
    return tuple(centers)


def first_points(
    df: DataFrame, point: Sequence[str], order: Sequence[str], k: int
) -> list[tuple[float, ...]]:
    """The points of the first ``k`` rows in the given order, as start centers."""
    return [tuple(row) for row in df.orderBy(*order).select(*point).limit(k).collect()]


def start_model(
    df: DataFrame, features: Sequence[str], order: Sequence[str], k: int = DEFAULT_K, steps: int = 0
) -> ClusterModel:
    """A model whose centers start at the first ``k`` valid items.

    With ``steps`` > 0 the centers are moved by :func:`lloyd`. Unlike
    :func:`fit_kmeans` the result does not depend on the partitioning.
    """
    valid = valid_items(df, features)
    stats = fit_stats(valid, features)
    placed = with_point(valid, stats)
    centers = tuple(first_points(placed, z_names(stats), order, k))
    if steps > 0:
        centers = lloyd(placed, z_names(stats), centers, steps)
    return ClusterModel(stats, centers, k, n_items=stats.n)


def cluster_items(
    df: DataFrame,
    features: Sequence[str] = SONG_FEATURES,
    k: int = DEFAULT_K,
    max_iter: int = DEFAULT_MAX_ITER,
    seed: int = DEFAULT_SEED,
) -> tuple[DataFrame, ClusterModel]:
    """Train on the table and assign every valid item: (assigned rows, model)."""
    model = fit_kmeans(df, features, k, max_iter, seed)
    return assign_items(df, model), model
