"""Feature columns: casting, validity, one-pass statistics and scaling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearkin.functions import casts, vectors


@dataclass(frozen=True)
class FeatureStats:
    """Mean and population standard deviation per feature, over ``n`` rows."""

    features: tuple[str, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]
    n: int


def feature_vector(df: DataFrame, features: Sequence[str]) -> list[Column]:
    """The features as DOUBLE columns, NaN where a value is missing or no number."""
    return [casts.number(df, name).alias(name) for name in features]


def valid_items(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows whose features are all finite; the columns stay as they are."""
    for name in features:
        df = df.filter(casts.has_number(df, name))
    return df


def valid_vectors(df: DataFrame, array: str, dimension: int) -> DataFrame:
    """Rows whose ARRAY<DOUBLE> column has ``dimension`` entries, all finite."""
    whole = (F.size(array) == dimension) & F.forall(array, casts.is_finite)
    return df.filter(F.col(array).isNotNull() & whole)


def _moments(df: DataFrame, features: Sequence[str]) -> DataFrame:
    vector = feature_vector(df, features)
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, value in enumerate(vector):
        aggregates += [
            F.avg(value).alias(f"mean_{i}"),
            F.stddev_pop(value).alias(f"std_{i}"),
            F.sum(value).alias(f"total_{i}"),
            F.sum(value * value).alias(f"total_squares_{i}"),
        ]
    return df.agg(*aggregates)


def feature_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per feature: n, mean, std, total, total_squares.

    A single aggregate with partial sums per task; one row leaves each task.
    """
    rows = [
        F.struct(
            F.lit(i).alias("pos"),
            F.lit(name).alias("feature"),
            F.col("n"),
            F.col(f"mean_{i}").alias("mean"),
            F.col(f"std_{i}").alias("std"),
            F.col(f"total_{i}").alias("total"),
            F.col(f"total_squares_{i}").alias("total_squares"),
        )
        for i, name in enumerate(features)
    ]
    return _moments(df, features).select(F.inline(F.array(*rows)))


def fit_stats(df: DataFrame, features: Sequence[str]) -> FeatureStats:
    """Run the statistics and bring the 2 x d numbers to the driver."""
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, value in enumerate(feature_vector(df, features)):
        aggregates += [F.avg(value).alias(f"mean_{i}"), F.stddev_pop(value).alias(f"std_{i}")]
    row = df.agg(*aggregates).first()
    if row["n"] == 0:
        raise ValueError("no valid items to compute statistics from")
    span = range(len(features))
    return FeatureStats(
        tuple(features),
        tuple(row[f"mean_{i}"] for i in span),
        tuple(row[f"std_{i}"] for i in span),
        row["n"],
    )


def z_vector(df: DataFrame, stats: FeatureStats) -> list[Column]:
    """The scaled features of a table, in the order of ``stats.features``."""
    return vectors.z_scores(feature_vector(df, stats.features), stats.mean, stats.std)


def standardize(df: DataFrame, stats: FeatureStats, suffix: str = "_z") -> DataFrame:
    """Add the scaled features as further columns."""
    scaled = zip(z_vector(df, stats), stats.features, strict=True)
    return df.select("*", *[value.alias(name + suffix) for value, name in scaled])


def z_names(stats: FeatureStats, prefix: str = "_z") -> list[str]:
    """The names that :func:`with_point` gives."""
    return [f"{prefix}{i}" for i in range(len(stats.features))]


def with_point(df: DataFrame, stats: FeatureStats, prefix: str = "_z") -> DataFrame:
    """Add the scaled features under short names, for distances to work on."""
    names = z_names(stats, prefix)
    scaled = zip(z_vector(df, stats), names, strict=True)
    return df.select("*", *[value.alias(name) for value, name in scaled])
