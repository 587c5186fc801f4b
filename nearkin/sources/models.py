"""Cluster models as three small tables: centers, feature_stats, model_meta.

Every saved model is a version in a folder of its own; the file CURRENT names the one
that counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from nearkin.operators.clusters import ClusterModel, centers_table
from nearkin.operators.features import FeatureStats

CENTERS = "cluster int, center array<double>"
STATS = "pos int, feature string, mean double, std double"
META = "k int, wssse double, n_songs bigint, created_at timestamp"


def model_tables(spark: SparkSession, model: ClusterModel) -> dict[str, DataFrame]:
    """The model as DataFrames by table name."""
    s = model.stats
    stats = [(i, *row) for i, row in enumerate(zip(s.features, s.mean, s.std, strict=True))]
    meta = [(model.k, float(model.wssse), model.n_items, model.created_at)]
    return {
        "centers": centers_table(spark, model),
        "feature_stats": spark.createDataFrame(stats, STATS),
        "model_meta": spark.createDataFrame(meta, META),
    }


MANIFEST = "CURRENT"


def _store(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _commit(spark: SparkSession, path: str, version: str) -> None:
    """Make a version the current one: a small file, renamed over the one before."""
    fs = spark._jvm.org.apache.hadoop.fs
    new, store = _store(spark, f"{path}/_{version}.new")
    stream = store.create(new, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    overwrite = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    overwrite[0] = getattr(fs, "Options$Rename").OVERWRITE
    target, _ = _store(spark, f"{path}/{MANIFEST}")
    context = fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(store.makeQualified(new), store.makeQualified(target), overwrite)


def current_version(spark: SparkSession, path: str) -> str:
    """The version that readers take; FileNotFoundError if none was ever finished."""
    target, store = _store(spark, f"{path}/{MANIFEST}")
    if not store.exists(target):
        raise FileNotFoundError(f"no finished model at {path}")
    return spark.read.text(f"{path}/{MANIFEST}").first()["value"]


def save_model(spark: SparkSession, model: ClusterModel, path: str) -> None:
    """Write the model below ``path`` as a new version, then make it the current one.

    A reader takes all tables of one version: of the model before until the last
    step, of this one after it. The version before is left for readers that are
    still at it; older ones, and those that were never finished, are removed.
    """
    folder, store = _store(spark, path)
    before = current_version(spark, path) if store.exists(_store(spark, f"{path}/{MANIFEST}")[0]) else None
    version = uuid.uuid4().hex
    for name, table in model_tables(spark, model).items():
        table.coalesce(1).write.parquet(f"{path}/version={version}/{name}")
    _commit(spark, path, version)
    for status in store.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("version=") and name not in (f"version={version}", f"version={before}"):
            store.delete(status.getPath(), True)


def load_model(spark: SparkSession, path: str) -> ClusterModel:
    """Read the current version of a saved model."""
    path = f"{path}/version={current_version(spark, path)}"
    centers = spark.read.schema(CENTERS).parquet(f"{path}/centers").orderBy("cluster").collect()
    stats = spark.read.schema(STATS).parquet(f"{path}/feature_stats").orderBy("pos").collect()
    meta = spark.read.schema(META).parquet(f"{path}/model_meta").first()
    return ClusterModel(
        FeatureStats(
            tuple(row["feature"] for row in stats),
            tuple(row["mean"] for row in stats),
            tuple(row["std"] for row in stats),
            meta["n_songs"],
        ),
        tuple(tuple(row["center"]) for row in centers),
        meta["k"],
        meta["wssse"],
        meta["n_songs"],
        meta["created_at"],
    )
