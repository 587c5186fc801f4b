"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_used: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the session names, or else one in its warehouse."""
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below :func:`scratch_root`; :func:`clear_scratch` removes it."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _used.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Remove what lies at the scratch paths that this application was given."""
    for path in _used.pop(spark.sparkContext.applicationId, []):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def kept(df: DataFrame) -> DataFrame:
    """The table worked out now, in files that outlive a lost executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()
