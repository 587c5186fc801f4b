"""The local session of tests and benches."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: str | None = None, **settings: str) -> SparkSession:
    """A session on this machine, web page off; ``settings`` by name, dots as ``__``."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = (
        builder.master(f"local[{cpus}]")
        .appName("nearkin")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
