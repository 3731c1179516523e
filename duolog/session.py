"""Session helper and worker import path."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benches: UTC, AQE on, few shuffle partitions."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("duolog")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers started from another folder import this package."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark
