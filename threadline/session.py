"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffle partitions, turns joins with a small measured
# side into broadcasts and splits skewed join partitions at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cpus: int | str = "*", app: str = "threadline", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    partitions = "8" if cpus == "*" else str(cpus)
    local = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": partitions,
        "spark.driver.memory": "20g",
    }
    for key, value in {**SETTINGS, **local, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
