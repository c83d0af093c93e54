"""The given tables, and the package itself, where tasks find them."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

import threadline


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers of this session, once.

    Operators run functions of this package in tasks; workers do not see the
    driver's import path.
    """
    context = spark.sparkContext
    if getattr(context, "_threadline_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(threadline.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="threadline-code-"), "threadline_code.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)
    context._threadline_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
