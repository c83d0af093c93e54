"""Durable intermediate tables for loops and frames that are read more than once.

Each table is parquet in the folder the cluster names in
``spark.checkpoint.dir``. Writing cuts the lineage, survives lost executors and
gives the next plan measured sizes, so small sides become broadcasts and large
ones do not.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="threadline-")
    spark.conf.set(SETTING, folder)
    return folder


class Scratch:
    """Intermediate tables of one job, in one folder of their own."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self._writes = 0
        # The frames are kept with their paths, so that their ids stay theirs.
        self._saved: dict[int, tuple[DataFrame, str]] = {}

    def save(self, df: DataFrame, label: str) -> DataFrame:
        """Write a frame and read it back."""
        return self._write(df, label)

    def save_counted(
        self, df: DataFrame, label: str, condition: Column | None = None
    ) -> tuple[DataFrame, int]:
        """Same, with the number of rows (that meet a condition), counted while they are written."""
        seen = Observation()
        rows = F.count_if(F.lit(True) if condition is None else condition)
        saved = self._write(df.observe(seen, rows.alias("rows")), label)
        return saved, seen.get.get("rows", 0)

    def discard(self, saved: DataFrame) -> None:
        """Delete a table of this job that no later table will read."""
        entry = self._saved.pop(id(saved), None)
        if entry is not None:
            self._delete(entry[1])

    def discard_but(self, *kept: DataFrame) -> None:
        """Delete all tables of this job that no later table will read, which are all but the given."""
        for saved, _ in list(self._saved.values()):
            if not any(saved is k for k in kept):
                self.discard(saved)

    def drop(self) -> None:
        """Delete all tables of this job; nothing may read them any more."""
        self._saved.clear()
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def _write(self, df: DataFrame, label: str) -> DataFrame:
        self._writes += 1
        path = f"{self.root}/{self._writes:05d}-{label}"
        df.write.mode("errorifexists").parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        self._saved[id(saved)] = (saved, path)
        return saved
