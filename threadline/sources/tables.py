"""The declared tables: create, read, append, drop, and what of them is current."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadline.config import DONE, TABLES, Config, table_schema
from threadline.operators.dependencies import latest_per_file

# Which stage writes the rows of a table whose rows belong to files.
WRITTEN_BY = {
    "resolved_dependencies": "RESOLVE",
    "expanded_includes": "RESOLVE",
    "lineage_edges": "BUILD",
}


@dataclass(frozen=True)
class Attempt:
    """What became of one table; ``error`` is None when it went well."""

    table: str
    error: Exception | None = None


def raise_first(attempts: list[Attempt]) -> None:
    for a in attempts:
        if a.error is not None:
            raise a.error


class Tables:
    """Tables of one location, in the format the configuration names."""

    def __init__(self, spark: SparkSession, config: Config = Config()) -> None:
        self.spark = spark
        self.config = config
        self.location = config.location

    def name(self, table: str) -> str:
        return self.location.table(table)

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def create_schema(self) -> None:
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.location.full_schema}")

    def create(self, table: str) -> None:
        """Create a declared table if it is absent; an unknown name raises ValueError."""
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table_schema(table))
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING {self.config.table_format}")

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def for_all(self, action: Callable[[str], None]) -> list[Attempt]:
        """``action`` on every declared table; one that fails does not keep the others from it."""
        return [self._attempt(action, t) for t in TABLES]

    @staticmethod
    def _attempt(action: Callable[[str], None], table: str) -> Attempt:
        try:
            action(table)
        except Exception as e:
            return Attempt(table, e)
        return Attempt(table)

    def create_all(self) -> list[Attempt]:
        return self.for_all(self.create)

    def drop_all(self) -> list[Attempt]:
        self.drop(DONE)
        return self.for_all(self.drop)

    def setup_all(self) -> None:
        """Schema and tables; raises the first error, after trying all."""
        self.create_schema()
        raise_first(self.create_all())

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def write(self, df: DataFrame, table: str, mode: str = "append") -> None:
        """Write the declared columns, in declared order and type, creating the table if absent."""
        schema = table_schema(table)
        if not self.exists(table):
            self.create(table)
        df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]).write.format(
            self.config.table_format
        ).mode(mode).saveAsTable(self.name(table))

    # -- rows that count after several runs ------------------------------------

    def done(self, stage: str) -> DataFrame:
        """(file_path, content, created_at): what each file was when a stage last wrote its rows, and when."""
        rows = self.read(DONE) if self.exists(DONE) else self.spark.createDataFrame([], table_schema(DONE))
        newest = F.max(F.struct("created_at", "content")).alias("newest")
        return rows.filter(F.col("stage") == stage).groupBy("file_path").agg(newest).select(
            "file_path", F.col("newest.content").alias("content"), F.col("newest.created_at").alias("created_at")
        )

    def mark_done(self, files: DataFrame, stage: str, stamp: object) -> None:
        """Note that a stage has written its rows of these (file_path, content); they count from now on."""
        self.write(files.select("file_path", "content", F.lit(stage).alias("stage"), F.lit(stamp).alias("created_at")), DONE)

    def current(self, table: str) -> DataFrame:
        """The rows that count: per file those of the last time its stage finished.

        Rows are only ever appended, so a run that fails half-way changes nothing
        here, and a file that has no rows any more has none. Raw dependencies
        keep the newest row per file, classifications the newest per dataset;
        the other tables are written whole.
        """
        rows = self.read(table)
        if table == "raw_dependencies":
            return latest_per_file(rows)
        if table == "dataset_classifications":
            rest = [c for c in rows.columns if c != "dataset_name"]
            newest = rows.groupBy("dataset_name").agg(F.max(F.struct("created_at", *[c for c in rest if c != "created_at"])).alias("newest"))
            return newest.select("dataset_name", *[F.col(f"newest.{c}").alias(c) for c in rest])
        if table not in WRITTEN_BY:
            return rows
        return rows.join(self.done(WRITTEN_BY[table]).select("file_path", "created_at"), ["file_path", "created_at"], "left_semi")

    def compact(self) -> None:
        """Rewrite the tables of files to the rows that count."""
        for table in ("raw_dependencies", "dataset_classifications", *WRITTEN_BY):
            if not self.exists(table):
                continue
            kept = self.name(f"{table}_kept")
            self.current(table).select(*table_schema(table).names).write.format(self.config.table_format).mode("overwrite").saveAsTable(kept)
            self.write(self.spark.table(kept), table, mode="overwrite")
            self.spark.sql(f"DROP TABLE {kept}")
