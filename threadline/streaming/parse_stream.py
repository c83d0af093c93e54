"""The parse stage over files as they arrive.

A file source remembers what it has read, so each run appends only new files.
Extraction is a projection: no state, no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from threadline.config import ParseOptions
from threadline.operators.dependencies import raw_dependencies
from threadline.sources.files import decoded
from threadline.sources.tables import Tables


def code_file_stream(spark: SparkSession, path: str, options: ParseOptions = ParseOptions()) -> DataFrame:
    reader = (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("pathGlobFilter", options.file_pattern)
    )
    if options.recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path).select(
        decoded("_metadata.file_path").alias("file_path"),
        decoded("_metadata.file_name").alias("file_name"),
        F.col("value").alias("code"),
    )


def append_new_files(tables: Tables, path: str, checkpoint: str) -> StreamingQuery:
    """Append raw dependencies of files not seen under ``checkpoint`` yet, then stop."""
    options = tables.config.parse
    tables.create("raw_dependencies")
    raw = raw_dependencies(code_file_stream(tables.spark, path, options), options, F.current_timestamp())
    return (
        raw.writeStream.format(tables.config.table_format)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .toTable(tables.name("raw_dependencies"))
    )
