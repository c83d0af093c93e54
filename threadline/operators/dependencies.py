"""Raw dependencies: one row per program file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadline.config import ParseOptions
from threadline.functions import extract
from threadline.functions.paths import base_name


def with_dependencies(files: DataFrame, options: ParseOptions = ParseOptions()) -> DataFrame:
    """Add the six dependency columns to a frame that has ``code``."""
    code = F.coalesce(F.col("code"), F.lit(""))
    return files.select(
        "*",
        extract.input_datasets(code, options.proc_data_as).alias("input_datasets"),
        extract.output_datasets(code, options.proc_data_as).alias("output_datasets"),
        extract.macro_calls(code, options.skip_language_words).alias("macro_calls"),
        extract.include_files(code).alias("include_files"),
        extract.has_dynamic_deps(code).alias("has_dynamic_deps"),
        extract.proc_types(code).alias("proc_types"),
    )


def _file_name(files: DataFrame) -> Column:
    return F.col("file_name") if "file_name" in files.columns else base_name(F.col("file_path"))


def raw_dependencies(
    files: DataFrame,
    options: ParseOptions = ParseOptions(),
    loaded_at: Column | None = None,
) -> DataFrame:
    """The ``raw_dependencies`` table for a frame of files."""
    created = F.lit(None) if loaded_at is None else loaded_at
    return with_dependencies(files, options).select(
        "file_path",
        _file_name(files).alias("file_name"),
        "input_datasets",
        "output_datasets",
        "macro_calls",
        "include_files",
        "has_dynamic_deps",
        "proc_types",
        created.cast("timestamp").alias("created_at"),
    )


def raw_dependencies_by_line(files: DataFrame, options: ParseOptions = ParseOptions()) -> DataFrame:
    """The same, with one row per line of text; statements over several lines are lost."""
    lines = files.select(
        "file_path",
        _file_name(files).alias("file_name"),
        F.posexplode(extract.line_array(F.col("code"))).alias("line_no", "code"),
    )
    return with_dependencies(lines, options).drop("code")


def num_files(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count_distinct("file_path").alias("num_files"))


def latest_per_file(raw: DataFrame) -> DataFrame:
    """Newest row per file over appended runs; equal times fall back to the row's values.

    A maximum instead of a window: it is combined before the shuffle, so a file
    that was parsed very often does not end up in one task.
    """
    rest = [c for c in raw.columns if c not in ("file_path", "created_at")]
    newest = F.max(F.struct("created_at", *rest)).alias("newest")
    return raw.groupBy("file_path").agg(newest).select(
        "file_path", *[F.col(f"newest.{c}").alias(c) for c in raw.columns if c != "file_path"]
    )


def unique_datasets(raw: DataFrame) -> DataFrame:
    """Distinct dataset names read or written anywhere."""
    names = F.explode(F.array_union("input_datasets", "output_datasets"))
    return raw.select(names.alias("dataset_name")).distinct()
