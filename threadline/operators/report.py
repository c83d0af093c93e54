"""Report queries over the declared tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from threadline.operators.graph import DATASET, FILE, READS, WRITES
from threadline.operators.runlog import latest_status, stage_durations


def overview_metrics(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table in one row, in the order given."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit(name)) for name, df in tables.items()
    ]
    stacked = reduce(DataFrame.unionByName, counted)
    return stacked.agg(*[F.max(F.when(F.col("name") == t, F.col("n"))).alias(t) for t in tables])


def top_critical_files(nodes: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` file nodes of highest PageRank, then degree, then id.

    PageRank is compared to 12 decimals, so that the order of summation does not
    decide between equal nodes.
    """
    degree = (F.col("in_degree") + F.col("out_degree")).alias("degree")
    return (
        nodes.filter(F.col("node_type") == FILE)
        .select("node_id", "node_name", degree, "pagerank")
        .orderBy(F.round("pagerank", 12).desc(), F.col("degree").desc(), "node_id")
        .limit(k)
    )


def domain_breakdown(classifications: DataFrame) -> DataFrame:
    """Datasets per domain and sensitivity, with subtotals and a total."""
    return (
        classifications.rollup("business_domain", "sensitivity_level")
        .agg(F.count(F.lit(1)).alias("datasets"), F.grouping_id().alias("rollup_level"))
        .select("business_domain", "sensitivity_level", "rollup_level", "datasets")
    )


def dependency_analysis(edges: DataFrame) -> DataFrame:
    """Programs that read and write each dataset; sources are never written, sinks never read."""
    is_read = F.col("edge_type") == READS
    is_write = F.col("edge_type") == WRITES
    dataset = F.when(is_read, F.col("source_node")).when(is_write, F.col("target_node"))
    return (
        edges.filter(is_read | is_write)
        .groupBy(dataset.alias("node_id"))
        .agg(F.count_if(is_write).alias("written_by"), F.count_if(is_read).alias("read_by"))
        .select(
            F.substr("node_id", F.lit(len(DATASET) + 2)).alias("dataset_name"),
            "written_by",
            "read_by",
            (F.col("written_by") == 0).alias("is_source"),
            (F.col("read_by") == 0).alias("is_sink"),
        )
    )


def stage_report(log: DataFrame, checks: dict[str, DataFrame], tie_breakers: list[str] | None = None) -> DataFrame:
    """(section, item, measure, value) rows: stage states, stage times, check figures."""
    states = latest_status(log, tie_breakers).groupBy("stage", "status").agg(F.count(F.lit(1)).cast("double").alias("value"))
    times = stage_durations(log, tie_breakers).groupBy("stage").agg(
        F.count(F.lit(1)).cast("double").alias("runs"),
        F.count("end_time").cast("double").alias("finished"),
        F.avg("seconds").alias("avg_seconds"),
        F.max("seconds").alias("max_seconds"),
    )
    parts = [
        states.select(F.lit("status").alias("section"), F.col("stage").alias("item"), F.col("status").alias("measure"), "value"),
        times.unpivot("stage", ["runs", "finished", "avg_seconds", "max_seconds"], "measure", "value").select(
            F.lit("time").alias("section"), F.col("stage").alias("item"), "measure", "value"
        ),
    ]
    for name, figures in checks.items():
        figures = figures.select(*[F.col(c).cast("double").alias(c) for c in figures.columns])
        figures = figures.withColumn("item", F.lit(name))
        measures = [c for c in figures.columns if c != "item"]
        parts.append(
            figures.unpivot("item", measures, "measure", "value").select(
                F.lit("check").alias("section"), "item", "measure", "value"
            )
        )
    return reduce(DataFrame.unionByName, parts)

