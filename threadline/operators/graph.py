"""Lineage graph: edges, nodes, degrees and dataset flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadline.functions.paths import candidate_path
from threadline.plans.skew import find_hot_keys, skew_join

# Node and edge types.
DATASET, FILE, MACRO = "dataset", "file", "macro"
READS, WRITES, INCLUDES, CALLS = "READS", "WRITES", "INCLUDES", "CALLS"


def node_id(node_type: str, name: Column) -> Column:
    return F.concat(F.lit(f"{node_type}:"), name)


def _edges(names: Column, source: str, target: str, edge_type: str, confidence: Column) -> Column:
    """Edge structs between the row's file and each name."""

    def edge(name: Column) -> Column:
        ends = {FILE: node_id(FILE, F.col("file_path"))}
        return F.struct(
            ends.get(source, node_id(source, name)).alias("source_node"),
            ends.get(target, node_id(target, name)).alias("target_node"),
            F.lit(edge_type).alias("edge_type"),
            confidence.cast("float").alias("confidence"),
        )

    return F.transform(names, edge)


def _exploded(df: DataFrame, *edge_arrays: Column) -> DataFrame:
    return df.select("file_path", F.inline(F.concat(*edge_arrays)))


def lineage_edges(
    raw: DataFrame,
    resolved: DataFrame | None = None,
    links: DataFrame | None = None,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Typed edges with confidence and the file they come from.

    ``raw`` holds one row per file and its lists are sets, so edges are distinct
    without a shuffle. Files in ``resolved`` give the names of their resolved
    lists: those the text shows as well at confidence 1, those that only
    substitution brought up at the confidence of the resolution; names that
    substitution changes are none. ``links`` gives include
    edges the path of the included file; without it the path in the text counts.
    """
    sure = F.lit(1.0)
    whole = raw
    edges = _exploded(raw, _edges(F.col("macro_calls"), MACRO, FILE, CALLS, sure))
    if resolved is not None:
        whole = raw.join(resolved.select("file_path"), "file_path", "left_anti")
        score = F.col("resolution_confidence")
        kept = {c: F.array_intersect(f"resolved_{c}", f"original_{c}") for c in ("inputs", "outputs")}
        new = {c: F.array_except(f"resolved_{c}", f"original_{c}") for c in ("inputs", "outputs")}
        edges = edges.unionByName(
            _exploded(
                resolved,
                _edges(kept["inputs"], DATASET, FILE, READS, sure),
                _edges(kept["outputs"], FILE, DATASET, WRITES, sure),
                _edges(new["inputs"], DATASET, FILE, READS, score),
                _edges(new["outputs"], FILE, DATASET, WRITES, score),
            )
        )
    edges = edges.unionByName(
        _exploded(
            whole,
            _edges(F.col("input_datasets"), DATASET, FILE, READS, sure),
            _edges(F.col("output_datasets"), FILE, DATASET, WRITES, sure),
        )
    )
    if links is None:
        included = raw.select("file_path", F.explode("include_files").alias("text")).select(
            "file_path", candidate_path(F.col("file_path"), F.col("text")).alias("included")
        )
    else:
        included = links.select("file_path", F.coalesce("resolved_path", "candidate").alias("included"))
    # Two texts of one file may stand for the same path.
    included = included.distinct().select(
        "file_path",
        node_id(FILE, F.col("included")).alias("source_node"),
        node_id(FILE, F.col("file_path")).alias("target_node"),
        F.lit(INCLUDES).alias("edge_type"),
        F.lit(1.0).cast("float").alias("confidence"),
    )
    created = F.lit(None) if loaded_at is None else loaded_at
    return edges.unionByName(included).select(
        "source_node",
        "target_node",
        "edge_type",
        "confidence",
        "file_path",
        created.cast("timestamp").alias("created_at"),
    )


def node_degrees(edges: DataFrame) -> DataFrame:
    """In- and out-degree of every edge end, in one aggregation."""
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("source_node").alias("node_id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
                F.struct(F.col("target_node").alias("node_id"), F.lit(1).alias("i"), F.lit(0).alias("o")),
            )
        )
    )
    return ends.groupBy("node_id").agg(
        F.sum("i").cast("int").alias("in_degree"), F.sum("o").cast("int").alias("out_degree")
    )


def lineage_nodes(
    edges: DataFrame,
    pagerank: DataFrame | None = None,
    betweenness: DataFrame | None = None,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Every edge end with its type, name, degrees and, when given, centralities.

    Nodes without a betweenness row (files and macros, when it was computed on
    the dataset graph) have none.
    """
    created = F.lit(None) if loaded_at is None else loaded_at
    nodes = node_degrees(edges)
    for metric, column in ((betweenness, "betweenness_centrality"), (pagerank, "pagerank")):
        if metric is None:
            nodes = nodes.withColumn(column, F.lit(None).cast("float"))
        else:
            nodes = nodes.join(metric.select("node_id", F.col(column).cast("float")), "node_id", "left")
    return nodes.select(
        "node_id",
        F.substring_index("node_id", ":", 1).alias("node_type"),
        F.substr("node_id", F.instr("node_id", ":") + 1).alias("node_name"),
        "in_degree",
        "out_degree",
        "betweenness_centrality",
        "pagerank",
        created.cast("timestamp").alias("created_at"),
    )


def dataset_flow(edges: DataFrame) -> DataFrame:
    """Distinct dataset pairs where one program reads the first and writes the second."""
    name = lambda c: F.substr(c, F.instr(c, ":") + 1)
    reads = edges.filter(F.col("edge_type") == READS).select(
        "file_path", name(F.col("source_node")).alias("source_dataset")
    )
    writes = edges.filter(F.col("edge_type") == WRITES).select(
        "file_path", name(F.col("target_node")).alias("target_dataset")
    )
    # One generated program may hold a large share of the edges.
    return (
        skew_join(
            reads, writes, "file_path",
            hot_left=find_hot_keys(reads, "file_path"), hot_right=find_hot_keys(writes, "file_path"),
            by_left=["source_dataset"], by_right=["target_dataset"],
        )
        .select("source_dataset", "target_dataset")
        .distinct()
    )


def nodes_with_catalog(nodes: DataFrame, matches: DataFrame) -> DataFrame:
    """Nodes tied to catalogue tables; only dataset nodes can have a match."""
    found = matches.select(
        node_id(DATASET, F.col("dataset_name")).alias("node_id"),
        "unity_catalog_match",
        "match_confidence",
    )
    return nodes.join(found, "node_id", "left")
