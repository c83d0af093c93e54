"""Names, options and declared tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Location:
    """Where tables live.

    ``catalog_name=None`` leaves the catalog out of table names, for sessions
    with the built-in session catalog only.
    """

    # The defaults of the data model.
    catalog_name: str | None = "demo"
    schema_name: str = "lineage_data"

    @property
    def full_schema(self) -> str:
        return f"{self.catalog_name}.{self.schema_name}" if self.catalog_name else self.schema_name

    def table(self, name: str) -> str:
        return f"{self.full_schema}.{name}"


# Column lists of the declared tables.
TABLES: dict[str, str] = {
    "raw_dependencies": (
        "file_path STRING, file_name STRING, input_datasets ARRAY<STRING>, "
        "output_datasets ARRAY<STRING>, macro_calls ARRAY<STRING>, include_files ARRAY<STRING>, "
        "has_dynamic_deps BOOLEAN, proc_types ARRAY<STRING>, created_at TIMESTAMP"
    ),
    "resolved_dependencies": (
        "file_path STRING, original_inputs ARRAY<STRING>, original_outputs ARRAY<STRING>, "
        "resolved_inputs ARRAY<STRING>, resolved_outputs ARRAY<STRING>, "
        "resolution_confidence FLOAT, macro_definitions MAP<STRING, STRING>, "
        "resolution_notes STRING, created_at TIMESTAMP"
    ),
    "expanded_includes": (
        "file_path STRING, include_file STRING, resolved_path STRING, include_content STRING, "
        "expansion_level INT, created_at TIMESTAMP"
    ),
    "dataset_classifications": (
        "dataset_name STRING, business_domain STRING, data_category STRING, "
        "sensitivity_level STRING, description STRING, unity_catalog_match STRING, "
        "match_confidence FLOAT, created_at TIMESTAMP"
    ),
    "lineage_edges": (
        "source_node STRING, target_node STRING, edge_type STRING, confidence FLOAT, "
        "file_path STRING, created_at TIMESTAMP"
    ),
    "lineage_nodes": (
        "node_id STRING, node_type STRING, node_name STRING, in_degree INT, out_degree INT, "
        "betweenness_centrality FLOAT, pagerank FLOAT, created_at TIMESTAMP"
    ),
    "file_metadata": (
        "file_path STRING, file_name STRING, file_size_bytes BIGINT, line_count INT, "
        "last_modified TIMESTAMP, created_at TIMESTAMP"
    ),
    "workflow_state": (
        "workflow_id STRING, stage STRING, status STRING, start_time TIMESTAMP, "
        "end_time TIMESTAMP, error_message STRING, checkpoint_data STRING, created_at TIMESTAMP"
    ),
}

# Which content of a file each stage has written rows for; not one of the declared tables.
DONE = "stage_contents"
_DONE_COLUMNS = "file_path STRING, content STRING, stage STRING, created_at TIMESTAMP"

# Stages of a run, in order.
STAGES = ("PARSE", "RESOLVE", "ENRICH", "BUILD", "VALIDATE")


def table_schema(name: str) -> T.StructType:
    if name == DONE:
        return T.StructType.fromDDL(_DONE_COLUMNS)
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return T.StructType.fromDDL(TABLES[name])


@dataclass(frozen=True)
class ParseOptions:
    """How program files are found and read."""

    file_pattern: str = "*.[sS][aA][sS]"
    recursive: bool = False
    max_file_bytes: int | None = None
    proc_data_as: str = "output"
    skip_language_words: bool = False


@dataclass(frozen=True)
class Config:
    location: Location = field(default_factory=Location)
    parse: ParseOptions = field(default_factory=ParseOptions)
    table_format: str = "parquet"
    # None: as many as the least confidence admits.
    max_edits: int | None = None
    # Summed change of all ranks at which the rounds end.
    pagerank_tolerance: float = 1e-4
    # None: exact. A number of sources gives an estimate.
    betweenness_pivots: int | None = None
