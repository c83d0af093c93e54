"""One query per operator, over the whole of the given tables.

Arrays leave as ``|``-joined text and metrics rounded, so that results compare
by value. Load times are left out.
"""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import TYPE_CHECKING
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadline import corpus
from threadline.config import TABLES, Config, Location, ParseOptions
from threadline.functions import extract
from threadline.operators import centrality, dependencies, enrich, graph, reach, reach_index, report, resolve, runlog, validate
from threadline.plans.scratch import Scratch
from threadline.plans.skew import find_hot_keys, skew_join
from threadline.sources import files as files_source
from threadline.sources.export import export_graph_json
from threadline.sources.files import text_metadata
from threadline.sources.tables import Tables, raise_first

if TYPE_CHECKING:
    import pyarrow as pa

Query = Callable[[SparkSession, str], DataFrame]


def joined(name: str) -> Column:
    return F.array_join(name, "|").alias(name)


def time_text(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


class Inputs:
    """Derived inputs of one query. Frames read more than once are written first."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.scratch = Scratch(spark, "query")
        self._resolution: resolve.Resolution | None = None
        self._edges: DataFrame | None = None
        self._raw: DataFrame | None = None
        self._programs: DataFrame | None = None

    def load(self, name: str) -> DataFrame:
        return corpus.load(self.spark, self.sf_dir, name)

    def files(self) -> DataFrame:
        return self.load("code_files")

    def programs(self) -> DataFrame:
        """The program files, their texts made once for a query that reads them many times."""
        if self._programs is None:
            self._programs = self.scratch.save(self.files(), "programs")
        return self._programs

    def raw(self) -> DataFrame:
        """Raw dependencies, extracted once for a query however often it reads them."""
        if self._raw is None:
            self._raw = self.scratch.save(dependencies.raw_dependencies(self.files() if self._programs is None else self._programs), "raw")
        return self._raw

    def lists(self) -> DataFrame:
        """The lists of raw dependencies, of which a query that reads them once needs only some."""
        if self._raw is not None:
            return self._raw
        return dependencies.raw_dependencies(self.files() if self._programs is None else self._programs)

    def resolution(self) -> resolve.Resolution:
        if self._resolution is None:
            self._resolution = resolve.read_corpus(self.programs(), self.scratch)
        return self._resolution

    def resolved(self) -> DataFrame:
        return resolve.resolved_dependencies(self.programs(), resolution=self.resolution())

    def links(self) -> DataFrame:
        return self.resolution().links

    def edges(self) -> DataFrame:
        if self._edges is None:
            self.programs()
            edges = graph.lineage_edges(self.lists(), self.resolved(), self.links())
            self._edges = self.scratch.save(edges, "edges")
        return self._edges

    def edges_alone(self) -> DataFrame:
        """The edges of a query that reads nothing else; what they were made of is deleted."""
        edges = self.edges()
        self._programs = self._raw = self._resolution = None
        self.scratch.discard_but(edges)
        return edges

    def flow(self) -> DataFrame:
        flow = graph.dataset_flow(self.edges())
        return self.scratch.save(flow, "flow")

    def datasets(self) -> DataFrame:
        return self.scratch.save(dependencies.unique_datasets(self.lists()), "datasets")

    def matches(self) -> DataFrame:
        return enrich.match_catalog(self.datasets(), self.load("catalog_tables"))

    def classifications(self) -> DataFrame:
        names = self.datasets()
        return enrich.dataset_classifications(
            enrich.classify_datasets(names, self.load("class_rules")),
            enrich.match_catalog(names, self.load("catalog_tables")),
        )

    def nodes(self) -> DataFrame:
        edges = self.edges()
        return graph.lineage_nodes(edges, pagerank=centrality.pagerank(edges))

    def log(self) -> DataFrame:
        return self.load("run_log")


def _extractor(name: str) -> Query:
    expression = getattr(extract, name)

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        files = Inputs(spark, sf_dir).files()
        return files.select("file_path", F.array_join(expression(F.col("code")), "|").alias(name))

    return query


def has_dynamic_deps(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = Inputs(spark, sf_dir).files()
    return files.select("file_path", extract.has_dynamic_deps(F.col("code")).alias("has_dynamic_deps"))


def normalize_dataset_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    written = F.concat(F.lit("  "), F.upper("p_brand"), F.lit("."), F.col("p_name"), F.lit(";.;  "))
    return part.select(
        "p_partkey", extract.normalize_dataset_name(written).alias("dataset_name")
    )


_LISTS = ("input_datasets", "output_datasets", "macro_calls", "include_files", "proc_types")


def raw_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dependencies.raw_dependencies(Inputs(spark, sf_dir).files())
    return raw.select("file_path", "file_name", "has_dynamic_deps", *[joined(c) for c in _LISTS])


def raw_dependencies_by_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_line = dependencies.raw_dependencies_by_line(Inputs(spark, sf_dir).files())
    return by_line.select("file_path", "line_no", "has_dynamic_deps", *[joined(c) for c in _LISTS])


def num_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dependencies.num_files(Inputs(spark, sf_dir).files())


def file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_metadata(Inputs(spark, sf_dir).files())


def latest_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = Inputs(spark, sf_dir).raw()
    first = raw.withColumn("created_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    again = (
        raw.filter(F.size("include_files") > 0)
        .withColumn("created_at", F.lit("2024-01-02 00:00:00").cast("timestamp"))
        .withColumn("proc_types", F.array(F.lit("rerun")))
    )
    latest = dependencies.latest_per_file(first.unionByName(again))
    return latest.select("file_path", joined("input_datasets"), joined("proc_types"), time_text("created_at"))


def export_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the exported graph, read back from the JSON files."""
    inputs = Inputs(spark, sf_dir)
    edges = inputs.edges_alone()
    nodes = graph.lineage_nodes(edges)
    path = f"{inputs.scratch.root}/export"
    export_graph_json(nodes, edges, path, compression="gzip")
    read = lambda kind, df: spark.read.schema(df.schema).json(f"{path}/{kind}")
    kinds = read("nodes", nodes).select(
        F.col("node_type").alias("kind"), F.col("node_id").alias("id"), F.col("node_name").alias("other"), "in_degree", "out_degree",
        F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("file_path"),
    )
    return kinds.unionByName(
        read("edges", edges).select(
            F.col("edge_type").alias("kind"), F.col("source_node").alias("id"), F.col("target_node").alias("other"),
            F.lit(None).cast("int").alias("in_degree"), F.lit(None).cast("int").alias("out_degree"),
            F.round(F.col("confidence").cast("double"), 6).alias("confidence"), "file_path",
        )
    )


def _write_local(rows: DataFrame, path: str) -> None:
    """Rows of (folder, code), one file each, as ``partitionBy("folder").text`` lays them out.

    For folders that are mounted on all machines: there Spark's writer starts a
    process for every file, to set its mode. Rows are sorted and numbered by folder, so a
    task that runs again writes the same files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        import re

        import pyarrow as pa
        from pyspark import TaskContext

        task, numbers = TaskContext.get().partitionId(), {}
        for batch in batches:
            for folder, code in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if folder not in numbers:
                    name = re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", folder or "") or "__HIVE_DEFAULT_PARTITION__"
                    home = f"{path}/folder={name}"
                    os.makedirs(home, exist_ok=True)
                    numbers[folder] = [home, 0]
                home, number = numbers[folder]
                with open(f"{home}/part-{task:05d}-{number:09d}{'n' if folder is None else ''}.txt", "wb") as file:
                    file.write((code or "").encode() + b"\n")
                numbers[folder][1] += 1
        yield pa.RecordBatch.from_pydict({"files": [sum(n for _, n in numbers.values())]})

    os.makedirs(path)
    rows.select("folder", "code").sortWithinPartitions("folder", "code").mapInArrow(write, "files long").agg(F.sum("files")).collect()


_FILES = 25_000  # program files that are on the disk at a time


class Written:
    """The corpus as program files in folders of the job, one file each, by the folder they had.

    A file takes a block of the disk however short it is, and the driver lists files,
    so they are written, scanned and deleted a part of the corpus at a time; the next
    part is written while one is scanned.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.scratch = spark, Scratch(spark, "written")
        self.options = ParseOptions(file_pattern="part-*.txt", recursive=True)
        files = Inputs(spark, sf_dir).files()
        parts = max(1, -(-files.count() // _FILES))
        folder = F.regexp_replace(F.regexp_extract("file_path", "^(.*)/[^/]*$", 1), "/", "_")
        part = F.pmod(F.xxhash64("file_path", "code"), F.lit(parts)).cast("int")
        rows = files.select(folder.alias("folder"), "code", part.alias("part"))
        path = f"{self.scratch.root}/rows"
        # A part is read by itself, so that the texts are made once.
        (rows if parts == 1 else rows.repartition(parts, "part")).write.partitionBy("part").parquet(path)
        self.rows = spark.read.schema(rows.schema).parquet(path)
        self.parts = [r["part"] for r in self.rows.select("part").distinct().sort("part").collect()] or [0]

    def _write(self, part: int) -> tuple[Scratch, str]:
        work = Scratch(self.spark, "programs")
        path = f"{work.root}/programs"
        rows = self.rows.filter(F.col("part") == part).select("folder", "code")
        place = urlparse(path)
        if place.scheme in ("", "file"):
            # By one task: several that make files on one disk at a time mostly wait for each other.
            _write_local(rows.coalesce(1), place.path)
        else:
            # One row, and so one program, to a file.
            rows.write.option("maxRecordsPerFile", 1).option("compression", "none").partitionBy("folder").text(path)
        return work, path

    def scanned(self, scan: Callable[[str], DataFrame]) -> DataFrame:
        """What ``scan`` makes of a folder of programs, for all parts together."""
        at, found = f"{self.scratch.root}/scanned", None
        with ThreadPoolExecutor(1) as ahead:
            written = ahead.submit(self._write, self.parts[0])
            for following in [*self.parts[1:], None]:
                work, path = written.result()
                if following is not None:
                    written = ahead.submit(self._write, following)
                found = scan(path)
                found.write.mode("append").parquet(at)
                work.drop()
                gc.collect()  # else the driver holds the lists of files of earlier parts
        return self.spark.read.schema(found.schema).parquet(at)


def _scanned(files: DataFrame) -> DataFrame:
    """What a scan gives of each file that does not depend on the job's own names."""
    return files.select(
        F.regexp_extract("file_path", "folder=([^/]*)/", 1).alias("folder"), F.md5("code").alias("content"),
        F.endswith(F.col("file_path"), F.concat(F.lit("/"), F.col("file_name"))).alias("named"),
        F.array_join(extract.input_datasets(F.col("code")), "|").alias("input_datasets"),
    )


def scan_code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folders scanned flat, without what may lie below them."""
    written = Written(spark, sf_dir)
    flat = ParseOptions(file_pattern=written.options.file_pattern)
    return written.scanned(lambda path: _scanned(files_source.scan_code_files(spark, f"{path}/folder=*", flat)))


def scan_code_files_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = Written(spark, sf_dir)
    return written.scanned(lambda path: _scanned(files_source.scan_code_files(spark, path, written.options)))


def scan_file_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = Written(spark, sf_dir)

    def scan(path: str) -> DataFrame:
        with files_source.listing(spark):
            paths = spark.read.option("recursiveFileLookup", "true").text(path).inputFiles()
        return _scanned(files_source.scan_file_list(spark, [unquote(p) for p in paths], written.options))

    return written.scanned(scan)


def scan_by_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-line form of the scan, with the path of each line's file."""
    written = Written(spark, sf_dir)

    def scan(path: str) -> DataFrame:
        lines = files_source.scan_code_files(spark, path, written.options, wholetext=False)
        return _scanned(lines).groupBy("folder", "content", "named").agg(F.count("*").alias("lines"))

    return written.scanned(scan).groupBy("folder", "content", "named").agg(F.sum("lines").alias("lines"))


def skewed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programs with the facts of their folder, joined as if each folder were too many rows for a task."""
    raw = Inputs(spark, sf_dir).raw().select(F.regexp_replace("file_path", "/[^/]*$", "").alias("folder"), "file_name")
    facts = raw.groupBy("folder").agg(F.count("*").alias("programs"))
    hot = find_hot_keys(raw, "folder", min_rows=2, rows_per_salt=50)
    return skew_join(raw, facts, "folder", "left", hot_left=hot, by_left=["file_name"])


def _with_tables(spark: SparkSession, use: Callable[[Tables], DataFrame]) -> DataFrame:
    """The result of work on tables of a schema of its own, which is gone afterwards."""
    tables = Tables(spark, Config(location=Location(None, f"threadline_{uuid.uuid4().hex}")))
    tables.create_schema()
    try:
        return Scratch(spark, "tables").save(use(tables), "result")
    finally:
        tables.drop_all()
        spark.sql(f"DROP SCHEMA IF EXISTS {tables.location.full_schema}")


def table_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw dependencies appended twice, the second time files with includes only, and read back."""
    raw = Inputs(spark, sf_dir).raw()

    def use(tables: Tables) -> DataFrame:
        tables.write(raw.withColumn("extra", F.lit(1)), "raw_dependencies")
        tables.write(raw.filter(F.size("include_files") > 0), "raw_dependencies")
        back = tables.read("raw_dependencies")
        return back.groupBy("file_path", *[joined(c) for c in _LISTS]).agg(F.count("*").alias("copies"))

    return _with_tables(spark, use)


def table_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared table before, while and after it exists, with the rows written to two of them."""
    inputs = Inputs(spark, sf_dir)

    def use(tables: Tables) -> DataFrame:
        steps = [{"table_name": t, "before": tables.exists(t)} for t in TABLES]
        raise_first(tables.create_all())
        tables.write(inputs.raw(), "raw_dependencies")
        tables.write(inputs.log(), "workflow_state")
        for s in steps:
            s |= {"created": tables.exists(s["table_name"]), "columns": len(tables.read(s["table_name"]).columns), "rows_written": tables.read(s["table_name"]).count()}
        raise_first(tables.drop_all())
        for s in steps:
            s["after"] = tables.exists(s["table_name"])
        return spark.createDataFrame([tuple(s.values()) for s in steps], "table_name string, before boolean, created boolean, columns int, rows_written long, after boolean")

    return _with_tables(spark, use)


def wf_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the log as the writer makes them for every event of the run log, by kind of row."""
    log = Inputs(spark, sf_dir).log()
    rows = runlog.log_rows(log.select("workflow_id", "stage", "status", "error_message", "checkpoint_data"))
    firsts = runlog.log_rows(
        log.select("workflow_id").distinct().select("workflow_id", F.lit("INIT").alias("stage"), F.lit("CREATED").alias("status"), F.lit(None).alias("error_message"), F.lit(None).alias("checkpoint_data"))
    )
    return rows.unionByName(firsts).select(
        "workflow_id", "stage", "status", F.col("start_time").isNotNull().alias("starts"), F.col("end_time").isNotNull().alias("ends"),
        "error_message", "checkpoint_data", F.col("created_at").isNotNull().alias("stamped"),
    )


def macro_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    defined = resolve.macro_definitions(Inputs(spark, sf_dir).files())
    pairs = F.transform(
        F.map_entries("macro_definitions"), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return defined.select(
        "file_path",
        F.array_join(F.array_sort(pairs), "|").alias("macro_definitions"),
        joined("macros_defined"),
    )


def dynamic_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.dynamic_files(Inputs(spark, sf_dir).raw()).select("file_path")


_RESOLVED = ("original_inputs", "original_outputs", "resolved_inputs", "resolved_outputs")


def resolved_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).resolved().select("file_path", *[joined(c) for c in _RESOLVED])


def resolution_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.round(F.col("resolution_confidence").cast("double"), 6)
    return Inputs(spark, sf_dir).resolved().select(
        "file_path", score.alias("resolution_confidence"), "resolution_notes"
    )


def expanded_includes(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = Inputs(spark, sf_dir).programs()
    links, _ = resolve.program_links(files)
    return resolve.expanded_includes(files, links).drop("created_at")


def include_path_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, _ = resolve.program_links(Inputs(spark, sf_dir).programs())
    return links.select("file_path", "include_file", "resolved_path").distinct()


def unique_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dependencies.unique_datasets(Inputs(spark, sf_dir).lists())


def dataset_classifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.round(F.col("match_confidence").cast("double"), 6)
    return Inputs(spark, sf_dir).classifications().withColumn("match_confidence", score).drop("created_at")


def catalog_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).matches().withColumn("match_confidence", F.round("match_confidence", 6))


def _no_time(df: DataFrame) -> DataFrame:
    return df.drop("created_at")


def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.round(F.col("confidence").cast("double"), 6)
    return _no_time(Inputs(spark, sf_dir).edges()).withColumn("confidence", score)


def lineage_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    nodes = inputs.nodes()
    # Betweenness of the dataset graph, in double precision.
    scores = centrality.betweenness(inputs.flow(), "source_dataset", "target_dataset").select(
        graph.node_id(graph.DATASET, F.col("node_id")).alias("node_id"), F.round("betweenness_centrality", 6).alias("betweenness_centrality")
    )
    return nodes.select(
        "node_id", "node_type", "node_name", "in_degree", "out_degree",
        F.round(F.col("pagerank").cast("double"), 9).alias("pagerank"),
    ).join(scores, "node_id", "left")


def node_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.node_degrees(Inputs(spark, sf_dir).edges())


def pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = centrality.pagerank(Inputs(spark, sf_dir).edges())
    return ranks.select("node_id", F.round("pagerank", 9).alias("pagerank"))


def betweenness(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = centrality.betweenness(Inputs(spark, sf_dir).flow(), "source_dataset", "target_dataset")
    return scores.select(
        F.col("node_id").alias("dataset_name"), F.round("betweenness_centrality", 6).alias("betweenness_centrality")
    )


def detect_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reach.strong_components(Inputs(spark, sf_dir).flow())


def cycle_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = Inputs(spark, sf_dir).edges()
    ends = ("source_node", "target_node")
    return reach.cycle_paths(edges, reach.strong_components(edges, *ends), *ends)


def dataset_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).flow()


def lineage_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reach.lineage_closure(Inputs(spark, sf_dir).flow())


def reach_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many datasets each one reaches, from the reach index, without a table of pairs."""
    index = reach_index.reach_index(Inputs(spark, sf_dir).flow())
    return index.counts().select(F.col("node").alias("dataset_name"), "reached")


def catalog_integration(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    tied = graph.nodes_with_catalog(graph.lineage_nodes(inputs.edges()), inputs.matches())
    return tied.select(
        "node_id", "node_type", "unity_catalog_match", F.round("match_confidence", 6).alias("match_confidence")
    )


def wf_load_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.latest_checkpoints(Inputs(spark, sf_dir).log())


def wf_latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = runlog.latest_status(Inputs(spark, sf_dir).log(), ["event_id"])
    return latest.withColumn("created_at", time_text("created_at"))


def wf_stage_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    paired = runlog.stage_durations(Inputs(spark, sf_dir).log(), ["event_id"])
    return paired.select(
        "workflow_id", "stage", "event_id", "end_status",
        time_text("start_time"), time_text("end_time"), F.round("seconds", 6).alias("seconds"),
    )


def wf_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = runlog.failures(Inputs(spark, sf_dir).log())
    return failed.select("workflow_id", "stage", "event_id", "error_type", "error_text")


def wf_resume_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.resume_points(Inputs(spark, sf_dir).log(), ["event_id"])


def wf_rows_of_workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runlog.workflow_statuses(Inputs(spark, sf_dir).log())
    return found.select("workflow_id", "rows", joined("statuses"))


def validate_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = validate.validate_parsing(Inputs(spark, sf_dir).raw())
    return figures.withColumn("dynamic_share", F.round("dynamic_share", 6))


def validate_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = validate.validate_resolution(Inputs(spark, sf_dir).resolved())
    for c in ("avg_confidence", "min_confidence", "low_confidence_share"):
        figures = figures.withColumn(c, F.round(c, 6))
    return figures


def _graph_checks(inputs: Inputs) -> DataFrame:
    edges = inputs.edges()
    nodes = graph.lineage_nodes(edges)
    # Cycles of the whole graph, programs included.
    cycles = reach.strong_components(edges, "source_node", "target_node")
    return validate.validate_graph(nodes, edges, cycles)


def validate_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _graph_checks(Inputs(spark, sf_dir))


def overview_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    inputs.programs()
    inputs.raw()
    edges = inputs.edges()
    return report.overview_metrics(
        {
            "raw_dependencies": inputs.raw(),
            "resolved_dependencies": inputs.resolved(),
            "datasets": dependencies.unique_datasets(inputs.raw()),
            "lineage_nodes": graph.node_degrees(edges),
            "lineage_edges": edges,
            "workflow_state": inputs.log(),
        }
    )


def top_critical_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = report.top_critical_files(Inputs(spark, sf_dir).nodes())
    return top.withColumn("pagerank", F.round(F.col("pagerank").cast("double"), 9))


def domain_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    return report.domain_breakdown(enrich.classify_datasets(inputs.datasets(), inputs.load("class_rules")))


def dependency_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.dependency_analysis(Inputs(spark, sf_dir).edges())


def stage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    inputs.programs()
    checks = {
        "parsing": validate.validate_parsing(inputs.raw()),
        "resolution": validate.validate_resolution(inputs.resolved()),
        "graph": _graph_checks(inputs),
    }
    rows = report.stage_report(inputs.log(), checks, ["event_id"])
    return rows.withColumn("value", F.round("value", 4))


QUERIES: dict[str, Query] = {
    **{
        name: _extractor(name)
        for name in ("input_datasets", "output_datasets", "macro_calls", "include_files", "proc_types")
    },
    "has_dynamic_deps": has_dynamic_deps,
    "normalize_dataset_name": normalize_dataset_name,
    "raw_dependencies": raw_dependencies,
    "raw_dependencies_by_line": raw_dependencies_by_line,
    "num_files": num_files,
    "scan_code_files": scan_code_files,
    "scan_code_files_recursive": scan_code_files_recursive,
    "scan_file_list": scan_file_list,
    "scan_by_line": scan_by_line,
    "skewed_lookup": skewed_lookup,
    "table_write": table_write,
    "table_lifecycle": table_lifecycle,
    "wf_append": wf_append,
    "file_metadata": file_metadata,
    "latest_per_file": latest_per_file,
    "export_graph_json": export_graph,
    "wf_load_checkpoint": wf_load_checkpoint,
    "wf_latest_status": wf_latest_status,
    "wf_stage_duration": wf_stage_duration,
    "wf_failures": wf_failures,
    "wf_resume_point": wf_resume_point,
    "wf_rows_of_workflow": wf_rows_of_workflow,
    "macro_definitions": macro_definitions,
    "dynamic_files": dynamic_files,
    "resolved_dependencies": resolved_dependencies,
    "resolution_confidence": resolution_confidence,
    "expanded_includes": expanded_includes,
    "include_path_resolution": include_path_resolution,
    "unique_datasets": unique_datasets,
    "dataset_classifications": dataset_classifications,
    "catalog_match": catalog_match,
    "lineage_edges": lineage_edges,
    "lineage_nodes": lineage_nodes,
    "node_degree": node_degree,
    "pagerank": pagerank,
    "betweenness": betweenness,
    "detect_cycles": detect_cycles,
    "cycle_paths": cycle_paths,
    "dataset_flow": dataset_flow,
    "lineage_closure": lineage_closure,
    "reach_counts": reach_counts,
    "catalog_integration": catalog_integration,
    "validate_parsing": validate_parsing,
    "validate_resolution": validate_resolution,
    "validate_graph": validate_graph,
    "overview_metrics": overview_metrics,
    "top_critical_files": top_critical_files,
    "domain_breakdown": domain_breakdown,
    "dependency_analysis": dependency_analysis,
    "stage_report": stage_report,
}
