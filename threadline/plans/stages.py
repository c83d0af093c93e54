"""The five stages of a run over the declared tables.

Stages hand over by table. Each logs STARTED, then SUCCESS with a summary as
checkpoint, or FAILED with the error, so a run can go on from the first stage
without SUCCESS, or from a stage the caller names.

Runs add up: a run replaces what the tables hold of its own files and leaves the
rest. A file is taken up again only if its content is new, or if what reaches
it from other files of the run is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, functions as F

from threadline.config import STAGES, Config
from threadline.operators import centrality, dependencies, enrich, graph, reach, report, resolve, runlog, validate
from threadline.plans.scratch import Scratch
from threadline.sources.export import export_graph_json
from threadline.sources.files import file_metadata, scan_code_files, scan_file_list
from threadline.sources.tables import Tables

_RULES = "priority INT, pattern STRING, business_domain STRING, data_category STRING, sensitivity_level STRING"


@dataclass(frozen=True)
class StageResult:
    """Figures of a stage, or what stopped it."""

    figures: dict[str, Any] = field(default_factory=dict)
    failure: Exception | None = None


@dataclass(frozen=True)
class RunResult:
    """Results of the stages that ran, in order; the last may be a failure."""

    stages: dict[str, StageResult]

    @property
    def failed_stage(self) -> str | None:
        return next((s for s, r in self.stages.items() if r.failure is not None), None)


class LineageRun:
    """One run: program files in, declared tables out."""

    def __init__(
        self,
        tables: Tables,
        workflow_id: str,
        files: DataFrame,
        rules: DataFrame | None = None,
        catalog: DataFrame | None = None,
        config: Config | None = None,
        export_path: str | None = None,
    ) -> None:
        self.tables = tables
        self.workflow_id = workflow_id
        self.files = files
        self.config = config or tables.config
        self.export_path = export_path
        spark = tables.spark
        self.rules = rules if rules is not None else spark.createDataFrame([], _RULES)
        self.catalog = catalog if catalog is not None else spark.createDataFrame([], "table_name STRING")
        self.log = runlog.RunLog(
            spark,
            append=lambda df: tables.write(df, "workflow_state"),
            read=lambda: tables.read("workflow_state"),
        )

    # -- stages ---------------------------------------------------------------

    def parse(self) -> dict[str, Any]:
        """Raw dependencies of files with new content; the number of files of this run."""
        contents = self.files.select("file_path", F.sha2(F.coalesce("code", F.lit("")), 256).alias("content"))
        changed = self._not_done(contents, "PARSE", "changed")
        stamp = self._now()
        raw = dependencies.raw_dependencies(self._only(self.files, changed), self.config.parse, F.lit(stamp))
        self.tables.write(raw, "raw_dependencies")
        self.tables.mark_done(changed, "PARSE", stamp)
        return dependencies.num_files(self.files).first().asDict()

    def resolve(self) -> dict[str, Any]:
        """Resolution and includes of files for which the text, or what includes and macros bring, is new."""
        plan = resolve.plan_reading(self.files)
        changed = self._not_done(resolve.reading_contents(self.files, plan), "RESOLVE", "changed")
        stamp = self._now()
        resolution = resolve.read_corpus(self.files, plan=plan, only=changed)
        self.tables.write(
            resolve.resolved_dependencies(self.files, self.config.parse, F.lit(stamp), resolution), "resolved_dependencies"
        )
        expanded = resolve.expanded_includes(self.files, resolution.links, loaded_at=F.lit(stamp))
        self.tables.write(self._only(expanded, changed), "expanded_includes")
        self.tables.mark_done(changed, "RESOLVE", stamp)
        return validate.validate_resolution(self.tables.current("resolved_dependencies")).first().asDict()

    def enrich(self) -> dict[str, Any]:
        """Classes and catalogue matches of the datasets that this run's files name."""
        resolved = self._only(self.tables.current("resolved_dependencies"), self.files)
        raw = self._only(self.tables.current("raw_dependencies"), self.files)
        datasets = report.dependency_analysis(graph.lineage_edges(raw, resolved)).select("dataset_name")
        datasets = Scratch(self.tables.spark, "datasets").save(datasets, "datasets")
        classes = enrich.dataset_classifications(
            enrich.classify_datasets(datasets, self.rules),
            enrich.match_catalog(datasets, self.catalog, self.config.max_edits),
            F.lit(self._now()),
        )
        self.tables.write(classes, "dataset_classifications")
        return {"datasets": self.tables.current("dataset_classifications").count()}

    def build(self) -> dict[str, Any]:
        """Edges of files resolved anew; nodes, their ties to the catalogue and the export from all edges."""
        mine = self._only(self.tables.done("RESOLVE"), self.files).select("file_path", "content")
        changed = self._not_done(mine, "BUILD", "changed")
        stamp = self._now()
        raw = self._only(self.tables.current("raw_dependencies"), changed)
        resolved = self._only(self.tables.current("resolved_dependencies"), changed)
        links, _ = resolve.program_links(self.files)
        edges = graph.lineage_edges(raw, resolved, self._only(links, changed), F.lit(stamp))
        self.tables.write(edges, "lineage_edges")
        self.tables.mark_done(changed, "BUILD", stamp)
        edges = Scratch(self.tables.spark, "edges").save(self.tables.current("lineage_edges"), "edges")
        nodes = graph.lineage_nodes(
            edges,
            pagerank=centrality.pagerank(edges, tolerance=self.config.pagerank_tolerance),
            betweenness=centrality.betweenness(edges, pivots=self.config.betweenness_pivots),
            loaded_at=F.lit(stamp),
        )
        self.tables.write(nodes, "lineage_nodes", mode="overwrite")
        nodes = self.tables.read("lineage_nodes")
        if self.export_path is not None:
            export_graph_json(nodes, edges, self.export_path, mode="overwrite")
        tied = self.nodes_with_catalog().filter(F.col("unity_catalog_match").isNotNull())
        return {"nodes": nodes.count(), "edges": edges.count(), "nodes_in_catalog": tied.count()}

    def validate(self) -> dict[str, Any]:
        checks = self._checks()
        return {name: figures.first().asDict() for name, figures in checks.items()}

    # -- results over several stages -------------------------------------------

    def nodes_with_catalog(self) -> DataFrame:
        """The nodes with the catalogue tables their datasets match."""
        return graph.nodes_with_catalog(self.tables.read("lineage_nodes"), self.tables.current("dataset_classifications"))

    def report(self) -> DataFrame:
        """Status, time and checks of this run, one figure a row."""
        mine = runlog.rows_of_workflow(self.tables.read("workflow_state"), self.workflow_id)
        return report.stage_report(mine, self._checks())

    def _checks(self) -> dict[str, DataFrame]:
        edges = Scratch(self.tables.spark, "edges").save(self.tables.current("lineage_edges"), "edges")
        cycles = reach.strong_components(edges, "source_node", "target_node")
        return {
            "parsing": validate.validate_parsing(self.tables.current("raw_dependencies")),
            "resolution": validate.validate_resolution(self.tables.current("resolved_dependencies")),
            "graph": validate.validate_graph(self.tables.read("lineage_nodes"), edges, cycles),
        }

    # -- running --------------------------------------------------------------

    def run(self, resume: bool = False, start: str | None = None) -> RunResult:
        """All stages in order, from ``start`` on, or with ``resume`` from the first one without SUCCESS."""
        steps: dict[str, Callable[[], dict[str, Any]]] = dict(
            zip(STAGES, (self.parse, self.resolve, self.enrich, self.build, self.validate))
        )
        if start is not None and start not in steps:
            raise ValueError(f"unknown stage {start!r}")
        first = start or STAGES[0]
        if resume and start is None:
            mine = runlog.rows_of_workflow(self.tables.read("workflow_state"), self.workflow_id)
            point = runlog.resume_points(mine).first()
            if point is not None and point["resume_stage"] is None:
                return RunResult({})
            first = point["resume_stage"] if point is not None else first
        elif not resume:
            self.log.create_workflow(self.workflow_id)
        results: dict[str, StageResult] = {}
        for stage in STAGES[STAGES.index(first) :]:
            results[stage] = self.run_stage(stage, steps[stage])
            if results[stage].failure is not None:
                break
        return RunResult(results)

    def run_stage(self, stage: str, step: Callable[[], dict[str, Any]]) -> StageResult:
        self.log.log_execution(self.workflow_id, stage, "STARTED")
        try:
            figures = step()
        except Exception as e:  # logged; the caller gets it with the result
            self.log.log_execution(self.workflow_id, stage, "FAILED", f"{type(e).__name__}: {e}")
            return StageResult(failure=e)
        self.log.log_execution(self.workflow_id, stage, "SUCCESS", extra_info=figures)
        return StageResult(figures)

    # -- which files ------------------------------------------------------------

    def _now(self) -> Any:
        return self.tables.spark.sql("SELECT current_timestamp() AS t").first()["t"]

    def _not_done(self, contents: DataFrame, stage: str, label: str) -> DataFrame:
        """(file_path, content) that the stage has not written rows for last, written down."""
        done = self.tables.done(stage).select("file_path", "content")
        fresh = contents.join(done, ["file_path", "content"], "left_anti").distinct()
        return Scratch(self.tables.spark, stage.lower()).save(fresh, label)

    @staticmethod
    def _only(df: DataFrame, files: DataFrame) -> DataFrame:
        return df.join(files.select("file_path"), "file_path", "left_semi")


def parse_repository(tables: Tables, path: str) -> dict[str, Any]:
    """Scan a folder and append its raw dependencies."""
    return _parse(tables, scan_code_files(tables.spark, path, tables.config.parse))


def parse_files(tables: Tables, paths: list[str]) -> dict[str, Any]:
    """Append the raw dependencies of an explicit list of files."""
    if not paths:
        return {"num_files": 0}
    return _parse(tables, scan_file_list(tables.spark, paths, tables.config.parse))


def _parse(tables: Tables, files: DataFrame) -> dict[str, Any]:
    # The load time tells this run's rows in the table, so they are counted
    # there and the files are read once.
    loaded_at = files.sparkSession.sql("SELECT current_timestamp() AS t").first()["t"]
    raw = dependencies.raw_dependencies(files, tables.config.parse, F.lit(loaded_at))
    tables.write(raw, "raw_dependencies")
    mine = tables.read("raw_dependencies").filter(F.col("created_at") == F.lit(loaded_at))
    return dependencies.num_files(mine).first().asDict()


def load_file_metadata(tables: Tables, path: str) -> None:
    tables.write(file_metadata(tables.spark, path, tables.config.parse), "file_metadata")
