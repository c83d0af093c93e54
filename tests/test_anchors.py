"""Figures of the smaller corpus described in FIXTURES.md, at sf0.01."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from threadline.operators import centrality, dependencies, graph, reach, report, resolve, runlog
from threadline.plans.scratch import Scratch

SF = "/root/testdata/sf0.01"
TEXT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "FIXTURES.md")

pytestmark = pytest.mark.skipif(
    not (os.path.isdir(SF) and os.path.isfile(TEXT)), reason="needs the given tables and FIXTURES.md"
)


@pytest.fixture(scope="module")
def fixture(spark):
    with open(TEXT) as f:
        blocks = dict(re.findall(r"```sql\n-- fixture: (\w+)\n(.*?)```", f.read(), re.S))
    for t in ("orders", "nation", "events", "customer", "part"):
        spark.read.parquet(f"{SF}/{t}.parquet").createOrReplaceTempView(t)
    scratch = Scratch(spark, "anchors")
    return lambda name: scratch.save(spark.sql(blocks[name]), name)


def test_programs(spark, fixture):
    files = fixture("code_files")
    raw = Scratch(spark, "anchors").save(dependencies.raw_dependencies(files), "raw")
    assert (raw.count(), resolve.dynamic_files(raw).count()) == (3020, 422)
    outputs = F.sum(F.size("output_datasets"))
    by_line = dependencies.raw_dependencies_by_line(files)
    assert (raw.agg(outputs).first()[0], by_line.agg(outputs).first()[0]) == (9320, 6320)
    assert by_line.count() == 26098
    assert dependencies.unique_datasets(raw).count() == 149
    resolved = resolve.resolved_dependencies(files)
    assert resolved.count() == 422
    assert resolved.filter(F.col("resolution_notes").isNotNull()).count() == 144

    links = resolve.include_links(raw, files.select("file_path"))
    assert links.count() == 740
    levels = resolve.expanded_includes(files, links).groupBy("expansion_level").count().collect()
    assert dict(map(tuple, levels)) == {1: 739, 2: 441, 3: 289, 4: 137}

    edges = graph.lineage_edges(raw).filter(F.col("edge_type").isin("READS", "WRITES"))
    edges = Scratch(spark, "anchors").save(edges, "edges")
    assert (edges.count(), graph.node_degrees(edges).count()) == (15940, 3169)
    assert report.dependency_analysis(edges).count() == 149
    flow = Scratch(spark, "anchors").save(graph.dataset_flow(edges), "flow")
    assert flow.count() == 3114
    ends = ("source_dataset", "target_dataset")
    closure = reach.lineage_closure(flow)
    assert closure.count() == 6572
    assert closure.filter("ancestor = descendant").count() == 58
    cycles = reach.strong_components(flow)
    assert [r["size"] for r in reach.cycle_list(cycles).collect()] == [58]
    top = centrality.betweenness(flow, *ends).agg(F.max("betweenness_centrality")).first()[0]
    assert top == pytest.approx(474.896510, abs=1e-6)


def test_run_log(spark, fixture):
    log = fixture("run_log")
    assert dict(map(tuple, log.groupBy("status").count().collect())) == {
        "STARTED": 2858, "SUCCESS": 2858, "FAILED": 1428, "CHECKPOINT": 2856,
    }
    assert runlog.latest_checkpoints(log).count() == 737
    assert runlog.latest_status(log).count() == 750
    assert fixture("catalog_tables").count() == 90
