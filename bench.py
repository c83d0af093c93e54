"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from checks.registered import QUERIES
from threadline.session import local_session

HEADLINE = (
    "raw_dependencies",
    "raw_dependencies_by_line",
    "latest_per_file",
    "resolved_dependencies",
    "include_path_resolution",
    "expanded_includes",
    "unique_datasets",
    "dataset_classifications",
    "catalog_match",
    "lineage_edges",
    "lineage_nodes",
    "node_degree",
    "dataset_flow",
    "pagerank",
    "betweenness",
    "detect_cycles",
    "cycle_paths",
    "lineage_closure",
    "reach_counts",
    "catalog_integration",
    "overview_metrics",
    "validate_parsing",
    "validate_graph",
    "dependency_analysis",
    "wf_load_checkpoint",
    "wf_latest_status",
    "wf_stage_duration",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # One small query first, so that session start is not counted as a query.
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    files = QUERIES["num_files"](spark, sf_dir).first()["num_files"]
    line = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "files": files,
        "files_per_sec_extraction": round(files / times["raw_dependencies"], 1) if "raw_dependencies" in times else None,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
