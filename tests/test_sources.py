from __future__ import annotations

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from threadline.config import TABLES, Config, Location, ParseOptions, table_schema
from threadline.operators import dependencies, graph, runlog
from threadline.plans import scratch, stages
from threadline.sources import export, files
from threadline.sources.tables import Tables, raise_first
from threadline.streaming.parse_stream import append_new_files


@pytest.fixture
def programs(tmp_path):
    root = tmp_path / "code"
    (root / "sub").mkdir(parents=True)
    (root / "a.sas").write_text("data a\n b;\nset c;\n")
    (root / "B.SAS").write_text("set d;")
    (root / "notes.txt").write_text("set no;")
    (root / "empty.sas").write_text("")
    (root / "sub" / "s.sas").write_text("%include '../a.sas';\nset &e;")
    return root


@pytest.fixture
def tables(spark, request):
    location = Location(catalog_name=None, schema_name=f"t_{abs(hash(request.node.name))}")
    t = Tables(spark, Config(location=location))
    t.create_schema()
    yield t
    t.drop_all()


def names(df):
    return sorted(r["file_name"] for r in df.collect())


def test_scan(spark, programs):
    flat = files.scan_code_files(spark, str(programs))
    assert names(flat) == ["B.SAS", "a.sas"]
    deep = files.scan_code_files(spark, str(programs), ParseOptions(recursive=True))
    assert names(deep) == ["B.SAS", "a.sas", "s.sas"]
    assert deep.filter("file_name = 's.sas'").first()["file_path"].endswith("/code/sub/s.sas")
    row = dependencies.raw_dependencies(flat).filter("file_name = 'a.sas'").collect()
    assert len(row) == 1 and row[0]["output_datasets"] == ["a", "b"]
    lines = files.scan_code_files(spark, str(programs), wholetext=False)
    assert lines.count() == 4


def test_scan_missing_and_empty(spark, programs, tmp_path):
    with pytest.raises(AnalysisException):
        files.scan_code_files(spark, str(tmp_path / "missing"))
    (tmp_path / "none").mkdir()
    assert files.scan_code_files(spark, str(tmp_path / "none")).count() == 0


def test_scan_list(spark, programs):
    listed = files.scan_file_list(spark, [str(programs / "a.sas"), str(programs / "sub" / "s.sas")])
    assert names(listed) == ["a.sas", "s.sas"]
    assert files.scan_file_list(spark, []).count() == 0


def test_size_limit_leaves_nothing_unnamed(spark, programs):
    limit = ParseOptions(max_file_bytes=10)
    assert names(files.scan_code_files(spark, str(programs), limit)) == ["B.SAS"]
    left_out = files.oversized_files(spark, str(programs), limit).collect()
    assert [(r[0].rsplit("/", 1)[1], r[1]) for r in left_out] == [("a.sas", 18)]


def test_file_metadata(spark, programs):
    rows = {r["file_name"]: r for r in files.file_metadata(spark, str(programs)).collect()}
    assert (rows["a.sas"]["file_size_bytes"], rows["a.sas"]["line_count"]) == (18, 3)
    assert rows["B.SAS"]["line_count"] == 1 and rows["a.sas"]["last_modified"] is not None


def test_locations():
    assert Location().full_schema == "demo.lineage_data"
    other = Location("c", "s")
    assert (other.full_schema, other.table("x")) == ("c.s", "c.s.x")
    assert Location(None, "s").table("x") == "s.x"


def test_tables(spark, tables):
    assert not tables.exists("raw_dependencies")
    assert [(a.table, a.error) for a in tables.create_all()] == [(t, None) for t in TABLES]
    for name in TABLES:
        assert [(f.name, f.dataType) for f in tables.read(name).schema] == [
            (f.name, f.dataType) for f in table_schema(name)
        ]
    with pytest.raises(ValueError):
        tables.create("unknown")
    with pytest.raises(ValueError):
        tables.write(spark.range(1), "unknown")
    assert all(a.error is None for a in tables.drop_all())
    assert not tables.exists("lineage_nodes")


def test_one_failing_table_does_not_keep_the_others(spark, tables):
    def action(table):
        if table == "lineage_edges":
            raise OSError("no room")
        tables.create(table)

    attempts = tables.for_all(action)
    assert [a.table for a in attempts if a.error is not None] == ["lineage_edges"]
    assert tables.exists("workflow_state") and not tables.exists("lineage_edges")
    with pytest.raises(OSError):
        raise_first(attempts)


def test_write_appends_declared_columns(spark, tables):
    code = spark.createDataFrame([("x.sas", "set a;")], "file_path string, code string")
    raw = dependencies.raw_dependencies(code).withColumn("extra", F.lit(1))
    tables.write(raw, "raw_dependencies")
    tables.write(raw, "raw_dependencies")
    assert tables.read("raw_dependencies").count() == 2
    assert tables.read("raw_dependencies").columns == table_schema("raw_dependencies").names
    tables.write(raw, "raw_dependencies", mode="overwrite")
    assert tables.read("raw_dependencies").count() == 1
    with pytest.raises(AnalysisException):
        tables.write(spark.range(1), "raw_dependencies")


def test_parse_entry_points(spark, tables, programs):
    assert stages.parse_repository(tables, str(programs)) == {"num_files": 2}
    assert stages.parse_files(tables, [str(programs / "a.sas")]) == {"num_files": 1}
    assert stages.parse_files(tables, []) == {"num_files": 0}
    raw = tables.read("raw_dependencies")
    assert raw.count() == 3 and dependencies.latest_per_file(raw).count() == 2
    stages.load_file_metadata(tables, str(programs))
    assert tables.read("file_metadata").count() == 2


def test_stream_appends_each_file_once(spark, tables, programs, tmp_path):
    for extra in (None, "new.sas"):
        if extra:
            (programs / extra).write_text("data n;")
        append_new_files(tables, str(programs), str(tmp_path / "cp")).awaitTermination()
    rows = tables.read("raw_dependencies").filter("size(input_datasets) + size(output_datasets) > 0").collect()
    assert sorted(r["file_name"] for r in rows) == ["B.SAS", "a.sas", "new.sas"]


def test_whole_run_and_resume(spark, tables, programs, tmp_path):
    tables.setup_all()
    config = Config(location=tables.location, parse=ParseOptions(recursive=True))
    code = files.scan_code_files(spark, str(programs), config.parse)
    catalog = spark.createDataFrame([("c",)], "table_name string")
    run = stages.LineageRun(tables, "w1", code, catalog=catalog, config=config)
    broken = run.enrich

    def fail():
        raise RuntimeError("no rules")

    run.enrich = fail
    first = run.run()
    assert first.failed_stage == "ENRICH" and str(first.stages["ENRICH"].failure) == "no rules"
    log = tables.read("workflow_state")
    assert runlog.resume_points(runlog.rows_of_workflow(log, "w1").filter("stage <> 'INIT'")).first()[1] == "ENRICH"
    assert runlog.failures(log).first()["error_type"] == "RuntimeError"
    run.enrich = broken
    run.export_path = str(tmp_path / "export")
    second = run.run(resume=True)
    assert second.failed_stage is None and list(second.stages) == ["ENRICH", "BUILD", "VALIDATE"]
    assert run.run(resume=True).stages == {}
    assert run.log.load_checkpoint("w1", "PARSE") == {"num_files": 3}
    assert tables.current("expanded_includes").first()["include_content"] == "data a\n b;\nset c;\n"
    match = tables.current("dataset_classifications").filter("unity_catalog_match = 'c'").first()
    assert match["dataset_name"] == "c" and match["match_confidence"] == 1.0
    checks = second.stages["VALIDATE"].figures
    assert checks["graph"]["dangling_ends"] == 0 and checks["parsing"]["distinct_files"] == 3
    assert second.stages["BUILD"].figures["nodes_in_catalog"] == 1
    exported = spark.read.json(f"{tmp_path}/export/edges")
    assert exported.count() == second.stages["BUILD"].figures["edges"] == tables.current("lineage_edges").count()
    report = {(r["section"], r["item"], r["measure"]) for r in run.report().collect()}
    assert ("check", "graph", "edges") in report and ("status", "BUILD", "SUCCESS") in report
    nodes = tables.read("lineage_nodes")
    assert nodes.agg(F.sum("pagerank")).first()[0] == pytest.approx(1.0, abs=1e-5)


def test_export(spark, tmp_path):
    nodes = spark.createDataFrame([("file:a", 1)], "node_id string, in_degree int")
    edges = spark.createDataFrame([("file:a", "dataset:b")], "source_node string, target_node string")
    export.export_graph_json(nodes, edges, str(tmp_path / "g"))
    parts = [p.read_text() for p in (tmp_path / "g" / "edges").glob("*.json")]
    assert json.loads("".join(parts)) == {"source_node": "file:a", "target_node": "dataset:b"}


def test_scratch_uses_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    saved, rows = scratch.Scratch(spark, "t").save_counted(spark.range(5), "five", F.col("id") > 1)
    assert rows == 3 and saved.count() == 5
    assert all(f"{folder}/t-" in f for f in saved.inputFiles())


def test_paths_are_as_on_disk(spark, tmp_path):
    folder = tmp_path / "my lib"
    folder.mkdir()
    (folder / "b c+d%20.sas").write_text("data a;\nrun;\n")
    from threadline.sources.files import scan_code_files

    row = scan_code_files(spark, str(folder)).first()
    assert row["file_name"] == "b c+d%20.sas" and row["file_path"].endswith("/my lib/b c+d%20.sas")


def test_resolution_of_an_empty_table_is_validated(spark):
    from threadline.operators.validate import validate_resolution

    none = spark.createDataFrame([], "resolution_confidence double, resolution_notes string")
    row = validate_resolution(none).first()
    assert row["total_rows"] == 0 and row["low_confidence_share"] == 0


def edges_of(tables):
    return {(r["source_node"], r["target_node"]) for r in tables.current("lineage_edges").collect()}


def test_runs_add_up(spark, tables):
    """A second run keeps the first one's lineage; only what is new is taken up."""
    tables.setup_all()

    def run(name, programs, **how):
        files = spark.createDataFrame(list(programs.items()), "file_path string, code string")
        result = stages.LineageRun(tables, name, files).run(**how)
        assert result.failed_stage is None, result.stages[result.failed_stage].failure
        return result.stages

    done = run("w1", {"a.sas": "data one;\nset two;\n", "i.sas": "%let lib=old;"})
    assert done["PARSE"].figures == {"num_files": 2}
    done = run("w2", {"b.sas": "data three;\nset one;\nset &lib..t;\n%include 'i.sas';", "i.sas": "%let lib=old;"})
    assert done["PARSE"].figures == {"num_files": 2}
    first = {("dataset:two", "file:a.sas"), ("file:a.sas", "dataset:one")}
    second = {("dataset:one", "file:b.sas"), ("file:b.sas", "dataset:three"), ("file:i.sas", "file:b.sas")}
    assert edges_of(tables) == first | second | {("dataset:old.t", "file:b.sas")}
    # i.sas was parsed once, and its rows are not written again.
    assert tables.read("raw_dependencies").filter("file_path = 'i.sas'").count() == 1
    written = tables.read("lineage_edges").count()
    run("w3", {"a.sas": "data one;\nset two;\n"})
    assert tables.read("lineage_edges").count() == written
    # The include changes: b.sas is resolved anew although its text is the same.
    run("w4", {"b.sas": "data three;\nset one;\nset &lib..t;\n%include 'i.sas';", "i.sas": "%let lib=new;"})
    assert edges_of(tables) == first | second | {("dataset:new.t", "file:b.sas")}
    # A program that names nothing any more has no edges.
    run("w5", {"a.sas": "run;"})
    assert edges_of(tables) == second | {("dataset:new.t", "file:b.sas")}
    nodes = {r["node_id"] for r in tables.read("lineage_nodes").collect()}
    assert "dataset:three" in nodes and "dataset:two" not in nodes
    names = {r["dataset_name"] for r in tables.current("dataset_classifications").collect()}
    assert {"one", "two", "three", "old.t", "new.t"} == names
    tables.compact()
    assert tables.read("lineage_edges").count() == 4 and edges_of(tables) == second | {("dataset:new.t", "file:b.sas")}
    assert list(run("w6", {"a.sas": "run;"}, start="BUILD")) == ["BUILD", "VALIDATE"]
    with pytest.raises(ValueError):
        run("w7", {"a.sas": "run;"}, start="NOWHERE")


def test_programs_are_laid_out_as_by_the_writer_of_texts(spark, tmp_path):
    """One file a row in the folder's place, whatever the folder's name, without the writer of tables."""
    from checks import registered

    rows = [("repo_d1", "data a;\n"), ("repo_d1", "data a;\n"), ("repo_d1", ""), ("a=b:c%d", "x"), ("", "e"), (None, "n"), ("repo_d2", None), ("repo_d2", "é\r\n")]
    frame = spark.createDataFrame(rows, "folder string, code string").repartition(2, "folder")
    frame.write.option("maxRecordsPerFile", 1).partitionBy("folder").text(str(tmp_path / "theirs"))
    registered._write_local(frame, str(tmp_path / "ours"))

    def laid_out(name):
        return sorted((f.parent.name, f.read_bytes()) for f in (tmp_path / name).rglob("part-*") if f.is_file())

    assert laid_out("ours") == laid_out("theirs") and len(laid_out("ours")) == len(rows)


def small_corpus(path, orders):
    """The tables behind the program corpus, with ``orders`` orders and one nation and region."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    keys = range(orders)
    pq.write_table(pa.table({"o_orderkey": pa.array(keys, pa.int64()), "o_custkey": pa.array([k * 7 % 29 for k in keys], pa.int64()), "o_orderpriority": [f"{k % 5}-X" for k in keys]}), path / "orders.parquet")
    pq.write_table(pa.table({"n_nationkey": pa.array([3], pa.int64())}), path / "nation.parquet")
    pq.write_table(pa.table({"r_regionkey": pa.array([0], pa.int64())}), path / "region.parquet")
    return str(path)


@pytest.mark.parametrize("name", ["scan_code_files", "scan_code_files_recursive", "scan_by_line", "scan_file_list"])
def test_scans_keep_a_part_of_the_files_on_the_disk(spark, tmp_path, monkeypatch, name):
    from checks import registered

    sf_dir, on_disk = small_corpus(tmp_path, 120), []
    rows = lambda: sorted(map(tuple, registered.QUERIES[name](spark, sf_dir).collect()), key=str)
    whole = rows()
    scanned = registered._scanned

    def seen(df):
        on_disk.append(len(set(df.inputFiles())))
        return scanned(df)

    monkeypatch.setattr(registered, "_scanned", seen)
    monkeypatch.setattr(registered, "_FILES", 30)
    assert rows() == whole and len(whole) >= 126
    assert len(on_disk) == 5 and sum(on_disk) == 126 and max(on_disk) < 60


def test_small_files_share_tasks(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"f{i:03}.sas").write_text(f"set d{i};\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # the cost of opening a file: one to a task
    try:
        for wholetext in (True, False):
            scan = files.scan_code_files(spark, str(tmp_path), wholetext=wholetext)
            assert scan.rdd.getNumPartitions() <= 8 * files._WAVES
            assert {r["code"].strip() for r in scan.collect()} == {f"set d{i};" for i in range(300)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_whole_texts_are_those_of_the_text_reader(spark, tmp_path):
    import gzip

    (tmp_path / "latin.sas").write_bytes("sét é;\r\n".encode("latin-1"))
    (tmp_path / "bom.sas").write_bytes(b"\xef\xbb\xbfset a;\n")
    (tmp_path / "packed.sas.gz").write_bytes(gzip.compress(b"set packed;\n"))
    (tmp_path / "empty.sas").write_bytes(b"")
    text = F.md5(F.col("value")).alias("text")
    for pattern in ("*.[sS][aA][sS]", "*", "*.sas.gz", "{latin,packed}*", "latin.sas"):
        theirs = spark.read.option("pathGlobFilter", pattern).text(str(tmp_path), wholetext=True).select(text)
        ours = files.scan_code_files(spark, str(tmp_path), ParseOptions(file_pattern=pattern)).select(F.md5("code"))
        assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))
    for paths in (["latin.sas", "bom.sas"], ["latin.sas", "packed.sas.gz"], ["*.sas*"], ["latin.sas", "latin.sas"]):
        paths = [str(tmp_path / p) for p in paths]
        theirs = spark.read.text(paths, wholetext=True).select(text)
        ours = files.scan_file_list(spark, paths).select(F.md5("code"))
        assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))
    assert not files._may_end_with("*.[sS][aA][sS]", ".gz") and files._may_end_with("*.[^a]z", ".gz")


def test_exported_graph_is_packed_and_alone_on_the_disk(spark, tmp_path, monkeypatch):
    from checks import registered

    sf_dir, left = small_corpus(tmp_path, 60), []
    export_graph_json = registered.export_graph_json

    def exported(nodes, edges, path, **options):
        export_graph_json(nodes, edges, path, **options)
        root = path.removeprefix("file:").rsplit("/", 1)[0]
        left.extend(sorted(os.listdir(root)))
        left.extend(name for kind in ("nodes", "edges") for name in os.listdir(f"{path}/{kind}") if name.endswith(".json"))

    monkeypatch.setattr(registered, "export_graph_json", exported)
    rows = sorted(map(str, registered.export_graph(spark, sf_dir).collect()))
    tables, (last,) = [n for n in left if n != "export"], [n for n in left if n == "export"]
    assert last == "export" and len(tables) == 1 and tables[0].endswith("-edges")
    inputs = registered.Inputs(spark, sf_dir)
    edges = inputs.edges()
    assert len(rows) == edges.count() + graph.lineage_nodes(edges).count()


def test_export_is_plain_unless_asked(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1), (None, None)], "x string, y int")
    export.export_graph_json(frame, frame, str(tmp_path / "plain"))
    export.export_graph_json(frame, frame, str(tmp_path / "packed"), compression="gzip")
    assert [*(tmp_path / "plain" / "edges").glob("*.json")] and [*(tmp_path / "packed" / "edges").glob("*.json.gz")]
    for kind in ("plain", "packed"):
        assert sorted(map(str, spark.read.schema(frame.schema).json(f"{tmp_path}/{kind}/nodes").collect())) == sorted(map(str, frame.collect()))
