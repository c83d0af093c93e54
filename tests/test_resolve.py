from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from threadline.functions import programs
from threadline.functions.paths import candidate_path, collapse_dots, plain_path
from threadline.operators import dependencies, resolve
from threadline.plans.scratch import Scratch


def files_of(spark, programs):
    return spark.createDataFrame(list(programs.items()), "file_path string, code string")


def resolved(spark, code):
    return resolve.resolved_dependencies(files_of(spark, {"p.sas": code})).first()


def test_last_definition_wins_and_names_ignore_case(spark):
    files = files_of(spark, {"p.sas": "%let A = 1;\n%LET b=x y ;%let a=2;%macro Go(x); %macro stop;"})
    row = resolve.macro_definitions(files).first()
    assert row["macro_definitions"] == {"a": "2", "b": "x y"}
    assert row["macros_defined"] == ["go", "stop"]


def test_substitution(spark):
    row = resolved(spark, "%let lib=a;\n%let library=b;\nset &lib..x &Library..y;\ndata &lib.z;")
    assert row["original_inputs"] == []
    assert row["resolved_inputs"] == ["a.x", "b.y"]
    assert row["resolved_outputs"] == ["az"]
    assert (row["resolution_confidence"], row["resolution_notes"]) == (1.0, None)


def test_values_with_replacement_characters(spark):
    row = resolved(spark, "%let p=c:\\d$1;\n%include '&p';\nproc sort data=&p out=k;")
    assert "c" in row["resolved_outputs"] and row["macro_definitions"] == {"p": "c:\\d$1"}


def test_nesting_forward_reference_and_open_names(spark):
    row = resolved(spark, "%let a=&b._1;\n%let b=&c.;\n%let c=z;\nset &a &nowhere..t;\n")
    # &b, &c, &a and &nowhere: three of four are replaced.
    assert row["resolution_confidence"] == pytest.approx(0.75)
    assert row["resolution_notes"] == "unresolved: nowhere"
    row = resolved(spark, "%let a=&b._1;\n%let b=&c.;\n%let c=z;\nset &a;\n")
    assert row["resolved_inputs"] == ["z_1"]


def test_self_reference_ends(spark):
    row = resolved(spark, "%let a=&a.x;\nset &a;\n")
    assert row["resolution_confidence"] == 0.0 and row["resolution_notes"] == "unresolved: a"


def test_ampersand_without_reference(spark):
    row = resolved(spark, "if a & b; set c;\nset d;")
    assert row["resolution_confidence"] == 1.0 and row["resolved_inputs"] == ["d"]


def test_paths(spark):
    cases = [
        ("/r/a/j.sas", "b.sas", "/r/a/b.sas"),
        ("/j.sas", "b.sas", "/b.sas"),
        ("j.sas", "b\\c.sas", "b/c.sas"),
        ("/r/a/j.sas", "../x/./b.sas", "/r/x/b.sas"),
        ("/r/j.sas", "C:\\t\\b.sas", "C:/t/b.sas"),
        ("/r/j.sas", "s3://k/b.sas", "s3://k/b.sas"),
        ("a/j.sas", "../../b.sas", "../b.sas"),
    ]
    df = spark.createDataFrame(cases, "f string, i string, want string")
    for r in df.select("want", candidate_path(F.col("f"), F.col("i")).alias("got")).collect():
        assert r["got"] == r["want"]
    row = spark.range(1).select(plain_path(F.lit("file:///a/b")), collapse_dots(F.lit("a..b/c"))).first()
    assert tuple(row) == ("/a/b", "a..b/c")


PROGRAMS = {
    "/r/main.sas": "%include '/lib/a.sas'; %include 'only.sas'; %include '/none/gone.sas';",
    "/r/other.sas": "%include 'twice.sas'; %include '/lib/b.sas';",
    "/lib/a.sas": "%include 'b.sas';",
    "/lib/b.sas": "%include 'c.sas'; %include '/lib/a.sas';",
    "/lib/c.sas": "%include '/lib/c.sas';",
    "/deep/down/only.sas": "data x;",
    "/x/twice.sas": "",
    "/y/twice.sas": "",
}

EXPANDED = {
    ("/r/main.sas", "/lib/a.sas", 1),
    ("/r/main.sas", "/deep/down/only.sas", 1),
    ("/r/main.sas", None, 1),
    ("/r/main.sas", "/lib/b.sas", 2),
    ("/r/main.sas", "/lib/c.sas", 3),
    ("/r/other.sas", None, 1),
    ("/r/other.sas", "/lib/b.sas", 1),
    ("/r/other.sas", "/lib/a.sas", 2),
    ("/r/other.sas", "/lib/c.sas", 2),
    ("/lib/a.sas", "/lib/b.sas", 1),
    ("/lib/a.sas", "/lib/c.sas", 2),
    ("/lib/b.sas", "/lib/a.sas", 1),
    ("/lib/b.sas", "/lib/c.sas", 1),
}


def expand(spark, **kwargs):
    files = files_of(spark, PROGRAMS)
    links = resolve.include_links(dependencies.raw_dependencies(files), files.select("file_path"))
    return resolve.expanded_includes(files, links, **kwargs)


def test_expanded_includes(spark):
    rows = expand(spark).collect()
    assert {(r["file_path"], r["resolved_path"], r["expansion_level"]) for r in rows} == EXPANDED
    assert len(rows) == len(EXPANDED)
    for r in rows:
        assert r["include_content"] == PROGRAMS.get(r["resolved_path"])


def test_expanded_includes_salted(spark, salted):
    rows = expand(spark).collect()
    assert sorted(map(str, {(r[0], r[2], r[4]) for r in rows})) == sorted(map(str, EXPANDED))
    assert len(rows) == len(EXPANDED)


def test_expanded_includes_with_a_level_limit(spark):
    rows = expand(spark, max_level=1).collect()
    assert {(r[0], r[2], r[4]) for r in rows} == {e for e in EXPANDED if e[2] == 1}


def test_no_includes_at_all(spark):
    files = files_of(spark, {"a.sas": "set a;"})
    links = resolve.include_links(dependencies.raw_dependencies(files), files.select("file_path"))
    assert resolve.expanded_includes(files, links).count() == 0


def test_dynamic_filter_reaches_the_scan(spark, tmp_path):
    files = files_of(spark, {"a.sas": "set &a;", "b.sas": "set b;"})
    path = str(tmp_path / "raw")
    dependencies.raw_dependencies(files).write.parquet(path)
    dynamic = resolve.dynamic_files(spark.read.parquet(path)).select("file_path")
    assert [r[0] for r in dynamic.collect()] == ["a.sas"]
    plan = dynamic._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(has_dynamic_deps,true)" in plan and "input_datasets" not in plan


@pytest.mark.parametrize(
    ("code", "inputs"),
    [
        ("%let root=prod;\n%let lib=&root;\nset &lib..t;\n", ["prod.t"]),
        ("%let lib=&root;\n%let root=prod;\nset &lib..t;\n", ["prod.t"]),
        ("%let a=1;\n%let a=&a.2;\nset x&a;\n", ["x12"]),
        ("%let a=1;\n%let b=&a;\n%let a=2;\nset x&b y&a;\n", ["x1", "y2"]),
        ("%let ds1=p;\n%let ds2=q;\n%let i=2;\nset &&ds&i;\n", ["q"]),
        ("".join(f"%let v{i}=x&v{i - 1};\n" for i in range(9, 0, -1)) + "%let v0=z;\nset &v9;\n", ["xxxxxxxxxz"]),
    ],
)
def test_values_settle_in_any_order_and_depth(spark, code, inputs):
    row = resolved(spark, code)
    assert row["resolved_inputs"] == inputs
    assert (row["resolution_confidence"], row["resolution_notes"]) == (1.0, None)


def test_open_values_keep_their_dot(spark):
    row = resolved(spark, "%let lib=&root;\nset &lib..t;\n")
    assert row["resolved_inputs"] == [] and row["resolution_notes"] == "unresolved: lib, root"
    circle = "%let a=&b.&b.;\n%let b=&a.&a.;\n" + "".join(f"%let n{i}=1;\n" for i in range(40)) + "set &a;\nset c&n1;\n"
    row = resolved(spark, circle)
    assert "c1" in row["resolved_inputs"] and row["resolution_notes"] == "unresolved: a, b"


def test_settled_links_and_texts_are_written_once(spark, monkeypatch):
    """Rounds write only links of files with references in include paths, and fetch a text once."""
    chain = [(f"/inc/c{i}.sas", f'%include "/inc/c{i + 1}.sas";\n%let v{i}=/inc/x{i}.sas;\n') for i in range(5)]
    rows = [*chain, ("/inc/c5.sas", "%let deep=/inc/end.sas;\n"), ("/inc/end.sas", "data a.b;\nrun;\n")]
    rows += [("/p.sas", '%include "/inc/c0.sas";\n%include "&deep";\n'), ("/q.sas", "%include '/inc/c1.sas';\n")]
    labels, write = [], Scratch._write

    def noted(self, df, label):
        labels.append(label)
        return write(self, df, label)

    monkeypatch.setattr(Scratch, "_write", noted)
    links, _ = resolve.program_links(spark.createDataFrame(rows, "file_path string, code string"))
    found = {(r["file_path"], r["site"]): r["resolved_path"] for r in links.collect()}
    assert found["/p.sas", 1] == "/inc/end.sas" and found["/q.sas", 0] == "/inc/c1.sas" and len(found) == 8
    assert labels.count("links") == 1 and labels.count("bodies") == 2


def test_texts_without_references_are_read_alike():
    """What is read without a program's pass gives the same as the pass."""
    for code in ("", 'data a.b;\n%INCLUDE  "x.sas";\n%include\n\'y.sas\';', "%f(a)\n%include 'a%include \"b\"';", "%include%include 'z'"):
        row = programs._row({"file_path": "/p", "code": code, "included": None, "macros": None})
        p = programs.Program("/p", code, {}, {})
        assert (row["text"], row["total"], row["open"], row["sites"]) == (p.text, p.total, p.open, p.sites) and not p.entries


def test_rows_of_one_path_meet_each_other(spark):
    """Two rows of a path, each read: every text as read with every row's code, as a join of the two gives."""
    rows = [("/p.sas", "%let a=x;\ndata &a..t;\n"), ("/p.sas", "%let a=y;\ndata &a..t;\n"), ("/q.sas", "data &a;\n"), (None, "data &a;\n")]
    read = resolve.read_corpus(spark.createDataFrame(rows, "file_path string, code string")).read
    assert sorted(r["file_path"] for r in read.collect()) == ["/p.sas"] * 4 + ["/q.sas"]


def test_only_programs_that_can_change_their_include_paths_are_read_for_them(spark, monkeypatch):
    texts = {
        "a": "%include 'x.sas';\ndata &lib..q;\n%include \"y.sas\";",
        "b": "data &lib..q;\n%include '&d/x.sas';",
        "c": "%let d=p;\n%include '&d/x.sas';",
        "d": "%macro m;\n%include 'x.sas';\n%mend;",
        "e": "%include 'x.sas'; data q;",
        "f": "%load(x) &a %include",
        "g": None,
    }
    files = spark.createDataFrame(list(texts.items()), "file_path string, code string")
    given = []
    read = resolve._read
    monkeypatch.setattr(resolve, "_read", lambda files, *a, **k: given.extend(r["file_path"] for r in files.collect()) or read(files, *a, **k))
    including = files.filter("file_path in ('a', 'b', 'c', 'd', 'e')")
    found = {r["file_path"]: [(s["site"], s["include_file"], s["path"]) for s in r["sites"]] for r in resolve._first_sites(including).collect()}
    assert sorted(given) == ["b", "c", "d"]
    whole = read(including, sites_only=True).collect()
    assert found == {r["file_path"]: [(s["site"], s["include_file"], s["path"]) for s in r["sites"]] for r in whole}
    links, _ = resolve.program_links(files)
    assert {r["file_path"] for r in links.collect()} == {"a", "b", "c", "d", "e"}
