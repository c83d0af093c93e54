from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from threadline.config import ParseOptions
from threadline.functions import extract
from threadline.operators import dependencies

FIELDS = ["input_datasets", "output_datasets", "macro_calls", "include_files", "has_dynamic_deps", "proc_types"]


def parse(spark, codes, options=ParseOptions()):
    rows = [(f"f{i}.sas", c) for i, c in enumerate(codes)]
    files = spark.createDataFrame(rows, "file_path string, code string")
    parsed = dependencies.with_dependencies(files, options).collect()
    return [r.asDict() for r in sorted(parsed, key=lambda r: int(r["file_path"][1:-4]))]


# (code, inputs, outputs, macro calls, includes, dynamic, procs)
CASES = [
    ("set a(where=(x=1));", [], [], [], [], False, []),
    ("merge a(in=ia) b;", [], [], [], [], False, []),
    ("set a end=e;", [], [], [], [], False, []),
    ("data a / view=a;", [], [], [], [], False, []),
    ("set &lib..x;", [], [], [], [], True, []),
    ("data o; set i; run;", [], ["o"], [], [], False, []),
    ("proc print data=p; run;", [], ["p"], [], [], False, ["print"]),
    ("data _null_;", [], ["_null_"], [], [], False, []),
    ("proc sort data=lib.&x;", [], ["lib"], [], [], True, ["sort"]),
    ("create table t as select * from s;", [], [], [], [], False, []),
    ("/*\nset c;\n*/", ["c"], [], [], [], False, []),
    ("%if (&a) %then %do;", [], [], ["if"], [], True, []),
    ("%macro m(x); %m(1) %go;", [], [], ["m"], [], False, []),
    ("%include fileref;", [], [], [], [], False, []),
    ("", [], [], [], [], False, []),
    (None, [], [], [], [], False, []),
    # keyword case, several lines, trailing dots, repeats
    ("DATA Stg.A\n  WORK.b. ;\nSeT x X y.z;", ["x", "y.z"], ["stg.a", "work.b"], [], [], False, []),
    # a keyword inside the other's list is a name there
    ("set a\nmerge b;", ["a", "b", "merge"], [], [], [], False, []),
    ("set\nmerge b;", ["b", "merge"], [], [], [], False, []),
    # option names count on a word boundary only
    ("xout=a out = b; layout=c;", [], ["b"], [], [], False, []),
    ("out=data=x", [], ["data", "x"], [], [], False, []),
    # only \n starts a line
    ("x\rset a;", [], [], [], [], False, []),
    ("x\r\n set a;", ["a"], [], [], [], False, []),
    # Unicode words, spaces and folding
    ("\u017fet \u00e9.b\u00a0c;", ["c", "\u00e9.b"], [], [], [], False, []),
    ("set a\x1cb;", ["a", "b"], [], [], [], False, []),
    # a combining mark is not a word character
    ("set a\u0301;", [], [], [], [], False, []),
    ("%include \"/A/b.sas\"; %INCLUDE 'c d.sas\";", [], [], [], ["/A/b.sas", "c d.sas"], False, []),
    ("proc sql; proc means;\n\n  Proc SORT;", [], [], [], [], False, ["sort", "sql"]),
    ("a & b && c", [], [], [], [], True, []),
]


def test_edge_cases(spark):
    found = parse(spark, [c[0] for c in CASES])
    for case, row in zip(CASES, found):
        assert [row[f] for f in FIELDS] == list(case[1:]), case[0]


def test_program(spark):
    code = """
    %macro unit(p);
      %put &=p;
    %mend;

    %unit(7);

    data work.result;
      set work.first work.second;
    run;

    proc sort data=work.result out=work.ordered;
      by id;
    run;

    %include "/shared/setup.sas";
    %include 'more/steps.sas';
    """
    (row,) = parse(spark, [code])
    assert row["input_datasets"] == ["work.first", "work.second"]
    assert row["output_datasets"] == ["work.ordered", "work.result"]
    assert row["macro_calls"] == ["unit"]
    assert row["include_files"] == ["/shared/setup.sas", "more/steps.sas"]
    assert row["proc_types"] == ["sort"]
    assert row["has_dynamic_deps"] is True


def test_long_statements_and_long_gaps(spark):
    names = [f"lib.t{i}" for i in range(30_000)]
    unfinished = "set " + " ".join(names)
    gap = "\n" * 200_000 + "set z;"
    found = parse(spark, [unfinished + ";", unfinished, gap])
    assert found[0]["input_datasets"] == sorted(names)
    assert found[1]["input_datasets"] == []
    assert found[2]["input_datasets"] == ["z"]


def test_data_option_as_input(spark):
    (row,) = parse(spark, ["proc sort data=a out=b;"], ParseOptions(proc_data_as="input"))
    assert (row["input_datasets"], row["output_datasets"]) == (["a"], ["b"])
    with pytest.raises(ValueError):
        parse(spark, ["x"], ParseOptions(proc_data_as="both"))


def test_language_words(spark):
    (row,) = parse(spark, ["%if(1) %eval(2) %load(3)"], ParseOptions(skip_language_words=True))
    assert row["macro_calls"] == ["load"]


def test_normalize_dataset_name(spark):
    names = [(" A.b;. ", "a.b"), ("x;.;", "x"), (None, ""), ("", ""), ("\u00a0Q\x1c", "q"), ("..", "")]
    df = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(names)], "i int, n string")
    found = df.select("i", extract.normalize_dataset_name(F.col("n")).alias("r")).collect()
    assert [r["r"] for r in sorted(found)] == [want for _, want in names]


def test_by_line(spark):
    files = spark.createDataFrame([("a.sas", "data a\n b;\r\nset c;\rset d;\n")], "file_path string, code string")
    rows = sorted(dependencies.raw_dependencies_by_line(files).collect(), key=lambda r: r["line_no"])
    assert len(rows) == 4
    assert [r["input_datasets"] for r in rows] == [[], [], ["c"], ["d"]]
    assert all(r["output_datasets"] == [] for r in rows)


def test_plan_has_no_python_and_no_shuffle(spark):
    files = spark.createDataFrame([("a.sas", "set a;")], "file_path string, code string")
    plan = dependencies.raw_dependencies(files)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_parsing_is_idempotent_and_latest_wins(spark):
    files = spark.createDataFrame([("a.sas", "set a;"), ("b.sas", "data b;")], "file_path string, code string")
    first = dependencies.raw_dependencies(files, loaded_at=F.lit("2024-01-01"))
    again = dependencies.raw_dependencies(files, loaded_at=F.lit("2024-01-02"))
    latest = dependencies.latest_per_file(first.unionByName(again).unionByName(again))
    assert sorted(map(str, latest.collect())) == sorted(map(str, again.collect()))
    assert dependencies.num_files(first.unionByName(again)).first()["num_files"] == 2
    assert sorted(r[0] for r in dependencies.unique_datasets(first).collect()) == ["a", "b"]


def test_option_keywords_are_looked_up_before_what_precedes_them():
    """A pattern that begins with a look-behind is tried at every character of a text."""
    for pattern in (extract.OUT_OPTION, extract.DATA_OPTION):
        assert not pattern.removeprefix(extract.FLAGS).startswith("(?<")
