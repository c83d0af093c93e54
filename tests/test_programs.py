"""Values, includes and macros across programs."""

from __future__ import annotations

import pytest

from threadline.functions.programs import Program
from threadline.operators import resolve


def files_of(spark, programs):
    return spark.createDataFrame(list(programs.items()), "file_path string, code string").repartition(3)


def resolved(spark, programs):
    rows = resolve.resolved_dependencies(files_of(spark, programs)).collect()
    return {r["file_path"]: r for r in rows}


def test_positions():
    text = Program("p", "%let m=a;\nset lib.&m.x;\n%let m=b;\nset lib.&m.x;", {}, {}).text
    assert text == "%let m=a;\nset lib.ax;\n%let m=b;\nset lib.bx;"


ENVIRONMENT = {
    "/j/first.sas": '%include "env.sas"; proc sort data=&lib..q; run;\ndata &deep..z;\n',
    "/j/env.sas": "%let lib=prod;\n%include '/x/roots.sas';\n%let lib2=&root._2;\n%include 'more.sas';\n",
    "/x/roots.sas": "%let root=base;\n%let area=/x/area;\n",
    "/j/more.sas": "%let deep=&lib2._deep;\n",
    # Its own value above the include is overwritten, the one below counts afterwards.
    "/j/order.sas": '%let lib=mine;\nset &lib..a;\n%include "env.sas";\nset &lib..b;\n%let lib=mine2;\nset &lib..c;\n',
    # The path needs a value that another include brings.
    "/j/paths.sas": '%include "/x/roots.sas";\n%include "&area./u.sas";\nset &unit..t;\n',
    "/x/area/u.sas": "%let unit=u1;\n",
    "/y/area/u.sas": "%let unit=wrong;\n",
    "/q/a.sas": '%let root=lib; %include "&root/u.sas";',
    "/q/lib/u.sas": "data x;",
    "/j/open.sas": '%include "&nowhere./u.sas";\nset &unit..t;\n',
    "/j/only.sas": "%let root=/y;\n%include \"&root/area/u.sas\";\nset &unit..t;\n",
}


POSITIONS = {"p.sas": "%let m=a;\nset lib.&m.x;\n%let m=b;\ndata out.&m;\n"}

CIRCLE = {
    "/a.sas": "%let x=a;\n%include '/b.sas';\nset &x..t &y..t &z..t;\n",
    "/b.sas": "%let x=b;\n%let y=b;\n%include '/c.sas';\n",
    "/c.sas": "%let z=c;\n%include '/a.sas';\n%include '/c.sas';\nset &x..u;\n",
}


def test_positional_values(rows):
    assert (rows["p.sas"]["resolved_inputs"], rows["p.sas"]["resolved_outputs"]) == (["lib.ax"], ["out.b"])
    assert rows["p.sas"]["macro_definitions"] == {"m": "b"}


def test_values_from_includes(rows):
    assert rows["/j/first.sas"]["resolved_outputs"] == ["base_2_deep.z", "prod.q"]
    assert (rows["/j/first.sas"]["resolution_confidence"], rows["/j/first.sas"]["resolution_notes"]) == (1.0, None)
    assert rows["/j/order.sas"]["resolved_inputs"] == ["mine.a", "mine2.c", "prod.b"]
    assert rows["/j/paths.sas"]["resolved_inputs"] == ["u1.t"]
    assert rows["/j/only.sas"]["resolved_inputs"] == ["wrong.t"]
    assert rows["/j/open.sas"]["resolved_inputs"] == [] and rows["/j/open.sas"]["resolution_notes"] == "unresolved: nowhere, unit"
    # A part on its own does not see what the programs that include it define.
    assert rows["/j/more.sas"]["resolution_confidence"] == 0.0


def test_references_in_include_paths(corpus):
    links = corpus[1]
    assert links["/j/paths.sas", "&area./u.sas"] == "/x/area/u.sas"
    assert links["/j/only.sas", "&root/area/u.sas"] == "/y/area/u.sas"
    assert links["/j/open.sas", "&nowhere./u.sas"] is None
    # Both files are called u.sas; the value decides.
    assert links["/q/a.sas", "&root/u.sas"] == "/q/lib/u.sas"


def test_include_circles_end(rows):
    assert rows["/a.sas"]["resolved_inputs"] == ["b.t", "c.t"] and rows["/a.sas"]["resolution_confidence"] == 1.0
    assert rows["/c.sas"]["resolved_inputs"] == ["b.u"]


MACROS = {
    "/own.sas": "%macro load(lib); set &lib..x;\nset &lib..y;\n%mend;\n%load(prod);",
    "/call.sas": "%let t=glob;\n%pull(cust, out=&t._o);\n%pull(b);\n",
    "/plain.sas": "data a;\nrun;\n%pull(c);\n",
    "/lib/pull.sas": "%macro pull(src, out=dflt);\ndata &out;\nset raw.&src;\nrun;\n%inner(&src)\n%mend;\n",
    "/lib/inner.sas": "%macro inner(a); proc sort data=tmp.&a.1; run; %inner(again) %mend;",
    "/two/a.sas": "%macro twice(p);\nset a.&p;\n%mend;",
    "/two/b.sas": "%macro twice(p);\nset b.&p;\n%mend;",
    "/uses_b.sas": "%include '/two/b.sas';\n%twice(q);\n",
    "/uses_none.sas": "%let z=1;\n%twice(q);\nset k&z;\n",
    "/shadow.sas": "%let p=global;\n%include '/two/a.sas';\n%twice(arg);\nset &p;\n",
    "/own_wins.sas": "%macro solo(src);\ndata own.&src; %mend;\n%solo(w);\n",
    "/lib/solo.sas": "%macro solo(src);\ndata other.&src; %mend;\n",
}


@pytest.fixture(scope="module")
def corpus(spark):
    """Rows and links of all programs above, read as one corpus."""
    resolution = resolve.read_corpus(files_of(spark, {**ENVIRONMENT, **MACROS, **POSITIONS, **CIRCLE}))
    rows = resolve.resolved_dependencies(None, resolution=resolution).collect()
    return {r["file_path"]: r for r in rows}, {(r["file_path"], r["include_file"]): r["resolved_path"] for r in resolution.links.collect()}


@pytest.fixture
def rows(corpus):
    return corpus[0]


def test_macro_arguments(rows):
    assert rows["/own.sas"]["resolved_inputs"] == ["prod.x", "prod.y"] and rows["/own.sas"]["resolution_confidence"] == 1.0
    assert rows["/call.sas"]["resolved_inputs"] == ["raw.b", "raw.cust"]
    assert rows["/call.sas"]["resolved_outputs"] == ["dflt", "glob_o", "tmp.b1", "tmp.cust1"]
    # Without a reference of its own, but a caller of a macro with parameters.
    assert (rows["/plain.sas"]["resolved_inputs"], rows["/plain.sas"]["resolved_outputs"]) == (["raw.c"], ["a", "dflt", "tmp.c1"])
    assert rows["/uses_b.sas"]["resolved_inputs"] == ["b.q"]
    assert rows["/uses_none.sas"]["resolved_inputs"] == ["k1"]
    assert rows["/shadow.sas"]["resolved_inputs"] == ["a.arg", "global"]
    assert rows["/own_wins.sas"]["resolved_outputs"] == ["own.w"]
    assert rows["/lib/pull.sas"]["resolution_confidence"] == 1.0  # parameters are bound by calls


def test_salted(spark, salted, rows):
    again = resolved(spark, {**ENVIRONMENT, **MACROS, **POSITIONS, **CIRCLE})
    assert {k: r.asDict(recursive=True) for k, r in again.items()} == {k: r.asDict(recursive=True) for k, r in rows.items()}


def test_names_cut_short_by_open_references(spark):
    rows = resolved(spark, {"b.sas": "proc sort data=lib.&x out=fine; run;"})
    row = rows["b.sas"]
    assert (row["original_outputs"], row["resolved_outputs"], row["resolution_confidence"]) == (["fine", "lib"], ["fine"], 0.0)


def test_odd_texts(spark):
    rows = resolved(spark, {
        "n.sas": None, "e.sas": "", "m.sas": "%macro never(a; set &a;", "c.sas": "%load(&a, b(c,d), 'x,y'",
        "p.sas": "%macro f(a,b); data &a;\ndata &b;\n%mend;\n%f(x(1,2), 'q,r');\n",
    })
    assert rows.keys() == {"m.sas", "c.sas", "p.sas"}
    assert resolve.resolved_dependencies(files_of(spark, {"a.sas": "set a;"})).count() == 0
    assert resolve.resolved_dependencies(spark.createDataFrame([], "file_path string, code string")).count() == 0


@pytest.mark.parametrize("n", [3000, 9000])
def test_long_chains_take_linear_time(n):
    code = "".join(f"%let v{i}=&v{i - 1};\n" for i in range(n, 0, -1)) + f"%let v0=z;\nset &v{n};\n"
    import sys

    sys.setrecursionlimit(20_000)
    p = Program("p", code, {}, {})
    assert p.total == n + 1 and (p.text.endswith("set z;\n") if n == 3000 else p.open)


def test_values_that_double_stay_bounded():
    code = "".join(f"%let v{i}=&v{i - 1}.&v{i - 1};\n" for i in range(60, 0, -1)) + "%let v0=zz;\nset &v60;\n"
    p = Program("p", code, {}, {})
    assert p.open and len(p.text) < 500_000
