"""Extraction of random and given texts against Python's own regex engine."""

from __future__ import annotations

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from threadline.operators.dependencies import with_dependencies

# The pattern contract, in the dialect it is stated in.
NAME_LIST = r"([\w.]+(?:\s+[\w.]+)*)\s*;"
LISTS = {k: re.compile(rf"^\s*{k}\s+{NAME_LIST}", re.I | re.M) for k in ("set", "merge", "data")}
OPTIONS = {k: re.compile(rf"\b{k}\s*=\s*([\w.]+)", re.I) for k in ("out", "data")}
MACRO = re.compile(r"%(\w+)\s*\(", re.I)
INCLUDE = re.compile(r"%include\s+['\"]([^'\"]+)['\"]", re.I)
PROC = re.compile(r"^\s*proc\s+(\w+)", re.I | re.M)


def names(tokens):
    return sorted({n for n in (t.rstrip(";.").lower() for t in tokens) if n})


def expected(code):
    listed = {k: [t for m in p.finditer(code) for t in m.group(1).split()] for k, p in LISTS.items()}
    options = [m.group(1) for p in OPTIONS.values() for m in p.finditer(code)]
    return (
        names(listed["set"] + listed["merge"]),
        names(listed["data"] + options),
        sorted({m.group(1).lower() for m in MACRO.finditer(code)}),
        sorted({m.group(1) for m in INCLUDE.finditer(code)}),
        "&" in code,
        sorted({m.group(1).lower() for m in PROC.finditer(code)}),
    )


PIECES = (
    ["set", "SET", "merge", "data", "Data", "proc", "out", "%include", "%macro", "%", "&", "=", ";", ";", ";", "(", "'", '"']
    + [" ", " ", " ", "  ", "\n", "\n", "\n", "\r", "\r\n", "\t", "\x0b", "\x1c", "\x1f", "\x85", " ", " ", "　"]
    + ["a", "lib.b", "b.", ".", "..", "x_1", "Z", "é", "ſet", "ı", "İ", "K", "ª", "²", "Ⅷ"]
    + ["́", "‿", "‍", "中", "\U0001d400", "-", "/", "da", "ta", "set a;", "\ndata q r;", "proc sort"]
    # no case tables differ on these letters of the keywords
    + ["ſı", "%ınclude 'p'", "K(", "merɡe x;"]
)


def texts():
    rng = random.Random(11)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 40))) for _ in range(6000)]


def check(files):
    fields = ("input_datasets", "output_datasets", "macro_calls", "include_files", "has_dynamic_deps", "proc_types")
    for row in with_dependencies(files).collect():
        want = expected(row["code"])
        got = tuple(row[f] for f in fields)
        assert got == want, repr(row["code"])


def test_random_texts(spark):
    check(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts())], "file_path string, code string"))


@pytest.mark.parametrize("table,column", [("documents", "text"), ("pages", "html"), ("conversations", "text")])
def test_given_texts(spark, table, column):
    path = f"/root/testdata/sf0.01/{table}.parquet"
    if not os.path.exists(path):
        pytest.skip("needs the given tables")
    rows = spark.read.parquet(path).select(F.lit("x").alias("file_path"), F.col(column).alias("code"))
    check(rows.filter(F.col("code").isNotNull()))
