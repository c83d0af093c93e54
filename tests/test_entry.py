"""The entry point without the optional parts, in a process of its own."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(len(e.queries()), sorted(n for n in e.queries() if n[:2] == 'op' or n == 'pipeline'), e.queries().keys() >= e.oracle_sql().keys())"


@pytest.mark.parametrize("without", [("llm",), ("llm", "corpus_pipeline.py")])
def test_entry_without_the_optional_folder(tmp_path, without):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "spark-warehouse", *without))
    done = subprocess.run([sys.executable, "-c", LIST], cwd=copy, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    count, optional, complete = done.stdout.strip().splitlines()[-1].split(" ", 2)
    assert int(count) >= 45 and (optional, complete) == ("[]", "True")
