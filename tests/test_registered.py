"""Every registered query against its SQL, on the smallest of the given tables."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as registry
from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.registered import QUERIES, Inputs

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module", autouse=True)
def shared_inputs():
    """Inputs that many queries start from are made once for the module; each query's own operator runs each time."""
    made, patch = {}, pytest.MonkeyPatch()
    for name in ("raw", "resolution", "edges", "flow", "datasets"):

        def once(self, name=name, make=getattr(Inputs, name)):
            if name not in made:
                made[name] = make(self)
            return made[name]

        patch.setattr(Inputs, name, once)
    yield
    patch.undo()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(registry.queries()[name](spark, SF), con, registry.oracle_sql()[name]) == []


def test_entry(spark):
    assert registry.entry(spark).count() > 0


def test_every_query_has_sql_without_limits():
    assert QUERIES.keys() == ORACLES.keys()
    limited = {n for n, sql in ORACLES.items() if re.search(r"\bLIMIT\b", sql)}
    assert limited == {"top_critical_files"}


def test_names_are_read_without_the_other_lists(spark):
    """A query that reads inputs and outputs once neither writes nor extracts the lists it does not read."""
    plan = Inputs(spark, SF).lists().select("input_datasets", "output_datasets")._jdf.queryExecution().optimizedPlan().toString()
    assert "(?imdu)%include" not in plan and "proc[" not in plan and "data[" in plan
