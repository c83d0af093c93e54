from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threadline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "8",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.sql.shuffle.partitions": "4",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def salted(monkeypatch):
    """Every key with two or more rows counts as hot and is spread over salts."""
    from threadline.plans import skew

    monkeypatch.setattr(skew, "MIN_ROWS", 2)
    monkeypatch.setattr(skew, "ROWS_PER_SALT", 1)
