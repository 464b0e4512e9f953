"""One local session for all tests."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

HERE = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (HERE, os.environ.get("PYTHONPATH")) if x)  # for the workers


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gneiss.session import session

    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows(spark):
    """Rows of a frame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
