"""A session for all tests."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from landrank.session import build, ship

    folder = tempfile.mkdtemp(prefix="spark-")
    s = build("tests", **{"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
                          "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": f"file://{folder}", "spark.sql.warehouse.dir": f"{folder}/warehouse"})
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    return s
