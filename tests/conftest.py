from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradelake.session import build_session, run_dir  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
           "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark, request):
    """A folder of its own for each test."""
    return run_dir(spark, "test")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
