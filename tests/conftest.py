"""One local session for all tests."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

DATA = Path(os.environ.get("TEST_DATA", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    if not DATA.exists():
        pytest.skip("no test data here")
    return str(DATA)


def rows(df) -> set[tuple]:
    """Rows of a small result as a set of tuples."""
    return {tuple(r) for r in df.collect()}


def listed(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)
