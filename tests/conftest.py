from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("voltmart-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def views(spark):
    from voltmart.sources.testviews import TestViews

    return TestViews(spark, SMALL)


def ts(text: str) -> dt.datetime:
    """A UTC time; the container runs in UTC, so naive values stay as written."""
    return dt.datetime.fromisoformat(text)


def rows(df, *order):
    """Rows as tuples, sorted by the given columns (all when none are given)."""
    cols = order or df.columns
    out = [tuple(r) for r in df.orderBy(*cols).collect()]
    return out
