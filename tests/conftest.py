from __future__ import annotations

import contextlib
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="ledgerline-tests-")
    found = session.local_session(cores=4, shuffle_partitions=4, **{"spark.checkpoint.dir": shared})
    yield found
    found.stop()


@pytest.fixture
def folder(spark):
    """A fresh folder path per test."""
    return lambda name: session.workspace(spark, name)


def bag(df):
    """Rows of a DataFrame as a sorted list of tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


@contextlib.contextmanager
def small_skew_thresholds(spark):
    """Adaptive execution takes partitions of test size for skewed, and nothing for broadcastable."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.files.maxPartitionBytes": "100KB",
    }
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def executed_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
