from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import bag
from ledgerline.operators.records import fresh_across_snapshots, fresh_records, repeat_rows, state_after
from ledgerline.schemas import FILING_COLUMNS

SCHEMA = "a string, b int"
COLUMNS = ("a", "b")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_nulls_and_duplicates(spark):
    old = frame(spark, [("a", None), ("b", 1)])
    new = frame(spark, [("a", None), ("c", 2), ("c", 2), ("b", None)])
    expected = sorted([("c", 2), ("c", 2), ("b", None)], key=repr)
    assert bag(fresh_records(new, old, COLUMNS)) == expected
    # The set operators at hand answer other questions.
    assert bag(new.subtract(old)) != expected
    assert bag(new.join(old, ["a", "b"], "left_anti")) != expected
    assert bag(frame(spark, [("b", 1), ("b", 1)]).exceptAll(old)) != bag(
        fresh_records(frame(spark, [("b", 1), ("b", 1)]), old, COLUMNS))


records = st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from([1, 2, None])), max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(new=records, old=records)
def test_like_a_nested_loop(spark, new, old):
    new_df, old_df = frame(spark, new), frame(spark, old)
    fresh = fresh_records(new_df, old_df, COLUMNS)
    expected = [row for row in new if row not in old]
    assert Counter(map(tuple, fresh.collect())) == Counter(expected)
    after = state_after(old_df, fresh, COLUMNS)
    assert Counter(map(tuple, after.collect())) == Counter(old) + Counter(expected)
    assert fresh_records(new_df, new_df, COLUMNS).count() == 0


def poll_loop(polls):
    """What comparing one poll after the other finds: rows with the poll they were found in."""
    seen, found = [], []
    for name, rows in polls:
        fresh = [row for row in rows if row not in seen]
        found += [(*row, name) for row in fresh]
        seen += fresh
    return Counter(found)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=records, second=records, third=records, cut=st.integers(0, 3))
def test_snapshots_like_polls(spark, first, second, third, cut):
    """Any number of polls per batch gives what one poll per batch gives."""
    polls = list(zip(["s1", "s2", "s3"], [first, second, third]))
    schema = SCHEMA + ", snapshot_id string"

    def batch(part):
        return spark.createDataFrame([(*row, name) for name, rows in part for row in rows], schema)

    seen = fresh_across_snapshots(batch(polls[:cut]), batch([]), COLUMNS)
    later = fresh_across_snapshots(batch(polls[cut:]), seen, COLUMNS)
    assert Counter(map(tuple, seen.unionByName(later).collect())) == poll_loop(polls)


def test_overlapping_snapshots(spark):
    rows = [("a", 0, "1"), ("b", 1, "1"), ("b", 1, "1"), ("a", 0, "2"), ("b", 1, "2"), ("c", 2, "2")]
    new = spark.createDataFrame(rows, SCHEMA + ", snapshot_id string")
    found = fresh_across_snapshots(new, new.limit(0), COLUMNS)
    assert bag(found) == [("a", 0, "1"), ("b", 1, "1"), ("b", 1, "1"), ("c", 2, "2")]


def test_snapshot_spread_over_two_batches(spark):
    schema = SCHEMA + ", snapshot_id string"
    first = spark.createDataFrame([("a", 0, "1"), ("b", 1, "1")], schema)
    rest = spark.createDataFrame([("a", 0, "1"), ("c", 2, "1"), ("a", 0, "2")], schema)
    assert bag(fresh_across_snapshots(rest, first, COLUMNS)) == [("a", 0, "1"), ("c", 2, "1")]


@pytest.mark.parametrize("copies", [1, 9, 10, 11, 20, 101])
def test_repeat_rows(spark, copies):
    df = spark.createDataFrame([("x", copies), ("y", 1)], "a string, copies long")
    assert Counter(row[0] for row in repeat_rows(df, run=10).collect()) == Counter(x=copies, y=1)


def test_a_hot_record_is_spread(spark):
    """A record that is most of the input leaves the comparison in many partitions, whole."""
    new = spark.range(300_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("a"),
        F.lit(1).alias("b"),
    )
    found = fresh_records(new, frame(spark, [("0", 1)]), COLUMNS)
    per_partition = (
        found.filter("a = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    )
    assert found.count() == 299_999
    assert sum(row["count"] for row in per_partition) == 200_000
    assert len(per_partition) > 1
    assert max(row["count"] for row in per_partition) < 200_000


def test_the_comparison_shuffles_once(spark):
    schema = ", ".join(f"{name} string" for name in FILING_COLUMNS)
    old = spark.createDataFrame([("a", "b", "c", "d", "e")], schema)
    found = fresh_records(old, old, FILING_COLUMNS)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    # one exchange for the grouping; copies of more than a run are spread by another, given number of partitions
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning(companyname") == 1
