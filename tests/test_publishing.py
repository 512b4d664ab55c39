from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from conftest import bag, executed_plan
from ledgerline import session
from ledgerline.catalog import staging_queries
from ledgerline.plans import staging

DAY = dt.date(2024, 1, 5)


@pytest.fixture
def days(spark, folder, tmp_path):
    return Days(spark, tmp_path / "raw", folder("days"))


class Days:
    def __init__(self, spark, raw, root):
        self.spark, self.raw, self.root = spark, raw, root

    def land(self, name, body, day=DAY):
        folder = self.raw / f"{day:%Y%m%d}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(body)

    def publish(self, day=DAY, **options):
        return staging.publish_day(self.spark, str(self.raw), self.root, day, **options)

    def seen(self):
        records = staging.read_published(self.spark, self.root).select("d", "cik")
        bad = staging.read_published(self.spark, self.root, "set_aside").select("d", "reason")
        return bag(records), bag(bad)


def test_nothing_published(days):
    assert days.seen() == ([], [])
    assert staging.published_days(days.spark, days.root).count() == 0


def test_a_day_published_twice(days):
    days.land("a", '[{"cik":"1"},{"cik":"2"}]')
    days.land("b", '[{"cik":')
    assert days.publish() == {"records": 2, "set_aside": 1}
    assert days.seen() == ([(20240105, "1"), (20240105, "2")], [(20240105, "malformed")])
    days.land("b", '[{"cik":"3"}]')
    days.land("c", "[]", dt.date(2024, 1, 6))
    assert days.publish() == {"records": 3, "set_aside": 0}
    assert days.publish(dt.date(2024, 1, 6)) == {"records": 0, "set_aside": 0}
    assert days.seen() == ([(20240105, "1"), (20240105, "2"), (20240105, "3")], [])
    told = staging.published_days(days.spark, days.root)
    assert bag(told) == [(20240105, 2, 3, 0), (20240106, 1, 0, 0)]
    # a day that nothing landed for is published as empty
    assert days.publish(dt.date(2024, 1, 7)) == {"records": 0, "set_aside": 0}


@pytest.mark.parametrize("broken_off", ["records", "set_aside"])
def test_a_run_that_breaks_off_is_never_seen(days, monkeypatch, broken_off):
    days.land("a", '[{"cik":"1"}]')
    days.land("b", "no json")
    days.publish()
    before = days.seen()
    days.land("a", '[{"cik":"7"},{"cik":"8"}]')
    days.land("b", "{}")
    replace = staging._replace

    def fail(rows, path):
        if f"/{broken_off}/" not in path:
            replace(rows, path)
            return
        if broken_off == "set_aside":
            replace(rows, path)  # everything is there but the marker
        raise RuntimeError("crash")

    with monkeypatch.context() as patch:
        patch.setattr(staging, "_replace", fail)
        with pytest.raises(RuntimeError):
            days.publish()
    assert days.seen() == before
    days.publish()
    after = ([(20240105, "7"), (20240105, "8")], [(20240105, "not_an_array_of_objects")])
    assert days.seen() == after
    staging.remove_unpublished(days.spark, days.root)
    assert days.seen() == after
    for outcome in ("records", "set_aside"):
        assert len(session.subfolders(days.spark, f"{days.root}/{outcome}/d=20240105")) == 1


def test_strict(days):
    days.land("a", '{"cik":"1"}')
    with pytest.raises(PySparkException, match="not a JSON array"):
        days.publish(strict=True)
    assert days.seen() == ([], [])


def test_runs_that_do_not_count_are_not_read(days):
    days.land("a", '[{"cik":"1"}]')
    days.publish()
    days.publish()
    plan = executed_plan(staging.read_published(days.spark, days.root))
    assert "dynamicpruning" in plan.lower() or "PartitionFilters: [" in plan


def test_the_query_publishes_records_twice(spark, tmp_path, monkeypatch):
    """The first run publishes a part of the good day, and the last one reads what landed at first, too."""
    rows = [(i, dt.datetime(2024, 1, day, 12), i % 7, "view", 9.5) for i in (*range(40), 100_001) for day in (5, 6, 8)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    told, publish = [], staging.publish_day
    monkeypatch.setattr(staging, "publish_day", lambda *args: told.append(publish(*args)) or told[-1])
    found = bag(staging_queries.staged_day_published(spark, str(tmp_path)).select("d", "inter_url", "reason"))
    # the broken day, the good one, and both again; two blocks of ids are two files
    assert told == [{"records": 0, "set_aside": 2}, {"records": 21, "set_aside": 0},
                    {"records": 0, "set_aside": 2}, {"records": 41, "set_aside": 0}]
    ids = [url.rsplit("/", 1)[1] for d, url, reason in found if d == 20240108 and reason is None]
    assert sorted(map(int, ids)) == [*range(40), 100_001]
    assert [row for row in found if row[0] != 20240108] == [(20240105, None, "malformed")]


def test_files_of_many_blocks_stay_files(spark, tmp_path):
    """A day of more blocks than cores is read by few tasks, and still each block's file lands as a file."""
    rows = [(i * 100_000, dt.datetime(2024, 1, day, 12), i, "view", 9.5) for i in range(30) for day in (5, 8)]
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    found = bag(staging_queries.staged_day_published(spark, str(tmp_path)).select("d", "cik", "reason"))
    assert found == sorted([(20240105, None, "malformed"), *((20240108, str(i), None) for i in range(30))], key=repr)
