from __future__ import annotations

import json
import os
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import bag, executed_plan
from ledgerline.catalog import stream_queries
from ledgerline.operators.enrich import page_links
from ledgerline.operators.route import batch_summary
from ledgerline.schemas import FILING, FILING_COLUMNS, extend, strings
from ledgerline.sources.daily_files import stream_files
from ledgerline.sources.feed import read_feed, stream_feed
from ledgerline.sources.ledger import FilingLedger
from ledgerline.sources.tables import stream_audit_log
from ledgerline.streaming import jobs
from ledgerline.streaming.filings import commit_batch, outbox_delivery, start_feed_stream, start_filing_stream
from ledgerline.streaming.ingest import ingested, set_aside, start_ingest
from ledgerline.streaming.tagging import start_tagging

A = ("A", "8-K", "1", "2024-01-01 00:00:00", "u1")
B = ("B", "10-K", "2", "2024-01-02 00:00:00", "u2")
C = ("C", "8-K", "3", None, "u3")
SNAPSHOTS = extend(FILING, *strings("snapshot_id"))


class Polls:
    def __init__(self, spark, folder):
        self.spark, self.landing = spark, folder("polls")
        self.ledger, self.checkpoint = FilingLedger(folder("ledger")).ensure(spark), folder("checkpoint")

    def land(self, name, *rows):
        path = f"{self.landing}/snapshot_id={name}"
        self.spark.createDataFrame(list(rows), FILING).coalesce(1).write.json(path)

    def run(self, on_committed=None):
        stream = self.spark.readStream.schema(SNAPSHOTS).json(self.landing)
        start_filing_stream(stream, self.ledger, self.checkpoint, on_committed).awaitTermination()

    def found(self):
        return bag(self.ledger.rows(self.spark).select("companyname", "snapshot_id", "batch_id"))


@pytest.fixture
def polls(spark, folder):
    return Polls(spark, folder)


def test_two_drops(polls):
    polls.land("1", A, B, B)
    polls.land("2", A, B, C)
    polls.run()
    assert polls.found() == [("A", "1", 0), ("B", "1", 0), ("B", "1", 0), ("C", "2", 0)]
    polls.land("3", A, C, ("D", "8-K", "4", "2024-01-02 00:00:00", "u4"))
    polls.run()
    assert polls.found()[-1] == ("D", "3", 1) and len(polls.found()) == 5
    polls.run()
    assert len(polls.found()) == 5


def test_crash_after_commit_loses_nothing(polls):
    polls.land("1", A, B)
    delivered = []

    def deliver(committed, batch_id):
        if not delivered:
            delivered.append("failed")
            raise RuntimeError("no delivery")
        delivered.append((batch_id, bag(committed.select("companyname"))))

    with pytest.raises(StreamingQueryException):
        polls.run(deliver)
    assert polls.found() == [("A", "1", 0), ("B", "1", 0)]
    polls.run(deliver)
    assert delivered == ["failed", (0, [("A",), ("B",)])]
    assert polls.found() == [("A", "1", 0), ("B", "1", 0)]


def test_reset(spark, polls):
    polls.ledger.reset(spark)
    assert polls.ledger.epoch(spark, 0) == -1
    polls.land("1", A, B)
    polls.run()
    polls.ledger.reset(spark)
    assert [polls.ledger.epoch(spark, batch) for batch in (0, 1, 2)] == [-1, 0, 0]
    polls.land("2", A, C)
    polls.run()
    assert polls.found() == [("A", "1", 0), ("A", "2", 1), ("B", "1", 0), ("C", "2", 1)]
    polls.land("3", A, B)
    polls.run()
    assert len(polls.found()) == 5 and ("B", "3", 2) in polls.found()
    assert bag(polls.ledger.batch(spark, 0).select("companyname")) == [("A",), ("B",)]


def test_replay_after_a_reset_stays_in_its_epoch(spark, folder):
    ledger = FilingLedger(folder("ledger"))
    rows = spark.createDataFrame([(*A, "1")], SNAPSHOTS)
    commit_batch(ledger, rows, 0)
    ledger.reset(spark)
    assert commit_batch(ledger, rows, 0).count() == 1
    assert ledger.rows(spark).count() == 1
    assert commit_batch(ledger, rows, 1).count() == 1
    again = spark.createDataFrame([(*A, "2")], SNAPSHOTS)
    assert commit_batch(ledger, again, 2).count() == 0


def test_state_is_read_where_equals_may_be(spark, polls):
    late = ("L", "8-K", "9", "2024-03-09 00:00:00", "u9")
    between = ("M", "8-K", "9", "2024-02-09 00:00:00", "u9")
    early = ("E", "8-K", "9", "2023-12-31 00:00:00", "u9")
    polls.land("1", A, B, C, late, between, early)
    polls.run()

    def seen(*new):
        return polls.ledger.seen_before(spark, 1, spark.createDataFrame(list(new), FILING))

    assert bag(seen(A).select("companyname")) == [("A",), ("C",)]
    assert bag(seen(A, late).select("companyname")) == [("A",), ("B",), ("C",), ("L",), ("M",)]
    assert bag(seen(C).select("companyname")) == [("C",)]
    plan = executed_plan(seen(A, late))
    filters = plan.split("PartitionFilters: [")[1]
    assert "batch_id" in filters and "month" in filters and "date" in plan.split("DataFilters: [")[1]


def test_an_empty_replay_replaces_the_batch(spark, folder):
    ledger = FilingLedger(folder("ledger"))
    rows = spark.createDataFrame([(*A, "1"), (*C, "1")], SNAPSHOTS)
    assert commit_batch(ledger, rows, 0).count() == 2
    assert commit_batch(ledger, rows, 0).count() == 2
    assert commit_batch(ledger, rows.limit(0), 0).count() == 0
    assert ledger.rows(spark).count() == 0


FEED = """<?xml version="1.0"?><feed>{}</feed>"""
ENTRY = ('<entry><title>{} - {} ({}) (Filer)</title><link rel="alternate" href="{}"/>'
         "<updated>2024-01-0{}T00:00:00Z</updated><id>{}</id></entry>")
TABLE = '<table class="tableFile" summary="Document Format Files"><a href="/d{}">t</a></table>'


def test_feed_files_to_messages(spark, folder, tmp_path):
    """From landed Atom files to messages per destination, over two polls."""
    links, outbox = folder("links"), folder("outbox")
    crawled = spark.createDataFrame(
        [("u1", 200, TABLE.format(1)), ("u2", 404, ""), ("u3", 200, "<p>"), ("u4", 200, TABLE.format(4))],
        "url string, status int, html string")
    page_links(crawled).write.parquet(links)
    landing = tmp_path / "feed"
    landing.mkdir()
    ledger, checkpoint = FilingLedger(folder("ledger")), folder("checkpoint")

    def poll(name, *entries):
        (landing / f"{name}.xml").write_text(FEED.format("".join(ENTRY.format(*entry) for entry in entries)))
        deliver = outbox_delivery(spark, links, outbox)
        stream = stream_feed(spark, str(landing))
        start_feed_stream(stream, ledger, f"{outbox}/rejects", checkpoint, deliver).awaitTermination()

    first = [("8-K", "A", 1, "u1", 1, "e1"), ("10-K", "B", 2, "u2", 2, "e2"), ("8-K", "C", 3, "u3", 3, "e3")]
    poll("one", *first)
    poll("two", *first, ("8-K", "D", 4, "u4", 4, "e4"), ("8-K/A", "E", 5, "u1", 5, "e5"), ("x", "F", 6, "u", "x", "e6"))
    messages = spark.read.parquet(f"{outbox}/messages").orderBy("batch_id", "route").collect()
    records = [(row["batch_id"], row["route"], json.loads(row["body"])) for row in messages]
    assert [(batch_id, name, record["companyname"], record["formurl"]) for batch_id, name, record in records] == [
        (0, "10k", "B", None),
        (0, "8k", "A", "https://www.sec.gov/d1"),
        (1, "8k", "D", "https://www.sec.gov/d4"),
    ]
    dropped = spark.read.parquet(f"{outbox}/dropped").select("companyname", "enrich_status")
    assert bag(dropped) == [("C", "no_link")]
    rejects = spark.read.parquet(f"{outbox}/rejects").select("batch_id", "entry_id", "reason")
    assert bag(rejects) == [(1, "e6", "bad_time")]
    summary = spark.read.parquet(f"{outbox}/summary").select("batch_id", "new_filings", "processed", "body")
    assert bag(summary) == [(0, 3, 2, "Finished downloading for 2 companies."),
                            (1, 2, 2, "Finished downloading for 2 companies.")]
    assert ledger.rows(spark).count() == 5


def test_ingest(spark, folder, tmp_path):
    raw, target, checkpoint = tmp_path / "raw", folder("ingested"), folder("checkpoint")

    def land(day, name, body):
        os.makedirs(raw / day, exist_ok=True)
        (raw / day / name).write_text(body)
        start_ingest(stream_files(spark, str(raw)), target, checkpoint).awaitTermination()

    land("20240101", "a", '[{"cik":"1"},{"cik":"2"}]')
    land("20240102", "b", '[{"cik":"3"}')
    land("20240102", "c", '[{"cik":"4"}]')
    land("20240103", "d", "[]")
    records = ingested(spark, target).select("ymd", "cik", "batch_id")
    assert bag(records) == [("20240101", "1", 0), ("20240101", "2", 0), ("20240102", "4", 2)]
    bad = set_aside(spark, target).select("ymd", "reason", "body", "batch_id")
    assert bag(bad) == [("20240102", "malformed", '[{"cik":"3"}', 1)]


def test_tagging(spark, folder, tmp_path):
    log, target = tmp_path / "log", folder("tagged")
    log.mkdir()
    user = {"arn": "x", "principalId": "AID", "type": "IAMUser", "userName": "u"}
    lines = [json.dumps({"id": str(n), "time": "t", "account": "a", "region": "r", "detail": {
        "eventName": name, "userIdentity": user, "responseElements": {"vpcId": f"v{n}"}}})
        for n, name in enumerate(["CreateVpc", "CreateVpc", "CreateSubnet"])]
    (log / "part").write_text("\n".join(lines))

    def snapshots():
        return (
            spark.createDataFrame([("a", ["ma-x-prd"])], "account string, aliases array<string>"),
            spark.createDataFrame([], "parent_id string, child_id string, kind string"),
            spark.createDataFrame([], "resource_id string, region string, tags array<struct<Key:string,Value:string>>"),
        )

    start_tagging(stream_audit_log(spark, str(log)), snapshots, target, folder("checkpoint")).awaitTermination()
    rows = spark.read.parquet(f"{target}/assignments").filter("key = 'Provisioned_By'")
    assert bag(rows.select("resource_id", "value")) == [("v0", "u"), ("v1", "u")]
    assert bag(spark.read.parquet(f"{target}/errors").select("event_id", "error")) == [("2", "no_resource")]
    assert spark.read.parquet(f"{target}/unsupported").count() == 0
    assert rows.select(F.count("*")).first()[0] == 2


def test_batches_run_adaptively(spark, folder, tmp_path):
    """A stream's session has adaptive execution off; what a batch does must not."""
    (tmp_path / "lines").write_text("a\nb\na")
    met = []

    def handle(batch, batch_id):
        counted = batch.groupBy("value").count()
        met.append((len(counted.collect()), "AdaptiveSparkPlan" in executed_plan(counted)))

    jobs.start(spark.readStream.text(str(tmp_path)), handle, folder("checkpoint")).awaitTermination()
    assert met == [(2, True)]


def test_a_hot_record_in_a_stream_is_kept_whole(spark, folder, tmp_path):
    """One record makes up nearly all of a poll; the ledger holds every copy."""
    copies = 120_000
    rows = spark.range(copies).select(*[F.lit(value).alias(name) for name, value in zip(FILING_COLUMNS, A)])
    landing, ledger = folder("polls"), FilingLedger(folder("ledger")).ensure(spark)
    rows.unionByName(spark.createDataFrame([B], FILING)).write.json(f"{landing}/snapshot_id=1")
    stream = spark.readStream.schema(SNAPSHOTS).json(landing)
    start_filing_stream(stream, ledger, folder("checkpoint")).awaitTermination()
    found = ledger.batch(spark, 0)
    assert bag(found.groupBy("companyname").count()) == [("A", copies), ("B", 1)]


def test_a_backlog_is_taken_in_batches(spark, folder, tmp_path):
    """Twelve files at five a batch: three batches, every record once, and done files moved away."""
    raw, done, target, checkpoint = tmp_path / "raw", tmp_path / "done", folder("ingested"), folder("checkpoint")

    def land(names):
        for at in names:
            os.makedirs(raw / f"2024010{at % 3 + 1}", exist_ok=True)
            (raw / f"2024010{at % 3 + 1}" / f"f{at}").write_text(f'[{{"cik":"{at}"}}]' if at != 7 else "broken")
        files = stream_files(spark, str(raw), **jobs.admission(max_files=5, done=str(done)))
        start_ingest(files, target, checkpoint).awaitTermination()

    land(range(12))
    rows = ingested(spark, target).select("cik", "batch_id").collect()
    assert sorted(int(row["cik"]) for row in rows) == [at for at in range(12) if at != 7]
    batches = [row["batch_id"] for row in rows] + [row["batch_id"] for row in set_aside(spark, target).collect()]
    assert sorted(batches.count(batch) for batch in set(batches)) == [2, 5, 5]
    land(range(12, 14))
    assert ingested(spark, target).count() == 13
    assert any(name.startswith("f") for _, _, names in os.walk(done) for name in names)


def test_the_summary_is_counted_as_filings_are_written(spark, folder):
    """No second pass over the stored filings, and the same figures as of one."""
    links, outbox, ledger = folder("links"), folder("outbox"), FilingLedger(folder("ledger"))
    crawled = spark.createDataFrame([("u1", 200, TABLE.format(1)), ("u2", 404, "")], "url string, status int, html string")
    page_links(crawled).write.parquet(links)
    deliver = outbox_delivery(spark, links, outbox)
    for batch_id, rows in enumerate(([A, A, B, C], [])):
        polled = spark.createDataFrame([(*row, f"s{batch_id}") for row in rows], SNAPSHOTS)
        deliver(commit_batch(ledger, polled, batch_id), batch_id)
        stored = spark.read.parquet(jobs.batch_folder(f"{outbox}/enriched", batch_id) + "/filings")
        told = spark.read.parquet(jobs.batch_folder(f"{outbox}/summary", batch_id))
        assert bag(told) == bag(batch_summary(stored))
    assert bag(told) == [(0, 0, False, "Finished downloading for 0 companies.")]


def test_a_larger_poll_comes_in_more_files(spark, folder, monkeypatch):
    monkeypatch.setattr(stream_queries, "_ENTRIES_A_FILE", 50)
    poll = spark.range(2000).selectExpr(
        "cast(id as string) as entry_id", "'t' as title", "if(id % 2 = 0, null, concat('l', id % 400)) as link", "'now' as updated")
    landed = folder("polls")
    assert stream_queries._land_poll(poll, landed) == 8
    entries = read_feed(spark, landed).select("entry_id", "link", "snapshot_file").collect()
    assert len(entries) == 2000
    assert max(Counter(row["snapshot_file"] for row in entries).values()) <= 150
    files = {}
    for row in entries:
        if row["link"] is not None:
            files.setdefault(row["link"], set()).add(row["snapshot_file"])
    assert all(len(found) == 1 for found in files.values())
    # a small one as before
    assert stream_queries._land_poll(poll.limit(100), folder("small")) == 1
