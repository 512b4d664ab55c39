"""Registered queries: the filings feed as a stream, with and without a crash."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.catalog import inputs
from ledgerline.catalog.filing_queries import POLLED_MESSAGES, POLLED_OUTPUTS, entry_polls, raw_polls
from ledgerline.catalog.inputs import derive, for_check
from ledgerline.operators.enrich import page_links
from ledgerline.schemas import FILING, FILING_COLUMNS, extend, strings
from ledgerline.sources.feed import land_feed, stream_feed
from ledgerline.sources.ledger import FilingLedger
from ledgerline.streaming import jobs
from ledgerline.streaming.filings import Delivery, outbox_delivery, start_feed_stream, start_filing_stream

# Three polls whose filings overlap and which hold all of them; the first two arrive together.
_SNAPSHOTS = {
    "s1": (None, dt.datetime(2024, 1, 14)),
    "s2": (dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 22)),
    "s3": (dt.datetime(2024, 1, 18), None),
}
_DROPS = (("s1", "s2"), ("s3",))


def _land(spark: SparkSession, sf_dir: str, folder: str, snapshots: tuple[str, ...]) -> None:
    filings = derive(spark, sf_dir, inputs.FILINGS)
    for name in snapshots:
        first, last = _SNAPSHOTS[name]
        poll = filings
        if first is not None:
            poll = poll.filter(F.col("ts") >= F.lit(first).cast("timestamp_ntz"))
        if last is not None:
            poll = poll.filter(F.col("ts") < F.lit(last).cast("timestamp_ntz"))
        poll.select(*FILING_COLUMNS).write.json(f"{folder}/snapshot_id={name}")


class _Feed:
    """A landing folder, the ledger it feeds, and the checkpoint between them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.landing = session.workspace(spark, f"{name}-polls")
        self.ledger = FilingLedger(session.workspace(spark, f"{name}-ledger")).ensure(spark)
        self.checkpoint = session.workspace(spark, f"{name}-checkpoint")

    def run(self, on_committed: Delivery | None = None) -> None:
        schema = extend(FILING, *strings("snapshot_id"))
        polls = self.spark.readStream.schema(schema).json(self.landing)
        start_filing_stream(polls, self.ledger, self.checkpoint, on_committed).awaitTermination()

    def found(self) -> DataFrame:
        return self.ledger.rows(self.spark).select("batch_id", "snapshot_id", *FILING_COLUMNS)


def stream_filing_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = _Feed(spark, "diff")
    for drop in _DROPS:
        _land(spark, sf_dir, stream.landing, drop)
        stream.run()
    return stream.found()


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch fails once after its commit and is then run again from the checkpoint.

    ``failures`` says how often a batch's delivery failed; any other failure of the stream is one of the query.
    """
    stream, failed = _Feed(spark, "replay"), []

    def fail(_: DataFrame, batch_id: int) -> None:
        failed.append(batch_id)
        raise RuntimeError(f"delivery of batch {batch_id} failed")

    for drop in _DROPS:
        _land(spark, sf_dir, stream.landing, drop)
        before = len(failed)
        try:
            stream.run(fail)
        except StreamingQueryException as problem:
            if len(failed) == before or f"delivery of batch {failed[-1]} failed" not in str(problem):
                raise
            stream.run()
    counts = spark.createDataFrame([(batch_id,) for batch_id in failed], "batch_id long").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("failures"))
    return stream.found().join(counts, "batch_id", "left")


def stream_filing_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two polls through the ledger, enrichment and routing; all messages as they were written."""
    stream, outbox, links = _Feed(spark, "messages"), session.workspace(spark, "outbox"), session.workspace(spark, "links")
    page_links(derive(spark, sf_dir, inputs.PAGES)).write.parquet(links)
    for name, poll in zip(("s1", "s2"), entry_polls(spark, sf_dir)):
        poll.write.json(f"{stream.landing}/snapshot_id={name}")
        stream.run(outbox_delivery(spark, links, outbox))
    messages = spark.read.schema("title string, body string, batch_id long, route string").parquet(f"{outbox}/messages")
    return messages.select("route", "title", "body")


def stream_feed_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two polls as Atom files, a few files a batch: whatever the stream leaves behind, in one table.

    Entries of one link share a file, so a filing and its copies come in one snapshot; those without a link are no
    filings and go anywhere. A file is read by one task, so a larger poll comes in more files, not in larger ones. The
    ledger is merged as it grows.
    """
    root = session.workspace(spark, "feed-outputs")
    ledger, landing, outbox, links = FilingLedger(f"{root}/ledger"), f"{root}/feed", f"{root}/outbox", f"{root}/links"
    page_links(derive(spark, sf_dir, inputs.PAGES)).write.parquet(links)
    for name, poll in zip(("p1", "p2"), raw_polls(spark, sf_dir)):
        parts = _land_poll(poll, f"{landing}/poll={name}")
        entries = stream_feed(spark, landing, **jobs.admission(max_files=3 * parts, done=f"{root}/done"))
        start_feed_stream(entries, ledger, f"{outbox}/rejects", f"{root}/checkpoint",
                          outbox_delivery(spark, links, outbox), merge_every=2).awaitTermination()
    summary = spark.read.schema("new_filings long, processed long").parquet(f"{outbox}/summary")
    totals = summary.agg(*[F.sum(name).cast("string").alias(name) for name in ("new_filings", "processed")])
    outputs = [
        _output("message", spark.read.schema("body string, route string").parquet(f"{outbox}/messages"), "route", "body"),
        _output("reject", spark.read.schema("reason string, entry_id string").parquet(f"{outbox}/rejects"),
                "reason", "entry_id"),
        _output("dropped", spark.read.schema("enrich_status string, inter_url string").parquet(f"{outbox}/dropped"),
                "enrich_status", "inter_url"),
        _output("summary", totals.unpivot([], ["new_filings", "processed"], "name", "detail"), "name", "detail"),
    ]
    return functools.reduce(DataFrame.unionByName, outputs)


def _land_poll(poll: DataFrame, folder: str) -> int:
    """Write a poll's files; says how many times ``_FILES_A_POLL`` they are."""
    parts = max(1, -(-poll.count() // (_FILES_A_POLL * _ENTRIES_A_FILE)))
    land_feed(poll.repartition(_FILES_A_POLL * parts, F.coalesce("link", "entry_id")), folder)
    return parts


_FILES_A_POLL = 5
_ENTRIES_A_FILE = 50_000


def _output(kind: str, rows: DataFrame, name: str, detail: str) -> DataFrame:
    return rows.select(F.lit(kind).alias("output"), F.col(name).alias("name"), F.col(detail).alias("detail"))


def stream_ledger_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same polls as in ``stream_filing_diff``, one a batch; the ledger is merged after each and swept."""
    stream = _Feed(spark, "merged")
    for at, name in enumerate(_SNAPSHOTS):
        _land(spark, sf_dir, stream.landing, (name,))
        stream.run()
        stream.ledger.compact(spark, at)
        stream.ledger.vacuum(spark)
    return stream.found().drop("batch_id")


QUERIES = {
    "stream_feed_outputs": stream_feed_outputs,
    "stream_ledger_merged": stream_ledger_merged,
    "stream_filing_diff": stream_filing_diff,
    "stream_replay": stream_replay,
    "stream_filing_messages": stream_filing_messages,
}

_FILING = ", ".join(FILING_COLUMNS)
_POLLS = " union all ".join(
    f"select '{name}' as snapshot_id, {_FILING} from {for_check(inputs.FILINGS)} f "
    + " and ".join(["where true", *([f"ts >= timestamp '{first}'"] if first else []),
                    *([f"ts < timestamp '{last}'"] if last else [])])
    for name, (first, last) in _SNAPSHOTS.items()
)
_FOUND = f"""
    with polls as ({_POLLS}),
    ranked as (select *, min(snapshot_id) over (partition by {_FILING}) as first_seen from polls)
    select cast(case when snapshot_id = 's3' then 1 else 0 end as bigint) as batch_id, snapshot_id, {_FILING}
    from ranked where snapshot_id = first_seen"""

_REPLAYED = f"select *, cast(1 as bigint) as failures from ({_FOUND}) found"

CHECKS = {
    "stream_filing_diff": _FOUND,
    "stream_replay": _REPLAYED,
    "stream_filing_messages": POLLED_MESSAGES,
    "stream_feed_outputs": POLLED_OUTPUTS,
    "stream_ledger_merged": f"select snapshot_id, {_FILING} from ({_FOUND}) found",
}
