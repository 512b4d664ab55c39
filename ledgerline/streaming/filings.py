"""The filings feed as a stream: every landed snapshot is compared with the ledger."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline import session
from ledgerline.fixed_values import ROUTES, Route
from ledgerline.operators.enrich import dropped, enrich, survivors
from ledgerline.operators.feed import parse_entries, rejected_entries
from ledgerline.operators.records import fresh_across_snapshots
from ledgerline.operators.route import route_filings, route_messages, summary_counts, summary_of
from ledgerline.schemas import FILING_COLUMNS
from ledgerline.sources.ledger import Extent, FilingLedger
from ledgerline.streaming import jobs

Delivery = Callable[[DataFrame, int], None]


def filing_snapshots(entries: DataFrame) -> DataFrame:
    """Filings of streamed feed entries; the landed file is the snapshot, ordered by landing time."""
    landed = F.concat_ws(" ", F.date_format("snapshot_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "snapshot_file")
    return parse_entries(entries.withColumn("snapshot_id", landed), "snapshot_id")


def commit_batch(ledger: FilingLedger, snapshots: DataFrame, batch_id: int) -> DataFrame:
    """Find a batch's new filings, commit them to the ledger, and return them as committed.

    The commit is the only step that decides what is new. Done again for the same batch it sees the same
    state, as a batch's own rows do not count, and replaces them by equal ones. ``snapshots`` is read
    twice, for its days and for the comparison.
    """
    spark = snapshots.sparkSession
    place = ledger.ensure(spark).place(spark, batch_id)
    extent = Extent.of(snapshots)
    seen = ledger.seen_before(spark, batch_id, snapshots, place, extent)
    ledger.commit(fresh_across_snapshots(snapshots, seen, FILING_COLUMNS), batch_id, place, extent)
    return ledger.batch(spark, batch_id, place)


def keep_up(spark: SparkSession, ledger: FilingLedger, batch_id: int, merge_every: int | None) -> None:
    """Merge what came before every ``merge_every``-th batch; what the manifest before names stays for its readers."""
    if merge_every and batch_id % merge_every == merge_every - 1 and ledger.compact(spark, batch_id):
        ledger.vacuum(spark, keep=2)


def start_filing_stream(
    snapshots: DataFrame,
    ledger: FilingLedger,
    checkpoint: str,
    on_committed: Delivery | None = None,
    every: str | None = None,
    merge_every: int | None = None,
) -> StreamingQuery:
    """Stream ``(snapshot_id, filing columns)`` into the ledger.

    ``on_committed`` gets each batch's filings read back from the ledger. If it fails, the batch is run
    again with the same outcome, so nothing new is lost; it should replace its output by batch, too.
    ``merge_every`` batches the ledger's folders are merged and those no longer needed are removed.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        with jobs.kept(batch):
            committed = commit_batch(ledger, batch, batch_id)
        if on_committed is not None:
            on_committed(committed, batch_id)
        keep_up(batch.sparkSession, ledger, batch_id, merge_every)

    return jobs.start(snapshots, handle, checkpoint, every)


def start_feed_stream(
    entries: DataFrame,
    ledger: FilingLedger,
    rejects: str,
    checkpoint: str,
    on_committed: Delivery | None = None,
    every: str | None = None,
    merge_every: int | None = None,
) -> StreamingQuery:
    """The same from raw feed entries; the unusable ones are written below ``rejects``, by batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        with jobs.kept(batch):
            jobs.replace_batch(rejected_entries(batch), rejects, batch_id)
            committed = commit_batch(ledger, filing_snapshots(batch), batch_id)
        if on_committed is not None:
            on_committed(committed, batch_id)
        keep_up(batch.sparkSession, ledger, batch_id, merge_every)

    return jobs.start(entries, handle, checkpoint, every)


def outbox_delivery(
    spark: SparkSession, links_path: str, outbox: str, routes: Sequence[Route] = ROUTES
) -> Delivery:
    """Delivery that enriches a batch, and writes its messages by route, its dropped filings and its summary.

    ``links_path`` is the stored table of page links, read as it is when the batch runs. The enriched
    filings are stored first, counted for the summary as they are written; messages and dropped filings
    are read from them.
    """

    def send(committed: DataFrame, batch_id: int) -> None:
        links, counted = spark.read.parquet(links_path), Observation()
        enriched = session.cut(
            enrich(committed.select(*FILING_COLUMNS), links).observe(counted, *summary_counts()),
            "filings", jobs.batch_folder(f"{outbox}/enriched", batch_id)
        )
        counts = spark.createDataFrame([counted.get], "new_filings long, processed long")
        jobs.replace_batch(route_messages(route_filings(survivors(enriched), routes)), f"{outbox}/messages", batch_id, by="route")
        jobs.replace_batch(dropped(enriched), f"{outbox}/dropped", batch_id)
        jobs.replace_batch(summary_of(counts), f"{outbox}/summary", batch_id)

    return send
