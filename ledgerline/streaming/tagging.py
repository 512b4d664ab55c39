"""Audit events as a stream, each batch joined with the current snapshots of accounts and inventory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ledgerline.plans.tagging import tag_events
from ledgerline.sources.tables import parse_audit_log
from ledgerline.streaming import jobs

# Reads accounts, attachments and inventory, in this order, as they are when a batch runs.
Snapshots = Callable[[], tuple[DataFrame, DataFrame, DataFrame]]


def start_tagging(
    lines: DataFrame, snapshots: Snapshots, target: str, checkpoint: str, every: str | None = None, **options
) -> StreamingQuery:
    """Write each batch's tag assignments, failed events and unsupported events below ``target``.

    The stored steps of a batch stay in ``target``'s folder ``work``, by batch.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        work = jobs.batch_folder(f"{target}/work", batch_id)
        tagged = tag_events(parse_audit_log(batch), *snapshots(), work=work, **options)
        jobs.replace_batch(tagged.assignments, f"{target}/assignments", batch_id)
        jobs.replace_batch(tagged.errors, f"{target}/errors", batch_id)
        jobs.replace_batch(tagged.unsupported, f"{target}/unsupported", batch_id)

    return jobs.start(lines, handle, checkpoint, every)
