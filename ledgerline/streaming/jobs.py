"""Running a stream over landed files batch by batch."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

_ADAPTIVE = "spark.sql.adaptive.enabled"


@contextlib.contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Run a batch's queries adaptively, as any other batch query.

    A stream's session has adaptive execution switched off, for the stream's own plan. What a batch is
    compared and joined with needs it: it splits hot keys, and rebalancing is part of it.
    """
    before = spark.conf.get(_ADAPTIVE)
    spark.conf.set(_ADAPTIVE, "true")
    try:
        yield
    finally:
        spark.conf.set(_ADAPTIVE, before)


def start(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to ``handle``; without ``every`` stop once all landed files are done."""
    trigger = {"processingTime": every} if every else {"availableNow": True}

    def run(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            handle(batch, batch_id)

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


@contextlib.contextmanager
def kept(batch: DataFrame) -> Iterator[None]:
    """Keep a batch's parsed rows while several steps read them; a lost part is read and parsed again."""
    batch.persist()
    try:
        yield
    finally:
        batch.unpersist()


def admission(max_files: int | None = None, done: str | None = None) -> dict[str, str]:
    """Options of a stream over files: at most so many of them in a batch, and where to move those that are done.

    A backlog then becomes several batches of a bounded size. Files move once a later batch has begun, so the last
    ones stay until more arrive; ``done`` must lie outside the landing folder.
    """
    options = {} if max_files is None else {"maxFilesPerTrigger": str(max_files)}
    return options if done is None else {**options, "cleanSource": "archive", "sourceArchiveDir": done}


def batch_folder(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id}"


def replace_batch(rows: DataFrame, root: str, batch_id: int, by: str | None = None) -> None:
    """Write a batch's rows to its own folder, in place of whatever an earlier attempt left."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if by is not None:
        writer = writer.partitionBy(by)
    writer.parquet(batch_folder(root, batch_id))
