"""The ledger of filings already seen: state and output of the feed in one table.

``filings/epoch=E/batch_id=N/month=M/`` holds what batch N found. A batch is written by replacing its own
folder, so writing it again after a crash changes nothing; no other write decides what counts as seen.

A reset begins a new epoch, named after the last batch before it, and deletes nothing. State is the
current epoch alone, so neither reading nor listing it grows with what came before.

``month`` is the calendar month of a filing's ``date``. As ``date`` takes part in record equality, a batch
can only meet equal records in its own months and between its first and last date. The months prune
folders, the dates prune row groups, which are sorted by date.

Every poll leaves a folder, so the folders are merged from time to time: ``merged/epoch=E/run=R/month=M/`` holds
the filings of several batches, and a manifest below ``manifests/epoch=E/version=V/`` names the runs that count
and the last batch they hold. A manifest is one row in one file. Until it is there nothing has changed, and from
then on the batches it covers are read from the runs alone; so a crash between two steps changes nothing, and
readers that began before go on with the files they listed. Runs of one level are merged once ``FAN_IN`` of them
have come together: a filing is rewritten as often as the logarithm of the number of polls says. ``vacuum``
removes what the last manifests no longer name.

A month of many filings is written by many tasks, as many as its rows ask for: equal filings compress so well that
their bytes say little about what a task has to sort.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.schemas import FILING_COLUMNS, LEDGER, LEDGER_RUNS

FAN_IN = 8
TASK_ROWS = 250_000
_EPOCH_SCHEMA = "epoch long"
_FIRST_EPOCH = -1
_MANIFEST_SCHEMA = "upto long, runs array<struct<run: string, level: int>>, epoch long, version long"


def filing_month(date: Column) -> Column:
    return F.substring(date, 1, 7)


@dataclass(frozen=True)
class Extent:
    """The first and last date of some filings, their number, and the months that hold more than ``TASK_ROWS``."""

    first: str | None
    last: str | None
    rows: int
    large: tuple[tuple[str | None, int], ...]

    @classmethod
    def of(cls, filings: DataFrame) -> Extent:
        """One row comes to the driver."""
        months = filings.groupBy(filing_month(F.col("date")).alias("month")).agg(
            F.count(F.lit(1)).alias("rows"), F.min("date").alias("first"), F.max("date").alias("last"))
        found = months.agg(
            F.min("first"), F.max("last"), F.coalesce(F.sum("rows"), F.lit(0)),
            F.collect_list(F.when(F.col("rows") > TASK_ROWS, F.struct("month", "rows")))).first()
        return cls(found[0], found[1], found[2], tuple((month, rows) for month, rows in found[3]))


def _where_new_may_be(extent: Extent) -> Column:
    """A filter for the months and dates a batch spans; nulls, which equal each other, always pass.

    The months prune folders, the dates row groups.
    """
    first, last = F.lit(extent.first).cast("string"), F.lit(extent.last).cast("string")
    month, date = F.col("month"), F.col("date")
    months = month.between(filing_month(first), filing_month(last))
    return (month.isNull() | months) & (date.isNull() | date.between(first, last))


@dataclass(frozen=True)
class Manifest:
    """The merged runs of an epoch, oldest first, and the last batch they hold; without runs that is -1."""

    epoch: int
    version: int = 0
    upto: int = -1
    runs: tuple[tuple[str, int], ...] = ()


@dataclass(frozen=True)
class FilingLedger:
    root: str

    @property
    def _filings(self) -> str:
        return f"{self.root}/filings"

    @property
    def _merged(self) -> str:
        return f"{self.root}/merged"

    @property
    def _manifests(self) -> str:
        return f"{self.root}/manifests"

    @property
    def _epochs(self) -> str:
        return f"{self.root}/epochs"

    def _batch_folder(self, epoch: int, batch_id: int) -> str:
        return f"{self._filings}/epoch={epoch}/batch_id={batch_id}"

    def _run_folder(self, epoch: int, run: str) -> str:
        return f"{self._merged}/epoch={epoch}/run={run}"

    def _read(self, spark: SparkSession, path: str) -> DataFrame:
        return _present(spark, LEDGER, self._filings, [path])

    def _runs(self, spark: SparkSession, manifests: Sequence[Manifest]) -> DataFrame:
        folders = [self._run_folder(one.epoch, run) for one in manifests for run, _ in one.runs]
        return _present(spark, LEDGER_RUNS, self._merged, folders).select(*LEDGER.names)

    def ensure(self, spark: SparkSession) -> FilingLedger:
        """Create the empty ledger if there is none."""
        spark.createDataFrame([], _EPOCH_SCHEMA).write.mode("ignore").parquet(self._epochs)
        return self

    def epoch(self, spark: SparkSession, batch_id: int) -> int:
        """The epoch a batch belongs to; a reset after the batch does not change it."""
        begun = spark.read.schema(_EPOCH_SCHEMA).parquet(self._epochs).filter(F.col("epoch") < batch_id)
        return begun.agg(F.coalesce(F.max("epoch"), F.lit(_FIRST_EPOCH))).first()[0]

    def _versions(self, spark: SparkSession, path: str) -> list[Manifest]:
        """Manifests below ``path``, the newest of each epoch last; their number is that of the merges kept."""
        found = _present(spark, _MANIFEST_SCHEMA, self._manifests, [path]).collect()
        return sorted((Manifest(row["epoch"], row["version"], row["upto"], tuple((run["run"], run["level"]) for run in row["runs"]))
                       for row in found), key=lambda one: (one.epoch, one.version))

    def manifest(self, spark: SparkSession, epoch: int) -> Manifest:
        """What is merged of an epoch, as of now."""
        return [Manifest(epoch), *self._versions(spark, f"{self._manifests}/epoch={epoch}")][-1]

    def place(self, spark: SparkSession, batch_id: int) -> Manifest:
        """The epoch a batch belongs to and what is merged of it; for the methods that take a place."""
        return self.manifest(spark, self.epoch(spark, batch_id))

    def rows(self, spark: SparkSession) -> DataFrame:
        """All filings ever found, whether or not they still count as seen."""
        newest = list({one.epoch: one for one in self._versions(spark, self._manifests)}.values())
        single = self._read(spark, self._filings)
        if not newest:
            return single
        covered = F.lit(False)
        for one in newest:
            covered = covered | ((F.col("epoch") == one.epoch) & (F.col("batch_id") <= one.upto))
        return single.filter(~covered).unionByName(self._runs(spark, newest))

    def _of_epoch(self, spark: SparkSession, at: Manifest) -> DataFrame:
        """The filings of an epoch: merged ones, and the folders of later batches."""
        single = self._read(spark, f"{self._filings}/epoch={at.epoch}").filter(F.col("batch_id") > at.upto)
        return single.unionByName(self._runs(spark, [at])) if at.runs else single

    def batch(self, spark: SparkSession, batch_id: int, place: Manifest | None = None) -> DataFrame:
        """The filings found by one batch."""
        at = place or self.place(spark, batch_id)
        if batch_id <= at.upto:
            return self._runs(spark, [at]).filter(F.col("batch_id") == batch_id)
        return self._read(spark, self._batch_folder(at.epoch, batch_id))

    def reset(self, spark: SparkSession) -> None:
        """Forget everything found so far. To be called between batches. Only the current epoch is read for it."""
        begun = spark.read.schema(_EPOCH_SCHEMA).parquet(self._epochs)
        current = begun.agg(F.coalesce(F.max("epoch"), F.lit(_FIRST_EPOCH))).first()[0]
        found = self._of_epoch(spark, self.manifest(spark, current))
        last = found.agg(F.max("batch_id").alias("epoch")).filter("epoch is not null")
        last.write.mode("append").parquet(self._epochs)

    def seen_before(self, spark: SparkSession, batch_id: int, new: DataFrame, place: Manifest | None = None,
                    extent: Extent | None = None) -> DataFrame:
        """State for a batch: earlier batches of its epoch, where ``new`` may have equals."""
        epoch = self._of_epoch(spark, place or self.place(spark, batch_id))
        return epoch.filter(F.col("batch_id") < batch_id).filter(_where_new_may_be(extent or Extent.of(new)))

    def commit(self, found: DataFrame, batch_id: int, place: Manifest | None = None, extent: Extent | None = None) -> None:
        """Write a batch's filings in place of whatever an earlier attempt left.

        An empty batch writes no rows. A batch that is merged already is history and cannot be written again. ``extent``
        is that of filings which ``found`` is part of; it says how many tasks are to write.
        """
        at = place or self.place(found.sparkSession, batch_id)
        if batch_id <= at.upto:
            raise ValueError(f"batch {batch_id} is merged already")
        shaped = found.select(*FILING_COLUMNS, "snapshot_id").withColumn("month", filing_month(F.col("date")))
        _write_by_month(_dealt(shaped, extent), self._batch_folder(at.epoch, batch_id))

    def compact(self, spark: SparkSession, before: int) -> bool:
        """Merge the batches before ``before`` in its epoch that are not merged yet; one merge runs at a time.

        ``before`` is the last batch or a later one, as only that may still be written again. The new run takes in the
        runs of its level once ``FAN_IN`` have come together, and those of the next one likewise, in one write. Says
        whether there was anything to merge.
        """
        at = self.place(spark, before)
        single = self._read(spark, f"{self._filings}/epoch={at.epoch}")
        single = single.filter((F.col("batch_id") > at.upto) & (F.col("batch_id") < before))
        last = single.agg(F.max("batch_id")).first()[0]
        if last is None:
            return False
        kept, level = list(at.runs), 0
        absorbed: list[tuple[str, int]] = []
        while sum(own == level for _, own in kept) >= FAN_IN - 1:
            absorbed += [run for run in kept if run[1] == level]
            kept = [run for run in kept if run[1] != level]
            level += 1
        rows = single if not absorbed else single.unionByName(
            self._runs(spark, [Manifest(at.epoch, runs=tuple(absorbed))]))
        name = uuid.uuid4().hex
        _write_by_month(_dealt(rows.drop("epoch"), Extent.of(rows)), self._run_folder(at.epoch, name))
        named = [(last, [*kept, (name, level)])]
        row = spark.createDataFrame(named, "upto long, runs array<struct<run: string, level: int>>")
        row.coalesce(1).write.parquet(f"{self._manifests}/epoch={at.epoch}/version={at.version + 1}")
        return True

    def vacuum(self, spark: SparkSession, keep: int = 1, epochs: bool = False) -> None:
        """Remove folders that none of the last ``keep`` manifests of their epoch needs.

        With ``keep`` of 2 or more, readers that began before the last merge go on. Runs that a merge left behind when it
        failed go, too, so no merge may be running. ``epochs`` also removes all epochs but the current one.
        """
        begun = spark.read.schema(_EPOCH_SCHEMA).parquet(self._epochs)
        current = begun.agg(F.coalesce(F.max("epoch"), F.lit(_FIRST_EPOCH))).first()[0]
        for folder in session.subfolders(spark, self._filings):
            epoch = int(folder.rsplit("=", 1)[1])
            if epochs and epoch < current:
                for root in (self._filings, self._merged, self._manifests):
                    session.remove(spark, f"{root}/epoch={epoch}")
                continue
            versions = self._versions(spark, f"{self._manifests}/epoch={epoch}")
            kept, gone = versions[-keep:], versions[:-keep]
            live = {run for one in kept for run, _ in one.runs}
            for run in session.subfolders(spark, f"{self._merged}/epoch={epoch}"):
                if run.rsplit("=", 1)[1] not in live:
                    session.remove(spark, run)
            merged = min((one.upto for one in kept), default=-1)
            for batch in session.subfolders(spark, folder):
                if int(batch.rsplit("=", 1)[1]) <= merged:
                    session.remove(spark, batch)
            for one in gone:
                session.remove(spark, f"{self._manifests}/epoch={epoch}/version={one.version}")


def _present(spark: SparkSession, schema, base: str, paths: list[str]) -> DataFrame:
    """The Parquet files below ``paths``; none if there are no such paths yet."""
    there = [path for path in paths if session.exists(spark, path)]
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*there)


def _dealt(rows: DataFrame, extent: Extent | None) -> DataFrame:
    """Rows by month; a month of more than ``TASK_ROWS`` is dealt over as many tasks as that many rows each ask for.

    Copies of one filing come from several tasks, so the task takes part in the deal: no filing is too frequent for it.
    Without such a month the rebalance keeps files large.
    """
    if extent is None or not extent.large:
        return rows.hint("rebalance", "month")
    dealt = F.xxhash64(*FILING_COLUMNS, F.spark_partition_id())
    part, tasks = F.lit(0).cast("long"), 1 + extent.rows // TASK_ROWS
    for month, count in extent.large:
        parts = -(-count // TASK_ROWS)
        part = F.when(F.col("month").eqNullSafe(F.lit(month).cast("string")), F.pmod(dealt, F.lit(parts))).otherwise(part)
    return rows.withColumn("_part", part).repartition(tasks, "month", "_part").drop("_part")


def _write_by_month(rows: DataFrame, folder: str) -> None:
    """Dealt rows with their ``month``, sorted by date within it."""
    (
        rows.sortWithinPartitions("month", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("month")
        .parquet(folder)
    )
