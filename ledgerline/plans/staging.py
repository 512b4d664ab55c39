"""Daily raw files to the typed, date-partitioned dataset."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import session
from ledgerline.functions.times import partition_columns
from ledgerline.operators.conform import conform
from ledgerline.schemas import STAGED_FILING, STAGED_FILING_STORED, STAGED_PARTITIONS, extend, strings
from ledgerline.sources import daily_files


def staged_rows(records: DataFrame, day: Column | None = None) -> DataFrame:
    """Records in the staged schema with their partition values, by default those of their folder."""
    day = F.to_date("ymd", "yyyyMMdd") if day is None else day
    return conform(records.withColumns(partition_columns(day)), STAGED_FILING_STORED)


def write_days(staged: DataFrame, root: str) -> None:
    """Replace the days present in ``staged``; other days stay as they are.

    Rows are rebalanced by day first: few files per day, and a day that holds much of the data is split
    over many tasks.
    """
    (
        staged.hint("rebalance", *STAGED_PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*STAGED_PARTITIONS)
        .parquet(root)
    )


def stage_day(
    spark: SparkSession,
    raw_root: str,
    staged_root: str,
    day: dt.date | None = None,
    quarantine_root: str | None = None,
    strict: bool = False,
) -> dict[str, int]:
    """Stage one day (default: yesterday) and say how many records and unreadable files it had.

    The day's folder is replaced even if the day turns out empty, and so is its folder of unreadable
    files. The raw files are parsed once, into a stored table that both are written from. ``strict``
    fails the job on a file that is JSON but not an array of objects.
    """
    day = day or dt.date.today() - dt.timedelta(days=1)
    ymd = f"{day:%Y%m%d}"
    parsed = daily_files.parse_files(daily_files.read_files(spark, raw_root, ymd))
    if strict:
        parsed = daily_files.require_arrays(parsed)
    seen = Observation()
    is_record = F.col("outcome") == daily_files.RECORDS
    observed = daily_files.outcomes(parsed).observe(
        seen, F.count_if(is_record).alias("records"), F.count_if(~is_record).alias("set_aside")
    )
    outcomes = session.cut(observed, "staging", by="outcome")
    _replace(conform(outcomes.filter(is_record), STAGED_FILING).hint("rebalance"),
             f"{staged_root}/y={day.year}/m={day.month}/d={ymd}")
    if quarantine_root is not None:
        bad = outcomes.filter(~is_record).select("source_file", "ymd", "reason", "body")
        _replace(bad, f"{quarantine_root}/d={ymd}")
    return seen.get


def publish_day(
    spark: SparkSession,
    raw_root: str,
    root: str,
    day: dt.date | None = None,
    strict: bool = False,
) -> dict[str, int]:
    """Stage one day (default: yesterday) aside and publish it by one marker; says how many rows each outcome has.

    Records go below ``records/d=yyyymmdd/run=N/`` and unreadable files below ``set_aside/...``, N being new. Readers
    follow the markers below ``published/``, each one row in one file: they see the run before until the marker of the
    new one is there, and then both outcomes of that. A run that breaks off is never seen; the next one takes another
    number. One run of a day at a time.
    """
    day = day or dt.date.today() - dt.timedelta(days=1)
    ymd = f"{day:%Y%m%d}"
    parsed = daily_files.parse_files(daily_files.read_files(spark, raw_root, ymd))
    if strict:
        parsed = daily_files.require_arrays(parsed)
    taken = [int(path.rsplit("=", 1)[1]) for outcome in _OUTCOMES
             for path in session.subfolders(spark, f"{root}/{outcome}/d={ymd}")]
    run = max(taken, default=0) + 1
    seen = Observation()
    is_record = F.col("outcome") == daily_files.RECORDS
    outcomes = session.cut(daily_files.outcomes(parsed).observe(
        seen, F.count_if(is_record).alias("records"), F.count_if(~is_record).alias("set_aside")), "publishing", by="outcome")
    _replace(conform(outcomes.filter(is_record), STAGED_FILING).hint("rebalance"), _run_folder(root, "records", ymd, run))
    bad = outcomes.filter(~is_record).select("source_file", "ymd", "reason", "body")
    _replace(bad, _run_folder(root, "set_aside", ymd, run))
    marker = spark.createDataFrame([(run, seen.get["records"], seen.get["set_aside"])], _MARKER)
    marker.coalesce(1).write.mode("append").parquet(f"{root}/published/d={ymd}")
    return seen.get


_OUTCOMES = ("records", "set_aside")
_MARKER = "run long, records long, set_aside long"


def _run_folder(root: str, outcome: str, ymd: str, run: int) -> str:
    return f"{root}/{outcome}/d={ymd}/run={run}"


def published_days(spark: SparkSession, root: str) -> DataFrame:
    """``d, run, records, set_aside`` of the run that counts of each day, a row per day."""
    schema, folder = f"{_MARKER}, d int", f"{root}/published"
    found = session.exists(spark, folder)
    markers = spark.read.schema(schema).parquet(folder) if found else spark.createDataFrame([], schema)
    newest = markers.groupBy("d").agg(F.max(F.struct("run", "records", "set_aside")).alias("last"))
    return newest.select("d", "last.*")


def read_published(spark: SparkSession, root: str, outcome: str = "records") -> DataFrame:
    """The published rows of an outcome, ``records`` or ``set_aside``, with their day ``d``.

    The runs are joined by their folders, so those that do not count are pruned before they are read.
    """
    columns = STAGED_FILING if outcome == "records" else strings("source_file", "ymd", "reason", "body")
    days = published_days(spark, root).select("d", "run")
    if days.isEmpty():
        return spark.createDataFrame([], extend(columns, T.StructField("d", T.IntegerType())))
    stored = extend(columns, T.StructField("d", T.IntegerType()), T.StructField("run", T.LongType()))
    return spark.read.schema(stored).parquet(f"{root}/{outcome}").join(days, ["d", "run"]).select(*columns.names, "d")


def remove_unpublished(spark: SparkSession, root: str) -> None:
    """Remove the runs that do not count, of days without a run going on; their readers must have ended."""
    live = {(row["d"], row["run"]) for row in published_days(spark, root).collect()}
    for outcome in _OUTCOMES:
        for day in session.subfolders(spark, f"{root}/{outcome}"):
            for run in session.subfolders(spark, day):
                if (int(day.rsplit("=", 1)[1]), int(run.rsplit("=", 1)[1])) not in live:
                    session.remove(spark, run)


def _replace(rows: DataFrame, folder: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)


def read_staged(spark: SparkSession, root: str) -> DataFrame:
    """The staged dataset; filters on ``y, m, d`` prune folders."""
    return spark.read.schema(STAGED_FILING_STORED).parquet(root)
