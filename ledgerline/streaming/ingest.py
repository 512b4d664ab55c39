"""File-arrival ingest: every new daily file is parsed and its records are passed on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.schemas import STAGED_FILING, extend, strings
from ledgerline.sources import daily_files
from ledgerline.streaming import jobs


def start_ingest(
    files: DataFrame,
    target: str,
    checkpoint: str,
    schema: T.StructType = STAGED_FILING,
    every: str | None = None,
) -> StreamingQuery:
    """Write the records and the unreadable files of each batch below ``target``, in one pass."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        parsed = daily_files.parse_files(batch, schema)
        jobs.replace_batch(daily_files.outcomes(parsed), target, batch_id, by="outcome")

    return jobs.start(files, handle, checkpoint, every)


def _read(spark: SparkSession, target: str, schema: T.StructType, outcome: str) -> DataFrame:
    parts = [T.StructField("batch_id", T.LongType()), T.StructField("outcome", T.StringType())]
    return spark.read.schema(extend(schema, *parts)).parquet(target).filter(F.col("outcome") == outcome)


def ingested(spark: SparkSession, target: str, schema: T.StructType = STAGED_FILING) -> DataFrame:
    """All records ingested so far, with their day and batch."""
    stored = extend(strings("ymd"), *schema.fields)
    return _read(spark, target, stored, daily_files.RECORDS).select("ymd", *schema.names, "batch_id")


def set_aside(spark: SparkSession, target: str) -> DataFrame:
    """All unreadable files met so far."""
    stored = strings("source_file", "ymd", "reason", "body")
    return _read(spark, target, stored, daily_files.QUARANTINE).drop("outcome")
