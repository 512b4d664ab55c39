"""Snapshot tables and event logs kept as Parquet or JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.once import with_once
from ledgerline.schemas import AUDIT_EVENT


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One Parquet table of a folder of tables."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def read_requests(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Requests kept as JSON lines; fields a request lacks are null."""
    return spark.read.schema(schema).json(path)


UNREADABLE = "unreadable"


def scan_requests(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every line of the request files, parsed; ``unreadable`` holds the line itself where it is no JSON object.

    Lines are read and parsed once. Blank lines are none. A field of another type than the schema's makes its line
    unreadable as a whole.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    declared = T.StructType([*schema.fields, T.StructField(UNREADABLE, T.StringType())])
    parsed = with_once(lines, "request", F.from_json("value", declared, {"columnNameOfCorruptRecord": UNREADABLE}))
    is_object = F.ltrim("value").startswith("{")
    bad = F.col(f"request.{UNREADABLE}").isNotNull() | F.col("request").isNull() | ~is_object
    return parsed.select(
        *[F.when(~bad, F.col(f"request.`{name}`")).alias(name) for name in schema.names],
        F.when(bad, F.col("value")).alias(UNREADABLE),
    )


def readable(scanned: DataFrame) -> DataFrame:
    """The requests among scanned lines."""
    return scanned.where(F.col(UNREADABLE).isNull()).drop(UNREADABLE)


def unreadable(scanned: DataFrame) -> DataFrame:
    """The lines that hold no request, as they are."""
    return scanned.where(F.col(UNREADABLE).isNotNull()).select(F.col(UNREADABLE).alias("line"))


def audit_fields(record: Column) -> list[Column]:
    """Flat columns of a parsed audit record; ``detail`` stays nested for the rule table."""
    user = record["detail"]["userIdentity"]
    return [
        record["id"].alias("event_id"),
        record["time"].alias("event_time"),
        record["account"].alias("account"),
        record["region"].alias("region"),
        record["detail"]["eventName"].alias("event_name"),
        user["arn"].alias("arn"),
        user["principalId"].alias("principal_id"),
        user["type"].alias("user_type"),
        user["userName"].alias("user_name"),
        user["sessionContext"]["sessionIssuer"]["userName"].alias("issuer_name"),
        record["detail"].alias("detail"),
    ]


def parse_audit_log(lines: DataFrame, column: str = "value", schema: T.StructType = AUDIT_EVENT) -> DataFrame:
    """Audit events from a column of JSON records; unreadable text gives a row of nulls.

    Each record is parsed once, which keeps the optimizer from leaving fields out: readers of the identity alone pass
    ``AUDIT_IDENTITY``.
    """
    parsed = with_once(lines, "record", F.from_json(F.col(column), schema))
    return parsed.select(*audit_fields(F.col("record")))


def stream_audit_log(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """New lines of the audit log folder, unparsed (column ``value``)."""
    return spark.readStream.format("text").options(**options).load(path)
