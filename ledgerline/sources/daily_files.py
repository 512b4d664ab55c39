"""Daily raw files: every file is one JSON array of records below a ``yyyymmdd/`` folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.once import with_once
from ledgerline.functions.payloads import is_json, parse_array
from ledgerline.schemas import STAGED_FILING, strings

MALFORMED = "malformed"
WRONG_SHAPE = "not_an_array_of_objects"
RECORDS, QUARANTINE = "records", "quarantine"
_ANY_DAY = "[0-9]" * 8


def _day_of(path: Column) -> Column:
    return F.regexp_extract(path, r"(\d{8})/[^/]*$", 1)


def _whole_files(raw: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    return raw.select(path.alias("source_file"), _day_of(path).alias("ymd"), F.col("value").alias("body"))


def read_files(spark: SparkSession, root: str, ymd: str | None = None, prefix: str = "") -> DataFrame:
    """One row per file, of one day or (default) of every day folder below ``root``.

    ``prefix`` is what the folder names have in front of the day, such as ``ymd=``. A day without a
    folder has no files.
    """
    folder = f"{root}/{prefix}{ymd or _ANY_DAY}"
    try:
        raw = spark.read.text(folder, wholetext=True)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], strings("source_file", "ymd", "body"))
    return _whole_files(raw)


def stream_files(spark: SparkSession, root: str, prefix: str = "", **options: str) -> DataFrame:
    """One row per newly landed file, of all day folders. ``options`` may bound a batch (``jobs.admission``)."""
    reader = spark.readStream.format("text").option("wholetext", True).options(**options)
    return _whole_files(reader.load(f"{root}/{prefix}{_ANY_DAY}"))


def land_files(payloads: DataFrame, root: str) -> None:
    """Write ``(ymd, body)`` rows as one file each, in folders ``ymd=yyyymmdd``."""
    writer = payloads.select("ymd", "body").write.option("maxRecordsPerFile", 1).partitionBy("ymd")
    writer.text(root)


def parse_files(files: DataFrame, schema: T.StructType = STAGED_FILING) -> DataFrame:
    """Parse every file whole: ``items`` holds its records, or ``reason`` says why it has none."""
    parsed = with_once(files, "items", parse_array(F.col("body"), schema))
    reason = F.when(
        F.col("items").isNull(),
        F.when(is_json(F.col("body")), F.lit(WRONG_SHAPE)).otherwise(F.lit(MALFORMED)),
    )
    return parsed.withColumn("reason", reason)


def records(parsed: DataFrame) -> DataFrame:
    """The records of all readable files, one row each, with the day folder they came from."""
    return parsed.select("ymd", F.inline("items"))


def quarantine(parsed: DataFrame) -> DataFrame:
    """The unreadable files, kept whole with the reason."""
    return parsed.filter(F.col("reason").isNotNull()).select("source_file", "ymd", "reason", "body")


def outcomes(parsed: DataFrame) -> DataFrame:
    """Records and unreadable files in one set of rows, told apart by ``outcome``.

    For writing both in a single pass over the files: ``partitionBy("outcome")``.
    """
    some = parsed.filter(F.col("reason").isNotNull() | (F.size("items") > 0))
    bad = F.col("reason").isNotNull()
    return some.select(
        F.when(bad, F.lit(QUARANTINE)).otherwise(F.lit(RECORDS)).alias("outcome"),
        "source_file",
        "ymd",
        "reason",
        F.when(bad, F.col("body")).alias("body"),
        F.inline_outer("items"),
    )


def require_arrays(parsed: DataFrame) -> DataFrame:
    """Strict variant: valid JSON of the wrong shape fails the job instead of being set aside."""
    checked = F.when(F.col("reason") == WRONG_SHAPE, F.raise_error(
        F.concat(F.lit("not a JSON array of objects: "), F.col("source_file")))).otherwise(F.col("reason"))
    return parsed.withColumn("reason", checked.cast("string"))
