"""Landed feed files: Atom documents with one row per ``<entry>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.schemas import FEED_ENTRY

_ENTRY = {"rowTag": "entry"}


def _main_link(links: Column) -> Column:
    """The target of the entry's main link: the first one that is an alternate or says nothing."""
    main = F.filter(links, lambda link: F.coalesce(link["_rel"], F.lit("alternate")) == "alternate")
    return F.get(main, F.lit(0))["_href"]


def _entries(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("entry_id"),
        "title",
        _main_link(F.col("link")).alias("link"),
        "updated",
        F.col("_metadata.file_path").alias("snapshot_file"),
        F.col("_metadata.file_modification_time").alias("snapshot_time"),
    )


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """All entries of the landed feed files, with the file they came in."""
    return _entries(spark.read.format("xml").options(**_ENTRY).schema(FEED_ENTRY).load(path))


def stream_feed(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same entries as a stream; every landed file is one poll. ``options`` may bound a batch (``jobs.admission``)."""
    reader = spark.readStream.format("xml").options(**_ENTRY, **options).schema(FEED_ENTRY)
    return _entries(reader.load(path))


def land_feed(entries: DataFrame, path: str) -> None:
    """Write entries (``entry_id, title, link, updated``) as Atom files."""
    link = F.when(
        F.col("link").isNotNull(),
        F.array(F.struct(F.col("link").alias("_href"), F.lit("alternate").alias("_rel"))),
    )
    shaped = entries.select(F.col("entry_id").alias("id"), "title", link.alias("link"), "updated")
    shaped.write.format("xml").options(rootTag="feed", **_ENTRY).save(path)
