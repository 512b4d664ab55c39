"""Feed entries to filing records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.fixed_values import FEED_PAGE_SIZE
from ledgerline.functions.once import with_once
from ledgerline.functions.times import entry_time
from ledgerline.functions.titles import is_filing_title, title_groups, title_part


def _judged(entries: DataFrame) -> DataFrame:
    """Entries with what was read from them and the first thing that is wrong with them, if any."""
    read = with_once(entries, "read", F.struct(
        title_groups(F.col("title")).alias("groups"), entry_time(F.col("updated")).alias("date")
    ))
    reason = (
        F.when(F.col("link").isNull(), F.lit("no_link"))
        .when(~is_filing_title(F.col("read.groups")) | F.col("title").isNull(), F.lit("bad_title"))
        .when(F.col("read.date").isNull(), F.lit("bad_time"))
    )
    return read.withColumn("reason", reason)


def parse_entries(entries: DataFrame, *keep: str) -> DataFrame:
    """Filing records of all usable entries; ``keep`` names entry columns to carry along."""
    usable = _judged(entries).filter(F.col("reason").isNull())
    return usable.select(
        *keep,
        title_part(F.col("read.groups"), "companyname").alias("companyname"),
        title_part(F.col("read.groups"), "formtype").alias("formtype"),
        title_part(F.col("read.groups"), "cik").alias("cik"),
        F.col("read.date").alias("date"),
        F.col("link").alias("inter_url"),
    )


def rejected_entries(entries: DataFrame) -> DataFrame:
    """The entries ``parse_entries`` leaves out, with the reason."""
    return _judged(entries).filter(F.col("reason").isNotNull()).drop("read")


def latest_page(
    filings: DataFrame,
    size: int = FEED_PAGE_SIZE,
    tie_break: str = "cik",
    start: int = 0,
    entity: str | None = None,
    form_type: str | None = None,
) -> DataFrame:
    """The newest filings from place ``start`` on, as one feed page shows them, of an entity or form type if named."""
    for column, wanted in (("cik", entity), ("formtype", form_type)):
        if wanted is not None:
            filings = filings.filter(F.col(column) == wanted)
    return filings.orderBy(F.desc("date"), F.desc(tie_break)).offset(start).limit(size)
