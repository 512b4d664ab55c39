"""Document links for filings, from crawled landing pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.fixed_values import PAGE_OK_STATUSES, SITE_BASE
from ledgerline.functions.html import LinkSection, first_text_anchor, link_target
from ledgerline.schemas import FILING_ENRICHED_COLUMNS

OK, HTTP_ERROR, NO_LINK, NO_PAGE = "ok", "http_error", "no_link", "no_page"


def page_links(pages: DataFrame, section: LinkSection = LinkSection(), base: str = SITE_BASE) -> DataFrame:
    """One row per page address: ``(url, page_outcome, formurl)``.

    The page text does not travel beyond the scan, and the anchor is found in a step of its own, so that
    it is searched for once per page. Copies of a page are merged, a link winning over none.
    """
    good = F.col("status").isin(*PAGE_OK_STATUSES)
    anchored = pages.select(
        "url", "status", F.when(good, first_text_anchor(F.col("html"), section)).alias("anchor")
    )
    linked = anchored.withColumn("formurl", F.concat(F.lit(base), link_target(F.col("anchor"))))
    outcome = (
        F.when(~F.coalesce(good, F.lit(False)), F.lit(HTTP_ERROR))
        .when(F.col("formurl").isNull(), F.lit(NO_LINK))
        .otherwise(F.lit(OK))
    )
    found = linked.select("url", F.struct((outcome != OK).alias("worse"), outcome.alias("page_outcome"),
                                          "formurl").alias("page"))
    best = found.groupBy("url").agg(F.min("page").alias("page"))
    return best.select("url", "page.page_outcome", "page.formurl")


def enrich(filings: DataFrame, links: DataFrame) -> DataFrame:
    """Every filing with ``formurl`` and ``enrich_status``.

    ``links`` is the stored outcome of ``page_links``. As a stored table it is unique and shuffled by the
    join itself (if it is not small enough to be broadcast), which is what lets adaptive execution split
    the filings of a hot page; a grouping right below the join would prevent that.
    """
    joined = filings.join(links, filings["inter_url"] == links["url"], "left")
    return joined.select(
        *[filings[name] for name in filings.columns],
        links["formurl"],
        F.coalesce(links["page_outcome"], F.lit(NO_PAGE)).alias("enrich_status"),
    )


def survivors(enriched: DataFrame) -> DataFrame:
    """Filings that go on: those with a link, and those whose page answered with an error (null link)."""
    kept = enriched.filter(F.col("enrich_status").isin(OK, HTTP_ERROR))
    return kept.select(*FILING_ENRICHED_COLUMNS)


def dropped(enriched: DataFrame) -> DataFrame:
    """Filings that do not go on, with the reason."""
    return enriched.filter(F.col("enrich_status").isin(NO_LINK, NO_PAGE)).drop("formurl")
