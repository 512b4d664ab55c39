"""From feed entries to routed messages, for one batch of entries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from ledgerline import session
from ledgerline.fixed_values import ROUTES, SITE_BASE, Route
from ledgerline.functions.html import LinkSection
from ledgerline.operators import enrich, feed, records, route
from ledgerline.schemas import FILING_COLUMNS


@dataclass(frozen=True)
class FilingBatch:
    """The outcomes of one batch, all lazy; ``rejected`` are the unusable entries it came with, if any."""

    fresh: DataFrame
    enriched: DataFrame
    routed: DataFrame
    rejected: DataFrame | None = None

    @property
    def messages(self) -> DataFrame:
        return route.route_messages(self.routed)

    @property
    def dropped(self) -> DataFrame:
        return enrich.dropped(self.enriched)

    @property
    def summary(self) -> DataFrame:
        return route.batch_summary(self.enriched)


def store_links(pages: DataFrame, section: LinkSection = LinkSection(), base: str = SITE_BASE) -> DataFrame:
    """The document links of crawled pages as a stored table: each page is searched once, not per batch."""
    return session.cut(enrich.page_links(pages, section, base), "page-links")


def deliver(fresh: DataFrame, links: DataFrame, routes: Sequence[Route] = ROUTES) -> FilingBatch:
    """Enrich and route filings that are already known to be new."""
    enriched = enrich.enrich(fresh, links)
    return FilingBatch(fresh, enriched, route.route_filings(enrich.survivors(enriched), routes))


def process_entries(
    entries: DataFrame, seen: DataFrame, links: DataFrame, routes: Sequence[Route] = ROUTES
) -> FilingBatch:
    """Parse a batch of entries, keep what was not seen, and deliver that."""
    fresh = records.fresh_records(feed.parse_entries(entries), seen, FILING_COLUMNS)
    return replace(deliver(fresh, links, routes), rejected=feed.rejected_entries(entries))
