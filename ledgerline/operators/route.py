"""Routing filings by form type, and the messages each destination gets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.fixed_values import ROUTES, SUMMARY_FORMAT, Route
from ledgerline.functions.payloads import record_json
from ledgerline.operators.enrich import HTTP_ERROR, OK
from ledgerline.schemas import FILING_ENRICHED_COLUMNS


def _by_form(routes: Sequence[Route], attribute: str) -> Column:
    return F.coalesce(*[
        F.when(F.col("formtype") == route.form_type, F.lit(getattr(route, attribute))) for route in routes
    ])


def route_filings(filings: DataFrame, routes: Sequence[Route] = ROUTES) -> DataFrame:
    """Filings whose form type has a destination, by exact match (an amendment has none)."""
    wanted = filings.filter(F.col("formtype").isin(*[route.form_type for route in routes]))
    return wanted.withColumn("route", _by_form(routes, "name")).withColumn("title", _by_form(routes, "title"))


def route_messages(routed: DataFrame, columns: Sequence[str] = FILING_ENRICHED_COLUMNS) -> DataFrame:
    """The outbox ``(route, title, body)``: one JSON object per record.

    A destination's message is its records. Written by route, that is its partition; a destination without records has
    none. Nothing is collected or shuffled, however much one destination gets.
    """
    return routed.select("route", "title", record_json(columns).alias("body"))


def summary_counts() -> list[Column]:
    """What a summary counts of enriched filings; for an aggregate, or for observing a pass that writes them."""
    return [
        F.count(F.lit(1)).alias("new_filings"),
        F.count_if(F.col("enrich_status").isin(OK, HTTP_ERROR)).alias("processed"),
    ]


def batch_summary(enriched: DataFrame) -> DataFrame:
    """One row about a batch: new filings, processed filings, whether the state changed, and the result line."""
    return summary_of(enriched.agg(*summary_counts()))


def summary_of(counts: DataFrame) -> DataFrame:
    """The summary row of counts that were taken before."""
    return counts.select(
        "new_filings",
        "processed",
        (F.col("new_filings") > 0).alias("state_changed"),
        F.format_string(SUMMARY_FORMAT, F.col("processed")).alias("body"),
    )
