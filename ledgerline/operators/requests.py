"""Notification and render requests to outbox and manifest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.fixed_values import MISSING_HTML_MESSAGE, NOTIFICATION_TEMPLATE
from ledgerline.functions.nulls import any_null
from ledgerline.functions.payloads import base64_line, object_url, record_json, render_name

_NOTICE_FIELDS = ("companyname", "formtype", "table")
_RENDER_FIELDS = ("formurl", "options", "ticker", "date", "formtype")


def _is_recipient(name: Column) -> Column:
    return F.coalesce(name, F.lit("")) != ""


def _incomplete() -> Column:
    return any_null("to", *_NOTICE_FIELDS) | ~F.coalesce(F.exists("to", _is_recipient), F.lit(False))


def notification_outbox(requests: DataFrame, template: str = NOTIFICATION_TEMPLATE) -> DataFrame:
    """One row per recipient of every complete request, with its template data as JSON; blank recipients get none."""
    complete = requests.filter(~_incomplete())
    return complete.select(
        F.explode(F.filter("to", _is_recipient)).alias("recipient"),
        F.lit(template).alias("template"),
        record_json(_NOTICE_FIELDS).alias("template_data"),
    )


def notification_rejects(requests: DataFrame) -> DataFrame:
    """Requests that lack a field or any recipient; nothing is sent for them."""
    return requests.filter(_incomplete())


def render_manifest(
    requests: DataFrame, endpoint: str, bucket: str, slash: str | None = None
) -> DataFrame:
    """What each render request results in: object name, address, code and message.

    ``slash`` replaces slashes in the form type, which otherwise stay in the name.
    """
    bad = any_null(*_RENDER_FIELDS)
    name = render_name(F.col("ticker"), F.col("formtype"), F.col("date"), slash)
    named = requests.withColumn("filename", F.when(~bad, name))
    return named.select(
        "formurl",
        "filename",
        F.when(bad, F.lit("")).otherwise(object_url(endpoint, bucket, F.col("filename"))).alias("file_url"),
        F.when(bad, F.lit(400)).otherwise(F.lit(200)).alias("code"),
        F.when(bad, F.lit("missing field")).otherwise(F.lit("success")).alias("message"),
    )


def validate_html(requests: DataFrame) -> DataFrame:
    """Requests with ``status`` and ``error``: missing or empty HTML is refused."""
    empty = F.coalesce(F.col("html"), F.lit("")) == ""
    return requests.withColumn("status", F.when(empty, F.lit(400)).otherwise(F.lit(200))).withColumn(
        "error", F.when(empty, F.lit(MISSING_HTML_MESSAGE))
    )


def base64_payload(documents: DataFrame, content: str, name: str = "data") -> DataFrame:
    """Documents with their binary content as one line of base64."""
    return documents.withColumn(name, base64_line(F.col(content))).drop(content)
