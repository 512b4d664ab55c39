"""JSON and binary payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.fixed_values import RENDER_NAME_FORMAT

_KEEP_NULLS = {"ignoreNullFields": "false"}


def record_json(columns: Sequence[str]) -> Column:
    """One JSON object with every column, nulls included, in the given order."""
    return F.to_json(F.struct(*columns), _KEEP_NULLS)


def array_json(records: Column) -> Column:
    """A JSON array from an array of structs, nulls included."""
    return F.to_json(records, _KEEP_NULLS)


def parse_array(body: Column, schema: T.StructType) -> Column:
    """The objects of a JSON array; null unless the whole text is exactly one array of objects.

    The text is parsed as the value of an object, so that a single object instead of an array, or
    anything after the array, makes it invalid rather than being read leniently.
    """
    wrapped = F.concat(F.lit('{"items":'), body, F.lit("}"))
    parsed = F.from_json(wrapped, T.StructType([T.StructField("items", T.ArrayType(schema))]))
    # As the one element of an array the list can be tested and returned without parsing it twice.
    whole = F.filter(F.array(parsed["items"]), lambda items: ~F.exists(items, lambda item: item.isNull()))
    return F.get(whole, F.lit(0))


def is_json(body: Column) -> Column:
    """True when the text parses as JSON of any shape."""
    return F.try_parse_json(body).isNotNull()


def base64_line(content: Column) -> Column:
    """Base64 without the line breaks Spark inserts every 76 characters."""
    return F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))


def render_name(ticker: Column, form_type: Column, date: Column, slash: str | None = None) -> Column:
    """Object name of a rendered filing. ``slash`` optionally replaces slashes in the form type."""
    form = form_type if slash is None else F.replace(form_type, F.lit("/"), F.lit(slash))
    return F.format_string(RENDER_NAME_FORMAT, ticker, form, date)


def object_url(endpoint: str, bucket: str, key: Column) -> Column:
    return F.concat_ws("/", F.lit(endpoint), F.lit(bucket), key)
