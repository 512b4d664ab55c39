"""Explicit schemas of every source; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    """A struct of nullable string fields."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def extend(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    return T.StructType([*schema.fields, *fields])


# An Atom entry may carry several links.
FEED_ENTRY = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("link", T.ArrayType(strings("_href", "_rel"))),
    T.StructField("updated", T.StringType()),
])

FILING_COLUMNS = ("companyname", "formtype", "cik", "date", "inter_url")
FILING = strings(*FILING_COLUMNS)
FILING_ENRICHED_COLUMNS = (*FILING_COLUMNS, "formurl")
FILING_ENRICHED = strings(*FILING_ENRICHED_COLUMNS)

LEDGER = extend(
    FILING,
    T.StructField("snapshot_id", T.StringType()),
    T.StructField("epoch", T.LongType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("month", T.StringType()),
)

# Several batches merged into one run; the batch is a column of the files there.
LEDGER_RUNS = extend(
    FILING,
    T.StructField("snapshot_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("epoch", T.LongType()),
    T.StructField("run", T.StringType()),
    T.StructField("month", T.StringType()),
)

# Daily crawl records, in the declared order of the staged dataset.
STAGED_FILING = strings("cik", "date", "formtype", "inter_url", "companyname", "formurl")
STAGED_PARTITIONS = ("y", "m", "d")
STAGED_FILING_STORED = extend(
    STAGED_FILING,
    *[T.StructField(name, T.IntegerType()) for name in STAGED_PARTITIONS],
)

LANDING_PAGE = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("html", T.StringType()),
])

NOTIFICATION_REQUEST = T.StructType([
    T.StructField("to", T.ArrayType(T.StringType())),
    *strings("companyname", "formtype", "table").fields,
])
RENDER_REQUEST = T.StructType([
    T.StructField("formurl", T.StringType()),
    T.StructField("options", T.MapType(T.StringType(), T.StringType())),
    *strings("ticker", "date", "formtype").fields,
])
HTML_REQUEST = strings("html")

TAGS = T.ArrayType(strings("Key", "Value"))
INVENTORY = extend(strings("resource_id", "region"), T.StructField("tags", TAGS))
ATTACHMENTS = strings("parent_id", "child_id", "kind")
ACCOUNT_ALIASES = extend(strings("account"), T.StructField("aliases", T.ArrayType(T.StringType())))


_ELEMENTS = T.MapType(T.StringType(), T.StringType())

# Who did what where, of an audit record; for readers that need no more, as what is not declared is not parsed.
AUDIT_IDENTITY = extend(
    strings("id", "account", "region", "time"),
    T.StructField("detail", T.StructType([
        T.StructField("eventName", T.StringType()),
        T.StructField("userIdentity", extend(
            strings("arn", "principalId", "type", "userName"),
            T.StructField("sessionContext", T.StructType([
                T.StructField("sessionIssuer", strings("userName")),
            ])),
        )),
    ])),
)

# One audit record. What an event names as created is looked up by its rule, hence the maps.
AUDIT_EVENT = extend(
    T.StructType(AUDIT_IDENTITY.fields[:-1]),
    T.StructField("detail", extend(
        AUDIT_IDENTITY["detail"].dataType,
        T.StructField("responseElements", _ELEMENTS),
        T.StructField("requestParameters", _ELEMENTS),
    )),
)
