"""Rows to a declared schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """The declared columns in declared order and type: absent ones null, others dropped, some renamed.

    Casts are range-checked: a value that does not fit fails the job.
    """
    present = set(df.columns)
    names = aliases or {}
    return df.select(*[
        (F.col(field.name) if field.name in present else F.lit(None))
        .cast(field.dataType)
        .alias(names.get(field.name, field.name))
        for field in schema
    ])
