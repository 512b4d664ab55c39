"""Keeping costly expressions from being evaluated again for every filter on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is evaluated exactly once per row.

    The optimizer moves filters below projections by copying the projected expression into them, so a
    parsed document would be parsed once more per filter. It does not move them below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
