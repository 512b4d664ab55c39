"""Null checks over several columns."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_null(*names: str) -> Column:
    """True when at least one of the columns is null."""
    return functools.reduce(operator.or_, [F.col(name).isNull() for name in names])
