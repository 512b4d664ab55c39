"""The head of a long-tailed count table: few rows, whatever the size of the table, that stand for most occurrences."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 16


def head_of(counts: DataFrame, column: str, limit: int) -> Column:
    """A condition that holds for at most ``limit`` rows of ``counts``, those with the largest values of ``column``.

    The rows are counted by value on a logarithmic scale, some hundred steps for any values. Rows of one step stay
    together, so the head can be smaller than ``limit``; where the first step is too large it is empty.
    """
    step = F.floor(F.log2(F.greatest(F.col(column).cast("double"), F.lit(1.0))) * STEPS)
    sizes = sorted(((row["step"], row["rows"]) for row in counts.groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("rows")).where("step is not null").collect()), reverse=True)
    lowest, total = 64 * STEPS + 1, 0
    for at, rows in sizes:
        total += rows
        if total > limit:
            break
        lowest = at
    return F.coalesce(step >= lowest, F.lit(False))


class Search:
    """Finds 64-bit hashes among sorted ones in a few steps each: the upper bits say where to look."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(1, len(keys).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.first = np.concatenate(([0], np.cumsum(np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits))))

    def places(self, wanted: np.ndarray) -> np.ndarray:
        """Where each hash is, -1 where it is not among the keys."""
        cell = (wanted >> self.shift).astype(np.int64)
        at, stop = self.first[cell], self.first[cell + 1]
        found = np.full(len(wanted), -1)
        rows = np.flatnonzero(at < stop)
        here = at[rows]
        while len(rows):
            hit = self.keys[here] == wanted[rows]
            found[rows[hit]] = here[hit]
            on = ~hit & (here + 1 < stop[rows])
            rows, here = rows[on], here[on] + 1
        return found
