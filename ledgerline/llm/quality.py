"""Quality scores by a regularised quadratic discriminant over document statistics.

Each class gets the mean and covariance of a dozen transformed statistics of its labelled documents. The covariance is
shrunk towards that of both classes together and towards its own diagonal; the Cholesky factor of each is computed once
and serves every row: the score is the logistic function of the difference of the two log-densities, each a Mahalanobis
distance by that factor, plus the log of the classes' shares. Densities of long-tailed statistics are made broad by a
floor on each variance.

Training reads counts, sums and sums of products that Spark adds up over all labelled rows that are not held out; the
driver gets one row per class. Scores use the text alone, never labels, language, source or id.

A null text is an empty one, and an empty text has statistics and a score like any other. Equal texts get equal scores.
Rows without id or label do not train. Without labelled rows of both classes every score is 0.5. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.wordhash import Splitter, groups_of_texts, text_buffers

STATISTICS = ("log_bytes", "log_words", "word_length", "long_words", "letters", "capitals", "digits", "marks", "symbols",
              "bars", "lines", "distinct_words", "repeated_next", "top_word")
SHRINK_POOLED = 0.10
SHRINK_DIAGONAL = 0.05
VARIANCE_FLOOR = 1e-3

_MARKS = tuple(b".,;:!?'\"()-")
_SPACES = (0x20, *range(0x09, 0x0E))


def _flags(members) -> np.ndarray:
    flags = np.zeros(256, dtype=np.uint8)
    flags[list(members)] = 1
    return flags


_KINDS = {
    "letters": _flags((*range(65, 91), *range(97, 123), *range(128, 256))),
    "capitals": _flags(range(65, 91)),
    "digits": _flags(range(48, 58)),
    "marks": _flags(_MARKS),
    "symbols": _flags(byte for byte in range(33, 127) if not chr(byte).isalnum() and byte not in (*_MARKS, ord("|"))),
    "bars": _flags((ord("|"),)),
    "lines": _flags((10,)),
}


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The logit of a share, with half a count added to either side."""
    return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))


def statistics(splitter: Splitter, column: pa.Array) -> np.ndarray:
    """The transformed statistics of each text, a column for each of ``STATISTICS``."""
    data, offsets = text_buffers(column)
    sizes = np.diff(offsets).astype(float)
    texts = data[offsets[0]:offsets[-1]]
    bounds_of = offsets - offsets[0]
    totals = {}
    for name, flags in _KINDS.items():
        sums = np.concatenate(([0], np.cumsum(flags[texts], dtype=np.int64)))
        totals[name] = np.diff(sums[bounds_of]).astype(float)
    hashes, _, lengths, bounds = splitter.words(data, offsets)
    words = np.diff(bounds)
    n = words.astype(float)
    owner = np.repeat(np.arange(len(words)), words)
    long_words = np.bincount(owner, weights=lengths > 12, minlength=len(words))
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    repeats = np.bincount(owner, weights=same, minlength=len(words))
    order = np.lexsort((hashes, owner))
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    heads = np.flatnonzero(new)
    distinct = np.bincount(owner[order][heads], minlength=len(words)).astype(float)
    runs = np.diff(np.append(heads, len(hashes)))
    top = np.zeros(len(words))
    np.maximum.at(top, owner[order][heads], runs)
    return np.column_stack([
        np.log1p(sizes), np.log1p(n), np.log1p(lengths_mean(lengths, owner, words)), _share(long_words, n),
        *(_share(totals[name], sizes) for name in ("letters", "capitals", "digits", "marks", "symbols", "bars", "lines")),
        _share(distinct, n), _share(repeats, n), _share(top, n)])


def lengths_mean(lengths: np.ndarray, owner: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.bincount(owner, weights=lengths, minlength=len(words)) / np.maximum(words, 1)


@dataclass
class Discriminant:
    """Per class its mean, the Cholesky factor of its covariance and the constant of its log-density."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(rows), 0.5)
        densities = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants, strict=True):
            solved = np.linalg.solve(factor, (rows - mean).T)
            densities.append(constant - 0.5 * (solved * solved).sum(axis=0))
        return 1.0 / (1.0 + np.exp(-np.clip(densities[1] - densities[0], -60, 60)))


def discriminant(counts: list[float], sums: list[np.ndarray], products: list[np.ndarray]) -> Discriminant:
    """The model of classes 0 and 1 from their counts, sums and sums of products."""
    if min(counts) < 2:
        return Discriminant([], [], [])
    means = [total / n for total, n in zip(sums, counts, strict=True)]
    own = [product / n - np.outer(mean, mean) for product, n, mean in zip(products, counts, means, strict=True)]
    pooled = sum(cov * n for cov, n in zip(own, counts, strict=True)) / sum(counts)
    factors, constants = [], []
    for cov, n in zip(own, counts, strict=True):
        # few rows lean more on the classes together
        share = SHRINK_POOLED + (1 - SHRINK_POOLED) * len(cov) / (len(cov) + n)
        shrunk = (1 - share) * cov + share * pooled
        shrunk = (1 - SHRINK_DIAGONAL) * shrunk + SHRINK_DIAGONAL * np.diag(np.diag(shrunk))
        shrunk += VARIANCE_FLOOR * np.eye(len(cov))
        factor = np.linalg.cholesky(shrunk)
        factors.append(factor)
        constants.append(float(np.log(n / sum(counts)) - np.log(np.diag(factor)).sum()))
    return Discriminant(means, factors, constants)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: a third, by the CRC of the id's digits."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def described(docs: DataFrame, text: str = "text", into: str = "statistics") -> DataFrame:
    """``docs`` with the array ``into`` of each text's statistics."""

    @F.arrow_udf("array<double>")
    def measured(column: pa.Array) -> pa.Array:
        splitter = Splitter()
        batch = pa.RecordBatch.from_arrays([column], ["text"])
        parts = [statistics(splitter, part.column("text")) for part in groups_of_texts(batch, "text")]
        flat = np.vstack(parts).ravel() if parts else np.zeros(0)
        ends = np.arange(0, len(flat) + 1, len(STATISTICS), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return docs.withColumn(into, measured(F.coalesce(F.col(f"`{text}`"), F.lit(""))))


def _rows_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``quality, at, total``: per task and class the count, sums and products, one number a row."""
    side = len(STATISTICS) + 1
    total = np.zeros((2, side, side))
    for batch in batches:
        rows, quality = _rows_of(batch.column("statistics")), batch.column("quality").to_numpy(zero_copy_only=False)
        for label in (0, 1):
            own = np.column_stack([np.ones((quality == label).sum()), rows[quality == label]])
            total[label] += own.T @ own
    for label in (0, 1):
        flat = total[label].ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(flat), label, dtype=np.int32)), pa.array(np.arange(len(flat), dtype=np.int32)),
             pa.array(flat)], ["quality", "at", "total"])


def train(measured: DataFrame, labels: DataFrame) -> Discriminant:
    """The model learnt from ``labels (doc_id, quality)`` of ``measured (doc_id, statistics)``, without held-out rows.

    What is joined are ids and statistics; texts are not shuffled.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    rows = measured.where(~held_out(F.col("doc_id"))).select("doc_id", "statistics").join(known, "doc_id")
    moments = rows.select("quality", "statistics").mapInArrow(_moments, "quality int, at int, total double")
    sums = moments.groupBy("quality", "at").agg(F.sum("total").alias("total")).collect()
    side = len(STATISTICS) + 1
    total = np.zeros((2, side * side))
    for row in sums:
        total[row["quality"], row["at"]] = row["total"]
    total = total.reshape(2, side, side)
    return discriminant([float(one[0, 0]) for one in total], [one[0, 1:] for one in total], [one[1:, 1:] for one in total])


def score(measured: DataFrame, model: Discriminant, statistics: str = "statistics", into: str = "quality_score") -> DataFrame:
    """``measured`` with the probability ``into`` of good quality."""

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return pa.array(model.scores(_rows_of(column)))

    return measured.withColumn(into, scored(F.col(f"`{statistics}`")))
