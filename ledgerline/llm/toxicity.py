"""Toxicity by a classifier chain: categories are predicted one after another, the overall verdict last.

The links are logistic models over counts of vocabulary words and word beginnings, so that inflected words count. Each later link also sees the probabilities of the
categories before it; in training those are out-of-fold predictions, so that a link learns from what it will get.

``labels`` marks documents as toxic or not. Categories are weak labels made from it: a toxic document belongs to a
category if it has one of the category's seed words (``CATEGORIES``, a parameter), and to ``unlisted`` if it has none;
the last link learns the given label itself. The vocabulary is not the seeds but the words whose share differs most between toxic and other labelled
documents, by ``CERTAINTY`` standard errors at least and with ``SUPPORT`` documents. Of near copies in the sample (equal smallest hash of five words)
one trains, so that a family of copies with one label does not make its words toxic.

Training uses at most ``sample`` labelled rows, those first in the order of a hash of their id; all other work covers
every row and its whole text. A word is a run of letters, A-Z lower-cased; bytes beyond ASCII count as letters.

A null or empty text has no words and gets the score of a document without any. Equal texts get equal scores; repeated
and null ids are no matter when scoring, a null label or id does not train. Without any labelled row of either kind
there is nothing to learn and every score is 0. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.llm.near_dedup import shingle_sets
from ledgerline.llm.wordhash import Splitter, groups_of_texts, text_buffers

# fixed values: seed words of the categories
CATEGORIES = {
    "stupidity": ("idiot", "moron", "stupid", "dumb", "fool", "clown", "imbecile"),
    "worth": ("worthless", "pathetic", "loser", "useless", "failure"),
    "disgust": ("trash", "scum", "disgusting", "filth", "vermin", "garbage"),
}
UNLISTED, VERDICT = "unlisted", "toxic"
SAMPLE = 12_000
VOCABULARY = 256
FOLDS = 5
PREFIXES = (4, 5, 6)  # bytes
CERTAINTY = 4.5
SUPPORT = 4
RIDGE = 0.2
LIMIT = 0.5

_LETTERS = {*range(65, 91), *range(97, 123), *range(128, 256)}
NOT_LETTERS = tuple(byte for byte in range(256) if byte not in _LETTERS)


def word_hash(word: str) -> int:
    """The hash that the scan gives to a lower-case word."""
    data = word.encode()
    hashes, _, _, _ = Splitter(NOT_LETTERS, PREFIXES).words(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
    return int(hashes[0, 0])


@dataclass
class Chain:
    """Sorted vocabulary hashes and one weight row (bias first) per category and for the verdict."""

    names: list[str]
    vocabulary: np.ndarray
    weights: list[np.ndarray]

    def counts(self, splitter: Splitter, column: pa.Array) -> np.ndarray:
        """How often each vocabulary word is in each text."""
        hashes, _, _, bounds = splitter.words(*text_buffers(column))
        found = np.zeros((len(column), len(self.vocabulary)))
        if len(self.vocabulary) and len(hashes):
            for kind in hashes.T:
                at = np.minimum(np.searchsorted(self.vocabulary, kind), len(self.vocabulary) - 1)
                hit = np.flatnonzero(self.vocabulary[at] == kind)
                np.add.at(found, (np.searchsorted(bounds, hit, "right") - 1, at[hit]), 1.0)
        return found

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Probabilities, a column per category and the verdict last."""
        known = features(counts)
        if not self.weights:
            return np.zeros((len(known), len(self.names)))
        for weights in self.weights:
            known = np.column_stack([known, probability(known, weights)])
        return known[:, -len(self.names):]


def features(counts: np.ndarray) -> np.ndarray:
    return np.log1p(counts)


def probability(known: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(weights[0] + known @ weights[1:], -40, 40)))


def fit_link(known: np.ndarray, target: np.ndarray, ridge: float = RIDGE, steps: int = 40) -> np.ndarray:
    """Weights of a logistic model with a ridge penalty, by Newton's method."""
    rows = np.column_stack([np.ones(len(known)), known])
    weights = np.zeros(rows.shape[1])
    penalty = np.full(rows.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(rows @ weights, -40, 40)))
        slope = rows.T @ (target - p) - penalty * weights
        curve = (rows * (p * (1 - p) + 1e-9)[:, None]).T @ rows + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        move *= min(1.0, 5.0 / max(np.abs(move).max(), 1e-12))
        weights += move
        if np.abs(move).max() < 1e-6:
            break
    return weights


def fit_chain(counts: np.ndarray, targets: list[np.ndarray], folds: np.ndarray) -> list[np.ndarray]:
    """Weights of all links; each passes out-of-fold probabilities on to the next."""
    known, links = features(counts), []
    for target in targets:
        links.append(fit_link(known, target))
        ahead = np.empty(len(target))
        for fold in range(FOLDS):
            held = folds == fold
            ahead[held] = probability(known[held], fit_link(known[~held], target[~held]))
        known = np.column_stack([known, ahead])
    return links


def _with_sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``sign``, the smallest hash of five words in a row, which near copies mostly share."""
    splitter = Splitter()
    for whole in batches:
        for batch in groups_of_texts(whole, "text"):
            signs = [int(one[0].view(np.int64)) if len(one) else 0 for one in shingle_sets(splitter, batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signs, pa.int64())], [*batch.schema.names, "sign"])


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, toxic, clean``: in how many documents of a batch of each kind a word is."""
    splitter = Splitter(NOT_LETTERS, PREFIXES)
    for whole in batches:
        for batch in groups_of_texts(whole, "text"):
            hashes, _, _, bounds = splitter.words(*text_buffers(batch.column("text")))
            marks = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            owners = np.repeat(np.arange(len(marks)), np.diff(bounds))
            counts = pd.concat([pd.DataFrame({"doc": owners, "word": kind}).drop_duplicates() for kind in hashes.T])
            counts["toxic"] = marks[counts["doc"].to_numpy()]
            counts = counts.groupby("word", sort=False)["toxic"].agg(["sum", "count"])
            toxic = counts["sum"].to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.index.to_numpy().view(np.int64)), pa.array(toxic),
                 pa.array(counts["count"].to_numpy().astype(np.int64) - toxic)], ["word", "toxic", "clean"])


def _matrix(lists: pa.ChunkedArray, width: int, blank: int) -> np.ndarray:
    """Lists of one length as rows, and rows of zeros after them."""
    rows = np.zeros((len(lists) + blank, width))
    at = 0
    for chunk in lists.chunks:
        rows[at:at + len(chunk)] = chunk.flatten().to_numpy().reshape(len(chunk), width)
        at += len(chunk)
    return rows


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, size: int = VOCABULARY,
          categories: dict[str, tuple[str, ...]] = CATEGORIES) -> Chain:
    """The chain learnt from ``labels (doc_id, toxic)`` of ``docs (doc_id, text)``."""
    chosen = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most `sample` rows of two numbers each
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.select("doc_id", "toxic", "text").mapInArrow(_with_sign, "doc_id long, toxic int, text string, sign long")
    rows = rows.groupBy("sign").agg(F.min_by(F.struct("doc_id", "toxic", "text"), F.struct("doc_id", "text")).alias("row"))
    rows = session.cut(rows.select("row.*"), "toxicity-sample")
    kinds = {row.toxic: row["count"] for row in rows.groupBy("toxic").count().collect()}
    names = [*categories, UNLISTED, VERDICT]
    if not kinds.get(0) or not kinds.get(1):
        return Chain(names, np.zeros(0, dtype=np.uint64), [])
    words = rows.select("text", "toxic").mapInArrow(_word_rows, "word long, toxic long, clean long")
    words = words.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    pooled = (F.col("toxic") + F.col("clean") + 1.0) / (kinds[0] + kinds[1] + 2.0)
    apart = F.col("toxic") / kinds[1] - F.col("clean") / kinds[0]
    words = words.withColumn("z", F.abs(apart) / F.sqrt(pooled * (1 - pooled) * (1.0 / kinds[0] + 1.0 / kinds[1])))
    sure = words.where((F.col("z") >= CERTAINTY) & (F.col("toxic") + F.col("clean") >= SUPPORT))
    best = sure.orderBy(F.col("z").desc(), "word").limit(size).select("word").collect()
    vocabulary = np.sort(np.array([row.word for row in best], dtype=np.int64).view(np.uint64))

    seeds = [np.array(sorted(word_hash(word) for word in found), dtype=np.uint64) for found in categories.values()]
    chain, marker = Chain(names, vocabulary, []), Chain(names, np.sort(np.concatenate(seeds)), [])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(NOT_LETTERS, PREFIXES)
        for whole in batches:
            for batch in groups_of_texts(whole, "text"):
                found, marks = (kind.counts(splitter, batch.column("text")) for kind in (chain, marker))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("toxic"), pa.array(found.tolist(), pa.list_(pa.float64())),
                     pa.array(marks.tolist(), pa.list_(pa.float64()))], ["doc_id", "toxic", "counts", "marks"])

    seen = rows.mapInArrow(count, "doc_id long, toxic int, counts array<double>, marks array<double>")
    seen = seen.where("toxic = 1 or exists(counts, c -> c > 0)").orderBy("doc_id", "counts", "toxic").toArrow()
    # documents without any vocabulary word are one row, weighted by repetition at most `sample` times
    blank = kinds[0] + kinds[1] - seen.num_rows
    counts, marks = (_matrix(seen.column(name), width, blank) for name, width in (
        ("counts", len(vocabulary)), ("marks", len(marker.vocabulary))))
    toxic = np.concatenate([seen.column("toxic").to_numpy(), np.zeros(blank)]).astype(float)
    marks = marks > 0
    targets = [toxic * marks[:, np.isin(marker.vocabulary, own)].any(axis=1) for own in seeds]
    targets.append(toxic * ~marks.any(axis=1))
    chain.weights = fit_chain(counts, [*targets, toxic], np.arange(len(toxic)) % FOLDS)
    return chain


def score(docs: DataFrame, chain: Chain, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with the struct ``into``: a probability per category, and ``toxic``."""
    names = chain.names

    @F.arrow_udf("array<double>")
    def scored(column: pa.Array) -> pa.Array:
        splitter = Splitter(NOT_LETTERS, PREFIXES)
        batch = pa.RecordBatch.from_arrays([column], ["text"])
        parts = [chain.scores(chain.counts(splitter, part.column("text"))) for part in groups_of_texts(batch, "text")]
        flat = np.vstack(parts).ravel() if parts else np.zeros(0)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(names), dtype=np.int32)), pa.array(flat))

    got = scored(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    marked = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), got.alias("got"))
    found = F.struct(*[F.col("got")[i].alias(name) for i, name in enumerate(names)])
    return marked.select("row.*", found.alias(into))


def drop_toxic(docs: DataFrame, chain: Chain, limit: float = LIMIT, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose verdict reaches ``limit``, its own columns only."""
    wide = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
                       F.col(f"`{text}`").alias("text"))
    return score(wide, chain).where(F.col(f"toxicity.{VERDICT}") < limit).select("row.*")
