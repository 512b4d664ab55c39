"""Secret scanning with a random forest that removes false positives.

A candidate is a run of at least ``SHORTEST`` characters that a credential can consist of, or the whole value, whatever
signs and length it has, that a word such as "password" or "token" and a colon or equals sign announce; runs within such
a value are part of it. The forest judges a candidate by

* its length, the kinds of characters in it and their entropy,
* its character transitions: how likely each is among the words of all documents, and how often the kind changes,
* its dictionary coverage: the share of its characters that lie in one of the corpus's most frequent words,
* paths: slashes, dots and extensions in it and around it, and
* the words next to it, hashed to ``NEIGHBOURS`` kinds on either side, and the signs between.

It is trained from labelled findings, at most ``sample`` of them; :func:`label_findings` derives labels where a format
or an assignment settles the matter, and a caller may bring labels of their own. So that the forest does not just learn
the rule that labelled them, half of the findings train with everything around them hidden: those are judged by the value
alone, as a credential that nothing announces has to be. The transition table and the dictionary come from all documents.
Both have a fixed size.

Null and empty texts have no candidates. Repeated rows have theirs each; ids may be null. A text that is one long run is
one candidate, read as a whole. Without labelled findings of either kind every score is 0. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.llm.wordhash import Splitter, groups_of_texts, text_buffers

SHORTEST = 12
AROUND = 32
SAMPLE = 20_000
TREES, DEPTH = 40, 8
DICTIONARY = 20_000
WORD_SIZES = range(4, 11)
SYMBOLS = 40

_CANDIDATE = re.compile(r"(?<![\w+/\-])[A-Za-z0-9_+/\-]{%d,}={0,2}(?!\w)" % SHORTEST)
# fixed values: words that announce a credential, and formats that are one by themselves
_ANNOUNCES = re.compile(r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential)s?\W*$")
_FORMATS = re.compile(r"(AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk_live_[0-9A-Za-z]{24,}|xox[abp]-[0-9A-Za-z-]{20,}")
_PLAIN = re.compile(r"[A-Za-z_/\-]+|\d+")
_ASSIGNED = re.compile(r"[=:]\s*[\"']?$")
_EXTENSION = re.compile(r"^\.[A-Za-z]{1,4}\b")
# an announced assignment: what stands before its sign, and its value, which ends with its quote or else with white space
_SIGN = re.compile("[=:]")
_ANNOUNCED = re.compile(
    r"(?i)(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential)s?[\"']?\s{0,4}$")
_VALUE = re.compile(r"(?:=>?|:=?)\s{0,4}(?:\"(?P<a>[^\"\n]{4,256})\"|'(?P<b>[^'\n]{4,256})'|(?P<c>[^\s\"'<>]{4,}))")
_WORD_BEFORE, _WORD_AFTER = re.compile(r"([^\W\d_]+)\W*$"), re.compile(r"\W*([^\W\d_]+)")

NEIGHBOURS = 8
VALUE_FEATURES = ("length", "digits", "capitals", "letters", "signs", "hex", "entropy", "likelihood", "changes", "coverage",
                  "slashes")
FEATURES = (*VALUE_FEATURES, "path_before", "extension", "announced", "assigned", "quoted", "word_before", "word_after",
            *(f"before_{k}" for k in range(NEIGHBOURS)), *(f"after_{k}" for k in range(NEIGHBOURS)))

# character classes of the transition table: 26 letters, 10 digits, other signs, beyond ASCII, space
_CLASSES = np.full(256, 36, dtype=np.int64)
_CLASSES[128:] = 37
_CLASSES[[9, 10, 11, 12, 13, 32]] = 38
for _k in range(26):
    _CLASSES[[65 + _k, 97 + _k]] = _k
for _k in range(10):
    _CLASSES[48 + _k] = 26 + _k
_NOT_LETTERS = tuple(byte for byte in range(256) if not (65 <= byte <= 90 or 97 <= byte <= 122 or byte >= 128))


@dataclass
class Corpus:
    """What the scan knows of ordinary text: log-probabilities of transitions, sorted hashes of frequent words."""

    transitions: np.ndarray
    dictionary: np.ndarray


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``at, n``: counts of neighbouring character classes, one table a task."""
    counts = np.zeros(SYMBOLS * SYMBOLS, dtype=np.int64)
    for whole in batches:
        for batch in groups_of_texts(whole, "text"):
            data, offsets = text_buffers(batch.column("text"))
            kinds = _CLASSES[data[offsets[0]:offsets[-1]]]
            counts += np.bincount(kinds[:-1] * SYMBOLS + kinds[1:], minlength=len(counts))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts), dtype=np.int32)), pa.array(counts)], ["at", "n"])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n``: words of a dictionary's sizes, counted within slices of a batch."""
    splitter = Splitter(_NOT_LETTERS)
    for whole in batches:
        for batch in groups_of_texts(whole, "text"):
            hashes, _, lengths, _ = splitter.words(*text_buffers(batch.column("text")))
            fits = (lengths >= WORD_SIZES[0]) & (lengths <= WORD_SIZES[-1])
            words, counts = np.unique(hashes[fits], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts.astype(np.int64))], ["word", "n"])


def corpus_of(docs: DataFrame) -> Corpus:
    """Transitions and dictionary of all documents ``(text)``."""
    texts = docs.select("text")
    rows = texts.mapInArrow(_transitions, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    counts = np.ones((SYMBOLS, SYMBOLS))
    for row in rows:
        counts[divmod(row["at"], SYMBOLS)] += row["n"]
    words = texts.mapInArrow(_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    best = words.orderBy(F.desc("n"), "word").limit(DICTIONARY).select("word").collect()
    known = np.sort(np.array([row["word"] for row in best], dtype=np.int64).view(np.uint64))
    return Corpus(np.log(counts / counts.sum(axis=1, keepdims=True)), known)


def candidate_spans(text: str) -> list[tuple[int, int]]:
    """Where the candidates of a text are, in order: announced values, and runs that do not meet any."""
    announced: list[tuple[int, int]] = []
    for sign in _SIGN.finditer(text):
        at = sign.start()
        if (not announced or announced[-1][1] <= at) and _ANNOUNCED.search(text, max(0, at - AROUND), at):
            value = _VALUE.match(text, at)
            if value:
                announced.append(value.span(value.lastgroup))
    found, at = list(announced), 0
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        while at < len(announced) and announced[at][1] <= a:
            at += 1
        if at == len(announced) or announced[at][0] >= b:
            found.append((a, b))
    return sorted(found) if announced else found


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, start, length, value, before, after`` of all candidates."""
    for batch in batches:
        ids, rows = batch.column("doc_id").to_pylist(), []
        for doc_id, one in zip(ids, batch.column("text"), strict=True):
            text = one.as_py() or ""
            for a, b in candidate_spans(text):
                rows.append((doc_id, a, b - a, text[a:b], text[max(0, a - AROUND):a], text[b:b + AROUND]))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        types = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                         ["doc_id", "start", "length", "value", "before", "after"])


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, start, length, value, before, after``: a row per candidate."""
    named = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return named.mapInArrow(_found, "doc_id long, start int, length int, value string, before string, after string")


def describe(corpus: Corpus, values: list[str], lengths: list[int], before: list[str], after: list[str]) -> np.ndarray:
    """The ``FEATURES`` of candidates."""
    joined = [value.encode("ascii", "replace") for value in values]
    data = np.frombuffer(b" ".join(joined) + b" ", dtype=np.uint8)
    ends = np.cumsum([len(value) + 1 for value in joined])
    firsts = ends - [len(value) + 1 for value in joined]
    covered = np.zeros(len(data), dtype=bool)
    splitter = Splitter()
    for size in WORD_SIZES:
        if len(data) < size or not len(corpus.dictionary):
            break
        hashes = splitter.runs(data, size)
        at = np.minimum(np.searchsorted(corpus.dictionary, hashes), len(corpus.dictionary) - 1)
        for start in np.flatnonzero(corpus.dictionary[at] == hashes):
            covered[start:start + size] = True
    kinds = _CLASSES[data]
    odds = np.concatenate([corpus.transitions[kinds[:-1], kinds[1:]], [0.0]])
    rough = np.select([kinds < 26, kinds < 36], [np.where(data >= 97, 0, 1), 2], 3)
    rows = np.zeros((len(values), len(FEATURES)))
    for i, (value, a, b) in enumerate(zip(values, firsts.tolist(), (ends - 1).tolist(), strict=True)):
        n = b - a
        own, chars = rough[a:b], np.bincount(data[a:b], minlength=128).astype(float)
        share = chars[chars > 0] / n
        word_before, word_after = _WORD_BEFORE.search(before[i]), _WORD_AFTER.match(after[i])
        rows[i] = (
            np.log(lengths[i]), (own == 2).mean(), (own == 1).mean(), (own < 2).mean(), (own == 3).mean(),
            float(all(c in "0123456789abcdefABCDEF" for c in value)), -(share * np.log2(share)).sum(),
            odds[a:b - 1].mean(), (own[1:] != own[:-1]).mean(), covered[a:b].mean(), value.count("/"),
            float(before[i][-1:] in ("/", ".", "\\", "@") or "://" in before[i].rpartition(" ")[2]),
            float(bool(_EXTENSION.match(after[i]))), float(bool(_ANNOUNCES.search(before[i]))),
            float(bool(_ASSIGNED.search(before[i]))), float(before[i][-1:] in ("'", '"') and after[i][:1] in ("'", '"')),
            len(word_before[1]) if word_before else 0, len(word_after[1]) if word_after else 0, *[0.0] * (2 * NEIGHBOURS))
        for word, first in ((word_before, len(FEATURES) - 2 * NEIGHBOURS), (word_after, len(FEATURES) - NEIGHBOURS)):
            if word:
                rows[i, first + zlib.crc32(word[1].lower().encode("utf-8", "replace")) % NEIGHBOURS] = 1.0
    return rows


def described(found: DataFrame, corpus: Corpus) -> DataFrame:
    """Candidates with the array ``features``."""

    @F.arrow_udf("array<double>")
    def features(value: pa.Array, length: pa.Array, before: pa.Array, after: pa.Array) -> pa.Array:
        rows = describe(corpus, value.to_pylist(), length.to_pylist(), before.to_pylist(), after.to_pylist())
        ends = np.arange(0, rows.size + 1, len(FEATURES), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))

    return found.withColumn("features", features("value", "length", "before", "after"))


def label_findings(found: DataFrame) -> DataFrame:
    """Candidates with ``label``: 1 where a known format or an announced assignment shows a credential, 0 for words, paths
    of words and plain numbers that nothing announces, null where neither settles it."""

    @F.arrow_udf("int")
    def label(value: pa.Array, before: pa.Array) -> pa.Array:
        out = []
        for one, left in zip(value.to_pylist(), before.to_pylist(), strict=True):
            announced = bool(_ANNOUNCES.search(left)) and bool(_ASSIGNED.search(left))
            mixed = bool(re.search(r"\d", one)) and bool(re.search(r"[A-Za-z]", one))
            if _FORMATS.fullmatch(one) or (announced and mixed):
                out.append(1)
            else:
                out.append(0 if not _ANNOUNCES.search(left) and (_PLAIN.fullmatch(one)) else None)
        return pa.array(out, pa.int32())

    return found.withColumn("label", label("value", "before"))


def train(labelled: DataFrame, sample: int = SAMPLE, seed: int = 11):
    """The forest learnt from ``features`` and ``label``; None if a kind is missing.

    Half of the sample is kept for either kind; both are picked by a hash of the finding. Of either kind, findings with an
    odd hash train without what stands around them.
    """
    known = labelled.where("label is not null").select("features", F.col("label").cast("double").alias("label"),
                                                       F.xxhash64("value", "before", "after").alias("h"))
    # at most `sample` rows, in one fixed order, so that the forest does not depend on how the table is split
    parts = [known.where(F.col("label") == kind).orderBy("h", "features").limit(sample // 2) for kind in (0.0, 1.0)]
    rows = session.cut(parts[0].unionByName(parts[1]).coalesce(1).sortWithinPartitions("h", "features"), "secret-sample")
    if {row["label"] for row in rows.select("label").distinct().collect()} != {0.0, 1.0}:
        return None
    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=seed)
    alone = F.concat(F.slice("features", 1, len(VALUE_FEATURES)),
                     F.array_repeat(F.lit(0.0), len(FEATURES) - len(VALUE_FEATURES)))
    shown = F.when(F.pmod("h", F.lit(2)) == 1, alone).otherwise(F.col("features"))
    return forest.fit(rows.withColumn("vector", array_to_vector(shown)))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, start, length, value, score, secret``: every candidate with the forest's verdict."""
    corpus = corpus_of(docs.select(F.col(f"`{text}`").alias("text")))
    found = session.cut(candidates(docs, doc_id, text), "secret-candidates")
    found = session.cut(described(label_findings(found), corpus), "secret-features")
    forest = train(found)
    if forest is None:
        scored = found.withColumn("score", F.lit(0.0))
    else:
        scored = forest.transform(found.withColumn("vector", array_to_vector("features"))).withColumn(
            "score", vector_to_array("probability")[1])
    return scored.select("doc_id", "start", "length", "value", "score", (F.col("score") >= 0.5).alias("secret"))
