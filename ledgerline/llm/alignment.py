"""Alignment of the tokens of two tokenizers, each distinct text once.

Rows are shuffled by their full text and counted, so a text that fills a third of the rows is one row per task. Each
distinct text is encoded by a byte-level BPE (A) and a piece model (B). Where tokens of both end at the same byte, the text
is cut; the tokens between two cuts are a group, and every A token is linked with every B token of its group. How many
documents hold an id pair linked is the sum of the multiplicities of the texts that do. The measures of a text are then
joined to the rows by the SHA-256 of the text.

A text's own pairs are looked up in two ways that together cover all of them: the commonest pairs, at most ``FREQUENT``
whatever the corpus, travel to every task as two arrays; all rarer ones are shuffled and joined. What is shuffled so has
no hot key, as the hot ones are not in it.

A text that is null or empty, or whose tokens do not spell a space and the text, has no tokens: all measures 0, digest ''.
Equal rows each count and each get a row. Texts are encoded part by part, cut at single spaces between Latin, Greek or
Cyrillic signs, where tokens of both kinds end; so only a run without such a place is encoded in one piece, however long the
text. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.llm.frequent import head_of
from ledgerline.llm.wordhash import groups_of_texts

FREQUENT = 1 << 18
BLOCK_CHARS = 1 << 18
KNOWN_CHARS = 1_500_000
GROUP_BYTES = 1 << 20
CELLS = 1 << 20
_PLACE = re.compile("(?<=[!-~À-ӿ]) (?=[!-~À-ӿ])")


def _byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + at): byte for at, byte in enumerate(others)}


class Tokenizers:
    """Both tokenizers and the bytes of each id, made from the contents of their files."""

    def __init__(self, bpe: bytes, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(bpe.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        byte_of = _byte_of_sign()
        description = json.loads(bpe)
        vocabulary = dict(description["model"]["vocab"])
        self.bytes_a = [b""] * (1 + max([*vocabulary.values(), *(token["id"] for token in description["added_tokens"])]))
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(map(byte_of.__getitem__, token)) if set(token) <= byte_of.keys() else token.encode()
        for token in description["added_tokens"]:
            self.bytes_a[token["id"]] = token["content"].encode()
        names = map(self.b.id_to_piece, range(self.b.get_piece_size()))
        self.bytes_b = [bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()
                        for i, name in enumerate(names)]
        self.sizes_a, self.sizes_b = (np.array([len(part) for part in parts]) for parts in (self.bytes_a, self.bytes_b))
        # ids as text, each with what may follow it: a comma, a bar or a semicolon
        self.written = [b"%d%c" % (i, mark) for i in range(max(len(self.bytes_a), len(self.bytes_b))) for mark in b",|;"]
        self.pairs = len(self.bytes_a) * len(self.bytes_b)
        self.cuts = not any(re.search(b"[^ ] ", piece) for piece in self.bytes_b)

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        found = self.a.encode_batch_fast([" " + part for part in parts], add_special_tokens=False)
        return [one.ids for one in found], self.b.encode(parts, num_threads=1)

    def spelt(self, part: str, a: list[int], b: list[int]) -> bool:
        """Whether the tokens of both kinds are the bytes of a space and the part."""
        whole = (" " + part).encode()
        return (b"".join(map(self.bytes_a.__getitem__, a)) == whole
                and b"".join(map(self.bytes_b.__getitem__, b)) == whole)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in rising order and the sums of their weights."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[heads], np.add.reduceat(weights, heads)


@dataclass
class Aligned:
    """The alignment of some texts or parts, a place each: counts, groups as text, and pairs with their links in runs."""

    spelt: np.ndarray
    counts: np.ndarray  # columns n_a, n_b, n_groups, n_links
    written: list[bytes]
    bounds: np.ndarray
    pairs: np.ndarray
    links: np.ndarray


def _linked(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """``(group, pair, links)`` of all links of groups that hold ``in_a`` and ``in_b`` tokens of ``a`` and ``b``.

    Groups are taken so many together that their links stay below ``CELLS``; one that exceeds this alone is expanded over
    its distinct ids, some of A's at a time.
    """
    ends_a, ends_b = np.cumsum(in_a), np.cumsum(in_b)
    links = in_a * in_b
    wide = np.flatnonzero(links > CELLS)
    total = np.cumsum(np.where(links > CELLS, 0, links))
    found = []
    g = 0
    while g < len(links):
        stop = max(g + 1, int(np.searchsorted(total, (total[g - 1] if g else 0) + CELLS, "right")))
        groups = np.arange(g, stop)
        groups = groups[links[groups] <= CELLS]
        each_a = np.repeat(groups, in_a[groups])
        tokens_a = np.arange(len(each_a)) + np.repeat(ends_a[groups] - np.cumsum(in_a[groups]), in_a[groups])
        times = in_b[each_a]
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        partner = b[at + np.repeat(ends_b[each_a] - times, times)]
        pair = np.repeat(a[tokens_a].astype(np.int64), times) * width + partner
        found.append((np.repeat(each_a, times), pair, np.ones(len(pair), dtype=np.int64)))
        g = stop
    for g in wide.tolist():
        own_a, times_a = np.unique(a[ends_a[g] - in_a[g]:ends_a[g]], return_counts=True)
        own_b, times_b = np.unique(b[ends_b[g] - in_b[g]:ends_b[g]], return_counts=True)
        step = max(1, CELLS // len(own_b))
        for at in range(0, len(own_a), step):
            pair = (own_a[at:at + step].astype(np.int64)[:, None] * width + own_b).ravel()
            found.append((np.full(len(pair), g), pair, (times_a[at:at + step, None] * times_b).ravel()))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def align_parts(tools: Tokenizers, parts: list[str]) -> Aligned:
    """The alignment of parts, each by itself; nothing of those that their tokens do not spell."""
    found_a, found_b = tools.encode(parts)
    spelt = np.array([tools.spelt(part, a, b) for part, a, b in zip(parts, found_a, found_b, strict=True)], dtype=bool)
    good = np.flatnonzero(spelt).tolist()
    counts = np.zeros((len(parts), 4), dtype=np.int64)
    if not good:
        return Aligned(spelt, counts, [b""] * len(parts), np.zeros(len(parts) + 1, dtype=np.int64), counts[:0, 0], counts[:0, 0])
    counts_a, counts_b = (np.array([len(found[k]) for k in good]) for found in (found_a, found_b))
    a, b = (np.fromiter(itertools.chain.from_iterable(found[k] for k in good), dtype=np.int64) for found in (found_a, found_b))
    ends_a, ends_b = np.cumsum(tools.sizes_a[a]), np.cumsum(tools.sizes_b[b])
    ends = np.zeros(int(ends_a[-1]) + 1, dtype=np.uint8)
    ends[ends_a] |= 1
    ends[ends_b] |= 2
    last_a, last_b = ends[ends_a] == 3, ends[ends_b] == 3
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    in_a, in_b = np.bincount(group_a), np.bincount(group_b)
    part_of_group = np.repeat(np.arange(len(good)), counts_b)[last_b]
    groups = np.bincount(part_of_group, minlength=len(good))
    links = np.add.reduceat(in_a * in_b, np.cumsum(groups) - groups)
    counts[good] = np.column_stack([counts_a, counts_b, groups, links])
    order = np.empty(len(a) + len(b), dtype=np.int64)
    order[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = a * 3 + last_a
    order[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = b * 3 + 2 * last_b
    marks = list(map(tools.written.__getitem__, order.tolist()))
    written, at = [b""] * len(parts), 0
    for k, size in zip(good, (counts_a + counts_b).tolist(), strict=True):
        written[k] = b"".join(marks[at:at + size])[:-1]
        at += size
    group, pair, times = _linked(a, b, in_a, in_b, len(tools.bytes_b))
    owner = np.array(good)[part_of_group[group]]
    sizes, pair, times = _summed_by(owner, pair, times, len(parts), tools.pairs)
    return Aligned(spelt, counts, written, np.concatenate(([0], np.cumsum(sizes))), pair, times)


def _summed_by(owner: np.ndarray, pair: np.ndarray, times: np.ndarray, owners: int, kinds: int) -> tuple[np.ndarray, ...]:
    """How many distinct pairs each owner has, and these one owner after another with their links added up."""
    if not len(owner):
        return np.zeros(owners, dtype=np.int64), pair, times
    if owners * kinds < 1 << 63:
        keys, times = _summed(owner * kinds + pair, times)
        owner, pair = keys // kinds, keys % kinds
    else:
        order = np.lexsort((pair, owner))
        owner, pair, times = owner[order], pair[order], times[order]
        heads = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])))
        owner, pair, times = owner[heads], pair[heads], np.add.reduceat(times, heads)
    return np.bincount(owner, minlength=owners), pair, times


class Aligner:
    """Aligns texts part by part and remembers the parts it has met, most of which are common words.

    A text is cut at each single space between two signs of ``_PLACE``. There a token of either kind ends: A looks at words
    apart, and none of B's pieces goes on beyond the end of a word, which is checked. So what a text has is the sum of what
    its parts have. The parts kept are bounded by ``KNOWN_CHARS``, beyond which all are forgotten.
    """

    def __init__(self, tools: Tokenizers):
        self.tools = tools
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.chars = 0
        self.spelt = np.zeros(0, dtype=bool)
        self.counts = np.zeros((0, 4), dtype=np.int64)
        self.written: list[bytes] = []
        self.bounds = np.zeros(1, dtype=np.int64)
        self.pairs = self.links = np.zeros(0, dtype=np.int64)

    def _meet(self, parts: list[str]) -> None:
        if self.chars > KNOWN_CHARS:
            self._forget()
        new = list(dict.fromkeys(part for part in parts if part not in self.places))
        found, at = [], 0
        while at < len(new):
            stop, size = at, 0
            while stop < len(new) and (stop == at or size + len(new[stop]) <= BLOCK_CHARS):
                size += len(new[stop])
                stop += 1
            found.append(align_parts(self.tools, new[at:stop]))
            at = stop
        if not found:
            return
        self.places.update(zip(new, range(len(self.written), len(self.written) + len(new)), strict=True))
        self.chars += sum(map(len, new))
        self.spelt = np.concatenate([self.spelt, *(one.spelt for one in found)])
        self.counts = np.concatenate([self.counts, *(one.counts for one in found)])
        self.written += itertools.chain.from_iterable(one.written for one in found)
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(
            np.concatenate([np.diff(one.bounds) for one in found]))])
        self.pairs = np.concatenate([self.pairs, *(one.pairs for one in found)])
        self.links = np.concatenate([self.links, *(one.links for one in found)])

    def align(self, texts: list[str]) -> Aligned:
        """The alignment of each text; ``written`` holds digests, empty for a text without tokens."""
        cut = _PLACE.split if self.tools.cuts else lambda text: [text]
        split = [cut(text) if text else [] for text in texts]
        parts = list(itertools.chain.from_iterable(split))
        self._meet(parts)
        at = np.fromiter(map(self.places.__getitem__, parts), dtype=np.int64, count=len(parts))
        sizes = np.array([len(own) for own in split])
        owner = np.repeat(np.arange(len(texts)), sizes)
        spelt = np.bincount(owner, weights=~self.spelt[at], minlength=len(texts)) == 0
        kept = spelt[owner]
        whole = np.column_stack([np.bincount(owner[kept], weights=self.counts[at[kept], k], minlength=len(texts))
                                 for k in range(4)]).astype(np.int64)
        digests, place = [], 0
        for good, size in zip((spelt & (sizes > 0)).tolist(), sizes.tolist(), strict=True):
            own = at[place:place + size].tolist()
            digests.append(hashlib.sha256(b";".join(map(self.written.__getitem__, own))).hexdigest().encode() if good else b"")
            place += size
        at, owner = at[kept], owner[kept]
        lengths = self.bounds[at + 1] - self.bounds[at]
        rows = np.arange(lengths.sum()) + np.repeat(self.bounds[at] - np.cumsum(lengths) + lengths, lengths)
        each, pairs, links = _summed_by(np.repeat(owner, lengths), self.pairs[rows], self.links[rows], len(texts), self.tools.pairs)
        return Aligned(spelt, whole, digests, np.concatenate(([0], np.cumsum(each))), pairs, links)


def _key(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _aligner(shared: dict) -> Aligner:
    """One aligner per worker process, kept in the worker's copy of the broadcast."""
    if "aligner" not in shared:
        shared["aligner"] = Aligner(Tokenizers(shared["bpe"], shared["pieces"]))
    return shared["aligner"]


def aligned_texts(texts: DataFrame, bpe_path: str, pieces_path: str) -> DataFrame:
    """``texts (text, rows)`` aligned: ``key, rows``, the measures of the text alone, and its ``pairs`` with their ``links``.

    A pair is the number ``A id * size of B + B id``.
    """
    contents = {}
    for name, path in (("bpe", bpe_path), ("pieces", pieces_path)):
        with open(path, "rb") as file:
            contents[name] = file.read()
    shared = texts.sparkSession.sparkContext.broadcast(contents)
    kind = "int" if pair_width(contents["pieces"]) * _bpe_size(contents["bpe"]) < 1 << 31 else "long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shared.value)
        number = pa.int32() if kind == "int" else pa.int64()
        for whole in batches:
            for batch in groups_of_texts(whole, "text", GROUP_BYTES):
                found = aligner.align(batch.column("text").to_pylist())
                ends = pa.array(found.bounds.astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(part).cast(number)) for part in (found.pairs, found.links)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), batch.column("rows"), *(pa.array(column) for column in found.counts.T),
                     pa.array([one.decode() for one in found.written]), *lists],
                    ["key", "rows", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"])

    schema = ("key binary, rows long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              f"pairs array<{kind}>, links array<{kind}>")
    return texts.select("text", "rows", _key(F.col("text")).alias("key")).mapInArrow(run, schema)


def _bpe_size(content: bytes) -> int:
    description = json.loads(content)
    return 1 + max([*description["model"]["vocab"].values(), *(token["id"] for token in description["added_tokens"])])


def pair_width(pieces: bytes) -> int:
    """How many ids B has: what an A id is multiplied with in the number of a pair."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=pieces).get_piece_size()


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``pair, documents, best``: in how many rows a pair is linked, and whether none of its A id is in more.

    The A ids' maxima are as many rows as A has ids, which bounds their broadcast.
    """
    counts = aligned.select("rows", F.explode("pairs").alias("pair")).groupBy("pair")
    counts = session.cut(counts.agg(F.sum("rows").alias("documents")), "pair-counts")
    a = F.expr(f"pair div {width}").alias("a")
    most = counts.groupBy(a).agg(F.max("documents").alias("most"))
    return counts.withColumn("a", a).join(F.broadcast(most), "a").select(
        "pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def _looked_up(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``key, n_best, count_sum`` of each text over all its pairs."""
    is_common = head_of(counts, "documents", FREQUENT)
    common = counts.where(is_common).select("pair", "documents", "best").toArrow().sort_by("pair")
    shared = aligned.sparkSession.sparkContext.broadcast(
        {name: common.column(name).to_numpy() for name in common.column_names})
    number = aligned.schema["pairs"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            pairs, links = (batch.column(name).flatten().to_numpy(zero_copy_only=False) for name in ("pairs", "links"))
            ends = batch.column("pairs").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), ends)
            at = np.minimum(np.searchsorted(known["pair"], pairs), max(len(known["pair"]) - 1, 0))
            hit = known["pair"][at] == pairs if len(known["pair"]) else np.zeros(len(pairs), dtype=bool)
            sums = []
            for weights in (known["best"], known["documents"]):
                each = np.zeros(len(pairs), dtype=np.int64)
                each[hit] = weights[at[hit]].astype(np.int64) * links[hit]
                total = np.concatenate(([0], np.cumsum(each)))
                stops = np.cumsum(ends)
                sums.append(pa.array(total[stops] - total[stops - ends]))
            left = np.bincount(owner[~hit], minlength=batch.num_rows)
            bounds = pa.array(np.concatenate(([0], np.cumsum(left))).astype(np.int32))
            rest = [pa.ListArray.from_arrays(bounds, pa.array(part[~hit])) for part in (pairs, links)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *sums, *rest],
                                             ["key", "n_best", "count_sum", "pairs", "links"])

    schema = f"key binary, n_best long, count_sum long, pairs array<{number}>, links array<{number}>"
    found = session.cut(aligned.select("key", "pairs", "links").mapInArrow(run, schema), "pairs-looked-up")
    rare = found.select("key", F.explode(F.arrays_zip("pairs", "links")).alias("one"))
    rare = rare.select("key", F.col("one.pairs").alias("pair"), F.col("one.links").alias("times"))
    rest = rare.join(counts.where(~is_common), "pair").select(
        "key", F.when(F.col("best"), F.col("times")).otherwise(0).cast("long").alias("n_best"),
        (F.col("documents") * F.col("times")).alias("count_sum"))
    return found.select("key", "n_best", "count_sum").unionByName(rest).groupBy("key").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def align(docs: DataFrame, bpe_path: str, pieces_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the measures and ``groups_sha256`` of each row of ``docs``."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    texts = rows.where("text != ''").groupBy("text").agg(F.count(F.lit(1)).alias("rows"))
    aligned = session.cut(aligned_texts(texts, bpe_path, pieces_path), "aligned-texts")
    with open(pieces_path, "rb") as file:
        width = pair_width(file.read())
    counts = session.cut(pair_counts(aligned, width), "pair-ranks")
    known = aligned.select("key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(_looked_up(aligned, counts), "key")
    known = session.cut(known, "text-measures")
    found = rows.select("doc_id", F.when(F.col("text") != "", _key(F.col("text"))).alias("key")).join(known, "key", "left")
    return found.select("doc_id", *(F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in MEASURES),
                        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
