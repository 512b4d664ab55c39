"""Benchmark decontamination by templates: passages are found even when numbers, names and units were exchanged.

A text becomes a sequence of tokens (runs of letters, digits and bytes beyond ASCII, A-Z lower-cased) in which

* a number, also one of several words or with inner points and commas, becomes a number slot,
* a capitalised word that does not begin a sentence becomes a name slot, several in a row one,
* a unit after a number becomes a unit slot.

Windows of ``WINDOW`` such tokens are joined by hash with those of the benchmark items. A window with fewer than ``PLAIN``
tokens that are no slots is joined on what stands in its slots as well, so it matches word for word only. Matches of a
document and an item that lie on one alignment are held together, and their slots are checked: the same value in the item
should always stand for the same value in the document. Of several values the one of most windows is taken, and windows
with another one contradict it. An alignment counts in any of three cases:

* nothing contradicts it, and its windows number ``MATCHES``, or all windows of a shorter item;
* as many of its windows are equal value for value, whatever the others say;
* ``STRETCH`` of its windows are left when those that contradict are taken away.

The windows with ``PLAIN`` such tokens also count on their own, so that what is word for word elsewhere takes no match away.
An item of fewer tokens than a window is one window of its own length; of slots alone it matches nothing.

The scan keeps a window only if a bitmap of fixed size, made from the benchmark, has its bit; so only likely matches
leave the scan, whatever the sizes, and an exact join follows.

Null and empty texts and items match nothing. Equal rows and rows without an id are judged each like any other.
Repeated items are items of their own. With an empty benchmark nothing matches; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.llm.rowsets import row_key, without_rows
from ledgerline.llm.wordhash import Splitter, groups_of_texts, mix, text_buffers

WINDOW = 8
PLAIN = 4
MATCHES = 6
STRETCH = 12
BITMAP_BITS = 1 << 22

_ALNUM = {*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)}
SEPARATORS = tuple(byte for byte in range(256) if byte not in _ALNUM)
_SENTENCE_ENDS = b".!?:\n"

# fixed values: number words and units
NUMBER_WORDS = ("one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
                "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
                "million billion").split()
UNITS = ("mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres g kg mg t oz lb "
         "lbs gram grams kilogram kilograms ounce ounces pound pounds ton tons ml l cl liter liters litre litres gallon "
         "gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
         "percent dollar dollars cent cents euro euros usd eur gbp degree degrees celsius kelvin w kw j kj v hz mph kmh"
         ).split()

NUMBER, NAME, UNIT = (np.uint64(value) for value in (0xA5A5A5A5A5A5A5A1, 0xA5A5A5A5A5A5A5A2, 0xA5A5A5A5A5A5A5A3))


def _hashes(words: list[str]) -> np.ndarray:
    data = " ".join(words).encode()
    return np.sort(Splitter(SEPARATORS).words(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))[0])


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


class Canonical:
    """Turns texts into template tokens and slot values."""

    def __init__(self) -> None:
        self.splitter = Splitter(SEPARATORS)
        self.number_words, self.units = _hashes(NUMBER_WORDS), _hashes(UNITS)
        self.ends = np.zeros(256, dtype=bool)
        self.ends[list(_SENTENCE_ENDS)] = True

    def tokens(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(tokens, values, bounds)``: a token is a word's hash or a slot kind, a value the hash of what stood there."""
        data, offsets = text_buffers(column)
        hashes, starts, lengths, bounds = self.splitter.words(data, offsets)
        if not len(hashes):
            return hashes, hashes, bounds
        first = data[starts]
        digit = (first >= 48) & (first <= 57)
        begins = np.zeros(len(hashes), dtype=bool)
        begins[bounds[:-1][bounds[:-1] < len(hashes)]] = True
        follows = np.zeros(len(hashes), dtype=bool)
        follows[1:] = ~begins[1:]
        gap = np.zeros(len(hashes), dtype=np.int64)
        gap[1:] = starts[1:] - starts[:-1] - lengths[:-1]
        before = data[np.maximum(starts - 1, 0)]
        # "1,000" and "3.14" are one number
        goes_on = follows & digit & (gap == 1) & ((before == 44) | (before == 46))
        goes_on[1:] &= digit[:-1]
        in_words = _among(hashes, self.number_words)
        number = digit | in_words
        unit = follows & ~number & _among(hashes, self.units)
        unit[1:] &= number[:-1]
        capital = (first >= 65) & (first <= 90) & (lengths > 1)
        second = data[np.minimum(starts + 1, len(data) - 1)]
        capital &= ((second >= 97) & (second <= 122)) | (second >= 128)
        name = capital & ~number & ~unit & follows & ~self._after_end(data, starts, lengths, capital & follows)
        # "thirty five", "thirty-five", "3 million" and "New York" are one slot each
        close = follows & (gap == 1)
        more = close & in_words & ((before == 32) | (before == 45))
        more[1:] &= number[:-1]
        also = close & name & (before == 32)
        also[1:] &= name[:-1]
        goes_on |= more | also
        tokens = np.select([number, unit, name], [NUMBER, UNIT, NAME], hashes)
        if goes_on.any():
            heads = np.flatnonzero(~goes_on)
            part = np.arange(len(hashes)) - np.repeat(heads, np.diff(np.append(heads, len(hashes))))
            values = np.add.reduceat(mix(hashes + part.astype(np.uint64)), heads)
            moved = np.concatenate(([0], np.cumsum(~goes_on)))
            return tokens[heads], values, moved[bounds]
        return tokens, mix(hashes), bounds

    def _after_end(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Whether a sentence ends between a wanted token and the one before it."""
        after = np.zeros(len(starts), dtype=bool)
        at = np.flatnonzero(wanted)
        froms, stops = starts[at - 1] + lengths[at - 1], starts[at]
        sizes = stops - froms
        if len(at) and sizes.any():
            ends = np.cumsum(sizes)
            reach = np.arange(ends[-1]) + np.repeat(froms - ends + sizes, sizes)
            sums = np.concatenate(([0], np.cumsum(self.ends[data[reach]])))
            after[at] = sums[ends] > sums[ends - sizes]
        return after


def _rolled(tokens: np.ndarray, size: int) -> np.ndarray:
    reach = len(tokens) - size + 1
    if reach <= 0:
        return tokens[:0]
    total = np.full(reach, size, dtype=np.uint64)
    for k in range(size):
        total += tokens[k:k + reach] * np.uint64((2 * k + 5) * 0xC2B2AE3D27D4EB4F % (1 << 64))
    return mix(total)


def _is_slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens == NUMBER) | (tokens == NAME) | (tokens == UNIT)


def _windows(tokens: np.ndarray, values: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and hash of the windows that lie within one text, and whether they have enough plain tokens.

    The hash of one that has not is that of its values.
    """
    rolled = _rolled(tokens, size)
    sums = np.concatenate(([0], np.cumsum(_is_slot(tokens))))
    starts = np.arange(len(rolled))
    inside = np.searchsorted(bounds, starts, "right") == np.searchsorted(bounds, starts + size - 1, "right")
    count = size - (sums[starts + size] - sums[starts])
    plain = count >= min(PLAIN, size)
    if not plain.all():
        rolled = np.where(plain, rolled, _rolled(mix(values ^ tokens), size))
    keep = np.flatnonzero(inside & (plain | (count > 0) | (size == WINDOW)))
    return keep, rolled[keep], plain[keep]


def _slots(tokens: np.ndarray, values: np.ndarray, starts: np.ndarray, size: int) -> pa.Array:
    """Per window the values of its slots in order."""
    if not len(starts):
        return pa.array([], pa.list_(pa.int64()))
    reach = starts[:, None] + np.arange(size)
    slot = _is_slot(tokens)[reach]
    ends = np.concatenate(([0], np.cumsum(slot.sum(axis=1)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values[reach[slot]].view(np.int64)))


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``item, h, size, at, slots, plain, windows, every`` of benchmark items.

    windows: how many with enough plain tokens the item has; every: how many at all.
    """
    canonical = Canonical()
    for whole in batches:
        for batch in groups_of_texts(whole, "text"):
            tokens, values, bounds = canonical.tokens(batch.column("text"))
            for row in range(batch.num_rows):
                own, kept = tokens[bounds[row]:bounds[row + 1]], values[bounds[row]:bounds[row + 1]]
                size = min(WINDOW, len(own))
                if not size:
                    continue
                starts, rolled, plain = _windows(own, kept, np.array([0, len(own)]), size)
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("item")[row].as_py()] * n, pa.int64()), pa.array(rolled.view(np.int64)),
                     pa.array(np.full(n, size, dtype=np.int32)), pa.array(starts.astype(np.int64)),
                     _slots(own, kept, starts, size), pa.array(plain), pa.array(np.full(n, plain.sum(), dtype=np.int64)),
                     pa.array(np.full(n, n, dtype=np.int64))],
                    ["item", "h", "size", "at", "slots", "plain", "windows", "every"])


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
            item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, a, b, item_id, matched, changed, first_token``: one row per document row, item and alignment.

    ``a, b`` are the row's key; ``changed`` counts the slots whose value differs.
    """
    items = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("item"), F.col(f"`{item_text}`").alias("text"))
    items = session.cut(items.mapInArrow(
        _item_windows, "item long, h long, size int, at long, slots array<long>, plain boolean, windows long, every long"),
        "benchmark-windows")
    marked = items.select(F.pmod("h", F.lit(BITMAP_BITS)).cast("int").alias("bit")).distinct().toPandas()["bit"]
    bitmap = np.zeros(BITMAP_BITS, dtype=bool)
    bitmap[marked.to_numpy(dtype=np.int64)] = True
    packed = docs.sparkSession.sparkContext.broadcast(np.packbits(bitmap))
    # sizes below WINDOW come from items that are shorter than a window: a handful of values
    sizes = sorted(row["size"] for row in items.select("size").distinct().collect())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = Canonical()
        bits = np.unpackbits(packed.value).astype(bool)
        for whole in batches:
            for batch in groups_of_texts(whole, "text"):
                tokens, values, bounds = canonical.tokens(batch.column("text"))
                for size in sizes:
                    starts, rolled, _ = _windows(tokens, values, bounds, size)
                    likely = bits[(rolled & np.uint64(BITMAP_BITS - 1)).astype(np.int64)]
                    starts, rolled = starts[likely], rolled[likely]
                    rows = np.searchsorted(bounds, starts, "right") - 1
                    took = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(name).take(took) for name in ("doc_id", "a", "b")),
                         pa.array(rolled.view(np.int64)), pa.array((starts - bounds[rows]).astype(np.int64)),
                         _slots(tokens, values, starts, size)], ["doc_id", "a", "b", "h", "at", "slots"])

    named = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    keyed = named.withColumn("key", row_key(F.col("doc_id"), F.col("text"))).select("doc_id", "key.a", "key.b", "text")
    found = keyed.mapInArrow(scan, "doc_id long, a long, b int, h long, at long, slots array<long>")
    met = found.alias("d").join(items.alias("i"), F.col("d.h") == F.col("i.h")).where(
        F.size("d.slots") == F.size("i.slots")).select(
        "doc_id", "a", "b", "item", "plain", "windows", "every", F.col("d.at").alias("at"),
        (F.col("d.at") - F.col("i.at")).alias("shift"),
        F.arrays_zip(F.col("i.slots").alias("was"), F.col("d.slots").alias("now")).alias("slots"))
    # judged twice if the item has other windows: by those with enough plain tokens, and by all
    judged = F.explode(F.when(F.col("plain") & (F.col("windows") < F.col("every")), F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(~F.col("plain"))))
    met = met.withColumn("whole", judged).withColumn("windows", F.when(F.col("whole"), F.col("every")).otherwise(F.col("windows")))
    met = session.cut(met.drop("plain", "every"), "benchmark-matches")
    return _judged(met).select("doc_id", "a", "b", F.col("item").alias("item_id"), "matched", "changed", "first_token")


def _judged(met: DataFrame) -> DataFrame:
    """The best verdict on each alignment of ``met`` that counts: a row per document row, item and shift."""
    alignment = ["a", "b", "item", "shift", "whole"]
    equal = ~F.exists("slots", lambda slot: slot["was"] != slot["now"])
    whole = met.groupBy(*alignment).agg(
        F.any_value("doc_id").alias("doc_id"), F.least(F.max("windows"), F.lit(MATCHES)).alias("wanted"),
        F.countDistinct("at").alias("found"), F.countDistinct(F.when(equal, F.col("at"))).alias("equal"),
        F.min("at").alias("first_token"))
    slots = met.select(*alignment, "at", F.explode("slots").alias("slot")).select(*alignment, "at", "slot.*")
    values = slots.groupBy(*alignment, "was", "now").agg(F.countDistinct("at").alias("n"))
    usual = values.groupBy(*alignment, "was").agg(F.max_by("now", F.struct("n", "now")).alias("usual"))
    against = slots.join(usual, [*alignment, "was"]).where("now <> usual").groupBy(*alignment).agg(
        F.countDistinct("at").alias("against"))
    changed = values.groupBy(*alignment).agg(F.sum((F.col("was") != F.col("now")).cast("long")).alias("changed"))
    none = F.lit(0).cast("long")
    told = whole.join(against, alignment, "left").join(changed, alignment, "left").select(
        *alignment, "doc_id", "wanted", "equal", "first_token", "found", F.coalesce("against", none).alias("against"),
        F.coalesce("changed", none).alias("changed"))
    left = F.col("found") - F.col("against")
    counts = ((F.col("against") == 0) & (F.col("found") >= F.col("wanted"))) | (F.col("equal") >= F.col("wanted")) | (
        left >= STRETCH)
    best = F.max(F.struct(F.greatest(left, F.col("equal")).alias("matched"), "changed", "first_token")).alias("best")
    return told.where(counts).groupBy("a", "b", "item", "shift").agg(
        F.any_value("doc_id").alias("doc_id"), best).select("doc_id", "a", "b", "item", "best.*")


def contaminated(docs: DataFrame, benchmark: DataFrame, **columns: str) -> DataFrame:
    """``doc_id, item_id, matched, changed, first_token``: the best alignment of each document and item that match.

    Rows that share an id are one document; each text without an id is one of its own.
    """
    found = matches(docs, benchmark, **columns)
    best = F.max(F.struct("matched", (-F.col("changed")).alias("same"), (-F.col("first_token")).alias("early")))
    nameless = F.when(F.col("doc_id").isNull(), F.struct("a", "b")).alias("text_key")
    return found.groupBy("doc_id", nameless, "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", "best.matched", (-F.col("best.same")).alias("changed"),
        (-F.col("best.early")).alias("first_token"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that match a benchmark item, its own columns only."""
    found = session.cut(matches(docs, benchmark, doc_id, text).select("a", "b").distinct(), "contaminated")
    return without_rows(docs, found.withColumn("only_one", F.lit(False)), doc_id, text)
