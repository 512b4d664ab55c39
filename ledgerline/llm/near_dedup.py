"""Near-duplicate detection: one-permutation MinHash, optimal densification, banded buckets, star-shaped edges.

A document's set holds its distinct shingles of five words (lower-cased A-Z; words lie between space, tab and line
characters); a document of one to four words has one element, the whole sequence. Two documents are linked when
100 * |A and B| >= 75 * |A or B|, which is decided on the full sets.

* Documents with equal sets form a class first; everything after that sees a class once, however many copies it has.
* One hash per shingle gives the whole signature: its top bits name one of ``BINS`` bins, and a bin keeps its smallest
  hash. An empty bin takes the value of the first filled bin in a random order of its own, the same for every document.
* A bucket is a band of ``ROWS`` bins with equal values. Candidate edges are stars: a class is compared with its hub, the
  class that meets most others in buckets. Two classes of one hub that are similar either share enough within what both
  have in common with the hub, or they share a shingle that the hub lacks. The first is known without comparing them; for
  the second there is a bucket for each such shingle, where what a class shares with the hub and has in such buckets
  bounds its similarity. That is exact, and spares a large family of copies from comparing its heavily edited members
  with all others.
* Buckets whose classes are not all connected then become stars themselves: a bucket of n classes gives n - 1 pairs, of one
  centre with each of the rest, and goes on without its centres into another round with eight times as many, until every two of
  its classes are compared, connected or known to differ. No pair is dropped, and none is formed within what is connected.
* With 51 bands of 5 bins a pair at the limit shares no bucket with a probability of about one in a million.

Empty and null texts and texts without words are linked with nothing. Equal rows are one class. Rows without an id
take part; they come last when the smallest id is sought. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.llm.components import connected, twice
from ledgerline.llm.rowsets import bloom_of, probe, row_key, without_rows
from ledgerline.llm.wordhash import Splitter, groups_of_texts, mix, text_buffers

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
ROWS = 5
BANDS = BINS // ROWS
SIMILARITY = 75  # per cent


def shingle_sets(splitter: Splitter, column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, _, _, bounds = splitter.words(*text_buffers(column))
    rolled = np.zeros(len(hashes), dtype=np.uint64)
    reach = len(hashes) - SHINGLE + 1
    for k in range(SHINGLE if reach > 0 else 0):
        rolled[:reach] += hashes[k:k + reach] * np.uint64((2 * k + 3) * 0x9FB21C651E98DF25 % (1 << 64))
    rolled = mix(rolled)
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        n = last - first
        if n >= SHINGLE:
            yield np.unique(rolled[first:last - SHINGLE + 1])
        elif n:
            whole = np.uint64(n)
            for word in hashes[first:last]:
                whole = mix(np.array([word ^ whole]))[0]
            yield np.array([whole], dtype=np.uint64)
        else:
            yield hashes[:0]


def bin_orders(seed: int = 7) -> np.ndarray:
    """``order[i, j]``: at which step empty bin ``i`` looks into bin ``j``."""
    return np.random.default_rng(seed).random((BINS, BINS)).argsort(axis=1).argsort(axis=1).astype(np.int16)


def signature(shingles: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """One value per bin of a non-empty sorted set."""
    bins = (shingles >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    filled = bins[first]
    values = np.empty(BINS, dtype=np.uint64)
    values[filled] = shingles[first]
    if len(filled) < BINS:
        free = np.ones(BINS, dtype=bool)
        free[filled] = False
        empty = np.flatnonzero(free)
        values[empty] = shingles[first[orders[np.ix_(empty, filled)].argmin(axis=1)]]
    return values


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per signature and band."""
    parts = signatures[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS)
    keys = np.zeros(parts.shape[:2], dtype=np.uint64)
    for row in range(ROWS):
        keys = mix(keys * np.uint64(3) + parts[:, :, row])
    return mix(keys + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _digests(shingles: np.ndarray) -> tuple[int, int]:
    twice = mix(shingles + np.uint64(0x632BE59BD9B4E019))
    return int(shingles.sum(dtype=np.uint64).view(np.int64)), int(twice.sum(dtype=np.uint64).view(np.int64))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate(([0], np.cumsum([len(part) for part in parts]))).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values.view(np.int64)))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``n, d1, d2`` (size and digests of the set) and ``bands`` to each row, without the text."""
    splitter, orders = Splitter(), bin_orders()
    none = np.zeros(0, dtype=np.uint64)
    for whole in batches:
        for batch in groups_of_texts(whole, "text"):
            sets = list(shingle_sets(splitter, batch.column("text")))
            sketched = [signature(one, orders) for one in sets if len(one)]
            keys = iter(band_keys(np.stack(sketched)) if sketched else ())
            digests = [_digests(one) for one in sets]
            rest = [batch.column(name) for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([
                *rest, pa.array([len(one) for one in sets], pa.int64()),
                pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                _lists([next(keys) if len(one) else none for one in sets])],
                [*(name for name in batch.schema.names if name != "text"), "n", "d1", "d2", "bands"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    splitter = Splitter()
    for whole in batches:
        for batch in groups_of_texts(whole, "text"):
            sets = list(shingle_sets(splitter, batch.column("text")))
            digests = [_digests(one) for one in sets]
            yield pa.RecordBatch.from_arrays([
                pa.array([len(one) for one in sets], pa.int64()), pa.array([d[0] for d in digests], pa.int64()),
                pa.array([d[1] for d in digests], pa.int64()), _lists(sets)], ["n", "d1", "d2", "shingles"])


def _similar(common: Column, n: Column, m: Column) -> Column:
    return 100 * common >= SIMILARITY * (n + m - common)


def _near_sizes(n: Column, m: Column) -> Column:
    """Whether sets of these sizes can be similar at all."""
    return 100 * F.least(n, m) >= SIMILARITY * F.greatest(n, m)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``u, v, common, similar``: the pairs with the size of their intersection."""
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    met = pairs.join(left, "u").join(right, "v").select(
        "u", "v", F.size(F.array_intersect("a", "b")).alias("common"), F.size("a").alias("n"), F.size("b").alias("m"))
    return met.select("u", "v", "common", _similar(F.col("common"), F.col("n"), F.col("m")).alias("similar"))


def _reachable(s: Column, n: Column, m: Column) -> Column:
    """Whether sets of sizes ``n`` and ``m`` are similar if they have ``s`` elements in common."""
    return (100 + SIMILARITY) * s >= SIMILARITY * (n + m)


def _hubs(members: DataFrame, state: DataFrame) -> DataFrame:
    """``node, hub``: the class that meets most others among those a class meets, and those this one meets, and so on."""
    met = members.select("key", "node").join(state.select("node", "meetings"), "node")
    best = met.groupBy("key").agg(F.max(F.struct("meetings", (-F.col("node")).alias("first"))).alias("best"))
    points = met.join(best, "key").groupBy("node").agg(F.max("best").alias("best")).select(
        F.col("node").alias("u"), (-F.col("best.first")).alias("to"))
    return twice(twice(session.cut(points, "near-points"))).select(F.col("u").alias("node"), F.col("to").alias("hub"))


def _beyond(members: DataFrame, state: DataFrame, sets: DataFrame) -> DataFrame:
    """A bucket for each hub and each shingle that the hub lacks but several of its classes in open buckets have."""
    left = members.join(state.select("node", "label", "hub"), "node")
    still = left.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    rest = left.join(still.select("key"), "key").select("node", "hub").distinct()
    own = sets.select("node", F.col("shingles").alias("own"))
    hubs = sets.select(F.col("node").alias("hub"), F.col("shingles").alias("theirs"))
    found = rest.join(own, "node").join(hubs, "hub").select(
        "hub", "node", F.explode(F.array_except("own", "theirs")).alias("shingle"))
    found = session.cut(found.select(F.xxhash64("hub", "shingle").alias("key"), "node"), "near-differences")
    shared = found.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key")
    return found.join(shared, "key").select("key", "node", F.lit(False).alias("within"))


def _linked(docs: DataFrame, classes: DataFrame, buckets: DataFrame) -> DataFrame:
    """``node, label`` of the classes that share a bucket; label is the same within a component."""
    shared = buckets.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min("node").alias("low"), F.bit_xor(F.xxhash64("node")).alias("who"))
    # buckets of the same classes are one, which counts for all of them when a hub is chosen
    once = shared.where("size > 1").groupBy("size", "low", "who").agg(
        F.min("key").alias("key"), F.count(F.lit(1)).alias("weight")).select("key", "weight")
    members = session.cut(buckets.join(once, "key").select("key", "node", "weight"), "near-members")
    met = members.groupBy("node").agg(F.sum("weight").alias("meetings"))
    state = session.cut(classes.select("node", "doc_id", "d1", "d2", "n").join(met, "node").withColumn(
        "label", F.col("node")), "near-state")
    ids = state.select(F.xxhash64("doc_id").alias("h"))
    texts = docs.select(F.col("doc_id"), F.col("text"))
    texts = probe(texts, F.xxhash64("doc_id"), bloom_of(ids, "h"), "maybe").where("maybe").select("text")
    found = texts.mapInArrow(_full_sets, "n long, d1 long, d2 long, shingles array<long>")
    sets = found.join(state.select("node", "n", "d1", "d2"), ["n", "d1", "d2"]).groupBy("node").agg(
        F.any_value("shingles").alias("shingles"))
    sets = session.cut(sets, "near-sets")

    hubs = _hubs(members, state)
    pairs = hubs.where("node <> hub").select(F.least("node", "hub").alias("u"), F.greatest("node", "hub").alias("v"))
    tested = session.cut(pairs.distinct(), "near-pairs")
    compared = session.cut(_compared(tested, sets), "near-compared")
    ends = [F.least("node", "hub").alias("u"), F.greatest("node", "hub").alias("v")]
    spokes = hubs.select("node", "hub", *ends).join(compared, ["u", "v"], "left")
    spokes = spokes.select("node", "hub", "common", F.coalesce("similar", F.lit(True)).alias("on"))
    state = state.drop("doc_id", "d1", "d2").join(spokes, "node").withColumn(
        "common", F.coalesce("common", "n").cast("long"))
    state = _joined(state, compared.where("similar").select("u", "v"))
    members = members.select("key", "node", F.lit(True).alias("within"))
    beyond = session.cut(_beyond(members, state, sets), "near-beyond")
    members = members.unionByName(beyond)
    extra = beyond.groupBy("node").agg(F.count(F.lit(1)).alias("extra"))
    state = session.cut(state.join(extra, "node", "left").withColumn("extra", F.coalesce("extra", F.lit(0))), "near-state")

    stars = 1
    while True:
        left = session.cut(members.join(state, "node"), "near-left")
        open_ = left.groupBy("key").agg(
            F.count(F.lit(1)).alias("size"), F.min("label").alias("lowest"), F.max("label").alias("highest"),
            F.min("hub").alias("low"), F.max("hub").alias("high"), F.min("n").alias("least"), F.min("node").alias("first"),
            F.max(F.when(~F.col("on"), F.col("common") * ((100 + SIMILARITY) / SIMILARITY) - F.col("n"))).alias("cap"),
            F.bit_xor(F.xxhash64("node", "within")).alias("who")).where("lowest < highest")
        # buckets that have come to hold the same classes go on as one
        open_ = open_.groupBy("size", "first", "who", "low", "high", "least", "cap").agg(F.min("key").alias("key"))
        drawn = F.pmod(F.xxhash64("node", "key", F.lit(stars)), F.col("size")) < stars
        # of a pair to compare one is not similar to the common hub, and the other is no larger than that one's cap
        inside = F.when(F.col("on"), F.col("n") <= F.col("cap") + 1e-6).otherwise(
            _reachable(F.col("common"), F.col("n"), F.col("least")))
        outside = _reachable(F.col("common") + F.col("extra"), F.col("n"), F.col("least"))
        useful = F.when(~F.col("within"), outside).when(F.col("low") == F.col("high"), inside).otherwise(True)
        placed = session.cut(left.join(open_, "key").where(useful).select(
            "key", "node", "within", "n", "label", "hub", "common", "extra",
            ((F.col("node") == F.col("first")) | drawn).alias("centre")), "near-placed")
        if placed.isEmpty():
            return state.select("node", "label")
        centres = placed.where("centre").select(
            "key", *(F.col(name).alias(f"c_{name}") for name in ("node", "n", "label", "hub", "common", "extra")))
        within = F.least("common", "c_common")
        most = F.when(F.col("within"), within).otherwise(within + F.least("extra", "c_extra"))
        met = placed.join(centres, "key").where(
            (F.col("label") != F.col("c_label")) & _near_sizes(F.col("n"), F.col("c_n"))
            & ((F.col("hub") != F.col("c_hub")) | _reachable(most, F.col("n"), F.col("c_n"))))
        pairs = met.select(F.least("node", "c_node").alias("u"), F.greatest("node", "c_node").alias("v")).distinct()
        pairs = session.cut(pairs.join(tested, ["u", "v"], "left_anti"), "near-pairs")
        tested = tested.unionByName(pairs)
        compared = session.cut(_compared(pairs, sets), "near-compared")
        state = _joined(state, compared.where("similar").select("u", "v"))
        # a centre has met its whole bucket; the others go on
        members = placed.where("not centre").select("key", "node", "within")
        stars *= 8


def _joined(state: DataFrame, links: DataFrame) -> DataFrame:
    """``state`` after the nodes of each link have got the same label."""
    one, two = (state.select(F.col("node").alias(end), F.col("label").alias(f"l{end}")) for end in ("u", "v"))
    ends = links.join(one, "u").join(two, "v").select(F.col("lu").alias("u"), F.col("lv").alias("v"))
    moved = connected(ends).select(F.col("node").alias("label"), F.col("label").alias("root"))
    return session.cut(state.join(moved, "label", "left").withColumn(
        "label", F.coalesce("root", "label")).drop("root"), "near-state")


def _grouped(docs: DataFrame) -> DataFrame:
    """Per row its keys, set size and the first row of its component: ``doc_id, a, b, n, tag, first``."""
    keyed = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text").select(
        "doc_id", "key.a", "key.b", "text")
    sketched = keyed.mapInArrow(_sketches, "doc_id long, a long, b int, n long, d1 long, d2 long, bands array<long>")
    stored = session.cut(sketched.withColumn("tag", F.monotonically_increasing_id()), "near-sketches")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag")
    filled = stored.where("n > 0")
    classes = filled.groupBy("n", "d1", "d2").agg(
        F.min("tag").alias("node"), F.min(order).alias("first"), F.any_value("bands").alias("bands"))
    classes = session.cut(classes.withColumn("doc_id", F.col("first.doc_id")), "near-classes")
    buckets = session.cut(classes.select(F.explode("bands").alias("key"), "node"), "near-buckets")
    labels = _linked(docs, classes, buckets)
    rooted = classes.select("n", "d1", "d2", "node", "first").join(labels, "node", "left").withColumn(
        "root", F.coalesce("label", "node"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("chosen"))
    named = session.cut(rooted.join(firsts, "root").select("n", "d1", "d2", "chosen"), "near-named")
    together = filled.drop("bands").join(named, ["n", "d1", "d2"]).select(
        "doc_id", "a", "b", "n", "tag", F.col("chosen.doc_id").alias("component_id"), F.col("chosen.tag").alias("keeper"))
    empty = stored.where("n = 0").select(
        "doc_id", "a", "b", "n", "tag", F.col("doc_id").alias("component_id"), F.col("tag").alias("keeper"))
    return together.unionByName(empty)


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id of the component, and ``kept`` says that the row has it: of rows that share
    their id all or none are kept. Where no row of a component has an id, all of them are.
    """
    return _grouped(_named(docs, doc_id, text)).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component, its own columns only.

    Only rows that may have to go are shuffled with their text.
    """
    grouped = session.cut(_grouped(_named(docs, doc_id, text)), "near-grouped")
    marked = grouped.withColumn("kept", F.col("tag") == F.col("keeper"))
    # rows equal in id and text share a key: if one of them is the kept one, one of them stays
    doomed = marked.groupBy("a", "b").agg(
        F.max("kept").alias("only_one"), F.count(F.lit(1)).alias("copies"), F.min("kept").alias("all_kept"))
    return without_rows(docs, doomed.where("not all_kept").select("a", "b", "only_one"), doc_id, text)
