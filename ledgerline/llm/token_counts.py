"""Token counts that follow edits: a segment tree per document, of which an edit touches only a few leaves.

A leaf is a stretch of pre-tokens. Leaves meet only where one space stands between two characters that are no white
space: there the pre-tokeniser always begins a new pre-token, whatever lies around, so a document's count is the sum of
its leaves' counts. The tree holds sums over leaves; an edit re-encodes the leaves it touches and one neighbour on
either side, as their bounds may no longer be such places, and updates the sums above them.

Offsets of edits are characters of the text before any of them; edits of a document may be in any order and must not
overlap. A leaf that edits have made eight times as long as usual is cut, and the tree above laid out anew without
encoding the others again.

A null or empty text has no tokens and takes edits like any text. Null edits are none. A text without a place to cut is
one leaf. Equal and repeated rows are treated alike, ids do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEAF = 512
OVERGROWN = 8

# a space between two characters that are no white space
_CUT = re.compile(r"(?<=\S) (?=\S)")
# fixed values: the pre-token pattern of the byte-level vocabularies
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

TREE = "struct<lengths: array<int>, sums: array<int>>"
EDITS = "array<struct<start: int, stop: int, replacement: string>>"

Edit = tuple[int, int, str]


def leaves_of(text: str, leaf: int = LEAF) -> list[str]:
    """``text`` cut at the first possible place after every ``leaf`` characters."""
    parts, at = [], 0
    while at < len(text):
        cut = _CUT.search(text, at + leaf)
        stop = cut.start() if cut else len(text)
        parts.append(text[at:stop])
        at = stop
    return parts


@dataclass
class CountTree:
    """Leaf lengths in characters and a heap of sums: node ``k`` has the children ``2k`` and ``2k + 1``."""

    lengths: list[int]
    sums: list[int]

    @classmethod
    def over(cls, lengths: list[int], counts: list[int]) -> CountTree:
        side = 1
        while side < len(counts):
            side *= 2
        sums = [0] * side + counts + [0] * (side - len(counts))
        for node in range(side - 1, 0, -1):
            sums[node] = sums[2 * node] + sums[2 * node + 1]
        return cls(lengths, sums)

    @property
    def total(self) -> int:
        return self.sums[1]

    @property
    def side(self) -> int:
        return len(self.sums) // 2

    def put(self, leaf: int, length: int, count: int) -> None:
        """Sets one leaf and the sums above it."""
        self.lengths[leaf] = length
        node = self.side + leaf
        change = count - self.sums[node]
        while change and node:
            self.sums[node] += change
            node //= 2


class Counter:
    """Counts tokens of a byte-level BPE."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import tiktoken

        self.encode = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def count(self, text: str) -> int:
        return len(self.encode(text))

    def tree(self, text: str) -> CountTree:
        parts = leaves_of(text)
        return CountTree.over([len(part) for part in parts], [self.count(part) for part in parts])

    def edited(self, text: str, tree: CountTree, edits: list[Edit]) -> tuple[CountTree, int]:
        """The tree of the edited text, and how many characters were encoded for it. ``tree`` is not changed."""
        edits = sorted(edits, key=lambda edit: edit[:2])
        if any(one[1] > two[0] for one, two in zip(edits, edits[1:], strict=False)) or any(
                not 0 <= start <= stop <= len(text) for start, stop, _ in edits):
            raise ValueError("edits overlap or lie outside their text")
        if not edits:
            return tree, 0
        new = CountTree(list(tree.lengths), list(tree.sums))
        if not new.lengths:
            whole = self.tree("".join(replacement for _, _, replacement in edits))
            return whole, sum(whole.lengths)
        starts = [0]
        for length in tree.lengths:
            starts.append(starts[-1] + length)
        encoded = 0
        for first, last, own in _regions(starts, edits):
            parts, at = [], starts[first]
            for start, stop, replacement in own:
                parts += [text[at:start], replacement]
                at = stop
            parts.append(text[at:starts[last + 1]])
            region = "".join(parts)
            encoded += len(region)
            # the region keeps its leaves, so that nothing moves in the tree: some may come out empty, the last one long
            cuts = leaves_of(region)
            room = last - first + 1
            cuts = cuts[:room - 1] + ["".join(cuts[room - 1:])] + [""] * (room - 1 - len(cuts))
            for leaf, part in zip(range(first, last + 1), cuts, strict=False):
                new.put(leaf, len(part), self.count(part))
        return new, encoded

    def laid_out(self, text: str, tree: CountTree) -> tuple[CountTree, int]:
        """The tree with overgrown leaves cut and empty ones gone, and how many characters were encoded for it."""
        if all(length <= OVERGROWN * LEAF for length in tree.lengths):
            return tree, 0
        lengths, counts, at, encoded = [], [], 0, 0
        for leaf, length in enumerate(tree.lengths):
            if length > OVERGROWN * LEAF:
                parts = leaves_of(text[at:at + length])
                lengths += [len(part) for part in parts]
                counts += [self.count(part) for part in parts]
                encoded += length
            elif length:
                lengths.append(length)
                counts.append(tree.sums[tree.side + leaf])
            at += length
        return CountTree.over(lengths, counts), encoded


def _regions(starts: list[int], edits: list[Edit]) -> list[tuple[int, int, list[Edit]]]:
    """Runs of leaves to encode again, each with its edits in order."""
    last_leaf = len(starts) - 2
    regions: list[tuple[int, int, list[Edit]]] = []
    for edit in edits:
        # the leaves that hold the characters before and after the edit, and one more that is not empty on either side
        first = max(0, bisect_left(starts, edit[0]) - 1)
        last = min(last_leaf, max(first, bisect_right(starts, edit[1]) - 1))
        first, last = _wider(starts, first, -1), _wider(starts, last, 1)
        if regions and first <= regions[-1][1] + 1:
            before = regions[-1]
            regions[-1] = (min(first, before[0]), max(last, before[1]), [*before[2], edit])
        else:
            regions.append((first, last, [edit]))
    return regions


def _wider(starts: list[int], leaf: int, step: int) -> int:
    """The next leaf with characters in that direction, or the last one there."""
    leaf += step
    while 0 < leaf < len(starts) - 2 and starts[leaf] == starts[leaf + 1]:
        leaf += step
    return min(max(leaf, 0), len(starts) - 2)


def apply_edits(text: str, edits: list[Edit]) -> str:
    """The edited text."""
    parts, at = [], 0
    for start, stop, replacement in sorted(edits, key=lambda edit: edit[:2]):
        parts += [text[at:start], replacement]
        at = stop
    return "".join([*parts, text[at:]])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in file if line.strip())}


def _shared(spark: SparkSession, path: str):
    """A broadcast of the vocabulary; each worker process builds its counter from it once."""
    return spark.sparkContext.broadcast({"ranks": read_ranks(path)})


def _counter(shared: dict) -> Counter:
    if "counter" not in shared:
        shared["counter"] = Counter(shared["ranks"])
    return shared["counter"]


def with_trees(docs: DataFrame, ranks_path: str, text: str = "text", into: str = "tree") -> DataFrame:
    """``docs`` with the tree of each text."""
    shared = _shared(docs.sparkSession, ranks_path)

    @F.arrow_udf(TREE)
    def trees(column: pa.Array) -> pa.Array:
        counter = _counter(shared.value)
        found = [counter.tree(one.as_py() or "") for one in column]
        return pa.array([{"lengths": tree.lengths, "sums": tree.sums} for tree in found], _TREE_TYPE)

    return docs.withColumn(into, trees(F.col(f"`{text}`")))


def with_edited_trees(docs: DataFrame, ranks_path: str, text: str = "text", tree: str = "tree", edits: str = "edits",
                      into: str = "edited") -> DataFrame:
    """``docs`` with the struct ``into``: ``tree`` after ``edits``, its ``tokens``, and the characters ``encoded`` for it."""
    shared = _shared(docs.sparkSession, ranks_path)

    @F.arrow_udf(f"struct<tokens: long, encoded: long, tree: {TREE}>")
    def follow(texts: pa.Array, trees: pa.Array, changes: pa.Array) -> pa.Array:
        counter, rows = _counter(shared.value), []
        for one, was, change in zip(texts, trees, changes, strict=True):
            before, old, todo = one.as_py() or "", was.as_py(), change.as_py() or []
            todo = [(edit["start"], edit["stop"], edit["replacement"] or "") for edit in todo]
            new, encoded = counter.edited(before, CountTree(old["lengths"], old["sums"]), todo)
            if max(new.lengths, default=0) > OVERGROWN * LEAF:
                new, more = counter.laid_out(apply_edits(before, todo), new)
                encoded += more
            rows.append({"tokens": new.total, "encoded": encoded, "tree": {"lengths": new.lengths, "sums": new.sums}})
        return pa.array(rows, pa.struct([("tokens", pa.int64()), ("encoded", pa.int64()), ("tree", _TREE_TYPE)]))

    return docs.withColumn(into, follow(*(F.col(f"`{name}`") for name in (text, tree, edits))))


# what the registered query edits: mail addresses and long numbers are replaced
_MAIL = re.compile(r"[A-Za-z0-9._+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}")
_NUMBER = re.compile(r"\d{7,}|\(\d{3}\) ?\d{3}-\d{4}")


def redactions(text: str) -> list[Edit]:
    """Edits that hide mail addresses and long or telephone numbers."""
    found = [(m.start(), m.end(), "<MAIL>") for m in _mails(text)]
    found += [(m.start(), m.end(), "<NUMBER>") for m in _NUMBER.finditer(text)]
    kept: list[Edit] = []
    for edit in sorted(found):
        if not kept or kept[-1][1] <= edit[0]:
            kept.append(edit)
    return kept


def _mails(text: str) -> Iterator[re.Match]:
    """Addresses, looked for only around each ``@``."""
    at = text.find("@")
    while at >= 0:
        found = _MAIL.search(text, max(0, at - 64), at + 640)
        if found:
            yield found
        at = text.find("@", max(at + 1, found.end() if found else 0))


def with_redactions(docs: DataFrame, text: str = "text", into: str = "edits") -> DataFrame:
    """``docs`` with the edits of :func:`redactions`."""

    @F.arrow_udf(EDITS)
    def edits(column: pa.Array) -> pa.Array:
        return pa.array([[{"start": a, "stop": b, "replacement": new} for a, b, new in redactions(one.as_py() or "")]
                         for one in column], pa.list_(pa.struct(
                             [("start", pa.int32()), ("stop", pa.int32()), ("replacement", pa.string())])))

    return docs.withColumn(into, edits(F.col(f"`{text}`")))


_TREE_TYPE = pa.struct([("lengths", pa.list_(pa.int32())), ("sums", pa.list_(pa.int32()))])
