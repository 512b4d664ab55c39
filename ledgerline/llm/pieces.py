"""SentencePiece encoding and decoding by a Viterbi pass over many words at once.

Distinct words of equal length advance together, one character per step, as rows of a matrix. At each end position the
hashes of all substrings that end there probe the sorted keys of the pieces, and the best admissible one is stored as
a back-pointer per word.

* For a unigram model the best is the greatest sum of piece scores.
* For a BPE model it is the one piece that the model's merges would leave there. A sequence of pieces is what merging
  yields exactly if each neighbouring pair alone is left as it is, so a piece is admissible after the piece that ends
  before it when merging the two alone would not join them; that is replayed from their own merges, for all rows at once.

Words are cut wherever no piece holds both neighbouring characters, as before a run of spaces. Characters without a
piece become byte pieces. The ids are those of the public library for the same model.

A null or empty text has no ids and decodes to an empty text. A text keeps its rows, ties and order: one result per row.
Very long texts are taken in parts. What a
worker holds is bounded: half a megabyte of text at a time and 40 MB of segments met before, which it then forgets. The marker character U+2581 in a text is read back as a space, as the format
defines it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.wordhash import groups_of_texts, mix, powers_of

TOKENIZERS = "/opt/tokenizers"
MARK = "▁"
BASE = 0x9E3779B97F4A7C15 | 1
GATE_BITS = 21
CELLS = 1 << 18
KNOWN_BYTES = 40 << 20
PART_CHARS = 1 << 18
GROUP_BYTES = 1 << 19
LEARN_BYTES = 4 << 20


def _key(text: str) -> int:
    value = 0
    for char in text:
        value = (value * BASE + ord(char) + 1) % (1 << 64)
    return value


@dataclass
class PieceModel:
    """A model as arrays: sorted keys, scores, and for BPE how each piece comes about by merging."""

    pieces: list[str]
    scores: np.ndarray
    bpe: bool
    byte_ids: np.ndarray
    kinds: np.ndarray  # 0 text, 1 byte, 2 neither
    keys: np.ndarray = field(init=False)
    ids: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        texts = [(i, piece) for i, piece in enumerate(self.pieces) if self.kinds[i] == 0]
        if any(re.search(f"[^{MARK}]{MARK}", piece) for _, piece in texts):
            raise ValueError("pieces that cross the start of a word are not supported")
        keys = np.array([_key(piece) for _, piece in texts], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array([i for i, _ in texts], dtype=np.int32)[order]
        if len(self.keys) > 1 and (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have the same key")
        self.lengths = np.array([len(piece) for piece in self.pieces], dtype=np.int64)
        self.longest = max((len(piece) for _, piece in texts), default=1)
        self.gate = np.zeros(1 << GATE_BITS, dtype=bool)
        self.gate[self.keys >> np.uint64(64 - GATE_BITS)] = True
        self.own_key = np.zeros(len(self.pieces), dtype=np.uint64)
        self.own_key[self.ids] = self.keys
        self.powers = np.array([pow(BASE, k, 1 << 64) for k in range(self.longest + 2)], dtype=np.uint64)
        self.neighbours = {piece[k:k + 2] for _, piece in texts for k in range(len(piece) - 1)}
        # by rank a better piece is smaller; pieces of one score share a rank, the leftmost pair then goes first
        _, self.rank = np.unique(-self.scores, return_inverse=True)
        self.rank = self.rank.astype(np.int32)
        if self.bpe:
            self._replay()

    @classmethod
    def load(cls, path: str) -> PieceModel:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            content = file.read()
        model = sentencepiece_model_pb2.ModelProto.FromString(content)
        kind = model.trainer_spec.model_type
        known = sentencepiece_model_pb2.TrainerSpec
        if kind not in (known.BPE, known.UNIGRAM):
            raise ValueError("a BPE or unigram model is needed")
        reader = sentencepiece.SentencePieceProcessor(model_proto=content)
        bytes_ = np.full(256, reader.unk_id(), dtype=np.int32)
        for i, piece in enumerate(model.pieces):
            if reader.is_byte(i):
                bytes_[int(piece.piece[3:5], 16)] = i
        kinds = np.array([1 if reader.is_byte(i) else 0 if p.type == p.NORMAL else 2 for i, p in enumerate(model.pieces)])
        return cls([p.piece for p in model.pieces], np.array([p.score for p in model.pieces], dtype=np.float64),
                   kind == known.BPE, bytes_, kinds)

    def _replay(self) -> None:
        """Per piece and merge step: the step's rank and the ids at its left and right edge after it."""
        known = {piece: i for i, piece in enumerate(self.pieces) if self.kinds[i] == 0}
        steps = self.longest + 1
        count = len(self.pieces)
        self.step_rank = np.full((count, steps), np.iinfo(np.int32).max, dtype=np.int32)
        self.left_edge = np.full((count, steps), -1, dtype=np.int32)
        self.right_edge = np.full((count, steps), -1, dtype=np.int32)
        self.reachable = np.zeros(count, dtype=bool)
        for piece, i in known.items():
            parts, step = list(piece), 0
            while True:
                self.left_edge[i, step], self.right_edge[i, step] = known.get(parts[0], -1), known.get(parts[-1], -1)
                best = min(((self.rank[known[a + b]], at) for at, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
                            if a + b in known), default=None)
                if best is None:
                    break
                self.step_rank[i, step] = best[0]
                step += 1
                parts[best[1]:best[1] + 2] = ["".join(parts[best[1]:best[1] + 2])]
            self.reachable[i] = len(parts) == 1

    def probe(self, hashes: np.ndarray) -> np.ndarray:
        """The ids of the pieces with these hashes, -1 where there is none."""
        found = np.full(len(hashes), -1, dtype=np.int32)
        likely = np.flatnonzero(self.gate[hashes >> np.uint64(64 - GATE_BITS)])
        wanted = hashes[likely]
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == wanted
        found[likely[hit]] = self.ids[at[hit]]
        return found

    def stays_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the two pieces of each pair alone leaves exactly these two."""
        apart = self.reachable[right] & ((left < 0) | self.reachable[left])
        rows = np.flatnonzero(apart & (left >= 0))
        p = np.zeros(len(rows), dtype=np.int64)
        q = np.zeros(len(rows), dtype=np.int64)
        none = np.iinfo(np.int32).max
        while len(rows):
            a, b = left[rows], right[rows]
            x, y = self.right_edge[a, p], self.left_edge[b, q]
            joined = self.probe(self.own_key[x] * self.powers[np.minimum(self.lengths[y], self.longest + 1)] + self.own_key[y])
            joined[(x < 0) | (y < 0)] = -1
            across = np.where(joined >= 0, self.rank[joined], none)
            next_a, next_b = self.step_rank[a, p], self.step_rank[b, q]
            # of equal ranks the leftmost pair is merged first: within a, then across, then within b
            merges = (across < next_a) & (across <= next_b) & (across < none)
            apart[rows[merges]] = False
            first = next_a <= next_b
            go = ~merges & ((next_a < none) | (next_b < none))
            p, q = (p + first)[go], (q + ~first)[go]
            rows = rows[go]
        return apart


def _sorted_by_first(keys: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    return keys[order], others[order]


class Encoder:
    """Encodes texts in segments between which no piece can reach, remembering the segments it has met."""

    def __init__(self, model: PieceModel):
        self.model = model
        chars = sorted({char for pair in model.neighbours for char in pair})
        self.classes = np.zeros(0x110000, dtype=np.int16)
        self.classes[[ord(char) for char in chars]] = np.arange(1, len(chars) + 1, dtype=np.int16)
        self.joins = np.zeros((len(chars) + 1, len(chars) + 1), dtype=bool)
        for one, two in model.neighbours:
            self.joins[self.classes[ord(one)], self.classes[ord(two)]] = True
        self._forget()
        self._grow(PART_CHARS + 2)

    def _grow(self, length: int) -> None:
        self.powers, self.inverse = powers_of(BASE, length)

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.rows = np.zeros(0, dtype=np.int64)
        # those learnt since the last time all were sorted
        self.late_known, self.late_rows = self.known, self.rows
        self.flat = np.zeros(0, dtype=np.int32)
        self.bounds = np.zeros(1, dtype=np.int64)

    def _advance(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Back-pointers of the rows of a character matrix: token (or -1 - code point) and its length per end."""
        model, (n, length) = self.model, chars.shape
        sums = np.zeros((length + 1, n), dtype=np.uint64)
        for i in range(length):
            sums[i + 1] = sums[i] * np.uint64(BASE) + chars[:, i] + np.uint64(1)
        token = np.empty((length + 1, n), dtype=np.int32)
        back = np.ones((length + 1, n), dtype=np.int16)
        best = np.zeros((length + 1, n)) if not model.bpe else None
        worst = float(model.scores.min()) - 10.0
        for i in range(1, length + 1):
            token[i] = -1 - chars[:, i - 1].astype(np.int32)
            open_ = np.arange(n)
            if best is not None:
                best[i] = best[i - 1] + worst
            for size in range(min(model.longest, i), 0, -1):
                found = model.probe(sums[i, open_] - sums[i - size, open_] * model.powers[size])
                hit = np.flatnonzero(found >= 0)
                if not len(hit):
                    continue
                rows, ids = open_[hit], found[hit]
                if best is not None:
                    score = best[i - size, rows] + model.scores[ids]
                    good = score > best[i, rows]
                    best[i, rows[good]] = score[good]
                else:
                    previous = token[i - size, rows] if i > size else np.full(len(rows), -1, dtype=np.int32)
                    good = model.stays_apart(previous, ids)
                token[i, rows[good]], back[i, rows[good]] = ids[good], size
                if best is None and good.any():
                    left = np.ones(len(open_), dtype=bool)
                    left[hit[good]] = False
                    open_ = open_[left]
                    if not len(open_):
                        break
        return token, back

    def _tokens(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the rows one after another, and how many each has."""
        token, back = self._advance(chars)
        n, length = chars.shape
        rows, ends = np.arange(n), np.full(n, length)
        path = np.zeros((n, length), dtype=np.int32)
        used = np.zeros(n, dtype=np.int64)
        while len(rows):
            used[rows] += 1
            path[rows, length - used[rows]] = token[ends, rows]
            ends = ends - back[ends, rows]
            go = ends > 0
            rows, ends = rows[go], ends[go]
        flat = path[np.arange(length) >= (length - used)[:, None]]
        return self._bytes(flat, used) if (flat < 0).any() else (flat, used)

    def _bytes(self, flat: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece replaced by byte pieces."""
        parts = [self.model.byte_ids[np.frombuffer(chr(-1 - t).encode("utf-8", "surrogatepass"), dtype=np.uint8)]
                 for t in flat[flat < 0].tolist()]
        sizes = np.ones(len(flat), dtype=np.int64)
        sizes[flat < 0] = [len(part) for part in parts]
        out = np.repeat(flat, sizes)
        out[np.repeat(flat < 0, sizes)] = np.concatenate(parts)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        stops = np.cumsum(used)
        return out, ends[stops] - ends[stops - used]

    def _learn(self, hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, chars: np.ndarray) -> None:
        """Encodes distinct segments, those of one length together."""
        order = np.argsort(lengths, kind="stable")
        hashes, starts, lengths = hashes[order], starts[order], lengths[order]
        flats, counts = [self.flat], []
        at_row = len(self.bounds) - 1
        for length in np.unique(lengths).tolist():
            first, last = np.searchsorted(lengths, [length, length + 1])
            step = max(1, CELLS // length)
            for at in range(first, last, step):
                some = starts[at:min(last, at + step)]
                flat, used = self._tokens(chars[some[:, None] + np.arange(length)])
                flats.append(flat)
                counts.append(used)
        self.flat = np.concatenate(flats)
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(np.concatenate(counts))])
        self.late_known, self.late_rows = _sorted_by_first(
            np.concatenate([self.late_known, hashes]),
            np.concatenate([self.late_rows, np.arange(at_row, at_row + len(hashes))]))
        if len(self.late_known) > len(self.known) // 4:
            self.known, self.rows = _sorted_by_first(
                np.concatenate([self.known, self.late_known]), np.concatenate([self.rows, self.late_rows]))
            self.late_known, self.late_rows = self.known[:0], self.rows[:0]

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """Where each hash is known, -1 where it is not."""
        places = np.full(len(hashes), -1)
        for known, rows in ((self.known, self.rows), (self.late_known, self.late_rows)):
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                places = np.where(known[at] == hashes, rows[at], places)
        return places

    def _segments(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """The characters of all texts, start, length and hash of each segment, and where each text ends."""
        marked = [MARK + text if text else "" for text in texts]
        chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.concatenate(([0], np.cumsum([len(text) for text in marked], dtype=np.int64)))
        chars = np.where(chars == 32, np.uint32(ord(MARK)), chars)
        kinds = self.classes[chars]
        cut = np.ones(len(chars), dtype=bool)
        cut[1:] = ~self.joins[kinds[:-1], kinds[1:]]
        cut[ends[:-1][ends[:-1] < len(chars)]] = True
        starts = np.flatnonzero(cut)
        lengths = np.diff(np.append(starts, len(chars)))
        if len(chars) >= len(self.powers):
            self._grow(len(chars) + 1)
        sums = np.zeros(len(chars) + 1, dtype=np.uint64)
        np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * self.powers[:len(chars)], out=sums[1:])
        hashes = (sums[starts + lengths] - sums[starts]) * self.inverse[starts]
        return chars, starts, lengths, mix(hashes) ^ lengths.astype(np.uint64), ends

    def meet(self, groups: Iterable[list[str | None]]) -> None:
        """Learns the segments of some groups of texts together, of which only those not met before are kept in memory."""
        kept = (self.known, self.rows, self.late_known, self.late_rows, self.bounds, self.flat)
        if sum(part.nbytes for part in kept) > KNOWN_BYTES:
            self._forget()
        found = []
        for texts in groups:
            chars, starts, lengths, hashes, _ = self._segments(texts)
            codes, distinct = pd.factorize(hashes)
            example = np.zeros(len(distinct), dtype=np.int64)
            example[codes[::-1]] = np.arange(len(codes))[::-1]
            at = example[self._places(distinct) < 0]
            sizes = lengths[at]
            places = np.arange(sizes.sum()) + np.repeat(starts[at] - np.cumsum(sizes) + sizes, sizes)
            found.append((hashes[at], sizes, chars[places]))
        if not found:
            return
        hashes, sizes, chars = (np.concatenate(part) for part in zip(*found, strict=True))
        distinct, first = np.unique(hashes, return_index=True)
        if len(distinct):
            self._learn(distinct, (np.cumsum(sizes) - sizes)[first], sizes[first], chars)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and the bounds of each text's."""
        _, starts, _, hashes, ends = self._segments(texts)
        if not len(starts):
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
        rows = self._places(hashes)
        if (rows < 0).any():
            self.meet([texts])
            rows = self._places(hashes)
        first, sizes = self.bounds[rows], self.bounds[rows + 1] - self.bounds[rows]
        stops = np.cumsum(sizes)
        ids = self.flat[np.arange(stops[-1]) + np.repeat(first - stops + sizes, sizes)]
        return ids, np.concatenate(([0], stops))[np.searchsorted(starts, ends)]


class Decoder:
    def __init__(self, model: PieceModel):
        self.parts = [bytes([int(piece[3:5], 16)]) if kind == 1 else piece.replace(MARK, " ").encode() if kind == 0 else b""
                      for piece, kind in zip(model.pieces, model.kinds.tolist(), strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        joined = b"".join(map(self.parts.__getitem__, ids.tolist()))
        return (joined[1:] if joined[:1] == b" " else joined).decode("utf-8", "replace")


def _shared(spark: SparkSession, model_path: str):
    """A broadcast of the model as plain arrays, its size that of the vocabulary."""
    return spark.sparkContext.broadcast({"model": vars(PieceModel.load(model_path))})


def _tools(shared: dict) -> tuple[Encoder, Decoder]:
    """One encoder per worker process, kept from task to task in the worker's copy of the broadcast."""
    if "tools" not in shared:
        model = object.__new__(PieceModel)
        vars(model).update(shared["model"])
        shared["tools"] = (Encoder(model), Decoder(model))
    return shared["tools"]


def _parts(text: str) -> Iterator[str]:
    """A very long text in parts that begin at a word, without the space that encoding puts before each."""
    at = 0
    while len(text) - at > PART_CHARS:
        cut = re.compile("(?<=[^ ]) ").search(text, at + PART_CHARS)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start() + 1
    yield text[at:]


def _encode_all(encoder: Encoder, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    if all(text is None or len(text) <= PART_CHARS for text in texts):
        return encoder.encode(texts)
    parts = [list(_parts(text or "")) for text in texts]
    found = [[encoder.encode([part])[0] for part in own] for own in parts]
    bounds = np.concatenate(([0], np.cumsum([sum(map(len, own)) for own in found])))
    return np.concatenate([ids for own in found for ids in own]), bounds


def _met(encoder: Encoder, whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The texts of a batch in small groups, whose segments were learnt some megabytes of text at a time."""
    for large in groups_of_texts(whole, "t", LEARN_BYTES):
        small = list(groups_of_texts(large, "t", GROUP_BYTES))
        encoder.meet([text for text in batch.column("t").to_pylist() if text and len(text) <= PART_CHARS] for batch in small)
        yield from small


def encode_pieces(docs: DataFrame, model_path: str, text: str = "text", ids: str = "piece_ids",
                  round_trip: str | None = None) -> DataFrame:
    """``docs`` with the array ``ids`` instead of ``text``; ``round_trip`` names a flag: decoding gives the text back."""
    model = _shared(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(model.value)
        for whole in batches:
            for batch in _met(encoder, whole):
                texts = batch.column("t").to_pylist()
                flat, bounds = _encode_all(encoder, texts)
                same = [decoder.decode(flat[a:b]) == (one or "")
                        for one, a, b in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                ids = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column("rest"), ids, pa.array(same)], ["rest", "ids", "same"])

    rest = [name for name in docs.columns if name != text]
    packed = docs.select(F.struct(*[F.col(f"`{name}`") for name in rest]).alias("rest"), F.col(f"`{text}`").alias("t"))
    schema = f"rest {packed.schema['rest'].dataType.simpleString()}, ids array<int>, same boolean"
    found = packed.mapInArrow(run, schema)
    extra = [F.col("ids").alias(ids)] + ([F.col("same").alias(round_trip)] if round_trip else [])
    return found.select("rest.*", *extra)


def decode_pieces(encoded: DataFrame, model_path: str, ids: str = "piece_ids", text: str = "text") -> DataFrame:
    """``encoded`` with ``text`` decoded from ``ids`` added."""
    model = _shared(encoded.sparkSession, model_path)

    @F.pandas_udf("string")
    def decoded(column: pd.Series) -> pd.Series:
        _, decoder = _tools(model.value)
        return pd.Series([decoder.decode(np.asarray([] if one is None else one, dtype=np.int64)) for one in column])

    return encoded.withColumn(text, decoded(F.col(f"`{ids}`")))
