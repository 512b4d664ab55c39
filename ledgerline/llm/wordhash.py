"""Words of Arrow text columns as 64-bit hashes, by numpy over whole blocks of bytes.

A block is about ``BLOCK`` bytes and ends between two words, so memory stays bounded whatever the length of a text;
only a single word longer than that makes a block longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACES = (0x20, *range(0x09, 0x0E))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def powers_of(base: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd base from 0 on, and those of its inverse, modulo 2 to the 64."""
    powers = np.full(length, base, dtype=np.uint64)
    inverse = np.full(length, pow(base, -1, 1 << 64), dtype=np.uint64)
    powers[0] = inverse[0] = 1
    return np.cumprod(powers, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)


class Splitter:
    """Finds words between separator bytes, lower-casing A-Z."""

    def __init__(self, separators: tuple[int, ...] = _SPACES, prefixes: tuple[int, ...] = ()):
        self.prefixes = prefixes
        self.is_word = np.ones(256, dtype=bool)
        self.is_word[list(separators)] = False
        self.lower = np.arange(256, dtype=np.uint64)
        self.lower[65:91] += np.uint64(32)
        self._grow(BLOCK + 1)

    def _grow(self, length: int) -> None:
        self.powers, self.inverse = powers_of(_BASE, length)

    def blocks(self, values: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(hash, start byte, length)`` of the words of one block after another, in order.

        With ``prefixes`` a word has a row of hashes: its own and those of its first bytes, one for each of these sizes.
        ``offsets`` are the bounds of the texts within ``values``; a bound also ends a word.
        """
        at, end = int(offsets[0]), int(offsets[-1])
        while at < end:
            stop = min(end, at + BLOCK)
            while stop < end:
                spaces = np.flatnonzero(~self.is_word[values[at:stop]])
                bound = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
                cut = max(at + int(spaces[-1]) + 1 if len(spaces) else at, bound)
                if cut > at:
                    stop = cut
                    break
                stop = min(end, stop + BLOCK)
            yield self._words(values, offsets, at, stop)
            at = stop

    def _words(self, values: np.ndarray, offsets: np.ndarray, at: int, stop: int):
        chunk = values[at:stop]
        if len(chunk) >= len(self.powers):
            self._grow(len(chunk) + 1)
        inside = self.is_word[chunk]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        bounds = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, stop)] - at
        starts[bounds] = inside[bounds]
        ends = np.zeros(len(chunk) + 1, dtype=bool)
        ends[1:-1] = inside[:-1] & (~inside[1:] | starts[1:])
        ends[-1] = inside[-1]
        first, last = np.flatnonzero(starts), np.flatnonzero(ends)
        sums = np.zeros(len(chunk) + 1, dtype=np.uint64)
        np.cumsum((self.lower[chunk] + np.uint64(1)) * self.powers[:len(chunk)], out=sums[1:])
        whole = mix((sums[last] - sums[first]) * self.inverse[first])
        if not self.prefixes:
            return whole, first + at, last - first
        starts_of = [mix(mix((sums[np.minimum(first + size, last)] - sums[first]) * self.inverse[first]) ^ np.uint64(size))
                     for size in self.prefixes]
        return np.column_stack([whole, *starts_of]), first + at, last - first

    def words(self, values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(hashes, starts, lengths, bounds)``: text ``i`` has the words from ``bounds[i]`` to ``bounds[i + 1]``."""
        found = list(self.blocks(values, offsets))
        if not found:
            nothing = np.zeros(0, dtype=np.int64)
            none = np.zeros((0, 1 + len(self.prefixes)) if self.prefixes else 0, dtype=np.uint64)
            return none, nothing, nothing, np.zeros(len(offsets), dtype=np.int64)
        hashes, starts, lengths = (np.concatenate(part) for part in zip(*found, strict=True))
        return hashes, starts, lengths, np.searchsorted(starts, offsets)

    def runs(self, data: np.ndarray, size: int) -> np.ndarray:
        """The hash of every run of ``size`` bytes, as if it were a word."""
        if len(data) >= len(self.powers):
            self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((self.lower[data] + np.uint64(1)) * self.powers[:len(data)], out=sums[1:])
        return mix((sums[size:] - sums[:-size]) * self.inverse[:len(data) - size + 1])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and text bounds of an Arrow string column; a null text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    values = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return values, offsets


def groups_of_texts(batch: pa.RecordBatch, column: str, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``size`` bytes of text each, one text at least."""
    if not batch.num_rows:
        return
    _, offsets = text_buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        stop = min(stop, batch.num_rows)
        yield batch.slice(at, stop - at)
        at = stop
