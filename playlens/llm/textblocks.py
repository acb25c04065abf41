"""Texts as numpy arrays: words, lines, word hashes and word shingles.

The operators that leave the JVM work on Arrow batches.  A batch is cut into
blocks of whole texts (about :data:`BLOCK_BYTES` each, a longer text is a block
of its own), and every step below runs over all texts of a block at once, so no
Python code runs per word and memory is bounded by one block.

Words are the runs ``[^\\x20\\x09-\\x0D]+``; only ``A``-``Z`` are lower-cased.
A null text is an empty one.  Hashes are 64-bit and depend on the word's bytes
alone, so they agree between tasks, runs and machines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18

_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse (mod 2**64), at least ``n`` of them."""
    if len(_powers[0]) < n:
        n = max(n, BLOCK_BYTES * 2)
        for k, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def fmix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; returns a new array."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Block:
    """Whole texts ``lo..hi`` of a batch: their bytes and where each text begins."""

    def __init__(self, lo: int, hi: int, data: np.ndarray, offsets: np.ndarray):
        self.lo, self.hi, self.data, self.offsets = lo, hi, data, offsets
        self._words: tuple | None = None
        self._prefix: dict[bool, np.ndarray] = {}

    @property
    def n(self) -> int:
        return self.hi - self.lo

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, first): byte spans of the words; words of text i are first[i]..first[i+1]."""
        if self._words is None:
            inside = ~_SEP[self.data]
            begin = inside.copy()
            begin[1:] &= ~inside[:-1]
            stop = inside.copy()
            stop[:-1] &= ~inside[1:]
            edges = self.offsets[1:-1]
            edges = edges[(edges > 0) & (edges < len(self.data))]
            begin[edges] = inside[edges]        # a text's end also ends its last word
            stop[edges - 1] = inside[edges - 1]
            starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
            self._words = starts, ends, np.searchsorted(starts, self.offsets)
        return self._words

    def word_counts(self) -> np.ndarray:
        return np.diff(self.words()[2])

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
        """64-bit hashes of the byte spans."""
        power, inverse = _grow(len(self.data) + 1)
        if lower not in self._prefix:
            data = _LOWER[self.data] if lower else self.data
            total = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=total[1:])
            self._prefix[lower] = total
        total = self._prefix[lower]
        return fmix64((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))

    def word_hashes(self, lower: bool = True) -> np.ndarray:
        starts, ends, _ = self.words()
        return self.span_hashes(starts, ends, lower)

    def owners(self, first: np.ndarray) -> np.ndarray:
        """For items counted by ``first`` (like words()[2]), the text each belongs to."""
        return np.repeat(np.arange(self.n), np.diff(first))

    def shingles(self, size: int, whole_if_shorter: bool, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, first): the ``size``-word shingles of each text, in order.

        A text of fewer words gives one shingle of all of them, or none; a text
        without words gives none.
        """
        hashes, first = self.word_hashes(lower), self.words()[2]
        counts = np.diff(first)
        per = np.maximum(counts - size + 1, 0)
        out_first = np.zeros(self.n + 1, dtype=np.int64)
        short = np.flatnonzero((counts > 0) & (counts < size)) if whole_if_shorter else np.zeros(0, np.int64)
        per[short] = 1
        np.cumsum(per, out=out_first[1:])
        out = np.zeros(out_first[-1], dtype=np.uint64)
        if len(hashes) >= size:
            mixed = np.full(len(hashes) - size + 1, np.uint64(size))
            for j in range(size):
                mixed = mixed * np.uint64(0xD6E8FEB86659FD93) + hashes[j:len(hashes) - size + 1 + j]
            long = np.maximum(counts - size + 1, 0)
            step = np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long)
            out[np.repeat(out_first[:-1], long) + step] = fmix64(mixed[np.repeat(first[:-1], long) + step])
        for i in short:
            value = np.full(1, np.uint64(counts[i]))
            for h in hashes[first[i]:first[i + 1]]:
                value = value * np.uint64(0xD6E8FEB86659FD93) + h
            out[out_first[i]] = fmix64(value)[0]
        return out, out_first

    def distinct(self, values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct values of each text, and where each text's begin."""
        owner = self.owners(first)
        order = np.lexsort((values, owner)) if self.n > 1 else np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        keep = np.ones(len(values), dtype=bool)
        keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        return values[keep], np.searchsorted(owner[keep], np.arange(self.n + 1))


def blocks(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The batch's texts in blocks of about ``limit`` bytes."""
    texts = batch.column(batch.schema.get_field_index(column))
    if pa.types.is_null(texts.type):
        texts = pa.array([""] * len(texts), pa.string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        own = offsets[lo:hi + 1]
        yield Block(lo, hi, data[own[0]:own[-1]], own - own[0])
        lo = hi
