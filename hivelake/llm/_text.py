"""Vectorised word hashing over Arrow string batches.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``; UTF-8 keeps those bytes for white space
alone, so the split by bytes equals the split by characters.  Words and lines are identified by a 64-bit hash:
the sum of their bytes, each times a random multiplier of its place, then mixed.  The multipliers have no
structure, so no form of a text makes two of them equal: whatever the two, they are with a chance below 2**-56.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(max(2 * SLICE_BYTES, 1 << (n - 1).bit_length()))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each row's offsets in them; a null is empty."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    n = len(column)
    if n == 0 or column.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:  # a null may cover bytes: leave them out
        keep = np.asarray(column.is_valid())
        lengths = np.where(keep, np.diff(offsets), 0)
        if (lengths != np.diff(offsets)).any():
            return text_bytes(column.fill_null(""))
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` bytes, or of one row."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, min(end, n)
        at = end


@lru_cache(maxsize=1)
def _multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _BASE)


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; spans ascend, don't overlap and are not empty."""
    size = end - start
    if not len(size):
        return np.zeros(0, np.uint64)
    first = np.cumsum(size) - size
    place = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
    value = raw[place + np.repeat(start, size)].astype(np.uint64)
    value += np.uint64(1)
    value *= _multipliers(max(1 << 12, 1 << int(size.max() - 1).bit_length()))[place]
    return mix(np.add.reduceat(value, first) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """The words of some rows, in order: where each begins and ends in ``raw``, its row, and its hash."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    n_rows: int

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.n_rows)


def words_of(raw: np.ndarray, offsets: np.ndarray, *, lower: bool) -> Words:
    n_rows = len(offsets) - 1
    inside = ~WHITE[raw]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]  # a text's last word and the next text's first are two words
    edges = edges[(edges > 0) & (edges < len(raw))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashed = span_hashes(LOWER[raw] if lower else raw, start, end)
    row = np.repeat(np.arange(n_rows), np.diff(np.searchsorted(start, offsets)))
    return Words(raw, start, end, row, hashed, n_rows)


def word_slices(column: pa.Array, *, lower: bool) -> Iterator[tuple[int, int, Words]]:
    """``(first row, row after the last, words)`` for runs of rows of about ``SLICE_BYTES``."""
    raw, offsets = text_bytes(column)
    for a, b in slices(offsets):
        yield a, b, words_of(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lower=lower)


def runs_of(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``k`` words of one row; a row of 1 to ``k - 1`` words gives one run of them all."""
    h, n = words.hash, len(words.hash)
    total = np.zeros(n, np.uint64)
    counts = words.counts()
    last = np.cumsum(counts)[words.row] if n else np.zeros(0, np.int64)  # the index after the row's last word
    at = np.arange(n)
    scale = 1
    for j in range(k):
        part = np.zeros(n, np.uint64)
        part[: max(0, n - j)] = h[j:]  # a slice may hold fewer than k words
        part[at + j >= last] = 0
        total += mix(part + np.uint64(j + 1)) * np.uint64(scale)
        scale = scale * int(_BASE) % (1 << 64)
    short = counts[words.row] < k if n else np.zeros(0, bool)
    first = at == last - counts[words.row] if n else np.zeros(0, bool)
    keep = (at + k <= last) | (short & first)
    return mix(total[keep]), words.row[keep]


def distinct_per_row(values: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each row, sorted within it, and the rows' offsets; ``rows`` ascends."""
    at = np.searchsorted(rows, np.arange(n_rows + 1))
    parts = [np.unique(values[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), offsets


class Lookup:
    """Places of hashes in an ascending array of hashes, by a table over their first bits."""

    def __init__(self, known: np.ndarray) -> None:
        self.known = known
        bits = max(1, (len(known) - 1).bit_length() if len(known) else 1)
        self.shift = np.uint64(64 - bits)
        begins = np.searchsorted(known, np.arange(1 << bits, dtype=np.uint64) << self.shift)
        self.begins = np.append(begins, len(known)).astype(np.int32)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        slot = (hashes >> self.shift).astype(np.int64)
        at, end = self.begins[slot], self.begins[slot + 1]
        out = np.full(len(hashes), -1)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            here = at[open_]
            hit = self.known[here] == hashes[open_]
            out[open_[hit]] = here[hit]
            open_ = open_[~hit]
            at[open_] += 1
            open_ = open_[at[open_] < end[open_]]
        return out
