"""Words of whole texts as numpy arrays, for functions that run inside ``mapInArrow``.

A chunk is a run of whole rows with a bounded number of text bytes (one longer text makes a chunk of
its own), so that the memory of a task does not depend on the size of its partition. Rows and words
are addressed by offsets: row ``r`` has the words ``first[r]`` to ``first[r + 1]``.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))
STEP = 1 << 16
SOME = 50_000

# White space of the contracts is 20 and 09 to 0D; the other class is 0-9, a-z and all beyond ASCII.
SPACED = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
PLAIN = np.array([b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A for b in range(256)])
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


_KEPT: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse; a process keeps one table, for the longest so far."""
    if len(_KEPT[0]) < n:
        size = max(STEP, 1 << (n - 1).bit_length())
        for i, factor in enumerate((BASE, UNBASE)):
            steps = np.full(size, factor)
            steps[0] = 1
            _KEPT[i] = np.cumprod(steps)
    return _KEPT[0], _KEPT[1]


def runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of ``values[start:end]`` for each pair; equal runs have equal hashes wherever they stand."""
    up, down = _powers(len(values))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)])])
    at = np.minimum(starts, max(len(values) - 1, 0))
    return mix((total[ends] - total[starts]) * down[at] + (ends - starts).astype(np.uint64) * BASE)


@dataclass
class Words:
    data: np.ndarray  # bytes of the chunk, lower-cased if asked for
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray
    first: np.ndarray  # first word of each row, and the number of words

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A hash of each word; some words at a time, since every byte needs 64-bit numbers on the way."""
        out = np.empty(len(self.starts), np.uint64)
        for i in range(0, len(out), SOME):
            starts, ends = self.starts[i : i + SOME], self.ends[i : i + SOME]
            out[i : i + SOME] = runs(BYTES[self.data[starts[0] : ends[-1]]], starts - starts[0], ends - starts[0])
        return out

    def windows(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every window of ``size`` consecutive words within a row."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        rows = self.rows
        at = np.flatnonzero(rows[:n] == rows[size - 1 :])
        return at, runs(hashes, at, at + size)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches between rows so that each part has at most ``limit`` bytes of ``column``, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    release()


def release() -> None:
    """Gives memory that a finished task has freed back to the system; Spark keeps its Python processes for later tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, and the offset of each row and of the end; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def find_words(column: pa.Array, inside: np.ndarray, lower: bool) -> Words:
    """The words of each row: longest runs of bytes that the table ``inside`` marks."""
    data, offsets = text_bytes(column)
    data = LOWER[data] if lower else data
    marked = inside[data]
    opens, closes = marked.copy(), marked.copy()
    opens[1:] &= ~marked[:-1]
    closes[:-1] &= ~marked[1:]
    begins, ends = offsets[:-1][offsets[:-1] < len(data)], offsets[1:][offsets[1:] > 0] - 1
    opens[begins] = marked[begins]
    closes[ends] = marked[ends]
    starts = np.flatnonzero(opens)
    return Words(data, starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets))


def gather(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The positions ``start``, ``start + 1``, ... of all runs one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)
