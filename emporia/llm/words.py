"""Vectorised word handling for Arrow string columns.

A word is a run of bytes outside 0x20 and 0x09-0x0D. Texts are taken as UTF-8
bytes and handled in chunks of bounded size, so the numpy temporaries stay
small whatever the batch holds; one text longer than a chunk is a chunk of its
own and is never cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK_BYTES = 2 << 20
BLOCK_BYTES = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """First ``n`` powers of the hash base, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        grown = np.empty(max(n, 2 * len(_powers)), dtype=np.uint64)
        grown[0] = 1
        grown[1:] = _BASE
        _powers = np.multiply.accumulate(grown)
    return _powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finishing step of the splitmix64 generator, elementwise."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``; what the work on each has freed is given back to the system before the next one is read.

    Python workers live on between tasks, and the allocators keep what they
    once had, beside the executor's heap.
    """
    pool = pa.default_memory_pool()
    try:
        trim = ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):       # another C library
        trim = None
    for b in batches:
        yield b
        del b
        pool.release_unused()
        if trim is not None:
            trim(0)


SHUFFLED_BYTES = 64 << 20


def dealt(frame: DataFrame, key: str, size: int) -> DataFrame:
    """``frame`` of about ``size`` bytes by ``key``: in the session's partitions, or in more where they would grow too large."""
    parts = -(-size // SHUFFLED_BYTES)
    own = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(parts, key) if parts > own else frame.repartition(key)


@dataclass
class Words:
    """The words of consecutive texts.

    ``first[i]:first[i + 1]`` are the words of text ``i``; ``starts`` and
    ``ends`` are byte positions in ``data``; ``offsets`` are the texts' own.
    """

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    inside: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def owner(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes; computed in blocks of words, so temporaries stay small."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        size = np.concatenate(([0], np.cumsum(self.ends - self.starts)))
        lo = 0
        while lo < len(out):
            hi = max(lo + 1, int(np.searchsorted(size, size[lo] + BLOCK_BYTES, "right")) - 1)
            lens = self.ends[lo:hi] - self.starts[lo:hi]
            begin = size[lo:hi] - size[lo]
            at = np.arange(int(size[hi] - size[lo])) - np.repeat(begin, lens)
            span = slice(self.starts[lo], self.ends[hi - 1])
            values = (self.data[span][self.inside[span]].astype(np.uint64) + np.uint64(1)) * powers(int(lens.max()))[at]
            out[lo:hi] = mix(np.add.reduceat(values, begin) + lens.astype(np.uint64))
            lo = hi
        return out

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Start words of all ``k``-word windows inside one text, and their hashes."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        total = np.zeros(n, dtype=np.uint64)
        for j, p in enumerate(powers(k)):
            total += hashes[j:j + n] * p
        last = np.repeat(self.first[1:], self.counts)[:n]
        ok = np.arange(n) + k <= last
        return np.flatnonzero(ok), mix(total[ok])


def split(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    inside = ~_SPACE[data]
    n = len(data)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    before[1:] = inside[:-1]
    before[:1] = False
    after = np.empty(n, dtype=bool)
    after[:-1] = inside[1:]
    after[-1:] = False
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets), inside)


def chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES,
           table: np.ndarray | None = None) -> Iterator[tuple[int, int, Words]]:
    """Chunks of a string column as (first row, end row, words); a null is an empty text.

    ``table`` replaces each byte, as ``LOWER`` does.
    """
    column = column.fill_null("") if column.null_count else column
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64, count=n + 1, offset=column.offset * 8)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.empty(0, dtype=np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + chunk_bytes, "right")) - 1
        end = min(max(end, at + 1), n)
        part = data[offsets[at]:offsets[end]]
        yield at, end, split(part if table is None else table[part], offsets[at:end + 1] - offsets[at])
        at = end
