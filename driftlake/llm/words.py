"""Words of whole texts as 64-bit hashes, and Rabin-Karp hashes of runs of words, a block of documents at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at once; a longer document makes a block of its own.
BLOCK_BYTES = 1 << 19
#: White space of the contracts: space and \x09 to \x0D.
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
#: White space and ASCII punctuation.
PUNCT = WHITE.copy()
PUNCT[[b for b in range(128) if not chr(b).isalnum()]] = True
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[65:91] += 32
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    return _powers(base, 1 << max(10, int(n - 1).bit_length()))[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Karp-Rabin hashes of values[start:end], from one running sum."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(inverse(base), len(values) + 1)[starts] + (ends - starts).astype(np.uint64))


class Block:
    """Some documents' words: hash and document of each, and their places in the bytes."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE, fold: np.ndarray = LOWER):
        self.first, self.data, self.offsets, self.n_docs = first, data, offsets, len(offsets) - 1
        inside = ~separators[data]
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        before = np.empty(len(data), bool)
        before[:1], before[1:] = False, inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | begins[:-1]))
        after = np.empty(len(data), bool)
        after[-1:], after[:-1] = False, inside[1:]
        self.ends = np.flatnonzero(inside & (~after | begins[1:])) + 1
        self.doc = np.searchsorted(offsets, self.starts, "right") - 1
        self.words = run_hashes(fold[data].astype(np.uint64) + np.uint64(1), self.starts, self.ends, BYTE_BASE)
        self.bounds = np.searchsorted(self.doc, np.arange(self.n_docs + 1))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each run of k words, by first word, and whether the run is within one document."""
        n = max(0, len(self.words) - k + 1)
        at = np.arange(n)
        return run_hashes(self.words, at, at + k, WORD_BASE), self.doc[:n] == self.doc[k - 1 : k - 1 + n]


@lru_cache(maxsize=1)
def _trim():
    """The C library's malloc_trim, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


def tidy() -> None:
    """Give unused memory back to the system: workers share an executor, and the driver's Python its machine, with a JVM."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def text_blocks(batch: pa.RecordBatch, name: str = "text", **how) -> Iterator[Block]:
    """The batch's texts, null ones empty, in blocks of whole documents; Block.first is the row of its first document."""
    column = batch.column(name)
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if column.null_count:
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        sizes = np.where(valid, np.diff(offs), 0)
        if (sizes != np.diff(offs)).any():
            data = np.concatenate([data[offs[i] : offs[i + 1]] for i in np.flatnonzero(valid)] or [data[:0]])
            offs = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + BLOCK_BYTES, "right")) - 1)
        to = min(to, n)
        yield Block(at, data[offs[at] : offs[to]], offs[at : to + 1] - offs[at], **how)
        at = to
    if n >= 500:
        tidy()


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of width values."""
    span, n = 1, len(x)
    if n < width:
        return x[:0]
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: n - width + 1], x[width - span : width - span + n - width + 1])


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def ids_of(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids as int64, and which are not null."""
    column = batch.column(name).cast(pa.int64())
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False), valid


def xxhash64(longs: np.ndarray) -> np.ndarray:
    """The public xxHash64 of eight bytes with seed 42, as pyspark.sql.functions.xxhash64 has it of a long."""
    p1, p2, p3, p4 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63))

    def turned(x: np.ndarray, by: int) -> np.ndarray:
        return x << np.uint64(by) | x >> np.uint64(64 - by)

    h = np.uint64((42 + 0x27D4EB2F165667C5 + 8) % (1 << 64)) ^ (turned(longs.view(np.uint64) * p2, 31) * p1)
    h = turned(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))
