"""Whole-batch word splitting and hashing for Arrow text columns.

A word is a maximal run of bytes other than space and ``\\x09-\\x0D``.  All
work is on flat numpy arrays over the UTF-8 bytes of many documents at once,
so there is no Python object per word.  Hashes are 64-bit polynomials over a
random byte table, finished by a bijective mixer; two seeds give two
independent hashes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
NULL_ID = np.iinfo(np.int64).max

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
#: Lower case, with ASCII punctuation read as space.
LETTERS = _LOWER.copy()
LETTERS[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finisher, so near-equal inputs spread over all 64 bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9FB21C651E98DF25)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=8)
def _seeded(seed: int) -> tuple[np.ndarray, int]:
    rng = np.random.default_rng(0x5EED + seed)
    return rng.integers(1, 2**64, 256, dtype=np.uint64), int(rng.integers(1, 2**62)) * 2 + 1


_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(seed: int, n: int, inverse: bool) -> np.ndarray:
    """base**i (or base**-i) modulo 2**64 for i < n."""
    have = _POWERS.get((seed, inverse))
    if have is None or len(have) < n:
        base = _seeded(seed)[1]
        base = pow(base, -1, 2**64) if inverse else base
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[seed, inverse] = np.multiply.accumulate(steps)
    return have[:n]


class RangeHash:
    """Position-free 64-bit hash of any range of a sequence, in constant time per range."""

    def __init__(self, values: np.ndarray, seed: int):
        n = len(values)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * _powers(seed, n, False), out=self.sums[1:])
        self.back = _powers(seed, n + 1, True)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


class Docs:
    """The words of a slice of documents: byte ranges, and ``first`` = word offset of each document."""

    def __init__(self, texts: pa.Array, lower: bool = False, table: np.ndarray | None = None):
        data, self.offsets = _bytes_of(texts)
        table = _LOWER if lower and table is None else table
        self.data = data = data if table is None else table[data]
        n = len(data)
        solid = ~_SPACE[data]
        edge = np.zeros(n + 1, dtype=bool)  # a document starts here, or the bytes end
        edge[self.offsets] = True
        start = solid.copy()
        start[1:] &= ~solid[:-1] | edge[1:n]
        stop = solid.copy()
        stop[:-1] &= ~solid[1:] | edge[1:n]
        self.starts = np.flatnonzero(start)
        self.ends = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return RangeHash(_seeded(seed)[0][self.data], seed)(self.starts, self.ends)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.n_words)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and their offsets; a null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def byte_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Re-cut batches so each holds at most ``limit`` text bytes (one longer document stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = _bytes_of(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def ids_of(batch: pa.RecordBatch, column: str = "doc_id") -> np.ndarray:
    """Ids as int64; a null id sorts after every other."""
    return np.asarray(batch.column(column).cast(pa.int64()).fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False))


def _trim() -> Callable[[int], int] | None:
    """The C library's call that hands free memory back to the system, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


@contextmanager
def released():
    """A task's block: at its end the memory it freed goes back to the system, not to the idle worker process."""
    try:
        yield
    finally:
        pa.default_memory_pool().release_unused()
        trim = _trim()
        if trim is not None:
            trim(0)


def arrow_map(fn: Callable[[pa.RecordBatch], dict | None], schema: pa.Schema,
              column: str = "text") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function calling ``fn`` on bounded slices; ``fn`` returns columns by name.  Freed memory goes back at a task's end."""

    def run(batches):
        with released():
            for part in byte_slices(batches, column):
                out = fn(part)
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [x if isinstance(x, pa.Array) else pa.array(x, type=f.type)
                         for f, x in ((f, out[f.name]) for f in schema)], schema=schema)

    return run


@contextmanager
def arrow_rows(spark, rows: int):
    """Python stages planned in this block get Arrow batches of at most ``rows`` rows (fewer where the session says so)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def segments(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, concatenated."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts)


def lists(values: np.ndarray, counts: np.ndarray, value_type: pa.DataType) -> pa.ListArray:
    """Consecutive runs of ``values`` as an Arrow list array."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=value_type))


class HashIndex:
    """Position of 64-bit hashes in a sorted table, by a directory on their leading bits."""

    def __init__(self, table: np.ndarray):
        self.table = np.sort(table.view(np.uint64))
        self.shift = np.uint64(64 - max(4, min(22, int(len(table)).bit_length() + 3)))
        slots = np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64)
        slot_of = self.table >> self.shift
        self.start = np.searchsorted(slot_of, slots).astype(np.int32)
        self.depth = int(np.diff(self.start).max()) if len(table) else 0

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each hash in the sorted table; its length for a hash it does not hold."""
        n = len(self.table)
        out = np.full(len(hashes), n, dtype=np.int64)
        if not n or not len(hashes):
            return out
        slot = (hashes >> self.shift).astype(np.int64)
        at, end, rows = self.start[slot], self.start[slot + 1], None
        for _ in range(self.depth):
            if rows is None:
                rows = np.flatnonzero(at < end)
                at, end, wanted = at[rows], end[rows], hashes[rows]
            else:
                more = at < end
                rows, at, end, wanted = rows[more], at[more], end[more], wanted[more]
            hit = self.table[at] == wanted
            out[rows[hit]] = at[hit]
            at = at + 1
        return out


_COUNTED = pa.schema([("word", pa.int64()), ("c", pa.int64())])


def _repeated_words(batch: pa.RecordBatch):
    words, counts = np.unique(Docs(batch.column("text"), lower=True).hashes(), return_counts=True)
    often = counts > 1  # a word among the most frequent of the corpus repeats within some slice
    return {"word": words[often].view(np.int64), "c": counts[often]} if often.any() else None


FLUSH_WORDS = 1 << 19


def _all_words(batches):
    """Every word of a task with its count, handed on whenever ``FLUSH_WORDS`` words have been read."""

    def counted(parts):
        words, counts = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts, pa.int64())], schema=_COUNTED)

    parts, held = [], 0
    for part in byte_slices(batches):
        parts.append(Docs(part.column("text"), lower=True).hashes())
        held += len(parts[-1])
        if held >= FLUSH_WORDS:
            yield counted(parts)
            parts, held = [], 0
    if held:
        yield counted(parts)


def top_words(texts, n: int, exact: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (ascending) and counts of the ``n`` most frequent lower-cased words of all ``text``: a fixed size.

    Not ``exact``, words are counted only in slices that repeat them, which is
    cheaper and depends on how the table is cut: enough where the words decide
    costs and no result.
    """
    from pyspark.sql import functions as F

    count = _all_words if exact else arrow_map(_repeated_words, _COUNTED)
    counted = texts.select("text").mapInArrow(count, "word long, c long")
    rows = counted.groupBy("word").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "word").limit(n).collect()
    words = np.array([r["word"] for r in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(words)
    return words[order], np.array([r["c"] for r in rows], dtype=np.int64)[order]
