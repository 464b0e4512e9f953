"""Vectorised tokenising and hashing of Arrow text batches.

Texts are handled as UTF-8 bytes. Words are maximal runs of bytes other than
0x20 and 0x09-0x0D; none of these bytes occurs inside a multi-byte character,
so byte runs and character runs are the same words. Nulls are empty texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Most bytes of text handled at once; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 20

_MULT = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLE = np.random.default_rng(20240131).integers(0, 1 << 64, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_powers: list[np.ndarray] = []
_AT_ONCE = 1 << 16


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        up, down = np.full(size, _MULT), np.full(size, _INV)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(x, out=x) for x in (up, down)]
    return _powers[0][:n], _powers[1][:n]


#: Rows and bytes of an Arrow batch; texts are long, and a batch is held by the JVM and by the worker at once.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's rows and bytes per Arrow batch, unless they have been set below already.

    The settings stay: Spark reads them when the caller's action plans the
    result. They bound memory and change no result.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).removesuffix("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


class Texts:
    """Some texts as one byte buffer; text i is data[offsets[i]:offsets[i + 1]]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def lower(self) -> Texts:
        """A-Z in lower case; other characters stay."""
        return Texts(_LOWER[self.data], self.offsets)

    def prefix_hash(self) -> np.ndarray:
        """P with P[b] - P[a] times the inverse's power a: the hash of bytes a to b."""
        up, _ = powers(len(self.data) + 1)
        out = np.zeros(len(self.data) + 1, np.uint64)
        for a in range(0, len(self.data), _AT_ONCE):  # in parts, as the table's rows and their places take as much again
            part = self.data[a : a + _AT_ONCE]
            np.multiply(_TABLE[part], up[a : a + len(part)], out=out[a + 1 : a + 1 + len(part)])
        np.cumsum(out[1:], out=out[1:])
        return out

    def span_hash(self, starts: np.ndarray, ends: np.ndarray, prefix: np.ndarray | None = None) -> np.ndarray:
        p = self.prefix_hash() if prefix is None else prefix
        _, down = powers(len(self.data) + 1)
        return mix((p[ends] - p[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def words(self) -> Words:
        is_word = _IS_WORD[self.data]
        first = is_word.copy()
        first[1:] &= ~is_word[:-1]
        last = is_word.copy()
        last[:-1] &= ~is_word[1:]
        if len(self.data):
            inner = self.offsets[1:-1]
            inner = inner[(inner > 0) & (inner < len(self.data))]
            first[inner] |= is_word[inner]
            last[inner - 1] |= is_word[inner - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return Words(self, starts, ends, np.searchsorted(starts, self.offsets))


class Words:
    """The words of some texts; those of text i are ptr[i] to ptr[i + 1]."""

    def __init__(self, texts: Texts, starts: np.ndarray, ends: np.ndarray, ptr: np.ndarray):
        self.texts, self.starts, self.ends, self.ptr = texts, starts, ends, ptr

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    def text_of(self) -> np.ndarray:
        """The number of each word's text."""
        return np.repeat(np.arange(len(self.texts)), self.counts)

    def hashes(self) -> np.ndarray:
        return self.texts.span_hash(self.starts, self.ends)

    def shingles(self, n: int, whole_if_short: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word shingles and their texts' pointer.

        A text of 1 to n - 1 words has its whole sequence as its one shingle, if asked for.
        """
        h, counts = self.hashes(), self.counts
        short = (counts > 0) & (counts < n)
        k = np.maximum(counts - n + 1, 0)
        if whole_if_short:
            k = np.where(short, 1, k)
        ptr = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(k, out=ptr[1:])
        at = np.arange(ptr[-1]) - np.repeat(ptr[:-1] - self.ptr[:-1], k)
        out = np.full(len(at), np.uint64(n))
        left = np.repeat(counts, k) - (at - np.repeat(self.ptr[:-1], k))
        for j in range(n):
            inside = left > j
            step = out * _MULT + h[np.minimum(at + j, max(len(h) - 1, 0))]
            out = step if inside.all() else np.where(inside, step, out)
        return mix(out), ptr


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """An Arrow string column as bytes; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_dictionary(column.type):
        column = column.dictionary_decode()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(data, offsets - offsets[0])


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The batch in pieces of at most `most` bytes of text, or of one row."""
    texts = texts_of(batch.column(column))
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(texts.offsets, texts.offsets[at] + most, side="right")) - 1
        end = min(max(end, at + 1), len(texts))
        a, b = texts.offsets[at], texts.offsets[end]
        yield batch.slice(at, end - at), Texts(texts.data[a:b], texts.offsets[at : end + 1] - a)
        at = end
    trim()


def trim() -> None:
    """Gives freed memory back to the system; workers are reused, and what one operator needed once would stay theirs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every C library has it
        pass


def sum_by(ptr: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of values[ptr[i]:ptr[i + 1]]; 0 where that is empty."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[ptr[1:]] - total[ptr[:-1]]
