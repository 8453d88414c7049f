"""Words and hashes of whole Arrow batches, with numpy on the UTF-8 bytes.

Texts are never cut: a batch is worked through in pieces of whole texts, and a
text longer than a piece makes a piece of its own.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of text that are worked on at once.
PIECE_BYTES = 1 << 18
#: Rows of an Arrow batch: rows are whole texts, and a batch is held by the JVM and by Python.
BATCH_ROWS, BATCH_CONF = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"
#: An odd number, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

_byte = np.arange(256)
#: Upper-case ASCII letters lower-cased; other bytes as they are.
LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
#: Bytes of words: ASCII digits and letters, and all bytes of other characters.
WORD = ((_byte >= 48) & (_byte <= 57)) | ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)

_powers: dict[int, np.ndarray] = {}


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS rows where they may be larger."""
    now = int(spark.conf.get(BATCH_CONF, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, which gives the memory that it freed back to the system when its task ends.

    Python workers live on between tasks, beside the executor's heap.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):   # elsewhere than with glibc
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return task


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i in 0..n-1 (kept, and made longer when needed)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, PIECE_BYTES + 1)
        steps = np.full(size, np.uint64(base), dtype=np.uint64)
        steps[0] = 1
        _powers[base] = have = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``values[start:end]`` that does not depend on its place."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    terms = values.astype(np.uint64)
    terms += np.uint64(1)
    terms *= powers(BASE, n)
    np.cumsum(terms, out=sums[1:])
    h = sums[ends]
    h -= sums[starts]
    h *= powers(INVERSE, n + 1)[starts]
    return mix(h)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each value begins (n + 1 offsets); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``most`` bytes together; every row is in one."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to
        at = to


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, where its bytes begin, and per text the index of its first word (n + 1)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return span_hashes(LOWER[data], starts, ends), starts, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``n`` words in one text, and per text the index of its first window.

    A text of fewer words, but not none, has one window with all its words.
    """
    counts = np.diff(firsts)
    windows = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    out_firsts = np.concatenate([[0], np.cumsum(windows)])
    total = int(out_firsts[-1])
    if total == 0:
        return np.zeros(0, np.uint64), out_firsts
    text = np.repeat(np.arange(len(counts)), windows)
    starts = firsts[text] + (np.arange(total) - out_firsts[text])
    ends = np.minimum(starts + n, firsts[text + 1])
    return span_hashes(hashes, starts, ends), out_firsts
