"""Operator 6: best-fit-decreasing packing of tokenised documents into sequences.

``tokenize_pieces`` turns documents into pieces of at most ``capacity`` tokens (in tasks,
whole texts).  ``best_fit_runs`` is best-fit decreasing with a segment tree over remaining
capacities.  Pieces of one length are interchangeable, so it takes each length with its count
(at most ``capacity`` rows, whatever the input) and places runs of equal pieces into runs of
equally full bins; the bins are those of piece-by-piece best-fit decreasing.  ``pack`` gives
every piece its place by rank among the pieces of its length.

Defined results: a null or empty text has the end token only (one piece of length 1); a null
doc_id is packed like any other; repeated rows are packed once per row; an empty table gives an
empty result; other columns are ignored; pieces of a text longer than the capacity are cut at
multiples of it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.llm import arrays, tokens
from codeloom.operators.broadcast import materialize

CAPACITY = 4096
END_ID = 1


class CapacityTree:
    """Segment tree over remaining capacities; leaf r holds whether an open bin has r left."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.leaves)

    def put(self, r: int, value: bool) -> None:
        i = r + self.leaves
        self.open[i] = value
        i //= 2
        while i:
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]
            i //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity of ``least`` or more that an open bin has."""
        i = least + self.leaves
        if not self.open[i]:
            while i > 1 and not (i % 2 == 0 and self.open[i + 1]):
                i //= 2
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first bin, pieces a bin, offset) of best-fit decreasing.

    Piece ``j`` of a run lies in bin ``first bin + j // a`` at ``offset + j % a * length``,
    a being its pieces a bin.
    """
    tree, bins = CapacityTree(capacity), {}  # remaining capacity -> [(first bin, bins)]
    runs, next_bin = [], 0

    def keep(r: int, first: int, n: int) -> None:
        if r > 0 and n > 0:
            bins.setdefault(r, []).append((first, n))
            tree.put(r, True)

    for length in sorted((k for k, c in counts.items() if c), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens doesn't fit {capacity}")
        done, count = 0, counts[length]
        while done < count:
            r = tree.tightest(length)
            if r is None:
                first, n, r = next_bin, -(-(count - done) // (capacity // length)), capacity
                next_bin += n
            else:
                first, n = bins[r].pop()
                if not bins[r]:
                    tree.put(r, False)
            each, offset, left = r // length, capacity - r, count - done
            full = min(n, left // each)
            if full:
                runs.append((length, done, full * each, first, each, offset))
                keep(r - each * length, first, full)
                done += full * each
            part = left if not full and left < each else count - done if full < n and count - done < each else 0
            if part:
                runs.append((length, done, part, first + full, part, offset))
                keep(r - part * length, first + full, 1)
                done += part
                full += 1
            keep(r, first + full, n - full)
    return runs


def tokenize_pieces(docs: DataFrame, encode: Callable[[list], tuple], capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id", end_id: int = END_ID) -> DataFrame:
    """Pieces of each document with the checksum of their ids; ``part`` and ``rank`` number
    the pieces of one length within a task (the same when a task runs again)."""
    arrays.bounded_batches(docs.sparkSession)
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), *[T.StructField(n, T.LongType()) for n in ("piece", "start", "length", "ids_crc32", "part", "rank")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ranks = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            column = batch.column("text")
            _, offsets = arrays.utf8(column)
            for a, b in arrays.pieces(offsets):
                ids, firsts = encode(column.slice(a, b - a).to_pylist())
                rows = []
                for i in range(b - a):
                    own = np.append(ids[firsts[i]:firsts[i + 1]], end_id).astype("<u4")
                    for k, at in enumerate(range(0, len(own), capacity)):
                        cut = own[at:at + capacity]
                        rows.append((a + i, k, at, len(cut), zlib.crc32(cut.tobytes()), ranks[len(cut)]))
                        ranks[len(cut)] += 1
                row, *rest = (np.array(c, dtype=np.int64) for c in zip(*rows))
                cols = [batch.column("doc_id").take(pa.array(row)), *map(pa.array, rest)]
                yield pa.RecordBatch.from_arrays([*cols[:5], pa.array(np.full(len(row), part, np.int64)), cols[5]], names=schema.names)

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(arrays.released(run), schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (of :func:`tokenize_pieces`) with ``sequence_id`` and ``offset``.

    To the driver go the counts by length, at most ``capacity`` rows; back to the tasks go the
    runs, of which there is a bounded number for a capacity.
    """
    pieces = materialize(pieces, "pieces")
    counts = materialize(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece_counts")
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.array(best_fit_runs(total, capacity), dtype=np.int64).reshape(-1, 6)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    key = runs[:, 0] << 48 | runs[:, 1]
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).drop("n")
    ranked = pieces.join(before, ["part", "length"])
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    schema = T.StructType([pieces.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in names[1:]]])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() + batch.column("before").to_numpy()
            run = runs[np.searchsorted(key, length << 48 | rank, side="right") - 1]
            j = rank - run[:, 1]
            at = run[:, 3] + j // run[:, 4], run[:, 5] + j % run[:, 4] * length
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names[:5]], *map(pa.array, at)], names=names)

    return ranked.mapInArrow(arrays.released(place), schema).withColumn("piece", F.col("piece").cast("int"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id", end_id: int = END_ID) -> DataFrame:
    """Tokenise with the word-BPE vocabulary at ``path`` (installed on every executor) and pack."""
    def encode(texts: list) -> tuple:
        return tokens.word_bpe(path).encode(texts)

    return pack(tokenize_pieces(docs, encode, capacity, text, doc_id, end_id), capacity)
