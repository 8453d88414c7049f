"""Operator 8: language by a string kernel.

The kernel of two texts is the number of byte n-grams (n = 1 to 4, hashed to ``2 ** BITS`` places)
present in both, divided by the geometric mean of their own numbers (a blended-spectrum presence
kernel).  Training takes a bounded sample of every language: ``PER_LANGUAGE`` labelled texts by
hash order, of which the first ``LANDMARKS`` are Nystroem landmarks; where there are many languages, each gets
its share of ``TEXTS`` texts and ``MARKS`` landmarks, and one landmark and two texts at least.
One-versus-rest kernel ridge regression is solved in the landmarks' span.  Whole texts are scored in batches: presence matrix times landmarks, times the
regression's weights.

Defined results: A-Z is lower-cased, other ASCII bytes than letters count as one space; a text
that is null or has no letter (Unicode ``L``) is ``und`` with score 0; without any labelled text
every text is ``und``; null languages aren't learned; repeated rows and a null doc_id are scored
like any other (null is not held out, nor learned from); an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.llm import arrays
from codeloom.operators.broadcast import materialize

NGRAMS = (1, 2, 3, 4)
BITS = 16
#: Bounds of the training sample, for a language and in all.
PER_LANGUAGE, TEXTS = 200, 4000
LANDMARKS, MARKS = 32, 512
RIDGE = 1e-3
FOLDS, HELD_OUT_FOLD = 4, 2
UNKNOWN = "und"
#: Texts scored at once: the presence matrix has 2**BITS bytes a text.
ROWS, PIECE = 64, 1 << 18

_letter = np.where((arrays.LOWER >= 97) & (arrays.LOWER <= 122) | (np.arange(256) >= 128), arrays.LOWER, 32).astype(np.uint8)


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    columns: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))            # places that some landmark has
    landmarks: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))   # columns x landmarks, normalised
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))     # landmarks x languages


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x 2**BITS: whether the text has an n-gram at the place."""
    n = len(offsets) - 1
    out = np.zeros(n << BITS, dtype=bool)
    if len(data):
        lengths = np.diff(offsets)
        row = np.repeat(np.arange(n, dtype=np.int64) << BITS, lengths)
        left = np.repeat(offsets[1:], lengths) - np.arange(len(data))   # bytes to the text's end
        text = _letter[data].astype(np.uint32)
        code = np.zeros(len(data), np.uint32)
        for i in range(max(NGRAMS)):
            code[:len(data) - i] = code[:len(data) - i] << np.uint32(8) | text[i:]
            if i + 1 in NGRAMS:
                place = (code + np.uint32(i)) * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS)
                whole = left > i
                out[(row + place)[whole]] = True
    return out.reshape(n, 1 << BITS)


def small_pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    for a, b in arrays.pieces(offsets, PIECE):
        for at in range(a, b, ROWS):
            yield at, min(b, at + ROWS)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    """The sample's presence bits (8 kB a text, a bounded number of texts) come to the driver."""
    arrays.bounded_batches(docs.sparkSession)
    lettered = F.col(text).rlike(r"\p{L}")
    known = docs.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"), lettered.alias("ok")).where("ok and lang is not null and id is not null").where(~held_out("id"))
    slim = known.select("id", "lang")
    n_languages = max(1, slim.select("lang").distinct().count())
    texts, most_marks = (max(least, min(most, total // n_languages)) for least, most, total in ((2, PER_LANGUAGE, TEXTS), (1, LANDMARKS, MARKS)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    chosen = materialize(slim.withColumn("rank", rank).where(F.col("rank") <= texts), "language_sample")
    sample = known.select("id", "text").join(F.broadcast(chosen), "id")

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.utf8(batch.column("text"))
            for a, b in small_pieces(offsets):
                x = np.packbits(presence(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]), axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("lang").slice(a, b - a), batch.column("rank").slice(a, b - a), pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "rank", "bits"])

    rows = sample.select("lang", "rank", "text").mapInArrow(arrays.released(bits), "lang string, rank int, bits binary").collect()
    if not rows:
        return Model()
    rows.sort(key=lambda r: (r["lang"], r["rank"], r["bits"]))
    bits_of = lambda some: np.unpackbits(np.stack([np.frombuffer(r["bits"], np.uint8) for r in some]), axis=1)
    marks = np.array([r["rank"] <= most_marks for r in rows])
    chosen_bits = bits_of([r for r, m in zip(rows, marks) if m])
    columns = np.flatnonzero(chosen_bits.any(axis=0))
    landmarks = (chosen_bits[:, columns] / np.sqrt(np.maximum(chosen_bits.sum(axis=1, dtype=np.float32), 1))[:, None]).T.astype(np.float32)
    languages = sorted({r["lang"] for r in rows})
    place = {g: i for i, g in enumerate(languages)}
    y = np.full((len(rows), len(languages)), -1.0)
    y[np.arange(len(rows)), [place[r["lang"]] for r in rows]] = 1.0
    pieces = []
    for at in range(0, len(rows), 256):                                    # texts x landmarks
        x = bits_of(rows[at:at + 256])
        pieces.append(x[:, columns].astype(np.float32) @ landmarks / np.sqrt(np.maximum(x.sum(axis=1, dtype=np.float32), 1))[:, None])
    k = np.vstack(pieces).astype(np.float64)
    mm = k[marks]
    left = k.T @ k + RIDGE * len(rows) * (mm + mm.T) / 2 + 1e-9 * np.eye(len(mm))
    weights = np.linalg.lstsq(left, k.T @ y, rcond=None)[0]
    return Model(languages, columns, landmarks, weights.astype(np.float32))


def predictions(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    arrays.bounded_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        names = np.array([*m.languages, UNKNOWN], dtype=object)
        for batch in batches:
            data, offsets = arrays.utf8(batch.column("text"))
            best, score = np.full(batch.num_rows, len(m.languages)), np.zeros(batch.num_rows)
            for a, b in small_pieces(offsets) if m.languages else ():
                x = presence(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                own = np.sqrt(np.maximum(x.sum(axis=1), 1))
                f = (x[:, m.columns].astype(np.float32) @ m.landmarks) @ m.weights / own[:, None]
                best[a:b] = f.argmax(axis=1)
                score[a:b] = np.clip((f.max(axis=1) + 1) / 2, 0, 1)
            ok = batch.column("ok").to_numpy(zero_copy_only=False).astype(bool)
            best[~ok] = len(m.languages)
            score[best == len(m.languages)] = 0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names[best], pa.string()), pa.array(score)], names=schema.names)

    ok = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(f"`{text}`").alias("text"), ok.alias("ok")).mapInArrow(arrays.released(run), schema)
