"""Operator 11: quality by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its bytes, words and lines.  The model is learned
from preference pairs (a better and a worse document) by logistic loss on the differences of their
features: P(a beats b) = sigmoid(strength(a) - strength(b)).  Pairs come from the caller or, by
:func:`preferences`, from 0/1 labels: in each of ``ROUNDS`` rounds the documents are dealt into as
many slots as the rarer label has documents, and a slot's smallest hash of either label make a
pair.  So pairs grow as the labelled documents, and no group is large.  All labelled rows of the
training folds and all pairs count: gradient and Hessian are summed in Spark for each Newton step,
and only these sums (a fixed number) reach the driver.

The threshold is a quantile of the labelled documents' strengths, at the share of the label 0.  A
score is the probability to beat a document at the threshold; it is 0.5 at the threshold itself.

Defined results: words are lower-cased A-Z runs of ASCII letters, digits and all non-ASCII
characters; null and empty texts have the features of a text without bytes; several labels of a
doc_id count as their maximum, null labels and labels without a document as none; repeated rows
of a doc_id all have its label, and the first by their features stands for it in training; without
both labels every score is 0.5; rows with a null doc_id are scored like any other (null is not
held out, nor learned from); an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.llm import arrays
from codeloom.operators.broadcast import known_rows, materialize

ROUNDS = 8
RIDGE = 1e-3
STEPS = 25
FOLDS, HELD_OUT_FOLD = 3, 1
#: Accuracy of the quantile: ranks are right to one in so many.
ACCURACY = 100_000
#: Standardised features are cut here, so that one odd text can't rule the model.
MOST = 8.0

_byte = np.arange(256)
_groups = [(_byte >= 97) & (_byte <= 122), (_byte >= 65) & (_byte <= 90), (_byte >= 48) & (_byte <= 57), (_byte == 32) | (_byte == 9),
           (_byte >= 10) & (_byte <= 13), np.isin(_byte, list(b".,;:?'\"()-")), _byte >= 128]
#: Lower case, upper case, digit, blank, line end, punctuation of prose, beyond ASCII, other ASCII.
KINDS = 8
KIND = np.select(_groups, range(KINDS - 1), KINDS - 1).astype(np.int64)
NAMES = [f"kind_{i}" for i in range(KINDS)] + [f"kinds_{i}_{j}" for i in range(KINDS) for j in range(KINDS)] + [
    "log_words", "distinct_words", "distinct_pairs", "distinct_fives", "top_word", "word_length", "word_length_spread", "long_words", "words_a_line", "distinct_lines", "exclaimed"]


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def _distinct(values: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text, of its ``values``: the share that is distinct (1 without any), and the share of the most frequent."""
    n, counts = len(firsts) - 1, np.diff(firsts)
    share, top = np.ones(n), np.zeros(n)
    if len(values):
        text = np.repeat(np.arange(n), counts)
        order = np.lexsort((values, text))
        v, t = values[order], text[order]
        begins = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (t[1:] != t[:-1])]))
        some = counts > 0
        share[some] = np.bincount(t[begins], minlength=n)[some] / counts[some]
        np.maximum.at(top, t[begins], np.diff(np.append(begins, len(v))))
        top[some] /= counts[some]
    return share, top


def _windows(hashes: np.ndarray, firsts: np.ndarray, size: int) -> np.ndarray:
    return _distinct(*arrays.shingles(hashes, firsts, size))[0]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x NAMES, for the texts whose bytes ``data`` holds one after the other."""
    n, lengths = len(offsets) - 1, np.diff(offsets)
    size = np.maximum(lengths, 1)[:, None]
    text = np.repeat(np.arange(n), lengths)
    kind = KIND[data]
    singles = np.bincount(text * KINDS + kind, minlength=n * KINDS).reshape(n, KINDS) / size
    pair = np.flatnonzero(text[1:] == text[:-1])
    pairs = np.bincount(text[pair] * KINDS * KINDS + kind[pair] * KINDS + kind[pair + 1], minlength=n * KINDS * KINDS).reshape(n, -1) / size
    hashes, starts, firsts = arrays.words(data, offsets)
    words = np.diff(firsts)
    word_text = np.repeat(np.arange(n), words)
    inside = np.concatenate([[0], np.cumsum(arrays.WORD[data])])
    ends = np.append(starts[1:], offsets[-1])[:len(starts)]
    length = (inside[ends] - inside[starts]).astype(float)        # up to the next word only its own bytes are of words
    some = np.maximum(words, 1)
    mean = np.bincount(word_text, length, minlength=n) / some
    spread = np.sqrt(np.maximum(np.bincount(word_text, length ** 2, minlength=n) / some - mean ** 2, 0))
    distinct, top = _distinct(hashes, firsts)
    ends_line = data == 10
    line_first = np.concatenate([[True], ends_line[:-1] | (text[1:] != text[:-1])]) if len(data) else np.zeros(0, bool)
    line_starts = np.flatnonzero(line_first)
    line_hashes = arrays.span_hashes(data, line_starts, np.append(line_starts[1:], len(data))[:len(line_starts)])
    lines = np.searchsorted(line_starts, offsets)
    rest = [np.log1p(words), distinct, _windows(hashes, firsts, 2), _windows(hashes, firsts, 5), top, mean, spread,
            np.bincount(word_text, length > 12, minlength=n) / some, np.log1p(words / np.maximum(np.diff(lines), 1)),
            _distinct(line_hashes, lines)[0], np.bincount(text, data == 33, minlength=n) / some]
    return np.hstack([singles, pairs, np.stack(rest, axis=1)])


def _rows(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    data, offsets = arrays.utf8(column)
    for a, b in arrays.pieces(offsets):
        yield a, b, features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.astype(np.float32).reshape(-1)))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1).astype(float)


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float = 0.0

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -MOST, MOST) @ self.weights


def _none() -> Model:
    return Model(np.zeros(len(NAMES)), np.ones(len(NAMES)), np.zeros(len(NAMES)))


def preferences(truth: DataFrame, doc_id: str = "id", label: str = "y", rounds: int = ROUNDS) -> DataFrame:
    """Pairs (better, worse) of ids from labels 1 and 0 (one row an id)."""
    n = {r["y"]: r["n"] for r in truth.groupBy(F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = max(1, min(n.get(0, 0), n.get(1, 0)))
    dealt = truth.select(F.col(doc_id).alias("id"), F.col(label).alias("y"), F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("round"))
    dealt = dealt.withColumn("hash", F.xxhash64("round", "id")).withColumn("slot", F.pmod("hash", F.lit(slots)))
    first = F.struct("hash", "id")
    met = dealt.groupBy("round", "slot").agg(F.min(F.when(F.col("y") == 1, first)).alias("a"), F.min(F.when(F.col("y") == 0, first)).alias("b"))
    return met.where("a is not null and b is not null").select(F.col("a.id").alias("better"), F.col("b.id").alias("worse"))


def _summed(rows: DataFrame, column: str, terms, size: int) -> np.ndarray:
    """The sum over all rows of ``terms`` (rows x features -> ``size`` numbers), added up in Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += terms(_matrix(batch.column(column)))
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], names=["i", "v"])

    got = rows.select(column).mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for r in got:
        out[r["i"]] = r["v"]
    return out


def learn(strong: DataFrame, pairs: DataFrame, ridge: float = RIDGE) -> Model:
    """Bradley-Terry model of ``pairs`` (better, worse) of ids in ``strong`` (id, x: features)."""
    d = len(NAMES)
    moments = _summed(strong, "x", lambda x: np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)]), 1 + 2 * d)
    n = max(moments[0], 1)
    mean = moments[1:1 + d] / n
    model = Model(mean, np.sqrt(np.maximum(moments[1 + d:] / n - mean ** 2, 0)), np.zeros(d))
    model.spread = np.where(model.spread < 1e-9, 1.0, model.spread)
    better = strong.select(F.col("id").alias("better"), F.col("x").alias("x_better"))
    worse = strong.select(F.col("id").alias("worse"), F.col("x").alias("x_worse"))
    both = pairs.join(better, "better").join(worse, "worse").select(F.concat("x_better", "x_worse").alias("x"))
    both = materialize(both, "preferences")
    total = known_rows(both) or 0
    if not total:
        return _none()

    def step(w: np.ndarray):
        def terms(x: np.ndarray) -> np.ndarray:
            z = np.clip((x.reshape(-1, 2, d) - model.mean) / model.spread, -MOST, MOST)
            diff = z[:, 0] - z[:, 1]
            p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))          # of the worse one to win
            return np.concatenate([diff.T @ p, ((diff * (p * (1 - p))[:, None]).T @ diff).reshape(-1), [np.logaddexp(0, -diff @ w).sum()]])
        return terms

    w, least = np.zeros(d), np.inf
    move = np.zeros(d)
    for _ in range(STEPS):
        sums = _summed(both, "x", step(w), d + d * d + 1)
        loss = sums[-1] / total + ridge / 2 * float(w @ w)
        if loss > least:                       # too long a step: half of it
            move /= 2
            w = w - move
            continue
        if least - loss < 1e-4:
            break
        least = loss
        move = np.linalg.solve(sums[d:-1].reshape(d, d) / total + ridge * np.eye(d), sums[:d] / total - ridge * w)
        w = w + move
    model.weights = w
    return model


def described(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, x) of every row: its features (about a tenth of the texts' bytes), written once for training and scoring."""
    arrays.bounded_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("x", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, x in _rows(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), _lists(x)], names=schema.names)

    return materialize(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(arrays.released(run), schema), "quality_features")


def train(features_of: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> Model:
    """Model and threshold from :func:`described` documents and the labels (0/1) of the training folds; no text is shuffled."""
    truth = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").alias("y")).where("y is not null and id is not null").where(~held_out("id"))
    truth = truth.groupBy("id").agg((F.max("y") > 0).cast("int").alias("y"))
    known = features_of.select(F.col("doc_id").alias("id"), "x").join(truth, "id")
    strong = materialize(known.groupBy("id").agg(F.min("y").alias("y"), F.min("x").alias("x")), "quality_labelled")
    model = learn(strong.select("id", "x"), preferences(strong.select("id", "y")))
    if not model.weights.any():
        return model
    counted = strong.agg(F.count(F.lit(1)).alias("n"), F.sum(1 - F.col("y")).alias("low")).first()
    return thresholded(strong, model, counted["low"] / counted["n"], counted["n"])


def thresholded(strong: DataFrame, model: Model, share: float, n: int) -> Model:
    """``model`` with its threshold between the ``share`` weakest documents and the rest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(model.strengths(_matrix(batch.column("x"))))], names=["s"])

    at = [max(0.0, share - 0.01 / max(n, 1)), min(1.0, share + 0.99 / max(n, 1))]        # of the weakest below, and the next one
    low, high = strong.select("x").mapInArrow(run, "s double").agg(F.percentile_approx("s", at, ACCURACY).alias("s")).first()["s"]
    return Model(model.mean, model.spread, model.weights, (low + high) / 2)


def _probability(model: Model, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.strengths(x) - model.threshold, -30, 30)))


def scores(features_of: DataFrame, model: Model) -> DataFrame:
    """One row per :func:`described` document: doc_id, held_out, score, predicted."""
    schema = T.StructType([features_of.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p = _probability(model, _matrix(batch.column("x")))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=schema.names)

    return features_of.select("doc_id", held_out().alias("held_out"), "x").mapInArrow(arrays.released(run), schema)


def kept(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents at or above the model's threshold, with all their columns."""
    arrays.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, x in _rows(batch.column(text)):
                yield batch.slice(a, b - a).filter(pa.array(_probability(model, x.astype(np.float32).astype(float)) >= 0.5))

    return docs.mapInArrow(arrays.released(run), docs.schema)
