"""Operator 9: toxic passages by maximum-scoring segments.

Training uses a bounded sample of labelled documents (``PER_LABEL`` of each label, by hash order).
A word's score is its log-odds between toxic and clean documents (those that have it) under an
informative Dirichlet prior (the words' joint frequencies), kept with its sign where the two differ
significantly (``SIGNIFICANT``; the words that pass by chance would else outweigh the few that tell: on
the 0.1 tables held-out recall is 0.94 with the bound, 0.91 at 6.6 and 0.0 without one); every other word costs a small ``drift``.  All maximal scoring segments of a text are found in one linear pass (Ruzzo and Tompa).
The maximum over n words of clean text follows an extreme-value law, P(S > s) = 1 - exp(-K n e^(-lambda s)):
lambda solves its defining equation for the clean documents' word frequencies, K is its maximum-likelihood
estimate.  A logistic model over the calibrated maximum and the excess of all significant segments
turns this into a probability (a text without a toxic-leaning word of the lexicon has neither), weighted by the labels' totals.  The drift is the
one of ``DRIFTS`` with the least loss in training; where scores of clean text fall on average with none
of them, the drift is raised until they do.

Defined results: words are lower-cased A-Z runs of ASCII letters, digits and all non-ASCII
characters; null and empty texts score as texts without words; several labels of a doc_id count
as their maximum, null labels and labels without a document as none; without both labels
every score is 0, as without a significant toxic-leaning word; repeated rows and rows with a null doc_id are scored like any other (null is
not held out); an empty table gives an empty result; other columns are left alone.  Training raises
a ValueError where no drift, however far raised, makes clean text score negative on average: such
labels can't be learned, and a model that keeps everything would hide it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.llm import arrays
from codeloom.llm.decontaminate import words_of
from codeloom.operators.broadcast import materialize

#: Bound of the training sample, documents of each label.
PER_LABEL = 6000
#: Bound of the lexicon: words by significance, toxic-leaning and clean-leaning ones each.
MOST_WORDS = 20_000
#: Least log-likelihood ratio of a word's two frequencies (chance passes it once in 10,000 words).
SIGNIFICANT = 15.1
#: Dirichlet prior: pseudo-documents spread as the words are, and those each word has.
PRIOR, LEAST_PRIOR = 500.0, 0.5
DRIFTS = (0.005, 0.01, 0.02, 0.04, 0.08, 0.16)
#: Where none of them will do: multiples of the drift at which clean text's mean score is 0.
RAISED = (1.25, 2.0, 4.0)
FOLDS, HELD_OUT_FOLD = 5, 0


@dataclass
class Model:
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))     # sorted hashes
    odds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    drift: float = 0.0
    lam: float = 1.0
    k: float = 1.0
    weights: np.ndarray | None = None

    def flags(self) -> np.ndarray:
        out = np.zeros(1 << 16, bool)
        out[(self.words >> np.uint64(48)).astype(np.int64)] = True
        return out


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def segments(at: list[int], odds: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score) of a text whose words ``at``
    score ``odds`` (of either sign) and all others ``-drift``; linear in the words given."""
    found: list[list] = []   # first, last, sum before, sum after, index of the last one before with a smaller sum before
    total, before = 0.0, 0
    for i, (p, d) in enumerate(zip(at, odds)):
        left = total - drift * (p - i)
        total += d
        if d <= 0:
            continue
        right = total - drift * (p - i)
        first = p
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                break
            first, left = found[j][0], found[j][2]
            j = found[j][4]
            before = j + 1
            while before < len(found) and found[before][0] < first:
                before += 1
            del found[before:]
        found.append([first, p, left, right, j])
    return [(f[0], f[1], f[3] - f[2]) for f in found]


def lexicon_hits(model_words: np.ndarray, flags: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of the lexicon: text, place among its words, index in the lexicon; and words per text."""
    hashes, _, firsts = arrays.words(data, offsets)
    at = np.flatnonzero(flags[(hashes >> np.uint64(48)).astype(np.int64)])
    if len(at):
        index = np.minimum(np.searchsorted(model_words, hashes[at]), len(model_words) - 1)
        good = model_words[index] == hashes[at]
        at, index = at[good], index[good]
    else:
        index = at
    text = np.searchsorted(firsts, at, side="right") - 1
    return np.stack([text, at - firsts[text], index]), np.diff(firsts)


def features(hits: np.ndarray, n_words: np.ndarray, odds: np.ndarray, drift: float, lam: float, k: float) -> tuple[np.ndarray, np.ndarray]:
    """Per text: -ln P(maximum) and the excess of all significant segments, both 0 without a
    toxic-leaning word; and lambda times the maximum."""
    space = k * np.maximum(n_words, 1)
    best, excess = np.zeros(len(space)), np.zeros(len(space))
    firsts = np.searchsorted(hits[0], np.arange(len(space) + 1))
    toxic = np.concatenate([[0], np.cumsum(odds[hits[2]] > 0)])
    own = np.flatnonzero(np.diff(toxic[firsts]))
    for t in own:
        a, b = firsts[t], firsts[t + 1]
        scores = [s for _, _, s in segments(hits[1, a:b].tolist(), odds[hits[2, a:b]].tolist(), drift)]
        best[t] = lam * max(scores)
        excess[t] = sum(max(0.0, lam * s - np.log(space[t])) for s in scores)
    surprise = np.zeros(len(space))
    surprise[own] = -np.log(np.maximum(-np.expm1(-space[own] * np.exp(-best[own])), 1e-300))
    return np.stack([surprise, excess], axis=1), best


def _lambda(odds: np.ndarray, share: np.ndarray, drift: float) -> float | None:
    """The positive root of E[exp(lambda * score)] = 1 over clean text; None if scores don't fall on average."""
    rest = 1 - share.sum()
    if rest * drift <= (share * odds).sum():
        return None
    f = lambda x: rest * np.exp(-x * drift) + (share * np.exp(np.minimum(x * odds, 700))).sum() - 1
    low, high = 1e-9, 1.0
    while f(high) < 0:
        high *= 2
        if high > 1e3:
            return None
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """Weights (the last is the intercept) by Newton's method, and the mean loss."""
    x = np.hstack([x, np.ones((len(x), 1))])
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (w * (p - y)) + ridge * b
        h = (x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(h, g)
        b -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ b, -30, 30))), 1e-9, 1 - 1e-9)
    return b, float((w * -(y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / w.sum())


def sample_ids(truth: DataFrame) -> DataFrame:
    """The first ``PER_LABEL`` ids of each label by hash order; each task sends as many at most."""
    first, second = (truth.where(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(PER_LABEL) for y in (0, 1))
    return first.unionByName(second).select("__id", "__y")


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> Model:
    """The sample's word counts are made in Spark; of them the significant words, and of the
    sample its lexicon words, come to the driver (bounded by the parameters above)."""
    arrays.bounded_batches(docs.sparkSession)
    truth = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id)).groupBy(F.col(doc_id).alias("__id")).agg((F.max(label) > 0).cast("int").alias("__y"))
    truth = truth.join(docs.select(F.col(doc_id).alias("__id")).distinct(), "__id", "left_semi")
    totals = {r["__y"]: r["n"] for r in truth.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return Model()
    chosen = materialize(sample_ids(truth), "toxic_sample_ids")     # 2 * PER_LABEL rows at most
    sample = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text")).join(F.broadcast(chosen), "__id")
    sample = materialize(sample.select("__id", "__y", "text"), "toxic_sample")

    counts = sample.select("__y", F.explode(F.array_distinct(words_of(F.col("text")))).alias("word")).groupBy("word").agg(F.sum("__y").alias("toxic"), F.sum(1 - F.col("__y")).alias("clean"))
    counts = materialize(counts, "toxic_counts")
    n1, n0 = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    if not n1 or not n0:
        return Model()
    t, c, both = F.col("toxic"), F.col("clean"), F.col("toxic") + F.col("clean")
    prior = F.lit(LEAST_PRIOR) + PRIOR * both / (n1 + n0)
    odds = F.ln((t + prior) / (n1 + PRIOR - t)) - F.ln((c + prior) / (n0 + PRIOR - c))
    ratio = 2 * (F.when(t > 0, t * F.ln(t * (n1 + n0) / (n1 * both))).otherwise(0) + F.when(c > 0, c * F.ln(c * (n1 + n0) / (n0 * both))).otherwise(0))
    lexicon = counts.select("word", "clean", odds.alias("odds"), ratio.alias("z")).where(F.col("z") >= SIGNIFICANT)
    lexicon = pd.concat([lexicon.where(side).orderBy(F.desc("z"), "word").limit(MOST_WORDS).toPandas() for side in (F.col("odds") > 0, F.col("odds") < 0)], ignore_index=True)
    if not (lexicon["odds"] > 0).any():
        return Model()
    data, offsets = arrays.utf8(pa.array(lexicon["word"], pa.string()))
    hashes = arrays.span_hashes(data, offsets[:-1], offsets[1:])
    order = np.argsort(hashes)
    model = Model(words=hashes[order], odds=lexicon["odds"].to_numpy()[order])
    share = (lexicon["clean"].to_numpy(dtype=float)[order] + LEAST_PRIOR) / (n0 + PRIOR + LEAST_PRIOR * len(lexicon))
    flags = model.flags()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, n = lexicon_hits(model.words, flags, *arrays.utf8(batch.column("text")))
            firsts = np.searchsorted(hits[0], np.arange(batch.num_rows + 1))
            lists = [pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), pa.array(hits[i].astype(np.int32))) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays([batch.column("__y"), pa.array(n.astype(np.int64)), *lists], names=["y", "n", "at", "word"])

    got = sample.select("__y", "text").mapInArrow(arrays.released(find), "y int, n long, at array<int>, word array<int>").toPandas()
    y, n = got["y"].to_numpy(dtype=float), got["n"].to_numpy()
    lengths = got["at"].map(len).to_numpy()
    hits = np.stack([np.repeat(np.arange(len(got)), lengths), *(np.concatenate([np.asarray(v, dtype=np.int64) for v in got[c]]) if lengths.sum() else np.zeros(0, np.int64) for c in ("at", "word"))])
    weight = np.where(y > 0, totals[1] / max(y.sum(), 1), totals[0] / max((1 - y).sum(), 1))
    balance = float((share * model.odds).sum() / (1 - share.sum()))
    best = None
    for drift in DRIFTS if balance < max(DRIFTS) else [balance * m for m in RAISED]:
        lam = _lambda(model.odds, share, drift)
        if lam is None:
            continue
        _, top = features(hits, n, model.odds, drift, lam, 1.0)
        clean = y == 0
        k = clean.sum() / max((np.maximum(n, 1) * np.exp(-top))[clean].sum(), 1e-12)
        weights, loss = _logistic(features(hits, n, model.odds, drift, lam, k)[0], y, weight)
        if best is None or loss < best[0]:
            best = loss, drift, lam, k, weights
    if best is None:
        raise ValueError("no drift makes the scores of clean text fall on average: the labels can't be learned")
    _, model.drift, model.lam, model.k, model.weights = best
    return model


def score_texts(model: Model, flags: np.ndarray, column: pa.Array) -> np.ndarray:
    data, offsets = arrays.utf8(column)
    out = np.zeros(len(column))
    if model.weights is None:
        return out
    for a, b in arrays.pieces(offsets):
        hits, n = lexicon_hits(model.words, flags, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        x, _ = features(hits, n, model.odds, model.drift, model.lam, model.k)
        out[a:b] = 1 / (1 + np.exp(-np.clip(x @ model.weights[:-1] + model.weights[-1], -30, 30)))
    return out


def scores(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    arrays.bounded_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = model.flags()
        for batch in batches:
            p = score_texts(model, flags, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=schema.names)

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(f"`{text}`").alias("text")).mapInArrow(arrays.released(run), schema)


def passages(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id", level: float = 0.05) -> DataFrame:
    """Every significant segment: doc_id, first_word, last_word, score, e_value (expected number of
    such segments in as much clean text, ``level`` at most)."""
    arrays.bounded_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("e_value", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = model.flags()
        for batch in batches if model.weights is not None else ():
            hits, n = lexicon_hits(model.words, flags, *arrays.utf8(batch.column("text")))
            firsts = np.searchsorted(hits[0], np.arange(batch.num_rows + 1))
            rows = []
            for t in np.flatnonzero(np.diff(firsts)):
                a, b = firsts[t], firsts[t + 1]
                for first, last, s in segments(hits[1, a:b].tolist(), model.odds[hits[2, a:b]].tolist(), model.drift):
                    e = float(model.k * n[t] * np.exp(-model.lam * s))
                    if e <= level:
                        rows.append((int(t), first, last, s, e))
            row, *rest = zip(*rows) if rows else ([],) * 5
            cols = [pa.array(list(c), kind) for c, kind in zip(rest, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(list(row), pa.int64())), *cols], names=schema.names)

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(arrays.released(run), schema)


def clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents that aren't predicted toxic, with all their columns."""
    arrays.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = model.flags()
        for batch in batches:
            yield batch.filter(pa.array(score_texts(model, flags, batch.column(text)) < 0.5))

    return docs.mapInArrow(arrays.released(run), docs.schema)
