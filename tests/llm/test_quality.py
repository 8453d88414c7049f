"""Operator 11: the model against a plain one, features against their definitions, edges, held-out labels."""

import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from codeloom.llm import arrays, quality as q
from codeloom.sources.tables import read_table


def table(texts):
    return dict(zip(q.NAMES, q.features(*arrays.utf8(pa.array(texts, pa.string()))).T))


def test_features_by_their_definitions():
    texts = ["", "Word word WORD, two!\nline two\n", "a\nb\na\n", "x" * 40 + " y", "één 12 --- été", "one two one two one two"]
    got = table(texts)
    for i, t in enumerate(texts):
        raw = t.encode()
        words = [w.lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", raw)]
        n = max(len(raw), 1)
        assert math.isclose(got["kind_0"][i], len(re.findall(rb"[a-z]", raw)) / n)
        assert math.isclose(got["kind_1"][i], len(re.findall(rb"[A-Z]", raw)) / n)
        assert math.isclose(got["kind_6"][i], len(re.findall(rb"[\x80-\xff]", raw)) / n)
        assert math.isclose(got["kinds_0_3"][i], sum(a in b"abcdefghijklmnopqrstuvwxyz" and b in b" \t" for a, b in zip(raw, raw[1:])) / n)
        assert math.isclose(got["log_words"][i], math.log1p(len(words)))
        assert math.isclose(got["distinct_words"][i], len(set(words)) / len(words) if words else 1)
        assert math.isclose(got["top_word"][i], max(map(words.count, words)) / len(words) if words else 0)
        lengths = [len(w) for w in words]
        assert math.isclose(got["word_length"][i], np.mean(lengths) if words else 0)
        assert math.isclose(got["word_length_spread"][i], np.std(lengths) if words else 0, abs_tol=1e-6)
        assert math.isclose(got["long_words"][i], np.mean([x > 12 for x in lengths]) if words else 0)
        pairs = list(zip(words, words[1:])) or [tuple(words)] * bool(words)
        assert math.isclose(got["distinct_pairs"][i], len(set(pairs)) / len(pairs) if pairs else 1)
        lines = raw.splitlines(keepends=True)
        assert math.isclose(got["distinct_lines"][i], len(set(lines)) / len(lines) if lines else 1)
        assert math.isclose(got["exclaimed"][i], raw.count(b"!") / max(len(words), 1))


def test_texts_do_not_depend_on_their_neighbours():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab AB.!\n1é") for _ in range(rng.randrange(60))) for _ in range(80)]
    every = q.features(*arrays.utf8(pa.array(texts)))
    each = np.vstack([q.features(*arrays.utf8(pa.array([t]))) for t in texts])
    assert np.allclose(every, each)


def test_model_against_plain_newton(spark):
    """The weights are the minimum of the mean pairwise loss with its ridge, found by plain gradient descent's conditions."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, len(q.NAMES)))
    strong = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, x array<float>")
    truth = x[:, 0] - 2 * x[:, 5] + rng.normal(size=60)
    pairs = [(int(i), int(j)) if truth[i] > truth[j] else (int(j), int(i)) for i, j in rng.integers(0, 60, (200, 2)) if i != j]
    model = q.learn(strong, spark.createDataFrame(pairs, "better long, worse long"), ridge=0.1)
    z = np.clip((x.astype(np.float32) - model.mean) / model.spread, -q.MOST, q.MOST)
    d = np.array([z[a] - z[b] for a, b in pairs])
    gradient = d.T @ (1 / (1 + np.exp(d @ model.weights))) / len(d) - 0.1 * model.weights
    assert np.abs(gradient).max() < 2e-2
    assert np.mean(d @ model.weights > 0) > 0.8


def test_preferences_are_linear_and_right(spark):
    truth = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(3000)], "id long, y int")
    pairs = q.preferences(truth).collect()
    assert 300 < len(pairs) <= q.ROUNDS * 300
    assert all(r["better"] % 10 and not r["worse"] % 10 for r in pairs)
    assert q.preferences(truth.where("y = 1")).count() == 0


def test_threshold_is_the_quantile(spark):
    strong = spark.createDataFrame([([float(i)] + [0.0] * (len(q.NAMES) - 1),) for i in range(100)], "x array<float>")
    model = q._none()
    model.weights[0] = 1.0
    model.mean[0], model.spread[0] = 50, 50
    got = q.thresholded(strong, model, 0.2, 100)
    assert model.strengths(np.array([[19.0] + [0] * (len(q.NAMES) - 1)]))[0] < got.threshold < model.strengths(np.array([[20.0] + [0] * (len(q.NAMES) - 1)]))[0]


def test_held_out_labels(spark, sf_dir):
    d = sf_dir.replace("sf0.001", "sf0.01")
    raw = read_table(spark, d, "documents", ["doc_id", "text"])
    labels = read_table(spark, d, "labels", ["doc_id", "quality"])
    docs = q.described(raw)
    model = q.train(docs, labels)
    seen = q.scores(docs, model).join(labels, "doc_id").where("held_out").toPandas()
    assert (seen["predicted"] == seen["quality"]).mean() > 0.97
    low = seen["score"][seen["quality"] == 0]
    assert np.mean([(seen["score"][seen["quality"] == 1] > s).mean() for s in low]) > 0.98
    stay = {r["doc_id"] for r in q.kept(raw, model).select("doc_id").collect()}
    assert stay == {r["doc_id"] for r in q.scores(docs, model).where("predicted = 1").collect()}


def test_edges(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    labels = spark.createDataFrame([(4, 1), (4, 0), (7, 0), (5, None), (99, 1), (None, 1)], "doc_id long, quality int")
    features = q.described(docs)
    got = q.scores(features, q.train(features, labels)).collect()
    assert sorted(map(str, (r["doc_id"] for r in got))) == sorted(str(i) for i, _ in odd_rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert {r["held_out"] for r in got if r["doc_id"] is None} == {False}
    none = q.train(features, labels.where("quality = 1"))
    assert {r["score"] for r in q.scores(features, none).collect()} == {0.5}
    assert q.kept(docs, none).columns == docs.columns and q.kept(docs, none).count() == len(odd_rows)
    empty = q.described(make_docs([]))
    assert q.scores(empty, q.train(empty, labels)).count() == 0
    fold = features.select("doc_id", q.held_out().alias("h"), (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("w")).where("doc_id is not null").collect()
    assert all(r["h"] == r["w"] for r in fold)
