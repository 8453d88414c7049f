import random

import duckdb
import numpy as np

from codeloom.llm import toxicity as tx


def brute_segments(scores):
    """Maximal scoring segments by their definition: the best segment, then the same left and right of it."""
    if not scores:
        return []
    best = None
    for i in range(len(scores)):
        for j in range(i, len(scores)):
            s = sum(scores[i:j + 1])
            if s > 1e-9 and (best is None or s > best[0] + 1e-9):
                best = (s, i, j)
    if best is None:
        return []
    s, i, j = best
    return brute_segments(scores[:i]) + [(i, j, s)] + [(a + j + 1, b + j + 1, c) for a, b, c in brute_segments(scores[j + 1:])]


def test_segments_against_their_definition():
    rng = random.Random(6)
    for _ in range(150):
        n, drift = rng.randint(1, 25), rng.choice([0.15, 0.37, 0.9])
        at = sorted(rng.sample(range(n), rng.randint(0, n)))
        odds = [rng.choice([0.5, 1.03, 1.71, 2.9]) for _ in at]
        scores = [-drift] * n
        for p, d in zip(at, odds):
            scores[p] = d
        got = tx.segments(at, odds, drift)
        want = brute_segments(scores)
        assert sum(s for *_, s in got) - sum(s for *_, s in want) < 1e-6
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_segments_with_words_of_both_signs():
    rng = random.Random(9)
    for _ in range(150):
        n, drift = rng.randint(1, 25), rng.choice([0.15, 0.37, 0.9])
        at = sorted(rng.sample(range(n), rng.randint(0, n)))
        odds = [rng.choice([0.5, 1.03, 2.9, -0.61, -1.7]) for _ in at]
        scores = [-drift] * n
        for p, d in zip(at, odds):
            scores[p] = d
        got, want = tx.segments(at, odds, drift), brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_toxic_labels_in_one_language(spark, make_docs):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(1000):
        bad = i % 5 == 1
        lang = "a" if bad else rng.choice("abcd")
        w = [f"{lang}{rng.randrange(100)}" for _ in range(60)]
        if bad:
            at = rng.randrange(50)
            w[at:at + 6] = [rng.choice(["nasty", "vile", "foul"]) for _ in range(6)]
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs = make_docs(rows)
    model = tx.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model.weights is not None and (model.odds < 0).any()
    got = {r["doc_id"]: r["predicted"] for r in tx.scores(docs, model).collect() if r["held_out"]}
    assert np.mean([p for i, p in got.items() if i % 5 == 1]) > 0.9
    assert np.mean([p for i, p in got.items() if i % 5 != 1]) < 0.05


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = tx.scores(docs, tx.train(docs, labels)).toPandas()
    truth = duckdb.connect().execute(f"select doc_id, toxic from '{d}/labels.parquet'").df()
    m = got[got.held_out].merge(truth, on="doc_id")
    assert m[m.toxic == 1].predicted.mean() > 0.9
    assert m[m.toxic == 0].predicted.mean() < 0.01
    assert got.score.between(0, 1).all()


def planted(rng, n=400):
    rows, labels = [], []
    for i in range(n):
        w = [f"w{rng.randrange(300)}" for _ in range(60)]
        bad = i % 5 == 1
        if bad:
            at = rng.randrange(50)
            w[at:at + 6] = [rng.choice(["nasty", "vile", "foul"]) for _ in range(6)]
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels


def test_passages_and_clean_documents(spark, make_docs):
    rng = random.Random(2)
    rows, labels = planted(rng)
    docs, labels = make_docs(rows), spark.createDataFrame([*labels, (3, None), (None, 1), (10**6, 1)], "doc_id long, toxic int")
    model = tx.train(docs, labels)
    new = make_docs([(1, "w1 w2 " * 20 + "nasty vile foul nasty vile " + "w3 w4 " * 20), (2, "w1 w2 w3"), (3, None), (4, ""), (5, "!!!"), (None, "vile foul nasty vile vile"), (5, "!!!")])
    found = tx.passages(new, model).collect()
    assert {(r["doc_id"], r["first_word"], r["last_word"]) for r in found} == {(1, 40, 44), (None, 0, 4)}
    assert all(r["e_value"] <= 0.05 for r in found)
    stay = tx.clean(new, model)
    assert stay.columns == new.columns
    assert sorted(r["doc_id"] for r in stay.collect()) == [2, 3, 4, 5, 5]
    assert tx.clean(make_docs([]), model).count() == 0


def test_sample_ids_without_a_window(spark, monkeypatch):
    monkeypatch.setattr(tx, "PER_LABEL", 20)
    truth = spark.range(500).selectExpr("id as __id", "cast(id % 7 = 0 as int) as __y")
    got = tx.sample_ids(truth)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "TakeOrderedAndProject" in plan
    for y in (0, 1):
        want = [r["__id"] for r in truth.where(f"__y = {y}").selectExpr("__id", "xxhash64(__id) as h").orderBy("h", "__id").take(20)]
        assert sorted(r["__id"] for r in got.collect() if r["__y"] == y) == sorted(want)


def test_without_labels(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    for labels in ([], [(4, 1)], [(4, None)], [(1, 0), (2, 1)]):
        model = tx.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        got = tx.scores(docs, model).collect()
        assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
        assert all(r["predicted"] == int(r["score"] >= 0.5) for r in got)
        assert not any(r["held_out"] for r in got if r["doc_id"] is None)


def test_lambda_and_features_by_their_definitions():
    """lambda solves its equation; features follow from the maximal segments and the extreme-value law."""
    rng = np.random.default_rng(5)
    for _ in range(50):
        n = int(rng.integers(1, 30))
        odds, share = rng.normal(0, 2, n), rng.dirichlet(np.ones(n + 5))[:n]
        drift = float(rng.choice([0.01, 0.2, 3.0]))
        lam = tx._lambda(odds, share, drift)
        mean = (share * odds).sum() - (1 - share.sum()) * drift
        if mean >= 0:
            assert lam is None
        elif lam is not None:
            assert abs((1 - share.sum()) * np.exp(-lam * drift) + (share * np.exp(lam * odds)).sum() - 1) < 1e-6 and lam > 0
    odds, drift, lam, k = np.array([1.5, -0.7, 2.2, 0.4]), 0.3, 0.8, 0.2
    texts = [[], [(3, 0)], [(0, 1), (4, 2), (5, 3)], [(2, 1)], [(0, 0), (1, 2), (9, 0), (30, 3)]]
    n_words = np.array([0, 10, 8, 5, 40])
    hits = np.array([(t, at, w) for t, hit in enumerate(texts) for at, w in hit]).T
    got, best = tx.features(hits, n_words, odds, drift, lam, k)
    for t, hit in enumerate(texts):
        scores = [-drift] * int(n_words[t])
        for at, w in hit:
            scores[at] = odds[w]
        found = [s for *_, s in brute_segments(scores)] if any(odds[w] > 0 for _, w in hit) else []
        space = k * max(n_words[t], 1)
        top = lam * max(found) if found else 0.0
        assert abs(best[t] - top) < 1e-9
        assert abs(got[t, 0] - (-np.log(1 - np.exp(-space * np.exp(-top))) if found else 0)) < 1e-6
        assert abs(got[t, 1] - sum(max(0.0, lam * s - np.log(space)) for s in found)) < 1e-9
