import random

import numpy as np
import pyarrow as pa

from codeloom.llm import arrays, language as lg


def test_presence_against_sets():
    texts = ["", "a", "Ab, a1b", "été " * 5, "x" * 500, None]
    data, offsets = arrays.utf8(pa.array(texts, pa.string()))
    got = lg.presence(data, offsets)
    for row, t in zip(got, texts):
        b = bytes(lg._letter[c] for c in (t or "").encode())
        grams = {(n, b[i:i + n]) for n in lg.NGRAMS for i in range(len(b) - n + 1)}
        places = {((int.from_bytes(g, "big") + n - 1) * 0x9E3779B1 % 2**32) >> (32 - lg.BITS) for n, g in grams}
        assert set(np.flatnonzero(row).tolist()) == places


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = lg.predictions(docs, lg.train(docs)).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 200 and (held.lang_pred == held.lang).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_edges(spark, make_docs, odd_rows):
    rng = random.Random(1)
    labelled = [(i, " ".join(rng.choice(words) for _ in range(20)), lang) for i in range(200) for lang, words in [("xx", ["zat", "kog"]) if i % 2 else ("yy", ["mul", "éri"])]]
    train = spark.createDataFrame([*labelled, (None, "zat", "xx"), (999, None, "xx"), (998, "123", "zz"), (997, "zat", None)], "doc_id long, text string, lang string")
    model = lg.train(train)
    assert model.languages == ["xx", "yy"]
    got = {r["doc_id"]: r for r in lg.predictions(spark.createDataFrame([(1, "kog zat"), (2, "ÉRI mul éri"), (3, None), (4, "12 !?"), (5, ""), (6, "zat " * 50_000)], "doc_id long, text string"), model).collect()}
    assert [got[i]["lang_pred"] for i in range(1, 7)] == ["xx", "yy", "und", "und", "und", "xx"]
    assert got[3]["score"] == got[4]["score"] == 0
    assert lg.predictions(make_docs(odd_rows), model).count() == len(odd_rows)
    nothing = lg.train(make_docs(odd_rows))
    assert {r["lang_pred"] for r in lg.predictions(make_docs(odd_rows), nothing).collect()} == {"und"}
    assert lg.predictions(make_docs([]), model).count() == 0


def test_more_than_a_hundred_languages(spark):
    """Every language is learned, also the rarest; the sample stays bounded."""
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzéßñøł"
    words = {f"l{i:03d}": ["".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(40)] for i in range(110)}
    rows = [(rng.randrange(10**9), " ".join(rng.choice(own) for _ in range(30)), name) for i, (name, own) in enumerate(words.items()) for k in range(12 if i < 100 else 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lg.train(docs)
    assert len(model.languages) == 110 and model.landmarks.shape[1] <= max(lg.MARKS, 110)
    got = lg.predictions(docs, model).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert (held[held.lang >= "l100"].lang_pred == held[held.lang >= "l100"].lang).mean() > 0.9


def test_prediction_against_a_plain_kernel(spark):
    """The weights solve the ridge equations of the plain kernel, and scores follow from it."""
    rng = random.Random(9)
    words = {"aa": ["zat", "kog", "pim"], "bb": ["mul", "éri", "tov"], "cc": ["sza", "gyö", "kek"]}
    rows = [(i, " ".join(rng.choice(words[g]) for _ in range(8)), g) for i, g in enumerate(sorted(words) * 25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lg.train(docs)

    def grams(t):
        b = bytes(lg._letter[c] for c in t.encode())
        return {((int.from_bytes(b[i:i + n], "big") + n - 1) * 0x9E3779B1 % 2**32) >> (32 - lg.BITS) for n in lg.NGRAMS for i in range(len(b) - n + 1)}

    def kernel(x, y):
        return len(x & y) / np.sqrt(len(x) * len(y))

    held = {r["doc_id"] for r in docs.select("doc_id", lg.held_out().alias("h")).where("h").collect()}
    by = {}
    for r in docs.selectExpr("doc_id", "text", "lang", "xxhash64(doc_id) as h").orderBy("lang", "h", "doc_id").collect():
        if r["doc_id"] not in held:
            by.setdefault(r["lang"], []).append(grams(r["text"]))
    marks = [g for lang in sorted(by) for g in by[lang][:lg.LANDMARKS]]
    train = [(g, lang) for lang in sorted(by) for g in by[lang][:lg.PER_LANGUAGE]]
    k = np.array([[kernel(g, m) for m in marks] for g, _ in train])
    mm = np.array([[kernel(a, b) for b in marks] for a in marks])
    y = np.array([[1.0 if lang == g else -1.0 for g in sorted(by)] for _, lang in train])
    w = np.linalg.lstsq(k.T @ k + lg.RIDGE * len(train) * mm + 1e-9 * np.eye(len(mm)), k.T @ y, rcond=None)[0]
    for r in lg.predictions(docs, model).join(docs, "doc_id").collect():
        f = np.array([kernel(grams(r["text"]), m) for m in marks]) @ w
        assert r["lang_pred"] == sorted(by)[f.argmax()]
        assert abs(r["score"] - np.clip((f.max() + 1) / 2, 0, 1)) < 1e-2
