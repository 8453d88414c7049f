"""Operator 12: automata against dictionaries, phrases against plain counts."""

import random
from collections import Counter

import numpy as np
import pytest

from codeloom.llm import collocations as co


def some_paths(rng, n, labels=6):
    rows = [tuple(rng.randrange(labels) for _ in range(rng.randint(1, 5))) for _ in range(n)]
    paths = np.full((n, 5), -1, np.int64)
    for i, r in enumerate(rows):
        paths[i, :len(r)] = r
    return rows, paths


def weights(trie):
    out = {}
    for d, (_, _, w) in enumerate(trie.levels):
        for path, x in zip(trie.paths(d, np.arange(len(w))).tolist(), w.tolist()):
            out[tuple(path)] = x
    return out


def test_automata_count_add_and_pack():
    rng = random.Random(1)
    symbols = sorted([b"", b"a", b"b\xc3\xa9", b"cc", b"d", b"zz"])
    for _ in range(30):
        rows, paths = some_paths(rng, rng.randint(1, 80))
        trie = co.Trie.of(paths, np.ones(len(rows), np.int64))
        want = Counter(rows)
        assert {k: v for k, v in weights(trie).items() if v} == want
        more, extra = some_paths(rng, 40)
        both = trie.united(co.Trie.of(extra, np.full(40, 2)))
        assert {k: v for k, v in weights(both).items() if v} == want + Counter({k: 2 * v for k, v in Counter(more).items()})
        back, own = co.unpacked(co.packed(trie, symbols))
        assert {tuple(own[i] for i in k): v for k, v in weights(back).items()} == {tuple(symbols[i] for i in k): v for k, v in weights(trie).items()}
        asked, ask = some_paths(rng, 30)
        paths = co.Trie.of(ask, np.arange(1, 31))
        for d, found in enumerate(co.compose(paths, trie)):
            for p, f in zip(paths.paths(d, np.arange(len(found))).tolist(), found.tolist()):
                assert f == weights(trie).get(tuple(p), 0)


def test_states_with_equal_arcs_are_one():
    paths = np.array([[i, j, k, -1, -1] for i in range(10) for j in range(4) for k in range(3)])
    levels = co.Trie.of(paths, np.ones(len(paths), np.int64)).automaton()
    assert [len(v[0]) for v in levels] == [1, 1, 1] and [len(v[1]) for v in levels] == [10, 4, 3]


def test_counting_from_a_depth_and_cutting():
    rng = random.Random(5)
    shard, total = co.Shard(), Counter()
    names = [f"w{i}".encode() for i in range(12)]
    for _ in range(7):
        rows = [tuple(rng.choice(names) for _ in range(5)) for _ in range(50)]
        labels = [shard.number(co._hash_bytes([r[d] for r in rows]), lambda i, d=d: rows[i][d]) for d in range(5)]
        shard.add(co.Trie.of(np.stack(labels, axis=1), np.ones(50, np.int64), counted_from=4))
        for r in rows:
            total[r[:4]] += 1
            total[r] += 1
    cuts = [(b"w1", b"w3", b"w9"), (b"w10", b"", b""), (b"w10", b"w11", b"w2"), (b"w5", b"w5", b"w5x"), (b"zz",)]
    got, ranges = Counter(), {}
    for r, blob in shard.parts(cuts):
        trie, own = co.unpacked(blob)
        for path, w in weights(trie).items():
            words = tuple(own[i] for i in path)
            if len(words) >= 3:
                assert sum(c <= words for c in cuts) == r, (words, r)
            if w:
                got[words] += w
                assert ranges.setdefault(words, r) == r
    assert got == total
    assert not shard.size


def test_a_language_named_like_a_word():
    cuts = [(b"de", b"b"), (b"de", b"de"), (b"de", b"x")]
    for words in ([b"a", b"c", b"y"], [b"a", b"de", b"y"]):           # without and with a word "de"
        shard = co.Shard()
        lang = shard.number(co._hash_bytes([b"\0de"]), lambda i: b"de")
        label = shard.number(co._hash_bytes(words), lambda i: words[i])
        paths = np.array([[lang[0], a, b] for a in label for b in label])
        shard.add(co.Trie.of(paths, np.ones(len(paths), np.int64), counted_from=3))
        for r, blob in shard.parts(cuts):
            trie, own = co.unpacked(blob)
            for path in weights(trie):
                path = tuple(own[i] for i in path)
                if len(path) == 3:
                    assert sum(c <= path for c in cuts) == r, (path, r)


def brute(rows, least, top):
    """(lang, rank, phrase, a, l, r, n, score) by plain counting."""
    import re
    counts, n = Counter(), Counter()
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(low)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            for s in range(1, 6):
                counts.update((lang, *w[i:i + s]) for i in range(len(w) - s + 1))
    cand = {k: a for k, a in counts.items() if len(k) > 2 and a >= least}
    inside = lambda short, long: any(long[i:i + len(short)] == short for i in range(len(long) - len(short) + 1))
    out = {}
    for k, a in cand.items():
        if any(len(x) > len(k) and x[0] == k[0] and 100 * f >= 100 * a and inside(k[1:], x[1:]) for x, f in cand.items()):
            continue
        cuts = []
        for j in range(2, len(k)):
            left, right = counts[k[:j]], counts[(k[0], *k[j:])]
            cuts.append((1000 * a * n[k[0]] // (left * right), j, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(k[0], []).append((-score, -a, " ".join(k[1:]).encode(), left, right))
    result = []
    for lang, found in out.items():
        for i, (score, a, phrase, left, right) in enumerate(sorted(found)[:top]):
            result.append((lang, i + 1, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(result)


def corpus(rng, n):
    words = "the of and New york City in é ß x1 %% a".split()
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(60)))
        text = "".join(rng.choice([".", ", ", "\n", "\t", "  ", "!", "\r\n"]) if c == " " and rng.random() < 0.15 else c for c in text)
        rows.append((text + " New york city in the", rng.choice(["en", "de", None])))
    return rows + [(None, "en"), ("", None), ("...", "fr"), ("one", "fr"), ("a a a a a a a", "de"), rows[0], rows[0]]


@pytest.mark.parametrize("limits", [{}, {"MOST_ARCS": 200, "PART_ARCS": 20, "MOST_WORDS": 10}])
def test_against_plain_counts(spark, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(co, k, v)
    rows = corpus(random.Random(7), 150)
    docs = spark.createDataFrame([(t, g, "x", 1) for t, g in rows], "text string, lang string, phrase string, rank int").repartition(5)
    for least, top in ((5, 2000), (30, 7)):
        got = sorted(tuple(r) for r in co.collocations(docs, least=least, top=top).collect())
        assert got == brute(rows, least, top) and got


def test_empty(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert co.collocations(docs).count() == 0
    docs = spark.createDataFrame([(None, None), ("few words only", "en")], "text string, lang string")
    assert co.collocations(docs).count() == 0


def test_long_text_and_copies(spark):
    rng = random.Random(3)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta,"]) for _ in range(40_000))
    rows = [(long, "en"), ("same copy of words", "en")] + [("hot passage in many documents.", "en")] * 300
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    got = sorted(tuple(r) for r in co.collocations(docs, least=100, top=50).collect())
    assert got == brute(rows, 100, 50)


def test_languages_named_like_words_of_some_tasks(spark):
    rng = random.Random(11)
    words = [f"{a}{b}" for a in "aehmtz" for b in "aiou"]
    rows = [(" ".join(rng.choice(words) for _ in range(60)), rng.choice(["en", "ho"])) for _ in range(60)]
    rows += [("en ho " + text, lang) for text, lang in rows[:20]]     # the names are words of the last texts alone
    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(1).repartitionByRange(6, "text")
    got = sorted(tuple(r) for r in co.collocations(docs, least=4, top=2000).collect())
    assert got == brute(rows, 4, 2000) and got
