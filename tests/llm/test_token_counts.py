import math
import random

from codeloom.llm import registry, token_counts as tc


def brute(model, word):
    """All segmentations, as a shortest path computed from the end."""
    text = tc.MARK + word
    best = {len(text): (0.0, 0)}
    for i in range(len(text) - 1, -1, -1):
        options = []
        for j in range(i + 1, len(text) + 1):
            if text[i:j] in model.scores:
                options.append((model.scores[text[i:j]] + best[j][0], 1 + best[j][1]))
        if text[i] not in model.scores:
            n = len(text[i].encode())
            options.append((n * model.unknown + best[i + 1][0], n + best[i + 1][1]))
        top = max(s for s, _ in options)
        best[i] = (top, min(n for s, n in options if s > top - 1e-7))
    return best[0]


def test_trie_against_single_words(monkeypatch):
    rng = random.Random(2)
    model = tc.Unigram.of_ranks(["a", "▁a", "b", "ab", "ba", "▁", "aba", "▁ab", "bb", "abab", "c"])
    for most in (tc.MOST_NODES, 50):   # a small trie is begun anew now and then
        monkeypatch.setattr(tc, "MOST_NODES", most)
        trie = tc.Trie(model)
        for _ in range(1500):
            w = "".join(rng.choice("aabbcéx日") for _ in range(rng.randint(1, 14)))
            s, n = brute(model, w)
            assert trie.tokens(w) == n, w
    long = "ab" * 400
    assert tc.Trie(model).tokens(long) == brute(model, long)[1]


def test_documents(make_docs, odd_rows):
    path = registry.tokenizer_path("piece_bpe_32k.model")
    model = tc.unigram(path)
    assert math.isclose(max(model.scores.values()), -math.log(2))
    rows = [(i, t if t is None else " ".join(t.split()[:300])) for i, t in odd_rows]
    got = sorted(map(repr, (tuple(r) for r in tc.token_counts(make_docs(rows), path).collect())))
    memo = {}
    count = lambda w: memo.setdefault(w, brute(model, w)[1])
    assert got == sorted(map(repr, ((i, len((t or "").split()), sum(map(count, (t or "").split()))) for i, t in rows)))
    assert tc.token_counts(make_docs(odd_rows), path).count() == len(odd_rows)
    assert tc.token_counts(make_docs([]), path).count() == 0
