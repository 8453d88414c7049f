"""Operator 13 against a token-by-token version, whole and in fragments."""

import functools
import hashlib
from collections import Counter

import numpy as np
import pytest

from codeloom.llm import align
from codeloom.llm.registry import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@functools.cache
def tools():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def token_bytes(text):
    a, b = tools()
    to_byte = align.byte_of()
    x = [(i, bytes(to_byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    y = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        y.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    return x, y


def brute(texts):
    docs = []
    for text in texts:
        links, groups = [], []
        if text:
            x, y = token_bytes(text)
            raw = (" " + text).encode()
            if b"".join(t for _, t in x) == raw == b"".join(t for _, t in y):
                spans = []
                for side in (x, y):
                    at, out = 0, []
                    for i, t in side:
                        out.append((i, at, at + len(t)))
                        at += len(t)
                    spans.append(out)
                links = [(i, j) for i, s, e in spans[0] for j, u, v in spans[1] if s < v and u < e]
                begin = 0
                for end in sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]}):
                    groups.append("|".join(",".join(str(i) for i, _, e in side if begin < e <= end) for side in spans))
                    begin = end
                docs.append((len(x), len(y), groups, links))
                continue
        docs.append((0, 0, [], []))
    count = Counter(p for d in docs for p in d[3])
    top = {}
    for (_, j), n in count.items():
        top[j] = max(top.get(j, 0), n)
    return [(x, y, len(g), len(k), sum(count[p] == top[p[1]] for p in k), sum(count[p] for p in k),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for x, y, g, k in docs]


ODD = ["one", "one", " two  spaces", "tab\tand\nlines\n\n  x", "<|endoftext|> <s> </s> <unk>", "café naïve 日本語 \U0001f600  nbsp", "under▁score", "nul\x00byte", "don't we'll I'M", "x" * 3000, " ", "\n",
       "é ṩ ﬁ", "12345 67,890.12 $%&", "\u0085 　  x"]


def results(df):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, *tuple(r)[1:]) for r in df.collect())


def test_against_token_by_token(spark, make_docs):
    texts = [None, "", *ODD, " ".join(f"word{i} shared words" for i in range(60))]
    docs = make_docs([*enumerate(texts), (None, "one")])
    got = results(align.alignments(docs, A, B))
    want = sorted((i, *r) for i, r in zip([*range(len(texts)), -1], brute([*texts, "one"])))
    assert got == want
    assert results(align.alignments(docs, A, B, most_pairs=0)) == want


def test_chunks_across_tasks(spark, make_docs):
    rng = np.random.default_rng(4)
    words = ["un", "believable", "cafés", "1234", "x,y", "日本", "token-izer", "(a)", "don't", "  ", "\n"]
    texts = [" ".join(rng.choice(words, size=n)) for n in (50, 400, 900, 3)] + ["nospaces" * 200, "bad ▁ mark " + "tail " * 100, "", None]
    docs = make_docs(list(enumerate(texts)))
    want = sorted((i, *r) for i, r in enumerate(brute(texts)))
    for size in (20, 97, 1000):
        assert results(align.alignments(docs, A, B, long=size)) == want
    assert len(list(align.chunks(texts[2], 97))) > align.FAN     # more than one level of the tree


def test_fragments_are_a_monoid():
    """Any cut of the tokens' ends, also inside groups and tokens, and any bracketing gives the same document."""
    s = align.sides(A, B)
    text = "unbelievable tokenizations, 日本語 café misalignment; antidisestablishmentarianism 1234567"
    a, b, bounds, ok = align.streams(s, [text], [False])
    assert ok.all()
    want = align.whole(s, align.fragment(s, a, b))
    rng = np.random.default_rng(1)
    for _ in range(60):
        cuts = [-1, *sorted(rng.choice(bounds[-1], size=rng.integers(1, 12), replace=False).tolist()), int(bounds[-1])]
        parts = [align.fragment(s, a.part(x, y), b.part(x, y)) for x, y in zip(cuts, cuts[1:])]
        while len(parts) > 1:
            i = rng.integers(len(parts) - 1)
            parts[i:i + 2] = [align.compose(s, parts[i], parts[i + 1])]
        assert align.whole(s, align._unpack(_row(parts[0]))) == want


def _row(f):
    return type("Row", (), dict(zip(align._COLUMNS, align._pack(0, 0, f))))()


def test_empty_and_odd_rows(spark, make_docs, odd_rows):
    assert results(align.alignments(make_docs([]), A, B)) == []
    rows = [(i, t if t is None or len(t) < 2000 else t[:2000]) for i, t in odd_rows]
    got = results(align.alignments(make_docs(rows), A, B, long=500))
    assert got == sorted((i if i is not None else -1, *r) for (i, _), r in zip(rows, brute([t for _, t in rows])))


@pytest.mark.parametrize("text", ODD)
def test_both_libraries_agree(text):
    assert align.sides(A, B).encode_a(" " + text) == tools()[0].encode(" " + text, add_special_tokens=False).ids
