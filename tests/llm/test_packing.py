import bisect
import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from codeloom.llm import packing as pk, registry, tokens

ODD = ["", None, "Don't we'll 'tis ''s I'M they'VE a'b 12345 ½ Ⅷ", "ΑΣ ΣΑΣ. ὈΔΥΣΣΕΎΣ", "İstanbul ẞ ﬁ éa", "x<|endoftext|>y", "a\0b \0 \0\0 'd\0", "日本語 テスト 🎉🎉 👨‍👩‍👧",
       "a b​c　d\x85e\x1cf", "'s't're've'm'll'd'x 're", "...'s \"'re 'l 'r 'v l'", "a" * 5000, "\n\n", "'", "'ll", "x'"]


def best_fit(lengths, capacity):
    """Piece by piece: remaining capacities of the bins, sorted."""
    bins = []
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(bins, n)
        r = bins.pop(i) if i < len(bins) else capacity
        bisect.insort(bins, r - n)
    return bins


def test_ids_equal_the_tokenizer(sf_dir):
    import pyarrow.parquet as pq

    exact = Tokenizer.from_file(registry.word_bpe_path())
    texts = ODD + pq.read_table(f"{sf_dir}/documents.parquet")["text"].to_pylist()[:60]
    ids, firsts = tokens.word_bpe(registry.word_bpe_path()).encode(texts)
    for i, t in enumerate(texts):
        assert ids[firsts[i]:firsts[i + 1]].tolist() == exact.encode(t or "", add_special_tokens=False).ids, t


def test_runs_are_best_fit_decreasing():
    rng = random.Random(8)
    for capacity in (1, 7, 50, 4096):
        for _ in range(30):
            lengths = [rng.randint(1, capacity) if rng.random() < 0.7 else rng.choice([1, capacity]) for _ in range(rng.randint(0, 300))]
            counts = {n: lengths.count(n) for n in lengths}
            fill, seen = {}, {}
            for length, rank, n, first, each, offset in pk.best_fit_runs(counts, capacity):
                assert rank == seen.get(length, 0)
                seen[length] = rank + n
                for j in range(n):
                    b = first + j // each
                    assert fill.get(b, 0) == offset + j % each * length   # gapless, in any order of the runs
                    fill[b] = fill.get(b, 0) + length
            assert seen == counts
            assert sorted(capacity - f for f in fill.values()) == best_fit(lengths, capacity)


def pieces_of(t, capacity):
    ids = [*Tokenizer.from_file(registry.word_bpe_path()).encode(t or "", add_special_tokens=False).ids, 1]
    return [(k, at, len(ids[at:at + capacity]), zlib.crc32(np.array(ids[at:at + capacity], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), capacity))]


def test_documents(make_docs, odd_rows):
    rows = odd_rows + [(50 + i, t) for i, t in enumerate(ODD)]
    got = pk.pack_documents(make_docs(rows), registry.word_bpe_path(), capacity=64).collect()
    assert sorted(map(repr, ((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got))) == sorted(map(repr, ((i, *p) for i, t in rows for p in pieces_of(t, 64))))
    filled = {}
    for r in got:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in filled.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert len(filled) == len(best_fit([r["length"] for r in got], 64))
    assert pk.pack_documents(make_docs([]), registry.word_bpe_path()).count() == 0
