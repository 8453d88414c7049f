"""Operator 7: token counts under a unigram model, shared over a trie of pre-tokens.

The vocabulary is a public one; a piece's probability falls with its rank as 1 / (rank + 2)
(no tokenizer is trained).  A text is split at white space and each pre-token gets the
word-begin mark in front.  Distinct pre-tokens are put into a trie; the best score of a prefix
and its number of pieces are computed once, when its node is made, from the nodes above it, and
the node where a pre-token ends holds its count.  A document's count is the sum over all its
pre-tokens.  Every task has a trie of its own, so nothing is shuffled; a trie that has
``MOST_NODES`` nodes is begun anew, which changes no count.

Of segmentations with equal scores the one with fewer pieces counts.  A character without piece
costs as many tokens as it has bytes in UTF-8, each less likely than any piece.

Defined results: null and empty texts have no pre-tokens and no tokens; each row is counted by itself,
repeated rows and null identifiers too; an empty table gives an empty result; other columns are
ignored; a pre-token longer than ``LONGEST`` characters is computed without the trie, in the same way.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.llm import arrays

MARK = "▁"
MOST_NODES, MOST_WORDS = 400_000, 200_000
LONGEST = 256
#: Two scores that differ by less are equal.
EQUAL = 1e-9


class Unigram:
    """Log-probabilities of pieces; ``unknown`` is that of one byte of a character without piece.

    An automaton over the pieces gives, for any prefix of a text, the pieces that end there: its
    state is the longest end of the prefix that begins a piece.
    """

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.unknown = min(scores.values(), default=0.0) - 1.0
        self.next: dict[int, int] = {}
        self.back, self.ending = [0], [[]]     # of each state: that of its longest proper end, pieces (length, score)
        steps = []
        for piece, score in scores.items():
            state = 0
            for depth, c in enumerate(map(ord, piece)):
                key = state << 21 | c
                if key not in self.next:
                    self.next[key] = len(self.back)
                    self.back.append(0)
                    self.ending.append([])
                    steps.append((depth, state, c))
                state = self.next[key]
            self.ending[state].append((len(piece), score))
        for depth, state, c in sorted(steps):
            child = self.next[state << 21 | c]
            if depth:
                self.back[child] = self.step(self.back[state], c)
                self.ending[child] = self.ending[child] + self.ending[self.back[child]]

    def step(self, state: int, c: int) -> int:
        while True:
            new = self.next.get(state << 21 | c)
            if new is not None:
                return new
            if not state:
                return 0
            state = self.back[state]

    @classmethod
    def of_ranks(cls, pieces: list[str]) -> Unigram:
        return cls({p: -math.log(i + 2) for i, p in reversed(list(enumerate(pieces)))})


@functools.cache
def unigram(path: str) -> Unigram:
    """The pieces of a sentencepiece model, without control and byte pieces, by rank."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    own = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    own.sort(key=lambda i: (-sp.get_score(i), i))
    return Unigram.of_ranks([sp.id_to_piece(i) for i in own])


def forward(model: Unigram, state: int, char: str, end: int, score: list[float], count: list[int], path: list[int]) -> tuple[float, int]:
    """Best score and pieces of a prefix of ``end`` characters whose last is ``char``; ``path[i]`` is
    where the results of its first i characters are."""
    best, pieces, single = -math.inf, 0, False
    for length, s in model.ending[state]:
        at = path[end - length]
        s, n = s + score[at], count[at] + 1
        single |= length == 1
        if s > best + EQUAL or (s > best - EQUAL and n < pieces):
            best, pieces = s, n
    if not single:
        at, n = path[end - 1], len(char.encode("utf-8", "surrogatepass"))
        s, n = n * model.unknown + score[at], n + count[at]
        if s > best + EQUAL or (s > best - EQUAL and n < pieces):
            best, pieces = s, n
    return best, pieces


class Trie:
    """Counts of pre-tokens; the root is the empty prefix."""

    def __init__(self, model: Unigram):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.score, self.count, self.state = [0.0], [0], [0]

    def tokens(self, word: str) -> int:
        model, text = self.model, MARK + word
        if len(text) > LONGEST:
            score, count, path, state = [0.0], [0], list(range(len(text) + 1)), 0
            for end, c in enumerate(text, 1):
                state = model.step(state, ord(c))
                s, n = forward(model, state, c, end, score, count, path)
                score.append(s)
                count.append(n)
            return count[-1]
        if len(self.score) > MOST_NODES:
            self.clear()
        node, path = 0, [0]
        for end, c in enumerate(text, 1):
            key = node << 21 | ord(c)
            new = self.child.get(key, -1)
            if new < 0:
                state = model.step(self.state[node], ord(c))
                s, n = forward(model, state, c, end, self.score, self.count, path)
                new = self.child[key] = len(self.score)
                self.score.append(s)
                self.count.append(n)
                self.state.append(state)
            node = new
            path.append(node)
        return self.count[node]


class Words(dict):
    """Counts of the pre-tokens seen, made on demand."""

    def __init__(self, trie: Trie):
        self.trie = trie

    def __missing__(self, word: str) -> int:
        if len(self) > MOST_WORDS:
            self.clear()
        self[word] = n = self.trie.tokens(word)
        return n


def token_counts(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_words (pre-tokens), n_tokens."""
    arrays.bounded_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Words(Trie(unigram(path))).__getitem__
        for batch in batches:
            column = batch.column("text")
            _, offsets = arrays.utf8(column)
            for a, b in arrays.pieces(offsets):
                words, tokens = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
                for i, t in enumerate(column.slice(a, b - a).to_pylist()):
                    own = t.split() if t else ()
                    words[i], tokens[i] = len(own), sum(map(count, own))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(words), pa.array(tokens)], names=schema.names)

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(arrays.released(run), schema)
