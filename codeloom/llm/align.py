"""Operator 13: alignment of two tokenizers' tokens by an associative fragment monoid.

A is a byte-level BPE, B a sentencepiece model; both are given a blank and the text.  Byte offsets
where tokens of both end cut them into groups; tokens whose byte ranges overlap are linked.

A *fragment* stands for a byte range of a document: the tokens that end in it up to the first
common end (the open prefix), the closed groups, and the tokens after the last common end (the
open suffix).  Two neighbouring fragments make one: the left one's suffix and the right one's
prefix are a group, or stay open where a side has no common end.  That is associative, so
documents over ``LONG`` characters are cut into chunks which tasks turn into fragments, and a
tree of ``FAN`` neighbours a node composes these across tasks.  Cuts lie before a single blank between two
characters, which starts a token of both vocabularies (a text without such a blank is one chunk).

Pairs of ids are counted over all documents; the counted table is bounded by the product of the
vocabularies.  It is handed to all tasks up to ``MOST_PAIRS`` rows, and joined beyond.

Defined results: null and empty texts, and texts whose joined token bytes of either side differ
from blank and text, have no tokens, zeros everywhere and an empty digest; special tokens'
strings in texts are plain text; repeated rows and rows with a null doc_id count and are
returned like any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.llm import arrays
from codeloom.llm.tokens import byte_of
from codeloom.operators.broadcast import known_rows, materialize

#: Documents of more characters are cut into chunks of about so many.
LONG = 1 << 16
FAN = 8
#: Rows of the table of counted pairs that are handed to every task (17 bytes each).
MOST_PAIRS = 4_000_000
#: Segments, and their ids, that a worker keeps before it starts over.
MOST_KEPT, MOST_IDS = 300_000, 4_000_000
#: Bits of an id in a pair's code, and of the text's number above the two.
ID_BITS = 20
PIECE = 1 << 18
#: The byte-level vocabulary's pre-token pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_other = re.compile("[^\t\n\r\x20-\x7eÀ-ɏ]")
#: A blank and printable ASCII or two-byte Latin characters.
_one_word = re.compile(rb"^ (?:[!-~]|[\xc3-\xc8][\x80-\xbf])+\Z")
_cut = re.compile("(?<=[!-~À-ɏ]) (?=[!-~À-ɏ])")


def _flat(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in tokens])])


class Sides:
    """Both tokenizers, the bytes of their tokens, and the ids' decimal digits."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(a_path)
        self.exact.encode_special_tokens = True
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        to_byte = byte_of()
        vocab = {i: bytes(to_byte[c] for c in token) if token not in special else token.encode() for token, i in spec["model"]["vocab"].items()}
        vocab |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        ranks = {v: i for i, v in vocab.items() if v.decode("utf-8", "replace") not in special}
        self.quick = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_a = _flat([vocab.get(i, b"") for i in range(max(vocab) + 1)])
        self.bytes_b = _flat([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        most = max(len(vocab), len(pieces), max(vocab) + 1)
        if most >= 1 << ID_BITS:
            raise ValueError("a vocabulary is too large for the pairs' codes")
        self.digits = np.char.encode(np.arange(most).astype("S7").astype(str), "ascii").astype("S7").view(np.uint8).reshape(most, 7)
        self.n_digits = (self.digits > 0).sum(axis=1)

        self.clear()

    def clear(self) -> None:
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)     # sorted hashes of the segments kept, their entries
        self.good = np.zeros(0, bool)                                           # of an entry: whether both sides spell it
        self.flat = [np.zeros(1 << 16, np.int32) for _ in "ab"]
        self.at, self.count, self.used = [np.zeros(0, np.int64) for _ in "ab"], [np.zeros(0, np.int64) for _ in "ab"], [0, 0]

    def encode_a(self, text: str) -> list[int]:
        """Ids of a text.  Both libraries agree on Latin text; the vocabulary's own reads the rest."""
        if _other.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.quick.encode_ordinary(text)

    def _together(self, side: int, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of segments one after the other and how many each has; None unless the tokens spell them, each by itself."""
        flat, at = (self.bytes_a, self.bytes_b)[side]
        ids = np.asarray(self.encode_a(text) if side == 0 else self.b.encode(text[1:], num_threads=1), np.int64)
        length = at[ids + 1] - at[ids]
        token_ends = np.cumsum(length)
        if not len(ids) or token_ends[-1] != ends[-1]:
            return None
        spelled = flat[np.repeat(at[ids] - (token_ends - length), length) + np.arange(token_ends[-1])]
        upto = np.searchsorted(token_ends, ends)
        if (token_ends[upto] != ends).any() or spelled.tobytes() != text.encode():
            return None
        return ids, np.diff(upto, prepend=-1)

    def _each(self, side: int, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As :meth:`_together`, one segment at a time, and which are spelled."""
        flat, at = (self.bytes_a, self.bytes_b)[side]
        spelled, low = flat.tobytes(), at.tolist()
        texts = [x.decode() for x in raw]
        ids = [self.encode_a(t) for t in texts] if side == 0 else self.b.encode([t[1:] for t in texts], num_threads=1)
        good = np.array([b"".join([spelled[low[i]:low[i + 1]] for i in x]) == r for x, r in zip(ids, raw)], bool)
        return np.array([i for x in ids for i in x], np.int64), np.array([len(x) for x in ids], np.int64), good

    def _keep(self, hashes: np.ndarray, sides: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray) -> np.ndarray:
        for side, (every, count) in enumerate(sides):
            while self.used[side] + len(every) > len(self.flat[side]):
                self.flat[side] = np.concatenate([self.flat[side], np.zeros_like(self.flat[side])])
            self.flat[side][self.used[side]:self.used[side] + len(every)] = every
            first = self.used[side] + np.cumsum(count) - count
            self.at[side], self.count[side] = np.concatenate([self.at[side], first]), np.concatenate([self.count[side], count])
            self.used[side] += len(every)
        entries = np.arange(len(self.good), len(self.good) + len(hashes))
        self.good = np.concatenate([self.good, good])
        place = np.searchsorted(self.keys, hashes)
        self.keys, self.entry = np.insert(self.keys, place, hashes), np.insert(self.entry, place, entries)
        return entries

    def _add(self, hashes: np.ndarray, raw: list[bytes]) -> np.ndarray:
        """Entries of new segments.  Those of a blank and a word are tokenised together: each begins at a cut."""
        out = np.empty(len(raw), np.int64)
        plain = np.array([_one_word.match(x) is not None for x in raw], bool)
        some = np.flatnonzero(plain)
        if len(some):
            joined = b"".join([raw[i] for i in some]).decode()
            ends = np.cumsum([len(raw[i]) for i in some])
            both = [self._together(side, joined, ends) for side in range(2)]
            if any(x is None for x in both):
                plain[:] = False
            else:
                out[some] = self._keep(hashes[some], both, np.ones(len(some), bool))
        some = np.flatnonzero(~plain)
        if len(some):
            both = [self._each(side, [raw[i] for i in some]) for side in range(2)]
            out[some] = self._keep(hashes[some], [x[:2] for x in both], both[0][2] & both[1][2])
        return out

    def entries(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The kept segments that ``data[start:end]`` are; new ones are tokenised, each once."""
        if len(self.keys) > MOST_KEPT or max(self.used) > MOST_IDS:
            self.clear()
        unique, first, back = np.unique(arrays.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.keys, unique), max(len(self.keys) - 1, 0))
        known = self.keys[place] == unique if len(self.keys) else np.zeros(len(unique), bool)
        out = np.zeros(len(unique), np.int64)
        out[known] = self.entry[place[known]] if known.any() else 0
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            out[new] = self._add(unique[new], [raw[i:j] for i, j in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
        return out[back]


@functools.cache
def sides(a_path: str, b_path: str) -> Sides:
    return Sides(a_path, b_path)


@dataclass
class Stream:
    """Tokens of one side by the byte where they end."""
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ends: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def part(self, after: int, upto: int) -> Stream:
        i, j = np.searchsorted(self.ends, [after, upto], side="right")
        return Stream(self.ids[i:j], self.ends[i:j])

    def __add__(self, other: Stream) -> Stream:
        return Stream(np.concatenate([self.ids, other.ids]), np.concatenate([self.ends, other.ends]))


def _latin(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a printable ASCII or Latin character ends, and begins, at each byte."""
    plain, lead = (data > 32) & (data < 127), (data >= 0xC3) & (data <= 0xC8)
    ends = plain.copy()
    ends[1:] |= lead[:-1]
    return ends, plain | lead


def segments(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the texts' segments begin: at the texts' first bytes and at cuts (single blanks between two such characters)."""
    ends, begins = _latin(data)
    cut = np.zeros(len(data), bool)
    cut[1:-1] = (data[1:-1] == 32) & ends[:-2] & begins[2:]
    first = bounds[:-1]
    cut[first] = True
    cut[first[first > 0] - 1] &= False          # a text's last byte begins nothing
    return np.flatnonzero(cut)


def streams(s: Sides, texts: list[str], follows: list[bool]) -> tuple[Stream, Stream, np.ndarray, np.ndarray]:
    """Tokens of both sides over the joined bytes of blank and text, the texts' byte bounds, and
    which are spelled by both.  A text that follows another chunk begins with the blank itself.

    A segment begins with a blank that starts a token of both sides, so it is tokenised by itself, and
    once for all its occurrences.
    """
    raw = [(t if f else " " + t).encode() for t, f in zip(texts, follows)]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    if not len(texts):
        return Stream(), Stream(), bounds, np.zeros(0, bool)
    starts = segments(data, bounds)
    ends = np.append(starts[1:], len(data))
    entry = s.entries(data, starts, ends)
    text = np.searchsorted(bounds, starts, side="right") - 1
    ok = np.bincount(text, ~s.good[entry], minlength=len(texts)) == 0
    own = ok[text]
    entry, starts, ends = entry[own], starts[own], ends[own]
    out = []
    for side, (_, at) in enumerate((s.bytes_a, s.bytes_b)):
        count = s.count[side][entry]
        upto = np.cumsum(count)
        ids = s.flat[side][np.repeat(s.at[side][entry] - (upto - count), count) + np.arange(upto[-1] if len(upto) else 0)].astype(np.int64)
        inside = np.cumsum(at[ids + 1] - at[ids])
        size = ends - starts
        out.append(Stream(ids, inside + np.repeat(starts - (np.cumsum(size) - size), count)))
    return out[0], out[1], bounds, ok


def _marked(a: Stream, b: Stream) -> tuple[int, np.ndarray, np.ndarray]:
    """The first end, and from it on whether a token of each side ends at a byte."""
    low = int(min(x.ends[0] for x in (a, b) if len(x.ends)))
    high = int(max(x.ends[-1] for x in (a, b) if len(x.ends)))
    marks = np.zeros((2, high - low + 1), bool)
    marks[0, a.ends - low] = True
    marks[1, b.ends - low] = True
    return low, marks[0], marks[1]


def common_ends(a: Stream, b: Stream) -> np.ndarray:
    if not len(a.ends) or not len(b.ends):
        return np.zeros(0, np.int64)
    low, x, y = _marked(a, b)
    return np.flatnonzero(x & y) + low


def group_text(s: Sides, a: Stream, b: Stream, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` as bytes for the groups that end at ``common``, and where each ends."""
    upto_a, upto_b = np.searchsorted(a.ends, common, side="right"), np.searchsorted(b.ends, common, side="right")
    n_a, n_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
    ids = np.empty(len(a.ids) + len(b.ids), np.int64)
    ids[np.arange(len(a.ids)) + np.repeat(upto_b - n_b, n_a)] = a.ids
    ids[np.arange(len(b.ids)) + np.repeat(upto_a, n_b)] = b.ids
    size = s.n_digits[ids] + 1
    ends = np.cumsum(size)
    out = np.full(int(ends[-1]) if len(ends) else 0, 44, np.uint8)
    starts = ends - size
    for d in range(7):
        has = np.flatnonzero(size > d + 1)
        if not len(has):
            break
        out[starts[has] + d] = s.digits[ids[has], d]
    out[ends[upto_a + (upto_b - n_b) - 1] - 1] = 124
    close = ends[upto_a + upto_b - 1]
    out[close - 1] = 59
    return out, close


def linked(a: Stream, b: Stream) -> tuple[np.ndarray, np.ndarray]:
    """Every link's code, and the byte where it ends: between two neighbouring ends one token of each side overlap."""
    if not len(a.ends) or not len(b.ends):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, x, y = _marked(a, b)
    at = np.flatnonzero(x | y)
    return a.ids[(np.cumsum(x) - x)[at]] << ID_BITS | b.ids[(np.cumsum(y) - y)[at]], at + low


@dataclass
class Fragment:
    """A byte range of a document; ``closed`` is None without a common end, and all tokens are in the prefix then."""
    prefix: tuple[Stream, Stream]
    suffix: tuple[Stream, Stream]
    closed: bytes | None = None
    n_groups: int = 0
    n_a: int = 0
    n_b: int = 0
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ok: bool = True


def _counted(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, back = np.unique(codes, return_inverse=True)
    out = np.zeros(len(unique), np.int64)
    np.add.at(out, back, counts)
    return unique, out


def fragment(s: Sides, a: Stream, b: Stream, ok: bool = True) -> Fragment:
    common = common_ends(a, b)
    if not len(common):
        return Fragment((a, b), (Stream(), Stream()), n_a=len(a.ids), n_b=len(b.ids), ok=ok)
    first, last, end = int(common[0]), int(common[-1]), 1 << 62
    mid = a.part(first, last), b.part(first, last)
    codes, _ = linked(*mid)
    return Fragment((a.part(-1, first), b.part(-1, first)), (a.part(last, end), b.part(last, end)), group_text(s, *mid, common[1:])[0].tobytes(),
                    len(common) - 1, len(a.ids), len(b.ids), *_counted(codes, np.ones(len(codes), np.int64)), ok)


def compose(s: Sides, f: Fragment, g: Fragment) -> Fragment:
    n_a, n_b, ok = f.n_a + g.n_a, f.n_b + g.n_b, f.ok and g.ok
    joined = tuple(x + y for x, y in zip(f.suffix if f.closed is not None else f.prefix, g.prefix))
    if f.closed is None:
        return Fragment(joined, g.suffix, g.closed, g.n_groups, n_a, n_b, g.codes, g.counts, ok)
    if g.closed is None:
        return Fragment(f.prefix, joined, f.closed, f.n_groups, n_a, n_b, f.codes, f.counts, ok)
    middle = group_text(s, *joined, joined[0].ends[-1:])[0].tobytes()
    new, _ = linked(*joined)
    codes = _counted(np.concatenate([f.codes, new, g.codes]), np.concatenate([f.counts, np.ones(len(new), np.int64), g.counts]))
    return Fragment(f.prefix, g.suffix, f.closed + middle + g.closed, f.n_groups + 1 + g.n_groups, n_a, n_b, *codes, ok)


_STREAMS = [f"{part}_{side}_{what}" for part in ("prefix", "suffix") for side in "ab" for what in ("ids", "ends")]
FRAGMENT = ("key long, idx long, ok boolean, closed binary, n_groups long, n_a long, n_b long, codes binary, counts binary, "
            + ", ".join(f"{c} binary" for c in _STREAMS))
_COLUMNS = [c.split()[0] for c in FRAGMENT.split(", ")]
ALIGNED = T.StructType([*[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")], T.StructField("groups_sha256", T.StringType()),
                        T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.LongType()))])


def _pack(key: int, idx: int, f: Fragment) -> tuple:
    parts = [x.astype("<i8").tobytes() for part in (f.prefix, f.suffix) for side in part for x in (side.ids, side.ends)]
    return (key, idx, f.ok, f.closed, f.n_groups, f.n_a, f.n_b, f.codes.astype("<i8").tobytes(), f.counts.astype("<i8").tobytes(), *parts)


def _unpack(r) -> Fragment:
    x = [np.frombuffer(getattr(r, c), "<i8") for c in _STREAMS]
    return Fragment((Stream(x[0], x[1]), Stream(x[2], x[3])), (Stream(x[4], x[5]), Stream(x[6], x[7])), r.closed, int(r.n_groups), int(r.n_a), int(r.n_b),
                    np.frombuffer(r.codes, "<i8"), np.frombuffer(r.counts, "<i8"), bool(r.ok))


def whole(s: Sides, f: Fragment) -> tuple:
    """A document's row from the fragment of all its bytes: its prefix is a group too."""
    if not f.ok or not f.n_a:
        return (0, 0, 0, 0, "", [], [])
    head = group_text(s, *f.prefix, f.prefix[0].ends[-1:])[0].tobytes()
    new, _ = linked(*f.prefix)
    codes, counts = _counted(np.concatenate([new, f.codes]), np.concatenate([np.ones(len(new), np.int64), f.counts]))
    n = (f.n_groups + 1) if f.closed is not None else 1
    return (f.n_a, f.n_b, n, int(counts.sum()), hashlib.sha256((head + (f.closed or b""))[:-1]).hexdigest(), codes.tolist(), counts.tolist())


def align_texts(s: Sides, texts: list[str]) -> pa.RecordBatch:
    """Rows of ALIGNED for whole texts."""
    n = len(texts)
    a, b, bounds, ok = streams(s, texts, [False] * n)
    ok &= np.array([bool(t) for t in texts], bool)
    for side in (a, b):
        own = ok[np.searchsorted(bounds, side.ends, side="left") - 1]
        side.ids, side.ends = side.ids[own], side.ends[own]
    common = common_ends(a, b)
    shown, close = group_text(s, a, b, common)
    code, ends = linked(a, b)
    count = [np.diff(np.searchsorted(x, bounds, side="right")) for x in (a.ends, b.ends, common, ends)]
    upto = np.concatenate([[0], close])[np.searchsorted(common, bounds, side="right")]
    held = memoryview(shown)
    digests = [hashlib.sha256(held[upto[i]:upto[i + 1] - 1]).hexdigest() if ok[i] else "" for i in range(n)]
    text = np.searchsorted(bounds, ends, side="left") - 1
    key, links = np.unique(text << 2 * ID_BITS | code, return_counts=True)
    firsts = np.searchsorted(key, np.arange(n + 1, dtype=np.int64) << 2 * ID_BITS).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(firsts), pa.array(x)) for x in (key & (1 << 2 * ID_BITS) - 1, links.astype(np.int64))]
    return pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int64)) for c in count], pa.array(digests, pa.string()), *lists], names=ALIGNED.names)


def _with_id(ids: pa.Array, batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, *batch.columns], names=["doc_id", *batch.schema.names])


def chunks(text: str, size: int) -> Iterator[tuple[int, str]]:
    """(Byte offset in blank and text, chunk) of a long text; a cut lies before a single blank."""
    at, byte = 0, 0
    while at < len(text):
        m = _cut.search(text, at + size) if at + size < len(text) else None
        end = m.start() if m else len(text)
        yield byte, text[at:end]
        byte += len(text[at:end].encode()) + (at == 0)
        at = end


def _reduced(fragments: DataFrame, a_path: str, b_path: str, most: int) -> DataFrame:
    """One fragment a key, by a tree of FAN neighbours a node; ``most`` fragments a key at most."""
    def join(rows: pd.DataFrame) -> pd.DataFrame:
        s = sides(a_path, b_path)
        rows = rows.sort_values("idx")
        f = functools.reduce(functools.partial(compose, s), [_unpack(r) for r in rows.itertuples()])
        return pd.DataFrame([_pack(int(rows["key"].iloc[0]), int(rows["idx"].iloc[0]) // FAN, f)], columns=_COLUMNS)

    while most > 1:
        fragments = materialize(fragments.groupBy("key", F.floor(F.col("idx") / FAN).alias("node")).applyInPandas(lambda rows: join(rows), FRAGMENT), "fragments")
        most = -(-most // FAN)
    return fragments


def aligned(docs: DataFrame, a_path: str, b_path: str, text: str = "text", doc_id: str = "doc_id", long: int = LONG) -> DataFrame:
    """A row per document: doc_id, the columns of ALIGNED (codes: distinct pairs of ids, counts: their links)."""
    arrays.bounded_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *ALIGNED.fields])
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    is_long = F.length("text") > long

    def direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sides(a_path, b_path)
        for batch in batches:
            _, offsets = arrays.utf8(batch.column("text"))
            for i, j in arrays.pieces(offsets, PIECE):
                yield _with_id(batch.column("doc_id").slice(i, j - i), align_texts(s, batch.column("text").slice(i, j - i).to_pylist()))

    short = docs.where(~is_long).mapInArrow(arrays.released(direct), schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(chunks(batch.column("text")[i].as_py(), long))
                n = len(rows)
                yield pa.RecordBatch.from_arrays([pa.repeat(batch.column("key")[i], n), pa.array([batch.column("doc_id")[i].as_py()] * n, batch.column("doc_id").type), pa.array(range(n), pa.int64()),
                                                  pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["key", "doc_id", "idx", "at", "text"])

    cut_schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc_id", kind), T.StructField("idx", T.LongType()), T.StructField("at", T.LongType()), T.StructField("text", T.StringType())])
    parts = materialize(docs.where(is_long).withColumn("key", F.monotonically_increasing_id()).select("key", "doc_id", "text").mapInArrow(arrays.released(cut), cut_schema), "chunks")
    if not known_rows(parts):
        return short

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sides(a_path, b_path)
        for batch in batches:
            for r in batch.to_pylist():
                a, b, bounds, ok = streams(s, [r["text"]], [r["idx"] > 0])
                a.ends, b.ends = a.ends + r["at"], b.ends + r["at"]
                yield pa.RecordBatch.from_pandas(pd.DataFrame([_pack(r["key"], r["idx"], fragment(s, a, b, bool(ok[0])))], columns=_COLUMNS), preserve_index=False).select(_COLUMNS).cast(_ARROW)

    tasks = max(1, min(known_rows(parts), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))))
    one = materialize(parts.repartition(tasks, "key", "idx").select("key", "idx", "at", "text").mapInArrow(arrays.released(pieces), FRAGMENT), "fragments")
    most = parts.agg(F.max("idx")).first()[0] + 1
    one = _reduced(one, a_path, b_path, most)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sides(a_path, b_path)
        for batch in batches:
            for r in batch.to_pandas().itertuples():
                row = whole(s, _unpack(r))
                yield pa.RecordBatch.from_arrays([pa.array([r.key], pa.int64()), *[pa.array([v], t) for v, t in zip(row, (*[pa.int64()] * 4, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())))]], names=["key", *ALIGNED.names])

    done = one.mapInArrow(arrays.released(finish), T.StructType([T.StructField("key", T.LongType()), *ALIGNED.fields]))
    named = parts.where("idx = 0").select("key", "doc_id").join(done, "key").select(*schema.names)
    return short.unionByName(named)


_ARROW = pa.schema([("key", pa.int64()), ("idx", pa.int64()), ("ok", pa.bool_()), ("closed", pa.binary()), ("n_groups", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                    ("codes", pa.binary()), ("counts", pa.binary()), *[(c, pa.binary()) for c in _STREAMS]])


def pair_counts(rows: DataFrame) -> DataFrame:
    """Of ``rows`` (codes, counts): a row per linked pair of ids: code, a, b, count, best (highest of its b, ties included)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, seen = [], [], 0
        def flushed() -> pa.RecordBatch:
            c, n = _counted(np.concatenate(codes), np.concatenate(counts))
            return pa.RecordBatch.from_arrays([pa.array(c), pa.array(n)], names=["code", "count"])
        for batch in batches:
            c, n = _counted(np.asarray(batch.column("codes").flatten()), np.asarray(batch.column("counts").flatten()))
            codes.append(c)
            counts.append(n)
            seen += len(c)
            if seen > 2_000_000:
                yield flushed()
                codes, counts, seen = [], [], 0
        if seen:
            yield flushed()

    summed = rows.select("codes", "counts").mapInArrow(arrays.released(count), "code long, count long").groupBy("code").agg(F.sum("count").alias("count"))
    summed = materialize(summed.select("code", F.shiftright("code", ID_BITS).alias("a"), F.col("code").bitwiseAND(F.lit((1 << ID_BITS) - 1)).alias("b"), "count"), "pair_counts")
    top = summed.groupBy("b").agg(F.max("count").alias("top"))
    return summed.join(top, "b").select("code", "a", "b", "count", (F.col("count") == F.col("top")).alias("best"))


def alignments(docs: DataFrame, a_path: str, b_path: str, text: str = "text", doc_id: str = "doc_id", long: int = LONG, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = materialize(aligned(docs, a_path, b_path, text, doc_id, long), "aligned")
    pairs = materialize(pair_counts(rows), "pairs")
    out = T.StructType([rows.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], T.StructField("groups_sha256", T.StringType())])
    if known_rows(pairs) <= most_pairs:
        table = pairs.select("code", "count", "best").toArrow()
        code = table.column("code").to_numpy()
        order = np.argsort(code)
        held = docs.sparkSession.sparkContext.broadcast((code[order], table.column("count").to_numpy()[order], table.column("best").to_numpy()[order]))

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, count, best = held.value
            for batch in batches:
                n = np.asarray(batch.column("counts").flatten())
                at = np.searchsorted(known, np.asarray(batch.column("codes").flatten()))
                firsts = np.concatenate([[0], np.cumsum(np.asarray(batch.column("codes").value_lengths()))]).astype(np.int64)
                sums = [np.concatenate([[0], np.cumsum(x)])[firsts] for x in (n * best[at], n * count[at])] if len(known) else [np.zeros(batch.num_rows + 1, np.int64)] * 2
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")], *[pa.array(np.diff(x).astype(np.int64)) for x in sums], batch.column("groups_sha256")], names=out.names)

        return rows.mapInArrow(arrays.released(judge), out)
    keyed = materialize(rows.withColumn("key", F.monotonically_increasing_id()), "aligned")
    each = keyed.select("key", F.explode(F.arrays_zip("codes", "counts")).alias("p")).select("key", F.col("p.codes").alias("code"), F.col("p.counts").alias("n"))
    sums = each.join(pairs, "code").groupBy("key").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    return keyed.join(sums, "key", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
