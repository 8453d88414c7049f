"""Operator 12: phrase collocations with weighted acyclic automata.

A phrase is the path (language, word, word, ...) of an acyclic automaton whose arcs carry counts:
the weight of a path's last arc is the phrase's number of occurrences (a count transducer).

1. Words are counted for each language.  A phrase of ``least`` occurrences only has parts of as
   many, so words, and after the second pass pairs, of fewer are passed over.  A bitmap of
   ``FILTER_BITS`` bits says which may be frequent; it only saves work (a bit that two phrases
   share lets one through), since all that is let through is counted exactly.
2. Each task turns its texts' phrases into sorted blocks, builds an automaton of each block and
   unites these as they grow.  The shard's automaton is cut at prefixes (splitters sampled by
   count, which share out the work and nothing else), states with equal arcs become one, and the
   parts go to the tasks of their prefix range, which unite them by adding weights.
3. Candidates inside a longer one of the same count go.  (Counts never rise with length, so it
   is enough to look at phrases of one word more.)
4. The parts of the rest's cuts are an automaton without weights; by prefix range its
   composition with the count transducer yields the parts' counts, from which the scores follow.

Defined results: A-Z is lower-cased; null and empty texts have no words; a null language is
``und``; repeated rows count each; ties in rank go by count, then by the phrase's bytes; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codeloom.llm import arrays
from codeloom.operators.broadcast import known_rows, materialize, sized_broadcast

LEAST, TOP, LONGEST = 100, 2000, 5
FILTER_BITS = 27
#: Sampled rows for each splitter.
SAMPLES = 32
#: Arcs of a shard's automaton before it is sent, and at most in one part of it.
MOST_ARCS, PART_ARCS = 400_000, 30_000
#: Distinct words of a task before they are sent.
MOST_WORDS = 200_000
PIECE = 1 << 19
UNKNOWN = "und"
#: Depth of a prefix that splitters cut at: language and two words.
PREFIX = 3

_byte = np.arange(256)
_apart = np.isin(_byte, [*b".,;:!?", 10, 11, 12, 13])
_word = ~_apart & (_byte != 32) & (_byte != 9)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts one after the other: hash, first byte and end of each word, its text, and whether
    the next word follows it in one piece."""
    if not len(data):
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3, np.zeros(0, bool)
    inside = _word[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(offsets, starts, side="right") - 1
    piece = np.cumsum(_apart[data])[starts]
    follows = np.zeros(len(starts), bool)
    follows[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
    return arrays.span_hashes(arrays.LOWER[data], starts, ends), starts, ends, text, follows


def _hash_bytes(values: list[bytes]) -> np.ndarray:
    at = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int64)
    return arrays.span_hashes(np.frombuffer(b"".join(values), np.uint8), at[:-1], at[1:])


def _place(*hashes: np.ndarray) -> np.ndarray:
    """The filter's bit of (language, word, ...), given as hashes."""
    h = np.zeros(len(hashes[0]), np.uint64)
    for x in hashes:
        h = arrays.mix(h * np.uint64(arrays.BASE) + x)
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def may_be_frequent(grams: DataFrame) -> np.ndarray:
    """The filter of ``grams`` (lang, phrase) as bytes, put together by Spark; always FILTER_BITS long."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                langs = _hash_bytes([x.encode() for x in batch.column("lang").to_pylist()])
                parts = [x.encode().split(b" ") for x in batch.column("phrase").to_pylist()]
                at = _place(langs, *[_hash_bytes([p[i] for p in parts]) for i in range(len(parts[0]))])
                yield pa.RecordBatch.from_arrays([pa.array(at)], names=["at"])

    rows = grams.select("lang", "phrase").mapInArrow(places, "at long")
    rows = rows.groupBy(F.shiftright("at", 15).alias("slice")).agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit(32767))).alias("bits")).collect()
    out = np.zeros((1 << FILTER_BITS - 15, 4096), np.uint8)
    for r in rows:
        out[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


def _arcs(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arcs from sorted keys of parent (upper half) and label."""
    return (keys >> 32).astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32), weights


@dataclass
class Trie:
    """Phrases as paths: for each depth the arcs' parents (arcs of the depth before), labels
    and weights, sorted by parent and label.  Labels are numbers of symbols that the user holds."""
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @property
    def size(self) -> int:
        return sum(len(level[1]) for level in self.levels)

    @staticmethod
    def of(paths: np.ndarray, weights: np.ndarray, counted_from: int = 0) -> Trie:
        """From rows of labels (-1 after a path's end).  A path's weight counts on its last arc, or
        from depth ``counted_from`` on, if given, on all its arcs."""
        state, levels = np.zeros(len(paths), np.int64), []
        for d in range(paths.shape[1]):
            on = np.flatnonzero(paths[:, d] >= 0)
            if not len(on):
                break
            unique, back = np.unique(state[on] << 32 | paths[on, d], return_inverse=True)
            state[on] = back
            if counted_from:
                own = weights[on] if d + 1 >= counted_from else np.zeros(len(on), np.int64)
            else:
                end = paths[on, d + 1] < 0 if d + 1 < paths.shape[1] else np.ones(len(on), bool)
                own = np.where(end, weights[on], 0)
            sums = np.zeros(len(unique), np.int64)
            np.add.at(sums, back, own)
            levels.append(_arcs(unique, sums))
        return Trie(levels)

    def relabeled(self, to: np.ndarray) -> Trie:
        return Trie([(p, to[x].astype(np.int32), w) for p, x, w in self.levels])

    def united(self, *others: Trie) -> Trie:
        """The union with weights added; also puts a relabeled trie in order (without others)."""
        tries, levels = [self, *others], []
        state = [np.zeros(1, np.int64) for _ in tries]
        for d in range(max(len(t.levels) for t in tries)):
            have = [(i, t.levels[d]) for i, t in enumerate(tries) if d < len(t.levels)]
            unique, back = np.unique(np.concatenate([state[i][p].astype(np.int64) << 32 | x for i, (p, x, _) in have]), return_inverse=True)
            sums = np.zeros(len(unique), np.int64)
            np.add.at(sums, back, np.concatenate([w for _, (_, _, w) in have]))
            cuts = np.cumsum([len(x) for _, (_, x, _) in have])[:-1]
            for (i, _), own in zip(have, np.split(back, cuts)):
                state[i] = own
            levels.append(_arcs(unique, sums))
        return Trie(levels)

    def under(self, depth: int, a: int, b: int) -> Trie:
        """The paths through arcs a..b-1 of a depth (from 0)."""
        spans, i, j = {depth: (a, b)}, a, b
        for d in range(depth, 0, -1):
            i, j = int(self.levels[d][0][i]), int(self.levels[d][0][j - 1]) + 1
            spans[d - 1] = i, j
        for d in range(depth + 1, len(self.levels)):
            a, b = (int(x) for x in np.searchsorted(self.levels[d][0], [a, b]))
            spans[d] = a, b
        out = []
        for d in range(len(self.levels)):
            i, j = spans[d]
            p, x, w = (v[i:j] for v in self.levels[d])
            out.append((p - (spans[d - 1][0] if d else 0), x, w))
        return Trie([v for v in out if len(v[1])])

    def paths(self, depth: int, arcs: np.ndarray) -> np.ndarray:
        """Labels from the root on (rows x depth + 1) of ``arcs`` of a depth."""
        out = np.empty((len(arcs), depth + 1), np.int64)
        for d in range(depth, -1, -1):
            out[:, d] = self.levels[d][1][arcs]
            arcs = self.levels[d][0][arcs]
        return out

    def automaton(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each depth the states' numbers of arcs, and the arcs' labels, weights and targets.

        Depths are frozen from the last one up; of states with the same arcs (labels, weights and targets) one stays.
        """
        out: list = []
        for d in range(len(self.levels) - 1, -1, -1):
            parent, label, weight = self.levels[d]
            n = len(self.levels[d - 1][1]) if d else 1
            target = out[0][4] if out else np.zeros(len(label), np.int64)       # the last depth's arcs all end in one state
            counts = np.bincount(parent, minlength=n)
            firsts = np.cumsum(counts) - counts
            arc = arrays.mix(arrays.mix(label.astype(np.uint64) * np.uint64(arrays.BASE) + weight.astype(np.uint64)) * np.uint64(arrays.BASE) + target.astype(np.uint64))
            sign = arrays.span_hashes(arc, firsts, firsts + counts)
            _, keep, state = np.unique(sign, return_index=True, return_inverse=True)
            same = counts[keep][state] == counts                                # states whose hashes agree are compared arc by arc
            of = np.repeat(firsts[keep][state] - firsts, np.where(same, counts, 0)) + np.flatnonzero(np.repeat(same, counts))
            mine = np.flatnonzero(np.repeat(same, counts))
            bad = (label[of] != label[mine]) | (weight[of] != weight[mine]) | (target[of] != target[mine])
            same[parent[mine[bad]]] = False
            odd = np.flatnonzero(~same)
            state[odd] = len(keep) + np.arange(len(odd))
            keep = np.concatenate([keep, odd])
            size = counts[keep]
            arcs = np.repeat(firsts[keep] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            out.insert(0, (size, label[arcs], weight[arcs], target[arcs], state))
        return [v[:4] for v in out]

    @staticmethod
    def read(automaton: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> Trie:
        """The paths of an automaton."""
        levels, state = [], np.zeros(1, np.int64)
        for size, label, weight, target in automaton:
            firsts, own = np.cumsum(size) - size, size[state]
            arcs = np.repeat(firsts[state] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            levels.append((np.repeat(np.arange(len(state), dtype=np.int32), own), label[arcs].astype(np.int32), weight[arcs]))
            state = target[arcs]
        return Trie([v for v in levels if len(v[1])])


def compose(paths: Trie, counts: Trie) -> list[np.ndarray]:
    """The weights of ``paths``' arcs in ``counts``, for each depth (0 where there is none)."""
    out, state = [], np.zeros(1, np.int64)
    for d, (parent, label, _) in enumerate(paths.levels):
        at = state[parent]
        if d >= len(counts.levels):
            out.append(np.zeros(len(label), np.int64))
            state = np.full(len(label), -1)
            continue
        p, x, w = counts.levels[d]
        key = p.astype(np.int64) << 32 | x
        want = at << 32 | label
        place = np.minimum(np.searchsorted(key, want), len(key) - 1)
        hit = (at >= 0) & (key[place] == want)
        out.append(np.where(hit, w[place], 0))
        state = np.where(hit, place, -1)
    return out


def packed(trie: Trie, symbols: list[bytes]) -> bytes:
    """A trie whose labels number the sorted ``symbols``, as bytes."""
    used = np.unique(np.concatenate([x for _, x, _ in trie.levels]))
    to = np.zeros(len(symbols), np.int64)
    to[used] = np.arange(len(used))
    own = [symbols[i] for i in used.tolist()]
    levels = trie.relabeled(to).automaton()
    head = np.array([len(levels), len(own), *[len(s) for s in own], *[n for v in levels for n in (len(v[0]), len(v[1]))]], "<i4")
    body = [x.astype(kind).tobytes() for v in levels for x, kind in zip(v, ("<i4", "<i4", "<i8", "<i4"))]
    return len(head).to_bytes(4, "little") + head.tobytes() + b"".join(own) + b"".join(body)


def unpacked(blob: bytes) -> tuple[Trie, list[bytes]]:
    n = int.from_bytes(blob[:4], "little")
    head = np.frombuffer(blob, "<i4", n, 4).astype(np.int64)
    at = 4 + 4 * n
    own, sizes = [], head[2 + head[1]:].reshape(-1, 2).tolist()
    for size in head[2:2 + head[1]].tolist():
        own.append(blob[at:at + size])
        at += size
    levels = []
    for states, arcs in sizes:
        level = []
        for kind, count in (("<i4", states), ("<i4", arcs), ("<i8", arcs), ("<i4", arcs)):
            level.append(np.frombuffer(blob, kind, count, at).astype(np.int64))
            at += level[-1].size * int(kind[2])
        levels.append(tuple(level))
    return Trie.read(levels), own


def merged(parts: list[tuple[Trie, list[bytes]]]) -> tuple[Trie, list[bytes]]:
    """The union of tries of own symbols."""
    symbols = sorted(set().union(*[s for _, s in parts]))
    index = {s: i for i, s in enumerate(symbols)}
    first, *rest = [t.relabeled(np.array([index[x] for x in s], np.int64)) for t, s in parts]
    return first.united(*rest), symbols


class Shard:
    """The growing automaton of a task: blocks are united when they are of like size."""

    def __init__(self):
        self.ids: dict[int, int] = {}
        self.symbols: list[bytes] = []
        self.stack: list[Trie] = []

    def number(self, hashes: np.ndarray, spell) -> np.ndarray:
        """Numbers of words by hash; ``spell(i)`` gives the bytes of the i-th."""
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        own = np.empty(len(unique), np.int64)
        for i, (h, at) in enumerate(zip(unique.tolist(), first.tolist())):
            n = self.ids.get(h)
            if n is None:
                n = self.ids[h] = len(self.symbols)
                self.symbols.append(spell(at))
            own[i] = n
        return own[back]

    def add(self, trie: Trie) -> None:
        self.stack.append(trie)
        while len(self.stack) > 1 and self.stack[-2].size <= 2 * self.stack[-1].size:
            last = self.stack.pop()
            self.stack[-1] = self.stack[-1].united(last)

    @property
    def size(self) -> int:
        return sum(t.size for t in self.stack)

    def parts(self, splitters: list[tuple[bytes, ...]]) -> Iterator[tuple[int, bytes]]:
        """(range, automaton) of everything added; empties the shard."""
        trie = self.stack[0].united(*self.stack[1:])
        symbols = sorted(set(self.symbols))              # a language's name may be a word as well
        index = {s: i for i, s in enumerate(symbols)}
        trie = trie.relabeled(np.array([index[s] for s in self.symbols], np.int64)).united()
        self.__init__()
        depth = min(PREFIX, len(trie.levels)) - 1
        paths = trie.paths(depth, np.arange(len(trie.levels[depth][1])))
        ranges = range_of(paths, symbols, splitters)
        weight = np.ones(len(paths), np.int64)
        below = np.arange(len(paths))
        for d in range(depth + 1, len(trie.levels)):
            below = below[trie.levels[d][0]]
            weight += np.bincount(below, minlength=len(paths))
        block = (np.cumsum(weight) - weight) // PART_ARCS
        begins = np.flatnonzero(np.concatenate([[True], (ranges[1:] != ranges[:-1]) | (block[1:] != block[:-1])]))
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(paths)]):
            yield int(ranges[a]), packed(trie.under(depth, a, b), symbols)


def range_of(paths: np.ndarray, symbols: list[bytes], splitters: list[tuple[bytes, ...]]) -> np.ndarray:
    """The number of splitters at or before each path's prefix; ``symbols`` are sorted."""
    if not splitters or not len(paths):
        return np.zeros(len(paths), np.int64)
    def twice(s: bytes) -> int:                     # odd for a symbol, even for a place between two
        i = bisect.bisect_left(symbols, s)
        return 2 * i + 1 if i < len(symbols) and symbols[i] == s else 2 * i
    width = 2 * len(symbols) + 2
    dtype = np.int64 if width ** PREFIX < 1 << 63 else object
    def key(columns) -> np.ndarray:
        out = np.zeros(len(columns[0]), dtype)
        for c in columns:
            out = out * width + c
        return out
    cuts = key([np.array([twice(s[d]) if d < len(s) else 0 for s in splitters], dtype) for d in range(PREFIX)])
    own = key([2 * paths[:, d].astype(dtype) + 1 if d < paths.shape[1] else np.zeros(len(paths), dtype) for d in range(PREFIX)])
    return np.searchsorted(cuts, own, side="right")


def splitters_of(grams: DataFrame, ranges: int) -> list[tuple[bytes, ...]]:
    """Prefixes that share out the occurrences of ``grams`` (lang, phrase, f): a sample by count of
    about ``SAMPLES`` rows a range; none for an empty table."""
    total = grams.agg(F.sum("f")).first()[0] or 0
    if ranges < 2 or not total:
        return []
    step = max(total / (ranges * SAMPLES), 1.0)
    luck = F.pmod(F.xxhash64("lang", "phrase"), F.lit(1 << 20)) / float(1 << 20)
    rows = grams.select("lang", "phrase", F.floor(F.col("f") / step + luck).alias("n")).where("n > 0").collect()
    rows = sorted(((r["lang"].encode(), *r["phrase"].encode().split(b" ")[:PREFIX - 1]), r["n"]) for r in rows)
    upto, done, out, per = 0, 0, [], sum(n for _, n in rows) / ranges
    for prefix, n in rows:
        if upto >= per * (done + 1) and (not out or out[-1] < prefix):
            out.append(prefix)
            done = int(upto // per)
        if len(prefix) < PREFIX and n > per:          # a frequent first word is cut at second words, as the language's words are spread
            words = [(p[1], m) for p, m in rows if p[0] == prefix[0]]
            share, so_far, cuts = sum(m for _, m in words) / (int(n // per) + 1), 0, 1
            for word, m in words:
                if so_far >= share * cuts:
                    out.append((*prefix, word))
                    cuts = int(so_far // share) + 1
                so_far += m
        upto += n
    return out


def _texts(batch: pa.RecordBatch) -> Iterator[tuple]:
    data, offsets = arrays.utf8(batch.column("text"))
    langs = batch.column("lang").to_pylist()
    for a, b in arrays.pieces(offsets, PIECE):
        own = data[offsets[a]:offsets[b]]
        yield langs[a:b], own, *words_of(own, offsets[a:b + 1] - offsets[a])


def _spell(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    lower = arrays.LOWER[data].tobytes()
    return lambda i: lower[starts[i]:ends[i]]


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, f) of every word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, total = Shard(), {}
        def rows() -> pa.RecordBatch:
            keys = list(total)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([shard.symbols[k[1]].decode() for k in keys], pa.string()), pa.array(list(total.values()), pa.int64())], names=["lang", "phrase", "f"])
        for batch in batches:
            for langs, data, hashes, starts, ends, text, _ in _texts(batch):
                names = sorted(set(langs))
                word = shard.number(hashes, _spell(data, starts, ends))
                lang = np.array([names.index(x) for x in langs], np.int64)[text]
                key, n = np.unique(lang << 32 | word, return_counts=True)
                for k, c in zip(key.tolist(), n.tolist()):
                    k = names[k >> 32], k & 0xFFFFFFFF
                    total[k] = total.get(k, 0) + c
                if len(total) > MOST_WORDS:
                    yield rows()
                    shard, total = Shard(), {}
        if total:
            yield rows()

    return docs.mapInArrow(arrays.released(count), "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def phrase_counts(docs: DataFrame, frequent: np.ndarray, splitters: list[tuple[bytes, ...]], sizes: range, least: int) -> DataFrame:
    """(lang, phrase, size, f) of the phrases of ``sizes`` words with ``least`` occurrences.  ``frequent``:
    the filter of the words (for two words) or of the pairs."""
    held = docs.sparkSession.sparkContext.broadcast((frequent, splitters))
    first = sizes[0]

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, cuts = held.value
        shard = Shard()
        def sent() -> pa.RecordBatch:
            rows = list(shard.parts(cuts))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["range", "automaton"])
        for batch in batches:
            for langs, data, hashes, starts, ends, text, follows in _texts(batch):
                lang_hash = _hash_bytes([x.encode() for x in langs])[text]
                if first == 2:
                    good = _has(bits, _place(lang_hash, hashes))
                    pair = np.flatnonzero(follows[:-1] & good[:-1] & good[1:])
                else:
                    near = np.flatnonzero(follows)
                    pair = near[_has(bits, _place(lang_hash[near], hashes[near], hashes[near + 1]))]
                on = np.zeros(len(hashes) + LONGEST, bool)
                on[pair] = True
                reach = on[:len(hashes)].astype(np.int64)          # words after this one that still make a phrase of frequent pairs
                for i in range(1, sizes[-1] - 1):
                    reach += (reach == i) & on[i:i + len(hashes)]
                at = np.flatnonzero(reach >= first - 1)
                if not len(at):
                    continue
                used = np.unique(np.minimum(at[:, None] + np.arange(sizes[-1]), len(hashes) - 1))
                spell = _spell(data, starts[used], ends[used])
                label = np.full(len(hashes), -1, np.int64)
                label[used] = shard.number(hashes[used], spell)
                names = sorted(set(langs))
                name_hash = _hash_bytes([b"\0" + x.encode() for x in names])
                lang = shard.number(name_hash, lambda i: names[i].encode())[np.array([names.index(x) for x in langs], np.int64)[text[at]]]
                paths = np.full((len(at), sizes[-1] + 1), -1, np.int64)
                paths[:, 0] = lang
                for i in range(sizes[-1]):
                    far = reach[at] >= i
                    paths[far, i + 1] = label[at[far] + i]
                shard.add(Trie.of(paths, np.ones(len(at), np.int64), counted_from=first + 1))
                if shard.size > MOST_ARCS:
                    yield sent()
        if shard.size:
            yield sent()

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held_parts, done = None, [], False
        def grams() -> pa.RecordBatch:
            trie, symbols = merged(held_parts)
            out: list[tuple] = []
            for d in range(first, len(trie.levels)):
                arcs = np.flatnonzero(trie.levels[d][2] >= least)
                for path, f in zip(trie.paths(d, arcs).tolist(), trie.levels[d][2][arcs].tolist()):
                    out.append((symbols[path[0]].decode(), b" ".join([symbols[i] for i in path[1:]]).decode(), d, f))
            lang, phrase, size, f = zip(*out) if out else ([],) * 4
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(phrase, pa.string()), pa.array(size, pa.int32()), pa.array(f, pa.int64())], names=["lang", "phrase", "size", "f"])
        for batch in batches:
            for r, blob in zip(batch.column("range").to_pylist(), batch.column("automaton")):
                if held_parts and r != now:
                    yield grams()
                    held_parts = []
                now = r
                held_parts.append(unpacked(blob.as_py()))
                while len(held_parts) > 1 and held_parts[-2][0].size <= 2 * held_parts[-1][0].size:
                    last = held_parts.pop()
                    held_parts[-1] = merged([held_parts[-1], last])
        if held_parts:
            yield grams()

    parts = docs.mapInArrow(arrays.released(shards), "range int, automaton binary")
    parts = parts.repartition(len(splitters) + 1, "range").sortWithinPartitions("range")
    return parts.mapInArrow(arrays.released(unite), "lang string, phrase string, size int, f long")


def _symbolic(rows: list[tuple[str, str]], weights: np.ndarray) -> tuple[Trie, list[bytes]]:
    """The automaton of (lang, phrase) rows."""
    split = [(a.encode(), *p.encode().split(b" ")) for a, p in rows]
    symbols = sorted({s for row in split for s in row})
    index = {s: i for i, s in enumerate(symbols)}
    paths = np.full((len(split), max(len(r) for r in split)), -1, np.int64)
    for i, row in enumerate(split):
        paths[i, :len(row)] = [index[s] for s in row]
    return Trie.of(paths, weights), symbols


def part_counts(parts: DataFrame, grams: DataFrame, splitters: list[tuple[bytes, ...]]) -> DataFrame:
    """(lang, part, f) of distinct ``parts`` (lang, part): their automaton composed with that of
    ``grams`` (lang, phrase, f), range by range."""
    held = parts.sparkSession.sparkContext.broadcast(splitters)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = held.value
        for batch in batches:
            rows = [(x.encode(), *p.encode().split(b" ")[:PREFIX - 1]) for x, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([bisect.bisect_right(cuts, r) for r in rows], pa.int32()), *batch.columns], names=["range", *batch.schema.names])

    asked = parts.select("lang", "part").mapInArrow(routed, "range int, lang string, part string")
    known = grams.select("lang", "phrase", "f").mapInArrow(routed, "range int, lang string, phrase string, f long")

    def composed(left: pa.Table, right: pa.Table) -> pa.Table:
        asks = list(zip(left.column("lang").to_pylist(), left.column("part").to_pylist()))
        got = np.zeros(len(asks), np.int64)
        if asks and right.num_rows:
            counts, own = _symbolic(list(zip(right.column("lang").to_pylist(), right.column("phrase").to_pylist())), right.column("f").to_numpy())
            paths, names = _symbolic(asks, np.arange(1, len(asks) + 1))            # a path's weight is its row's number
            index = {s: i for i, s in enumerate(own)}
            found = compose(paths.relabeled(np.array([index.get(s, len(own)) for s in names], np.int64)), counts)
            for (_, _, row), f in zip(paths.levels, found):
                got[row[row > 0] - 1] = f[row > 0]
        return pa.table({"lang": left.column("lang"), "part": left.column("part"), "f": pa.array(got)})

    return asked.groupBy("range").cogroup(known.groupBy("range")).applyInArrow(composed, "lang string, part string, f long")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    arrays.bounded_batches(spark)
    docs = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text}`").alias("text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    words = materialize(word_counts(docs), "words")
    n = materialize(words.groupBy("lang").agg(F.sum("f").alias("n")), "words_by_language")
    words = words.where(F.col("f") >= least).select("lang", "phrase", F.lit(1).alias("size"), "f")
    pairs = materialize(phrase_counts(docs, may_be_frequent(words), splitters_of(words, ranges), range(2, 3), least), "pairs")
    splitters = splitters_of(pairs, ranges)
    more = materialize(phrase_counts(docs, may_be_frequent(pairs), splitters, range(3, LONGEST + 1), least), "phrases")
    found = pairs.unionByName(more)
    split = F.split("phrase", " ")
    shorter = more.select("lang", "f", F.explode(F.array(F.array_join(F.slice(split, F.lit(2), F.col("size") - 1), " "), F.array_join(F.slice(split, F.lit(1), F.col("size") - 1), " "))).alias("phrase"))
    kept = materialize(found.join(shorter, ["lang", "phrase", "f"], "left_anti"), "candidates")
    cut = kept.select("lang", "phrase", "size", F.col("f").alias("a"), split.alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"), F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"))
    parts = cut.select("lang", F.col("first").alias("part")).unionByName(cut.select("lang", F.col("rest").alias("part"))).distinct()
    known = materialize(part_counts(parts, words.unionByName(found), splitters), "parts")
    firsts = known.select("lang", F.col("part").alias("first"), F.col("f").alias("l"))
    rests = known.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    whole = cut.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"]).join(sized_broadcast(n), "lang")
    exact = {c: F.col(c).cast("decimal(15,0)") for c in "alrn"}
    score = F.call_function("div", exact["a"] * exact["n"] * F.lit(1000).cast("decimal(4,0)"), exact["l"] * exact["r"])
    best = whole.groupBy("lang", "phrase").agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r", "a", "n")).alias("x"))
    best = materialize(best.select("lang", "phrase", "x.*").drop("k"), "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salts = 1 + (known_rows(best) or 0) // (8 * top)
    best = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
