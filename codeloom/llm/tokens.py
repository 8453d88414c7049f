"""Token ids of a public word-BPE vocabulary for whole Arrow batches.

The pre-tokens of a batch are found with numpy on code points.  Every distinct pre-token
is encoded once per Python worker (its ids are kept in flat arrays), so that the work for a
frequent word is a table lookup.  Distinct pre-tokens are merged by ``tiktoken`` with the
same vocabulary: the word-end suffix is written as a zero byte, pre-tokens that hold a zero
byte themselves and texts with the vocabulary's special strings go to ``tokenizers``.
The result equals ``Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids``.
"""

from __future__ import annotations

import functools
import json
import unicodedata

import numpy as np

from codeloom.llm import arrays

#: Pre-tokens that a worker keeps before it starts over.
MOST_KEPT = 300_000
SLOT_BITS = 20
SPACE, LETTER, NUMBER, OTHER = range(4)
#: Code points above ASCII that the vocabulary's patterns take as white space.
SPACES = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@functools.cache
def classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[[*range(9, 14), 32, *SPACES]] = SPACE
    return out


@functools.cache
def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordBpe:
    """Ids of many texts; one instance per Python worker (:func:`word_bpe`)."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        special = {t["content"] for t in spec["added_tokens"]}
        self.special = sorted(special)
        to_byte, suffix = byte_of(), spec["model"]["end_of_word_suffix"]
        ranks = {}
        self.is_end = np.zeros(max(vocab.values()) + 1, dtype=bool)
        for token, i in vocab.items():
            if token in special:
                continue
            end = token.endswith(suffix) and token != suffix
            body = token[:-len(suffix)] if end else token
            ranks[bytes(to_byte[c] for c in body) + b"\0" * end] = i
            self.is_end[i] = end
        self.merger = tiktoken.Encoding("word_bpe", pat_str="[^\\x00]+\\x00", mergeable_ranks=ranks, special_tokens={})
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)        # sorted hashes of the pre-tokens kept
        self.entry = np.zeros(0, np.int32)        # their entries
        self.at, self.length = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, np.uint16), 0
        self.slot_key = np.zeros(1 << SLOT_BITS, np.uint64)
        self.slot_entry = np.zeros(1 << SLOT_BITS, np.int32)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens, one after the other, and how many each has."""
        odd = [i for i, w in enumerate(words) if "\0" in w]
        plain = [w for w in words if "\0" not in w] if odd else words
        ids = np.asarray(self.merger.encode_ordinary("\0".join(plain) + "\0" if plain else ""), dtype=np.uint16)
        lengths = np.diff(np.flatnonzero(self.is_end[ids]), prepend=-1)
        if len(lengths) != len(plain):
            raise ValueError("pre-tokens and their ids don't match")
        if odd:
            parts = np.split(ids, np.cumsum(lengths)[:-1]) if plain else []
            for i in odd:
                parts.insert(i, np.asarray(self.exact.encode(words[i], add_special_tokens=False).ids, dtype=np.uint16))
            ids, lengths = np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, lengths

    def add(self, hashes: np.ndarray, words: list[str]) -> np.ndarray:
        ids, lengths = self.merge(words)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        entries = np.arange(len(self.at), len(self.at) + len(words), dtype=np.int32)
        self.at = np.concatenate([self.at, self.used + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths.astype(np.int32)])
        self.used += len(ids)
        place = np.searchsorted(self.keys, hashes)
        self.keys = np.insert(self.keys, place, hashes)
        self.entry = np.insert(self.entry, place, entries)
        return entries

    def entries(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: str) -> np.ndarray:
        if len(self.keys) > MOST_KEPT:
            self.clear()
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        out = self.slot_entry[slot]
        missed = np.flatnonzero(self.slot_key[slot] != hashes)
        if len(missed):
            unique, first, back = np.unique(hashes[missed], return_index=True, return_inverse=True)
            place = np.minimum(np.searchsorted(self.keys, unique), max(len(self.keys) - 1, 0))
            known = self.keys[place] == unique if len(self.keys) else np.zeros(len(unique), bool)
            found = np.zeros(len(unique), np.int32)
            if known.any():
                found[known] = self.entry[place[known]]
            if not known.all():
                new = np.flatnonzero(~known)
                where = missed[first[new]]
                found[new] = self.add(unique[new], [text[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())])
            out[missed] = found[back]
            slot = (unique >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            self.slot_key[slot] = unique
            self.slot_entry[slot] = found
            late = self.slot_key[slot] != unique   # of two in one slot, the last stays
            self.slot_entry[slot[~late]] = found[~late]
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and per text the index of its first id (n + 1)."""
        normal, exact = [], {}
        for i, t in enumerate(texts):
            t = t or ""
            if any(s in t for s in self.special):
                exact[i] = self.exact.encode(t, add_special_tokens=False).ids
                t = ""
            if not t.isascii():
                t = unicodedata.normalize("NFC", t).replace("Σ", "σ")
            normal.append(t.lower())
        text = "\n".join(normal) + "\n"
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = classes()[points]
        begins = kind != SPACE
        begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        quotes = np.flatnonzero((points == 39) & begins)
        if len(quotes):
            ahead = np.concatenate([points, np.zeros(4, np.uint32)])
            one, two = ahead[quotes + 1], ahead[quotes + 2]
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
            s, g = quotes[short], quotes[long & ~short]
            begins[s + 1] = False
            begins[s + 2] = kind[s + 2] != SPACE
            begins[g + 1] = begins[g + 2] = False
            begins[g + 3] = kind[g + 3] != SPACE
        borders = np.flatnonzero(begins | (kind == SPACE))
        mine = np.flatnonzero(begins[borders])
        starts, ends = borders[mine], borders[mine + 1] if len(mine) else borders[mine]
        entry = self.entries(arrays.span_hashes(points, starts, ends), starts, ends, text)
        lengths = self.length[entry].astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.repeat(self.at[entry] - upto[:-1], lengths) + np.arange(upto[-1])]
        text_at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in normal])])
        firsts = upto[np.searchsorted(starts, text_at)]
        if exact:
            parts = [np.asarray(exact[i], dtype=np.uint16) if i in exact else ids[firsts[i]:firsts[i + 1]] for i in range(len(texts))]
            ids, firsts = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, firsts


@functools.cache
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)
