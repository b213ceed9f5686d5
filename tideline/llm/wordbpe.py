"""Ids of a lower-casing word-level BPE tokenizer, with repeated words looked up.

The tokenizer drops white space, so a text's ids are those of its white-space separated
words, joined. Words are remembered; the new words of a batch are cut as the tokenizer's
file says and merged all together with array operations. Anything unusual (control
characters, special tokens, scripts beyond Latin, Greek and Cyrillic, letters whose
lower case depends on their place, or a file of another make) goes to the library.
"""

from __future__ import annotations

import json
import unicodedata
from itertools import chain

import numpy as np
import regex

#: Bytes that the remembered words, and the remembered parts, may take up. Words save more work.
CACHE_BYTES = 176 << 20
PART_BYTES = 8 << 20
#: Bytes of a remembered word besides its letters and ids: two objects and a table slot.
ENTRY_BYTES = 200
#: Longer words go to the library: the rounds below merge one pair of each word at a time.
LONG_WORD = 128
NO_MERGE = 2**31 - 1
#: White space for the host language but not for the tokenizer: fixed values.
ODD_SPACES = "\x1c\x1d\x1e\x1f"
LAST_PLAIN = "\u052f"
PLACE_DEPENDENT = "\u03a3"


def byte_letters() -> list[str]:
    """The printable stand-in of every byte, as byte-level vocabularies spell them."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


def _bytes_of(words: list[str], ids: list[bytes]) -> int:
    return sum(map(len, words)) + sum(map(len, ids)) + ENTRY_BYTES * len(words)


class WordTokenizer:
    def __init__(self, path: str, cache_bytes: int | None = None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.cache_bytes = cache_bytes or CACHE_BYTES
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.known_bytes = self.parts_bytes = 0
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.special = [t["content"] for t in made.get("added_tokens") or []]
        self.table = _merge_table(made)

    def _direct(self, text: str) -> bytes:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _usual(self, word: str) -> bool:
        return len(word) <= LONG_WORD and (word.isascii() and "<|" not in word or self._plain(word))

    def _plain(self, text: str) -> bool:
        return (
            max(text) <= LAST_PLAIN
            and PLACE_DEPENDENT not in text
            and unicodedata.is_normalized("NFC", text)
            and not any(s in text for s in self.special)
        )

    def _learn(self, new: list[str]) -> None:
        known, parts, table = self.known, self.parts, self.table
        if table is None:
            for word in new:
                known[word] = self._direct(word)
            return
        strange = [w for w in new if len(w) > LONG_WORD or not w.isascii() or "<|" in w]
        # What holds for these words joined holds for each.
        if strange and (max(map(len, strange)) > LONG_WORD or not self._plain("\n".join(strange))):
            strange = [w for w in strange if not self._usual(w)]
        else:
            strange = []
        known.update((word, self._direct(word)) for word in strange)
        if strange:
            new = [w for w in new if w not in known]
        if self.parts_bytes > PART_BYTES:
            parts.clear()
            self.parts_bytes = 0
        # All words are cut in one go: a line each, and the line ends come back as parts.
        cut = table.lines.findall("\n".join(new).lower())
        parts["\n"] = b""
        fresh = list(set(cut).difference(parts))
        if fresh:
            made = table.merge_all([p.encode() for p in fresh])
            parts.update(zip(fresh, made))
            self.parts_bytes += _bytes_of(fresh, made)
        ids = list(map(parts.__getitem__, cut))
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        data = b"".join(ids)
        lines = np.fromiter(map("\n".__eq__, cut), bool, len(cut))
        stops = [*ends[lines].tolist(), len(data)]
        known.update(zip(new, [data[a:z] for a, z in zip([0, *stops], stops)]))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, each as little-endian 32-bit numbers."""
        odd = [any(c in t for c in ODD_SPACES) for t in texts]
        split = [[] if o else t.split() for t, o in zip(texts, odd)]
        known = self.known
        if self.known_bytes > self.cache_bytes:
            known.clear()
            self.known_bytes = 0
        new = list(set(chain.from_iterable(split)).difference(known))
        if new:
            self._learn(new)
            self.known_bytes += _bytes_of(new, [known[w] for w in new])
        get = known.__getitem__
        return [self._direct(t) if o else b"".join(map(get, some)) for t, some, o in zip(texts, split, odd)]


class MergeTable:
    """Pair ranks in an open hash table of arrays, so all pairs of a round are looked up at once."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str, pattern: str):
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.final = np.array([vocab[c + suffix] for c in letters], dtype=np.int64)
        self.lines = regex.compile(pattern + "|\n")
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        key = (left << 32) | right
        self.bits = max(8, int(len(key) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, NO_MERGE, dtype=np.int64)
        slot = self._slot(key)
        todo = np.arange(len(key))
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.keys[slot[todo]] == -1
            at, first = np.unique(slot[todo[free]], return_index=True)
            won = todo[free][first]
            self.keys[at], self.ranks[at] = key[won], won
            todo = np.setdiff1d(todo, won)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        slot = self._slot(key)
        out = np.full(len(key), NO_MERGE, dtype=np.int64)
        open_ = np.arange(len(key))
        for _ in range(self.probes):
            there = self.keys[slot[open_]]
            hit = there == key[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
        return out

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """Each round merges the best-ranked, leftmost pair of every word that has one left."""
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        lengths = np.array([len(w) for w in words])
        symbol = self.inner[raw]
        last = np.cumsum(lengths) - 1
        symbol[last] = self.final[raw[last]]
        owner = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(raw))
        done = []
        rank = np.full(len(symbol), NO_MERGE, dtype=np.int64)
        if len(symbol) > 1:
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            rank[inside] = self.rank(symbol[inside], symbol[inside + 1])
        while len(owner):
            n = len(owner)
            heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            least = np.minimum.reduceat(rank * n + np.arange(n), heads)
            best, at = least // n, least % n
            merge = best < NO_MERGE
            at = at[merge]
            symbol[at] = self.made[best[merge]]
            keep = np.ones(n, bool)
            keep[at + 1] = False
            live = np.repeat(merge, np.diff(np.concatenate((heads, [n]))))
            done.append((place[~live], symbol[~live], owner[~live]))
            touched = np.zeros(n, bool)
            touched[at] = True
            touched[np.maximum(at - 1, 0)] |= at > 0
            keep &= live
            symbol, owner, place, rank, touched = symbol[keep], owner[keep], place[keep], rank[keep], touched[keep]
            i = np.flatnonzero(touched)
            rank[i] = NO_MERGE
            i = i[i + 1 < len(owner)]
            i = i[owner[i + 1] == owner[i]]
            rank[i] = self.rank(symbol[i], symbol[i + 1])
        place, symbol, owner = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(place)
        data = symbol[order].astype("<u4").tobytes()
        stops = (4 * np.cumsum(np.bincount(owner, minlength=len(words)))).tolist()
        return [data[a:z] for a, z in zip([0, *stops[:-1]], stops)]


def _merge_table(made: dict) -> MergeTable | None:
    """The table, if the file is of the make this module knows; else None."""
    try:
        model, steps = made["model"], made["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in made["normalizer"]["normalizers"]]
        fits = (
            model["type"] == "BPE" and model["end_of_word_suffix"] and not model["byte_fallback"] and not model["dropout"]
            and not model["ignore_merges"] and not model["continuing_subword_prefix"]
            and kinds == ["NFC", "Replace", "Lowercase"] and made["post_processor"] is None
            and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and not steps[1]["use_regex"]
            and not steps[1]["add_prefix_space"]
        )
        if not fits:
            return None
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return MergeTable(model["vocab"], merges, model["end_of_word_suffix"], steps[0]["pattern"]["Regex"])
    except (KeyError, TypeError, IndexError):
        return None
