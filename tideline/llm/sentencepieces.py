"""SentencePiece encoding and decoding with suffix-array matching.

The new words of a batch are concatenated, at most ``PART_CHARS`` at a time, and their suffixes
sorted; every piece of the
vocabulary is then binary-searched for the range of its occurrences. The occurrences
are edges (position, length, rank), sorted by position, and the segmentation comes
from relaxing along them. For the public vocabulary, which is a BPE model, a
relaxation step is a merge: the best-ranked edge that covers exactly two neighbouring
segments of a word, leftmost first, joins them, for all words at once. (Relaxing a
sum of scores instead, as for unigram models, gives other ids than the model's.)

Words are runs of the space mark and what follows up to the next one. No piece
crosses their borders, so words are segmented on their own and remembered. A word too long for
a part, as in scripts without spaces, is cut where no piece spans the cut: merges never
cross such a place.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended, held, without
from .shingles import batches_by_bytes

SPACE = "▁"
#: Bytes that the remembered words may take up, and those of a word besides its letters and ids.
CACHE_BYTES = 64 << 20
ENTRY_BYTES = 200
STEP_BYTES = 1 << 20
#: Characters whose pieces are matched at once; a character needs about 200 bytes meanwhile.
PART_CHARS = 1 << 18
LONG_WORD = 64
NO_EDGE = np.int32(2**31 - 1)


class PieceTable:
    """The vocabulary of a BPE SentencePiece model in the form that matching needs."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        usual = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.pieces = {model.id_to_piece(i): i for i in usual}
        by_score = sorted(usual, key=lambda i: (-model.get_score(i), i))
        self.rank = {i: r for r, i in enumerate(by_score)}
        self.unknown = model.unk_id()
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.longest = max(map(len, self.pieces), default=1)
        self.id_of_rank = np.array(by_score, dtype=np.int64)
        multi = [(p, i) for p, i in self.pieces.items() if len(p) > 1]
        self.letters = {c for p, _ in multi for c in p}
        self.points = np.zeros((len(multi), self.longest), dtype=np.uint32)
        for r, (p, _) in enumerate(multi):
            self.points[r, : len(p)] = [ord(c) for c in p]
        self.sizes = np.array([len(p) for p, _ in multi], dtype=np.int64)
        self.ranks = np.array([self.rank[i] for _, i in multi], dtype=np.int32)
        self.single = {ord(p): i for p, i in self.pieces.items() if len(p) == 1}
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("pieces that cross a word border are not supported")
        barrier = "\n" if "\n" not in self.letters else ""
        self.word = re.compile(f"{SPACE}*[^{SPACE}{barrier}]+|{SPACE}+" + (f"|{barrier}" if barrier else ""))
        self.raw: list[bytes] = []
        for i in range(size):
            if model.is_byte(i):
                self.raw.append(bytes([int(model.id_to_piece(i)[3:5], 16)]))
            elif model.is_control(i):
                self.raw.append(b"")
            elif model.is_unknown(i):
                self.raw.append(" ⁇ ".encode())
            else:
                self.raw.append(model.id_to_piece(i).replace(SPACE, " ").encode())
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0

    # ------------------------------------------------------------ matching

    def edges(self, codes: np.ndarray, bits: int, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All occurrences of pieces of two characters or more: (position, length, rank), by position.

        ``codes`` are places in the sorted ``chars`` counted from 1; 0 matches nothing.
        """
        per_key = 64 // bits
        depth = -(-self.longest // per_key)
        keys = _windows(codes, bits, depth)
        suffixes = np.lexsort(keys[::-1])
        keys = [k[suffixes] for k in keys]
        inside = np.arange(self.longest) < self.sizes[:, None]
        slot = np.searchsorted(chars, self.points)
        present = np.isin(self.points, chars)
        use = (present | ~inside).all(axis=1)
        low = np.zeros((int(use.sum()), depth * per_key), dtype=np.uint64)
        low[:, : self.longest] = np.where(inside, slot + 1, 0)[use]
        high = low.copy()
        lengths = self.sizes[use]
        high[np.arange(low.shape[1]) >= lengths[:, None]] = (1 << bits) - 1
        begin = _search(keys, _pack(low, bits, depth), False)
        end = _search(keys, _pack(high, bits, depth), True)
        counts = end - begin
        at = np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        position = suffixes[at]
        order = np.argsort(position, kind="stable")
        return position[order], np.repeat(lengths, counts)[order], np.repeat(self.ranks[use], counts)[order]

    def segment(self, words: list[str]) -> list[bytes]:
        """Ids of each word (little-endian 32-bit), found together."""
        text = "".join(words)
        chars = np.array(sorted(map(ord, set(text) & self.letters)), dtype=np.uint32)
        if len(chars) >= 65534 and len(words) > 1:
            half = len(words) // 2
            return self.segment(words[:half]) + self.segment(words[half:])
        bits = 8 if len(chars) < 255 else 16
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        seen, which = np.unique(points, return_inverse=True)
        code_of = np.where(np.isin(seen, chars), np.searchsorted(chars, seen) + 1, 0).astype(np.uint64)
        id_of = np.array([self.single.get(c, -1) for c in seen.tolist()], dtype=np.int64)
        lengths = np.array([len(w) for w in words])
        # Every word ends in a zero, which no piece contains.
        place = np.arange(len(points)) + np.repeat(np.arange(len(words)), lengths)
        codes = np.zeros(len(points) + len(words), dtype=np.uint64)
        codes[place] = code_of[which]
        single = np.full(len(codes), -1, dtype=np.int64)
        single[place] = id_of[which]
        starts = np.cumsum(lengths) - lengths + np.arange(len(words))
        rank = np.full((len(codes), self.longest + 1), NO_EDGE, dtype=np.int32)
        position, size, found = self.edges(codes, bits, chars)
        rank[position, size] = found
        begin, end, owner = self._relax(rank, starts, lengths)
        order = np.argsort(begin)
        begin, end, owner = begin[order], end[order], owner[order]
        size = end - begin
        ids = np.where(size > 1, self.id_of_rank[np.minimum(rank[begin, size], len(self.id_of_rank) - 1)], single[begin])
        data = ids.astype("<u4").tobytes()
        stops = 4 * np.cumsum(np.bincount(owner, minlength=len(words)))
        stops = stops.tolist()
        out = [data[a:z] for a, z in zip([0, *stops[:-1]], stops)]
        for w in np.unique(np.concatenate((owner[ids < 0], np.flatnonzero(lengths > LONG_WORD)))).tolist():
            word, s, got = words[w], int(starts[w]), []
            for b, e in _relax_long(rank[s : s + len(word)]):
                self._emit(word[b:e], got)
            out[w] = np.asarray(got, dtype="<u4").tobytes()
        return out

    def _emit(self, piece: str, out: list[int]) -> None:
        found = self.pieces.get(piece)
        if found is not None:
            out.append(found)
        elif self.bytes:
            out.extend(self.bytes[b] for b in piece.encode("utf-8", "surrogatepass"))
        elif not out or out[-1] != self.unknown:
            out.append(self.unknown)

    def _relax(self, rank: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """Merge the words of up to LONG_WORD characters; (begin, end, word) of the final segments."""
        longest = self.longest
        short = np.flatnonzero((lengths <= LONG_WORD) & (lengths > 0))
        owner = np.repeat(short, lengths[short])
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(lengths[short]) - lengths[short], lengths[short])
        begin = starts[owner] + nth
        end = begin + 1
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(owner):
            size = np.zeros(len(owner), np.int64)
            size[:-1] = np.where(owner[1:] == owner[:-1], end[1:] - begin[:-1], 0)
            cost = rank[begin, np.where((size > 0) & (size <= longest), size, 0)].astype(np.int64)
            cost[(size == 0) | (size > longest)] = NO_EDGE
            heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            least = np.minimum.reduceat(cost * len(cost) + np.arange(len(cost)), heads)
            at = least % len(cost)
            merge = least // len(cost) < NO_EDGE
            at = at[merge]
            end[at] = end[at + 1]
            keep = np.ones(len(owner), bool)
            keep[at + 1] = False
            # Words without a merge are finished.
            live = np.repeat(merge, np.diff(np.concatenate((heads, [len(owner)]))))
            done.append((begin[~live], end[~live], owner[~live]))
            keep &= live
            begin, end, owner = begin[keep], end[keep], owner[keep]
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*done))

    # ------------------------------------------------------------ texts

    def _spanned(self, word: str, at: int) -> bool:
        """True if a piece that occurs in ``word`` covers the place between ``at - 1`` and ``at``."""
        reach, pieces = self.longest, self.pieces
        return any(
            word[a:z] in pieces for a in range(at - 1, max(-1, at - reach), -1) for z in range(at + 1, min(len(word), a + reach) + 1)
        )

    def _cut(self, word: str) -> list[str]:
        """A long word in parts that no piece connects; each is about PART_CHARS long if there are such places."""
        parts, last, at = [], 0, PART_CHARS
        while at < len(word):
            if self._spanned(word, at):
                at += 1
                continue
            parts.append(word[last:at])
            last, at = at, at + PART_CHARS
        return [*parts, word[last:]]

    def _learn(self, new: list[str]) -> None:
        """Segment new words, so many at a time that the arrays of a part stay small."""
        known = self.known
        part, size = [], 0
        for word in [*new, None]:
            if part and (word is None or size + len(word) > PART_CHARS):
                made = self.segment(part)
                known.update(zip(part, made))
                self.known_bytes += sum(map(len, part)) + sum(map(len, made)) + ENTRY_BYTES * len(part)
                part, size = [], 0
            if word is not None:
                part.append(word)
                size += len(word)

    def _ids_of_long(self, word: str) -> bytes:
        """Parts meet where an unknown character can be on both sides: such ids are one."""
        out: list[bytes] = []
        for part in self._cut(word):
            made = self.segment([part])[0]
            if out and not self.bytes and made[:4] == out[-1][-4:] == np.asarray([self.unknown], "<u4").tobytes():
                made = made[4:]
            out.append(made)
        return b"".join(out)

    def _texts(self, texts: list[str]) -> list[bytes]:
        split = [self.word.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        known = self.known
        if self.known_bytes > CACHE_BYTES:
            known.clear()
            self.known_bytes = 0
        long = {w: self._ids_of_long(w) for w in {w for words in split for w in words if len(w) > PART_CHARS}}
        self._learn(sorted({w for words in split for w in words if w not in known and w not in long}))
        return [b"".join([known[w] if w in known else long[w] for w in words]) for words in split]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; long texts are taken in slices that end before a space."""
        out, step = [], []
        for text in texts:
            if len(text) <= 2 * STEP_BYTES:
                step.append(text)
                continue
            out += self._texts(step)
            out.append(b"".join([self._texts([part])[0] for part in _slices(text)]))
            step = []
        return out + self._texts(step)

    def decode(self, ids: bytes) -> str:
        raw = self.raw
        data = b"".join([raw[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])
        text = data.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _slices(text: str, size: int = STEP_BYTES) -> Iterator[str]:
    """Parts of about ``size`` characters, cut at single spaces: each but the last ends before one, which is left out
    because a text begins with a space mark of its own."""
    at = 0
    while len(text) - at > size:
        border = text.find(" ", at + size)
        # Among several spaces in a row, or next to a mark, a slice would begin another word.
        while 0 <= border < len(text) - 1 and (text[border + 1] in f" {SPACE}" or text[border - 1] in f" {SPACE}"):
            border = text.find(" ", border + 1)
        if border < 0 or border >= len(text) - 1:
            break
        yield text[at:border]
        at = border + 1
    yield text[at:]


def _windows(codes: np.ndarray, bits: int, depth: int) -> list[np.ndarray]:
    """The next ``depth * 64 / bits`` characters of every suffix, packed into ``depth`` numbers."""
    per_key = 64 // bits
    padded = np.concatenate([codes, np.zeros(depth * per_key, np.uint64)])
    one = np.zeros(len(padded), np.uint64)
    for k in range(per_key):
        one[: len(padded) - k] |= padded[k:] << np.uint64(64 - bits * (k + 1))
    return [one[k * per_key : k * per_key + len(codes)] for k in range(depth)]


def _pack(rows: np.ndarray, bits: int, depth: int) -> list[np.ndarray]:
    per_key = 64 // bits
    out = []
    for k in range(depth):
        key = np.zeros(len(rows), np.uint64)
        for j in range(per_key):
            key |= rows[:, k * per_key + j] << np.uint64(64 - bits * (j + 1))
        out.append(key)
    return out


def _search(keys: list[np.ndarray], wanted: list[np.ndarray], right: bool) -> np.ndarray:
    """Binary search of all wanted keys at once in lexicographically sorted keys."""
    n = len(keys[0])
    low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), n)
    while (open_ := low < high).any():
        mid = (low + high) // 2
        probe = np.minimum(mid, n - 1)
        less, same = np.zeros(len(low), bool), np.ones(len(low), bool)
        for key, want in zip(keys, wanted):
            less |= same & (key[probe] < want)
            same &= key[probe] == want
        go = (less | same) if right else less
        low = np.where(open_ & go, mid + 1, low)
        high = np.where(open_ & ~go, mid, high)
    return low


def _relax_long(rank: np.ndarray) -> list[tuple[int, int]]:
    """Merging of one long word with a heap; ``rank[position, length]``."""
    n, longest = len(rank), rank.shape[1] - 1
    nxt, prv, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = nxt[i]
        if j < n and end[j] - i <= longest and (r := int(rank[i, end[j] - i])) != NO_EDGE:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = nxt[i] if alive[i] else n
        if j >= n or end[j] != stop or end[i] != j:
            continue
        alive[j] = False
        end[i], nxt[i] = stop, nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
        offer(i)
        if prv[i] >= 0:
            offer(prv[i])
    out, i = [], 0
    while i < n:
        out.append((i, end[i]))
        i = nxt[i]
    return out


def piece_table(path: str) -> PieceTable:
    return held(f"pieces {path}", lambda: PieceTable(path))


def encode(docs: DataFrame, model_path: str, text_col: str = "text", with_text: bool = True) -> DataFrame:
    """All rows and columns plus ``ids``: the model's ids as little-endian 32-bit numbers (binary).

    Null texts and empty texts have no ids. An input column ``ids`` is replaced. A text
    that holds the space mark itself encodes it as a space, as the model does.
    ``model_path`` must name the same file on all machines.
    """
    slim = without(docs, "ids")
    keep = slim.columns if with_text else [c for c in slim.columns if c != text_col]

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(model_path)
        for batch in batches:
            for part in batches_by_bytes(batch, text_col, STEP_BYTES):
                ids = table.encode_batch([t or "" for t in part.column(text_col).to_pylist()])
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(ids, pa.binary())], [*keep, "ids"])

    return slim.mapInArrow(stage, extended(slim.select(*keep), ids="binary"))


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """All rows and columns plus ``decoded``; null ids decode to an empty text. ``decoded`` is replaced."""
    slim = without(encoded, "decoded")

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [table.decode(x or b"") for x in part.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])

    return slim.mapInArrow(stage, extended(slim, decoded="string"))


def token_count(ids: str = "ids"):
    return F.floor(F.octet_length(ids) / 4)
