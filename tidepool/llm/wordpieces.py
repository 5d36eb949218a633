"""Token ids of words, by the tokenizers library.

The vocabulary drops white space before it merges, and no rule of it looks across white space, so the
ids of a text are those of its words one after another. Its rules also split a word into runs of
letters, single digits and runs of other characters, fold case, and never merge across such parts. So
words of plain characters (ASCII and Latin letters, without apostrophe and angle bracket) are cut into
these parts here; all other words stay whole. Each distinct part is encoded once per worker.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from tidepool.llm import hashing
from tidepool.llm.hashing import Texts, Words

DEFAULT_TOKENIZER = "word_bpe_49k.json"
#: Words that a worker remembers between slices.
CACHE_WORDS = 500_000


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=2)
def pieces(path: str) -> list[str]:
    """Piece of each id; the size is fixed by the vocabulary. The driver keeps these, not the tokenizer."""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    out = [""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        out[i] = piece
    return out


#: Kinds of bytes in plain words: letters, digits, others; 0 makes a word one that stays whole.
_KIND = np.zeros(256, dtype=np.int8)
_KIND[33:127] = 3
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = _KIND[0xC3] = 1
_KIND[0x80:0xC0] = 1  # second byte of a Latin letter, checked against its first
_KIND[[ord("'"), ord("<")]] = 0
#: Parts encoded as one text, and the mark of the last piece of each.
_JOINED, _LAST = 256, "</w>"


class Parts(NamedTuple):
    """Parts of the words of a slice that are encoded on their own; ``plain`` ones hold characters of one kind."""

    texts: Texts
    words: Words
    plain: np.ndarray


def parts_of(texts: Texts, words: Words | None = None) -> Parts:
    words = hashing.words_of(texts) if words is None else words
    data = texts.data
    if not len(words.starts):
        return Parts(texts, words, np.zeros(0, dtype=bool))
    kind = _KIND[data]
    lead, follow = data == 0xC3, (data >= 0x80) & (data < 0xC0)
    bad = kind == 0
    after = np.zeros(len(data), dtype=bool)
    after[1:] = lead[:-1]
    bad |= follow & (~after | (data == 0x97) | (data == 0xB7))
    inside = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(bad, out=inside[1:])
    plain = inside[words.ends] == inside[words.starts]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    sizes = words.ends - words.starts
    of_plain = np.repeat(plain, sizes)
    at = np.repeat(words.starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(of_plain))
    cut = edge[at] & of_plain
    cut[np.cumsum(sizes) - sizes] = True
    first = np.flatnonzero(cut)
    starts = at[first]
    number = np.repeat(np.arange(len(sizes)), sizes)[first]
    ends = words.ends[number]
    same = number[1:] == number[:-1]
    ends[:-1][same] = starts[1:][same]
    bounds = np.searchsorted(number, words.bounds)
    folded = data.copy()
    own = at[of_plain]
    folded[own] = hashing.LOWER[data[own]]
    return Parts(Texts(texts.first, folded, texts.offsets), Words(starts, ends, bounds), plain[number])


@lru_cache(maxsize=2)
def last_pieces(path: str) -> np.ndarray:
    """Which ids end a part."""
    return np.array([p.endswith(_LAST) for p in pieces(path)])


def encode_plain(path: str, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of plain parts one after another, and how many each has; many at once, cut at pieces that end a part."""
    joined = [" ".join(parts[i : i + _JOINED]) for i in range(0, len(parts), _JOINED)]
    ids, _ = flat_lists(encode_words(path, joined))
    ends = np.flatnonzero(last_pieces(path)[ids]) + 1
    if len(ends) != len(parts) or (len(ends) and ends[-1] != len(ids)):  # a vocabulary without such marks
        return flat_lists(encode_words(path, parts))
    return ids, np.diff(ends, prepend=0)


def encode_words(path: str, words: list[str]) -> list[list[int]]:
    return [e.ids for e in tokenizer(path).encode_batch_fast(words, add_special_tokens=False)]


def word_array(texts: Texts, words: Words) -> pa.Array:
    """The words of a slice as an Arrow string column, one value per position."""
    lengths = words.ends - words.starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    inside = np.repeat(words.starts - offsets[:-1], lengths) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(texts.data[inside]))


def packed(texts: Texts, words: Words, which: np.ndarray) -> tuple[Texts, Words]:
    """Some words of a slice, one after another with a blank between, as a slice of one row."""
    sizes = words.ends[which] - words.starts[which]
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    at = np.repeat(words.starts[which] - starts, sizes + 1) + np.arange(ends[-1] if len(ends) else 0)
    data = texts.data[np.minimum(at, max(len(texts.data) - 1, 0))]
    data[ends - 1] = 32
    return Texts(0, data, np.array([0, len(data)])), Words(starts, ends - 1, np.array([0, len(which)]))


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists ``which`` of a flat list array one after another, and the length of each."""
    n = lengths[which]
    ends = np.cumsum(n)
    at = np.repeat(starts[which] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
    return values[at], n


def flat_lists(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Values of lists one after another, and their lengths."""
    n = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype=np.int32, count=int(n.sum())), n


def _grown(values: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``values``, of which ``used`` are in use, with ``more`` behind them; room doubles."""
    if used + len(more) > len(values):
        larger = np.empty(max(2 * len(values), used + len(more)), dtype=values.dtype)
        larger[:used] = values[:used]
        values = larger
    values[used : used + len(more)] = more
    return values


def small(values: np.ndarray) -> np.ndarray:
    """In two bytes each if all fit, else in four."""
    return values.astype(np.uint16 if values.max(initial=0) < 1 << 16 else np.int32)


class WordTable:
    """Ids of words in a table with open addresses; a word is known by two independent 64-bit hashes, both of which are compared."""

    def __init__(self, room: int):
        self.slots = np.full(1 << max(10, (2 * room - 1).bit_length()), -1, dtype=np.int32)
        self.hashes = self.others = np.zeros(0, dtype=np.uint64)
        self.starts = self.lengths = self.values = np.zeros(0, dtype=np.int32)
        self.count = self.n_values = 0

    def compact(self) -> WordTable:
        """Without room for more words; to be broadcast."""
        self.hashes, self.others = self.hashes[: self.count].copy(), self.others[: self.count].copy()
        self.starts, self.lengths = self.starts[: self.count].copy(), small(self.lengths[: self.count])
        self.values = small(self.values[: self.n_values])
        return self

    def ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known words one after another, and how many each has."""
        return gathered(self.values, self.starts, self.lengths.astype(np.int64), at)

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Number of each known word, else -1."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        if not self.count:
            return out
        slot, left = self._slot(hashes), np.arange(len(hashes))
        while len(left):
            here = self.slots[slot]
            taken = here >= 0
            slot, left, here = slot[taken], left[taken], here[taken]
            same = (self.hashes[here] == hashes[left]) & (self.others[here] == others[left])
            out[left[same]] = here[same]
            slot, left = (slot[~same] + 1) % len(self.slots), left[~same]
        return out

    def learn(self, hashes: np.ndarray, others: np.ndarray, fresh: np.ndarray, n: np.ndarray) -> None:
        """Adds words that aren't known, none twice."""
        if self.count + len(hashes) > len(self.slots) // 2:
            self.slots = np.full(1 << (4 * (self.count + len(hashes)) - 1).bit_length(), -1, dtype=np.int32)
            self._place(self.hashes[: self.count], 0)
        self.starts = _grown(self.starts, self.count, self.n_values + np.cumsum(n, dtype=np.int64) - n)
        self.lengths = _grown(self.lengths, self.count, n)
        self.hashes = _grown(self.hashes, self.count, hashes)
        self.others = _grown(self.others, self.count, others)
        self.values = _grown(self.values, self.n_values, fresh)
        self._place(hashes, self.count)
        self.count += len(hashes)
        self.n_values += len(fresh)

    def _place(self, hashes: np.ndarray, first: int) -> None:
        slot, left = self._slot(hashes), np.arange(first, first + len(hashes), dtype=np.int32)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            lost = self.slots[slot] != left
            slot, left = (slot[lost] + 1) % len(self.slots), left[lost]


class WordEncoder:
    """Encodes slices; a worker keeps the ids of words it met, up to a bound, besides those of a given table."""

    def __init__(self, path: str, most: int = CACHE_WORDS, given: WordTable | None = None):
        self.path, self.most, self.given, self.own = path, most, given, WordTable(most)

    def ids(self, texts: Texts, words: Words | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and the bounds of each row."""
        parts = parts_of(texts, words)
        out, n = self.each(parts)
        return out, np.concatenate([[0], np.cumsum(n)])[parts.words.bounds]

    def each(self, parts: Parts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts one after another, and how many each has."""
        hashes, others = hashing.word_hash_pair(parts.texts, parts.words)
        at_given = self.given.find(hashes, others) if self.given is not None else np.full(len(hashes), -1, dtype=np.int64)
        rare = np.flatnonzero(at_given < 0)
        at = self._learnt(parts, hashes, others, rare)
        ids, n = self.own.ids(at)
        if len(rare) == len(hashes):
            return ids, n
        known = np.flatnonzero(at_given >= 0)
        near, n_near = self.given.ids(at_given[known])
        size, begin = np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        size[known], size[rare] = n_near, n
        begin[known], begin[rare] = np.cumsum(n_near) - n_near, len(near) + np.cumsum(n) - n
        return gathered(np.concatenate([near.astype(np.int32), ids]), begin, size, np.arange(len(hashes)))

    def _learnt(self, parts: Parts, hashes: np.ndarray, others: np.ndarray, rare: np.ndarray) -> np.ndarray:
        """Place of each rare part in the worker's own table; unknown ones are encoded."""
        texts, words, plain = parts
        at = self.own.find(hashes[rare], others[rare])
        missing = np.flatnonzero(at < 0)
        while len(missing):
            _, first = np.unique(hashes[rare[missing]], return_index=True)
            new = rare[missing[first]]
            if self.own.count and self.own.count + len(new) > self.most:
                self.own = WordTable(self.most)
                at, missing = np.full(len(rare), -1, dtype=np.int64), np.arange(len(rare))
                continue
            for kind, encode in ((plain, encode_plain), (~plain, lambda path, names: flat_lists(encode_words(path, names)))):
                some = new[kind[new]]
                if len(some):
                    names = word_array(texts, Words(words.starts[some], words.ends[some], words.bounds)).to_pylist()
                    self.own.learn(hashes[some], others[some], *encode(self.path, names))
            at[missing] = self.own.find(hashes[rare[missing]], others[rare[missing]])
            missing = missing[at[missing] < 0]  # words that share one hash only
        return at


@lru_cache(maxsize=2)
def worker_encoder(path: str, most: int = CACHE_WORDS) -> WordEncoder:
    """The encoder that tasks of one worker share."""
    return WordEncoder(path, most)
