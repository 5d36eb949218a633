"""Words, word hashes and word-window hashes of whole Arrow batches, in numpy.

A word is a longest run of bytes other than ASCII white space. Texts are cut into slices of bounded
size between rows, so a task holds a few megabytes of scratch arrays whatever its batch holds.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
#: Starting values of two independent hashes.
_SEEDS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))
#: Words beyond this many bytes are hashed by the library, one by one.
_LONG_WORD = 64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 4 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64-bit result."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers_upto(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _BASE_INVERSE):
        p = np.full(size, base, dtype=np.uint64)
        p[0] = 1
        np.multiply.accumulate(p, out=p)
        out.append(p)
    return out[0], out[1]


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers for ``size`` words; tables beyond those of a usual slice are not kept."""
    most = SLICE_BYTES // 2 + 2
    return _powers_upto(most) if size <= most else _powers_upto.__wrapped__(size)


class Texts(NamedTuple):
    """Rows [first, first + len(offsets) - 1) of a batch: their UTF-8 bytes and where each row starts."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def text(self, row: int) -> str:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes().decode("utf-8", "replace")


def give_back() -> None:
    """Returns memory that isn't in use: a worker lives on for later stages, beside others of its executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError, TypeError):
        pass  # another C library


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """A string column in slices of at most ``most`` bytes, or one row; NULL reads as the empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield Texts(row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end
    if len(column) and offsets[-1] - offsets[0] > most:  # small batches leave little behind
        give_back()


class Words(NamedTuple):
    """Words of a slice in order: byte ranges, and per row the range of its words."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # rows + 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def words_of(texts: Texts) -> Words:
    size = len(texts.data)
    inside = np.zeros(size + 2, dtype=np.int8)  # one blank before and after
    inside[1:-1] = ~SPACE[texts.data]
    inner = texts.offsets[1:-1]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # a row border inside a run of word bytes ends one word and starts another
    cut = inner[(inner > 0) & (inner < size)]
    cut = np.unique(cut[(inside[cut] == 1) & (inside[cut + 1] == 1)])
    if len(cut):
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    return Words(starts, ends, np.searchsorted(starts, texts.offsets))


def _chunks(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``data`` on, as numbers; behind the end stand zeros."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))


def word_hash_pair(texts: Texts, words: Words, lower: bool = False, both: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each word; ``lower`` reads A-Z as a-z. Without ``both`` the second is empty.

    Eight bytes at a time are mixed into the hash, so no arithmetic pattern of letters cancels out.
    """
    data = LOWER[texts.data] if lower else texts.data
    sizes = words.ends - words.starts
    seeds = _SEEDS if both else _SEEDS[:1]
    hashes = [sizes.astype(np.uint64) * _LENGTH + seed for seed in seeds]
    if len(sizes):
        chunks = _chunks(data)
        at, left, which = words.starts, sizes, None
        for _ in range(_LONG_WORD // 8):
            chunk = chunks[at] & _MASKS[np.minimum(left, 8)]
            for h in hashes:
                if which is None:
                    h[:] = mixed(h ^ chunk)
                else:
                    h[which] = mixed(h[which] ^ chunk)
            more = np.flatnonzero(left > 8)
            if not len(more):
                break
            which = more if which is None else which[more]
            at, left = at[more] + 8, left[more] - 8
        for i in np.flatnonzero(sizes > _LONG_WORD):
            raw = data[words.starts[i] : words.ends[i]].tobytes()
            digest = np.frombuffer(hashlib.blake2b(raw, digest_size=16).digest(), dtype="<u8")
            for h, part in zip(hashes, digest, strict=False):
                h[i] = part
    return hashes[0], hashes[1] if both else np.zeros(0, dtype=np.uint64)


def word_hashes(texts: Texts, words: Words, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word; ``lower`` reads A-Z as a-z."""
    return word_hash_pair(texts, words, lower, both=False)[0]


class Windows(NamedTuple):
    """Hashes of word windows, in order, with per row the range of its windows."""

    hashes: np.ndarray
    bounds: np.ndarray


def _range_hash(sums: np.ndarray, inverse: np.ndarray, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    length = np.asarray(length)
    return mixed((sums[start + length] - sums[start]) * inverse[start] + length.astype(np.uint64) * _LENGTH)


def window_hashes(hashes: np.ndarray, bounds: np.ndarray, size: int, short: bool) -> Windows:
    """Windows of ``size`` words within each row; ``short``: a row with fewer words has one window of them all."""
    counts = np.diff(bounds)
    power, inverse = _powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * power[: len(hashes)], out=sums[1:])
    whole = np.maximum(counts - size + 1, 0)
    n = np.where((counts > 0) & (counts < size), 1, whole) if short else whole
    out_bounds = np.concatenate([[0], np.cumsum(n)])
    shift = np.repeat(bounds[:-1] - out_bounds[:-1], n)
    start = np.arange(out_bounds[-1]) + shift
    length = np.repeat(np.minimum(counts, size), n) if short else size
    return Windows(_range_hash(sums, inverse, start, length), out_bounds)


def distinct_in_rows(windows: Windows) -> Windows:
    """Sorted distinct hashes of each row."""
    row = np.repeat(np.arange(len(windows.bounds) - 1), np.diff(windows.bounds))
    order = np.lexsort((windows.hashes, row))
    h, r = windows.hashes[order], row[order]
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return Windows(h[first], np.concatenate([[0], np.cumsum(np.bincount(r[first], minlength=len(windows.bounds) - 1))]))
