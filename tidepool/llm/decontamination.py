"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

An item leaks into a document if at least ``percent`` of the item's distinct word shingles occur in it.
A long document is far larger than an item, so its whole-text Jaccard similarity says nothing. Items
are therefore put into size classes (1, 2, 4, ... shingles), and for a class of at most w shingles
each document is cut into blocks of w consecutive shingles; two neighbouring blocks form a window in
which a passage of that length lies whole. Minima of a block are minima of its halves, so all classes
share one pass over the text. A class has as many minima as make the chance of missing a contiguous
leak at most ``miss``; one equal minimum makes a candidate, and each candidate is then counted on the
distinct shingles of the whole document, first by hash, then by its words.

Items are broadcast in blocks of bounded bytes, and documents are scanned where they lie: nothing is
shuffled, and neither a common passage nor a hot source changes the work of a task.

Cases: a NULL or blank text on either side leaks nothing; an item or document with fewer than k words
has one shingle, all its words; repeated rows give repeated pairs; ids may be NULL and are passed on;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm import hashing
from tidepool.llm.hashing import Texts, Windows

SHINGLE_WORDS = 5
PERCENT = 80
MISS = 1e-6
#: Bytes of item text in one broadcast block.
BLOCK_BYTES = 4 << 20
_FILTER_BITS = 18
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class Signature(NamedTuple):
    """Minima of one order, sorted, their items, and a filter of their leading bits, which is built anew where the rest is sent."""

    keys: np.ndarray
    members: np.ndarray
    seen: np.ndarray

    def __reduce__(self):
        return _signature, (self.keys, self.members)


def _signature(keys: np.ndarray, members: np.ndarray) -> Signature:
    seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
    seen[keys >> np.uint64(64 - _FILTER_BITS)] = True
    return Signature(keys, members, seen)


class SizeClass(NamedTuple):
    """Items of (width / 2, width] shingles; signatures[j] are their j-th minima, sorted, with the items."""

    width: int
    signatures: list[tuple[np.ndarray, np.ndarray, np.ndarray]]


class Block(NamedTuple):
    ids: pa.Array
    shingles: list[np.ndarray]  # distinct hashes by item
    words: list[frozenset]  # the shingles themselves by item
    need: np.ndarray  # shared shingles from which an item leaks
    classes: list[SizeClass]


@lru_cache(maxsize=4)
def _orders(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that give ``n`` orders of shingle hashes; the first ones are the same for every ``n``."""
    xor = np.random.default_rng(7).integers(0, 2**63, n, dtype=np.uint64)
    return xor, np.random.default_rng(8).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _minima(width: int, percent: int, miss: float) -> int:
    """Minima needed for the worst passage of a size class: the smallest item, in the fullest window."""
    if width == 1:
        return 1
    least = width // 2 + 1
    shared = -(-least * percent // 100)
    jaccard = shared / (2 * width + least - shared)
    return math.ceil(math.log(miss) / math.log(1 - jaccard))


def _shingles(texts: Texts, k: int) -> Windows:
    words = hashing.words_of(texts)
    return hashing.window_hashes(hashing.word_hashes(texts, words, lower=True), words.bounds, k, short=True)


def _word_shingles(text: bytes, k: int) -> list[tuple]:
    words = _WORD.findall(text.translate(_LOWER))
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [tuple(words)] * bool(words)


def index_items(ids: pa.Array, texts: pa.Array, k: int, percent: int, miss: float) -> Block:
    """The items of one block with their signatures by size class."""
    shingles, words = [], []
    for part in hashing.text_slices(texts):
        sets = hashing.distinct_in_rows(_shingles(part, k))
        for row in range(part.rows):
            shingles.append(sets.hashes[sets.bounds[row] : sets.bounds[row + 1]])
            words.append(frozenset(_word_shingles(part.text(row).encode(), k)))
    sizes = np.array([len(s) for s in shingles], dtype=np.int64)
    widths = np.array([1 << max(0, int(n) - 1).bit_length() for n in sizes])
    classes = []
    for width in np.unique(widths[sizes > 0]):
        members = np.flatnonzero((widths == width) & (sizes > 0))
        signatures, n = [], _minima(int(width), percent, miss)
        xor, odd = _orders(n)
        for j in range(n):
            least = np.array([((shingles[i] ^ xor[j]) * odd[j]).min() for i in members], dtype=np.uint64)
            order = np.argsort(least, kind="stable")
            signatures.append(_signature(least[order], members[order]))
        classes.append(SizeClass(int(width), signatures))
    return Block(ids, shingles, words, -(-sizes * percent // 100), classes)


def _block_starts(bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First element of each run of ``width`` within its row, and the row."""
    runs = -(-np.diff(bounds) // width)
    row = np.repeat(np.arange(len(runs)), runs)
    before = np.concatenate([[0], np.cumsum(runs)])
    return bounds[row] + (np.arange(before[-1]) - before[row]) * width, row


def _candidates(windows: Windows, block: Block) -> np.ndarray:
    """(row, item) pairs with an equal minimum in some window."""
    found = []
    values = windows.hashes
    if not len(values) or not block.classes:
        return np.zeros((0, 2), dtype=np.int64)
    starts = {c.width: _block_starts(windows.bounds, c.width) for c in block.classes}
    finest = block.classes[0].width
    to_finest = {w: np.searchsorted(starts[finest][0], s) for w, (s, _) in starts.items()}
    most = max(len(c.signatures) for c in block.classes)
    xor, odd = _orders(most)
    for j in range(most):
        small = (values ^ xor[j]) * odd[j]
        small = np.minimum.reduceat(small, starts[finest][0])
        for c in block.classes:
            if j >= len(c.signatures):
                continue
            row = starts[c.width][1]
            least = np.minimum.reduceat(small, to_finest[c.width])
            if c.width > 1:
                joined = np.minimum(least[:-1], least[1:])
                least[:-1] = np.where(row[:-1] == row[1:], joined, least[:-1])
            keys, members, seen = c.signatures[j]
            at = np.flatnonzero(seen[least >> np.uint64(64 - _FILTER_BITS)])
            low, high = np.searchsorted(keys, least[at], "left"), np.searchsorted(keys, least[at], "right")
            n = high - low
            if n.any():
                at, low, n = at[n > 0], low[n > 0], n[n > 0]
                item = members[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                found.append(np.unique(np.stack([np.repeat(row[at], n), item], axis=1), axis=0))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), dtype=np.int64)


def leaks(texts: Texts, block: Block, k: int) -> Iterator[tuple[int, int, int]]:
    """(row, item, shared shingles) of a slice, exact."""
    windows = _shingles(texts, k)
    last, words = -1, []
    for row, item in _candidates(windows, block):
        own = windows.hashes[windows.bounds[row] : windows.bounds[row + 1]]
        if np.isin(block.shingles[item], own).sum() < block.need[item]:
            continue
        if row != last:
            last, words = row, _word_shingles(texts.text(row).encode(), k)
        at = np.flatnonzero(np.isin(own, block.shingles[item]))
        shared = len({words[p] for p in at} & block.words[item])
        if shared >= block.need[item]:
            yield int(row), int(item), shared


def _blocks(items: DataFrame, k: int, percent: int, miss: float, item_id: str, text: str, block_bytes: int) -> Iterator[Block]:
    items = items.select(F.col(item_id).alias("item"), F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).toArrow().combine_chunks()
        yield index_items(*(pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in part.columns), k, percent, miss)


def contaminated_pairs(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    k: int = SHINGLE_WORDS, percent: int = PERCENT, miss: float = MISS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per leak: document id, item id, the item's shingles, those shared, and their ratio."""
    spark = docs.sparkSession
    schema = T.StructType(
        [T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField(item_id, items.schema[item_id].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("n_shingles", "n_shared")]
        + [T.StructField("containment", T.DoubleType())]
    )
    source = docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text"))
    result = None
    for block in _blocks(items, k, percent, miss, item_id, text, block_bytes):
        held = spark.sparkContext.broadcast(block)

        def find(batches, held=held):
            for batch in batches:
                for texts in hashing.text_slices(batch.column(1)):
                    hits = list(leaks(texts, held.value, k))
                    if not hits:
                        continue
                    rows, at, shared = (np.array(x, dtype=np.int64) for x in zip(*hits, strict=True))
                    sizes = np.array([len(held.value.words[i]) for i in at], dtype=np.int64)
                    columns = [batch.column(0).take(pa.array(rows + texts.first)), held.value.ids.take(pa.array(at))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes), pa.array(shared), pa.array(shared / sizes)], names=schema.names)

        part = source.mapInArrow(find, schema)
        result = part if result is None else result.unionByName(part)
    return result


def decontaminated(
    docs: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text",
    k: int = SHINGLE_WORDS, percent: int = PERCENT, miss: float = MISS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs``, all columns, into which no item leaks; one scan, no shuffle."""
    column = docs.columns.index(text)
    for block in _blocks(items, k, percent, miss, item_id, text, block_bytes):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches, held=held):
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for texts in hashing.text_slices(batch.column(column)):
                    for row, _, _ in leaks(texts, held.value, k):
                        keep[texts.first + row] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
