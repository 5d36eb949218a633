"""Substring dedup by relative Lempel-Ziv parsing against reference blocks.

The reference is the corpus itself. It is cut where the least hash of the ``ANCHOR_WORDS``-word
anchors of a window changes: all windows of a piece share that anchor, and so do equal windows
anywhere, so dealing pieces by anchor gives reference blocks such that a piece can only match inside
its own block. Each block indexes every window of its pieces, and each piece is factored greedily
against that index: a factor starts at a window that occurs elsewhere and runs on while its source
runs on, too. A window that crosses the end of a factor is looked up like any other and starts a
factor of its own if it occurs elsewhere, so the factors cover exactly the words of repeated windows.

A piece that repeats within a task is sent twice, as a rule; further copies are known to be repeats
where they lie. So a passage found in a third of all documents reaches its block a few times per task.

A frequent line in differing surroundings gives many different pieces with one anchor. So a first pass
counts the windows that each bucket of anchors would receive. Pieces of buckets beyond ``ANCHOR_WINDOWS``
are dealt window by window, by anchor and window hash, and each window is sent twice per task, as a rule.
Equal windows still meet, and no task holds more than ``ANCHOR_WINDOWS`` windows of different content for
one key. Which buckets these are is a matter of balance only. At 30 GB a bucket of ordinary anchors has
about 5000 windows; from some 400 GB on nearly all windows are dealt one by one, at more shuffle.

Cases: a NULL or blank text has no words; a text shorter than a window keeps all; repeated rows, and
rows that share an id, are documents of their own and repeat each other where their words do; NULL ids
are kept; other columns are ignored, whatever their names. Windows are compared by a 64-bit anchor
hash and 48 bits of an independent window hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import hashing, storage
from tidepool.llm.hashing import Texts, Words

WINDOW_WORDS = 35
ANCHOR_WORDS = 6
_KEPT_BYTES = 6  # of a window's hash
#: Pieces, and windows, that a task remembers, and window rows that a block works on at a time.
_KNOWN, _BLOCK_WINDOWS = 1 << 18, 1 << 20
#: Buckets of anchors that are counted, and windows up to which a bucket is dealt by anchor.
_BUCKETS, ANCHOR_WINDOWS = 1 << 20, 1 << 16


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[: len(values) - span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Pieces:
    """Runs of windows of a slice that share their anchor."""

    def __init__(self, texts: Texts, window: int, anchor: int):
        self.words = hashing.words_of(texts)
        hashes = hashing.word_hashes(texts, self.words, lower=False)
        windows = hashing.window_hashes(hashes, self.words.bounds, window, short=False)
        self.windows, total = windows.hashes, len(windows.hashes)
        row = np.repeat(np.arange(texts.rows), np.diff(windows.bounds))
        if not total:
            self.key = np.zeros(0, dtype=np.uint64)
            self.row = self.first = self.count = self.start = np.zeros(0, dtype=np.int64)
            return
        # anchors of the slice as one text; those of a window lie in its row
        anchors = hashing.window_hashes(hashes, np.array([0, len(hashes)]), anchor, short=False).hashes
        least = _sliding_least(anchors, window - anchor + 1)
        position = np.arange(total) + (self.words.bounds[:-1] - windows.bounds[:-1])[row]
        key = least[position]
        new = np.ones(total, dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
        self.first = np.flatnonzero(new)
        self.count = np.diff(np.append(self.first, total))
        self.key, self.row = key[self.first], row[self.first]
        self.start = position[self.first] - self.words.bounds[self.row]

    def content(self) -> np.ndarray:
        """Hash of each piece: its anchor and its windows in order."""
        bounds = np.append(self.first, len(self.windows))
        return hashing.mixed(hashing.window_hashes(self.windows, bounds, int(self.count.max(initial=1)), short=True).hashes ^ self.key)


class Sent:
    """What a task sent once or twice, in a table of fixed size; copies of what fell out are sent again."""

    def __init__(self):
        self.hashes, self.times = np.zeros(_KNOWN, dtype=np.uint64), np.zeros(_KNOWN, dtype=np.int64)

    def new(self, hashes: np.ndarray) -> np.ndarray:
        """Which of these are to be sent; all others are repeats of two that were."""
        distinct, inverse, n = np.unique(hashes, return_inverse=True, return_counts=True)
        rank = np.empty(len(hashes), dtype=np.int64)
        rank[np.argsort(inverse, kind="stable")] = np.arange(len(hashes)) - np.repeat(np.cumsum(n) - n, n)
        slot = (distinct % np.uint64(_KNOWN)).astype(np.int64)
        before = np.where(self.hashes[slot] == distinct, self.times[slot], 0)
        self.hashes[slot] = distinct
        self.times[slot] = np.where(self.hashes[slot] == distinct, np.minimum(before + n, 2), 0)
        return rank < (2 - before)[inverse]


def _buckets(keys: np.ndarray) -> np.ndarray:
    return (hashing.mixed(keys) % np.uint64(_BUCKETS)).astype(np.int64)


def _count(batches, window: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """Windows that a task would send to each bucket of anchors."""
    sent, counts = Sent(), np.zeros(_BUCKETS, dtype=np.int64)
    for batch in batches:
        for texts in hashing.text_slices(batch.column(0)):
            p = Pieces(texts, window, anchor)
            if len(p.key):
                new = sent.new(p.content())
                np.add.at(counts, _buckets(p.key[new]), p.count[new])
    used = np.flatnonzero(counts)
    for first in range(0, len(used), 1 << 16):
        some = used[first : first + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], names=["bucket", "n"])


def _dealt(batch: pa.RecordBatch, texts: Texts, key: np.ndarray, row: np.ndarray, start: np.ndarray, count: np.ndarray, sent: np.ndarray, windows: np.ndarray) -> pa.RecordBatch:
    """Runs of windows to deal by key; ``windows`` are those of the sent runs, others are known repeats."""
    raw = np.ascontiguousarray(np.ascontiguousarray(windows).view(np.uint8).reshape(-1, 8)[:, :_KEPT_BYTES])
    offsets = np.concatenate([[0], np.cumsum(np.where(sent, count * _KEPT_BYTES, 0))]).astype(np.int32)
    of_windows = pa.BinaryArray.from_buffers(pa.binary(), len(sent), [pa.array(sent).buffers()[1], pa.py_buffer(offsets), pa.py_buffer(raw)])
    at = pa.array(row + texts.first)
    # known repeats only pass through a block, any block
    key = np.where(sent, key, key + np.arange(len(key), dtype=np.uint64)).view(np.int64)
    columns = [pa.array(key), batch.column(0).take(at), batch.column(1).take(at), pa.array(start.astype(np.int32))]
    return pa.RecordBatch.from_arrays([*columns, pa.array(count.astype(np.int32)), of_windows], names=["key", "doc_id", "row_hash", "start", "n", "windows"])


def _send(batches, window: int, anchor: int, crowded: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    pieces, singles = Sent(), Sent()
    for batch in batches:
        for texts in hashing.text_slices(batch.column(2)):
            p = Pieces(texts, window, anchor)
            if not len(p.key):
                continue
            content = p.content()
            sent = pieces.new(content)
            split = sent & np.isin(_buckets(p.key), crowded) if crowded is not None and len(crowded) else np.zeros(len(sent), dtype=bool)
            whole = ~split
            key = np.where(sent, p.key, content)
            yield _dealt(batch, texts, key[whole], p.row[whole], p.start[whole], p.count[whole], sent[whole], p.windows[np.repeat(sent & whole, p.count)])
            if not split.any():
                continue
            at = np.flatnonzero(np.repeat(split, p.count))
            piece = np.repeat(np.arange(len(p.key)), p.count)[at]
            key = hashing.mixed(p.windows[at] ^ hashing.mixed(p.key[piece]))
            sent = singles.new(key)
            # a sent window goes alone, known ones in runs
            first = np.ones(len(at), dtype=bool)
            first[1:] = sent[1:] | sent[:-1] | (piece[1:] != piece[:-1])
            runs = np.flatnonzero(first)
            start = p.start[piece[runs]] + at[runs] - p.first[piece[runs]]
            yield _dealt(batch, texts, key[runs], p.row[piece[runs]], start, np.diff(np.append(runs, len(at))), sent[runs], p.windows[at[sent]])


def block_factors(keys: np.ndarray, counts: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Greedy factors of the pieces of whole blocks: (piece, first window, windows, source piece)."""
    piece = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(windows)) - np.repeat(np.cumsum(counts) - counts, counts)
    order = np.lexsort((windows, keys[piece]))
    h, k = windows[order], keys[piece[order]]
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (k[1:] == k[:-1])
    leader = np.maximum.accumulate(np.where(same, 0, np.arange(len(h))))
    repeated = same.copy()
    repeated[:-1] |= same[1:]
    # the source is the first occurrence; that of the first is the second
    source = np.full(len(h), -1, dtype=np.int64)
    source[order] = np.where(repeated, order[np.where(same, leader, np.minimum(np.arange(len(h)) + 1, len(h) - 1))], -1)
    found = source >= 0
    goes_on = np.zeros(len(h), dtype=bool)
    goes_on[1:] = found[1:] & found[:-1] & (piece[1:] == piece[:-1]) & (source[1:] == source[:-1] + 1) & (piece[source[1:]] == piece[source[:-1]])
    first = np.flatnonzero(found & ~goes_on)
    length = np.diff(np.append(np.flatnonzero(~goes_on), len(h)))[found[~goes_on]]
    return piece[first], within[first], length, piece[source[first]]


def _parse(batches, window: int) -> Iterator[pa.RecordBatch]:
    def parsed(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        pieces = table.filter(table.column("windows").is_valid())
        known = table.filter(table.column("windows").is_null())
        columns = [[known.column(c).combine_chunks() for c in ("doc_id", "row_hash", "start")] + [pa.array(known.column("n").to_numpy() + window - 1, pa.int32())]]
        if pieces.num_rows:
            raw = pieces.column("windows").combine_chunks()
            counts = pieces.column("n").to_numpy().astype(np.int64)
            flat = np.zeros((int(counts.sum()), 8), dtype=np.uint8)
            low = np.frombuffer(raw.buffers()[1], dtype=np.int32)[raw.offset]
            data = np.frombuffer(raw.buffers()[2], dtype=np.uint8)[low : low + len(flat) * _KEPT_BYTES]
            flat[:, :_KEPT_BYTES] = data.reshape(-1, _KEPT_BYTES)
            piece, first, length, _ = block_factors(pieces.column("key").to_numpy(), counts, flat.view(np.uint64)[:, 0])
            at = pa.array(piece)
            start = pieces.column("start").to_numpy()[piece] + first
            columns.append([pieces.column(c).combine_chunks().take(at) for c in ("doc_id", "row_hash")] + [pa.array(start, pa.int32()), pa.array(length + window - 1, pa.int32())])
        whole = [pa.concat_arrays([c[i] for c in columns]) for i in range(4)]
        return pa.RecordBatch.from_arrays(whole, names=["doc_id", "row_hash", "start", "n"])

    held: list[pa.RecordBatch] = []
    waiting = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        waiting += int(batch.column("n").to_numpy().sum())
        if waiting < _BLOCK_WINDOWS:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column("key").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))  # a key's pieces stay together
        if cut:
            yield parsed(table.slice(0, cut))
            held = table.slice(cut).to_batches()
            waiting = int(table.slice(cut).column("n").to_numpy().sum())
    if held:
        yield parsed(pa.Table.from_batches(held))


def dealt_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS, most: int = ANCHOR_WINDOWS) -> DataFrame:
    """(key, doc_id, row_hash, start, n, windows): runs of windows by the key at which equal ones meet; known repeats have no windows."""
    of_id, anchor = docs.schema[doc_id].dataType.simpleString(), min(anchor, window)
    rows = docs.select(F.col(doc_id).alias("doc_id"), storage.row_hash(doc_id, text).alias("row_hash"), F.col(text).cast("string").alias("text"))
    counts = rows.select("text").mapInArrow(lambda batches: _count(batches, window, anchor), "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    crowded = np.array([r.bucket for r in counts.where(F.col("n") > most).collect()], dtype=np.int64)
    held = docs.sparkSession.sparkContext.broadcast(crowded)
    return rows.mapInArrow(
        lambda batches: _send(batches, window, anchor, held.value), f"key bigint, doc_id {of_id}, row_hash binary, start int, n int, windows binary"
    )


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS, most: int = ANCHOR_WINDOWS) -> DataFrame:
    """(doc_id, row_hash, start, n): words [start, start + n) of a document are a factor found elsewhere; factors may overlap."""
    of_id = docs.schema[doc_id].dataType.simpleString()
    blocks = dealt_pieces(docs, doc_id, text, window, anchor, most).repartition("key").sortWithinPartitions("key")
    return blocks.mapInArrow(lambda batches: _parse(batches, window), f"doc_id {of_id}, row_hash binary, start int, n int")


def _joined(texts: Texts, words: Words, keep: np.ndarray) -> pa.Array:
    """Kept words of each row joined by one space."""
    row = np.repeat(np.arange(texts.rows), words.counts)[keep]
    starts, sizes = words.starts[keep], (words.ends - words.starts)[keep]
    last = np.ones(len(row), dtype=bool)
    last[:-1] = row[1:] != row[:-1]
    sizes = sizes + ~last
    ends = np.cumsum(sizes)
    at = np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    data = texts.data[np.minimum(at, max(len(texts.data) - 1, 0))] if len(at) else np.zeros(0, dtype=np.uint8)
    data[ends[~last] - 1] = 32
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, weights=sizes, minlength=texts.rows))]).astype(np.int32)
    return pa.StringArray.from_buffers(texts.rows, pa.py_buffer(offsets), pa.py_buffer(data))


def _remove(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column(2)
        counts = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        flat = spans.flatten()
        start, n = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        for texts in hashing.text_slices(batch.column(1)):
            words = hashing.words_of(texts)
            a, b = bounds[texts.first], bounds[texts.first + texts.rows]
            of = np.repeat(words.bounds[:-1], counts[texts.first : texts.first + texts.rows])
            step = np.zeros(len(words.starts) + 1, dtype=np.int64)
            np.add.at(step, of + start[a:b], 1)
            np.add.at(step, of + start[a:b] + n[a:b], -1)
            keep = np.cumsum(step)[:-1] == 0
            kept = np.bincount(np.repeat(np.arange(texts.rows), words.counts)[keep], minlength=texts.rows)
            rows = batch.column(0).slice(texts.first, texts.rows)
            yield pa.RecordBatch.from_arrays([rows, pa.array(words.counts), pa.array(words.counts - kept), _joined(texts, words, keep)], names=["doc_id", "n_words", "n_removed", "text"])


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS, most: int = ANCHOR_WINDOWS) -> DataFrame:
    """(doc_id, n_words, n_removed, text) per row: the words outside repeated windows, joined by one space."""
    of_id = docs.schema[doc_id].dataType.simpleString()
    spans = repeated_spans(docs, doc_id, text, window, anchor, most)
    # row_hash and id make the join key; a factor sits in one document, so a list is no longer than its text
    lists = spans.groupBy("doc_id", "row_hash").agg(F.collect_set(F.struct("start", "n")).alias("spans")).withColumnsRenamed({"doc_id": "of_doc", "row_hash": "of_row"})
    rows = docs.select(F.col(doc_id).alias("doc_id"), storage.row_hash(doc_id, text).alias("row_hash"), F.col(text).cast("string").alias("text"))
    joined = rows.join(lists, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("row_hash") == F.col("of_row")), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(_remove, f"doc_id {of_id}, n_words bigint, n_removed bigint, text string")
