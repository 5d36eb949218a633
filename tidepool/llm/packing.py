"""Lexical retrieval packing: windows filled with the nearest unused documents by BM25.

Texts are encoded once and written as token lists, each with an end id. A document's whole windows go
out as they are; what is left of it, shorter than a window, is packed. Terms are token ids, and their
document frequencies are counted over all documents; the table's size is that of the vocabulary.

The inverted index is sharded. Rests are dealt by range of their leading terms (those with the greatest
BM25 weights), so that documents on one matter come to one shard; rests with the same leading terms,
however many, are split by their place in the token files. A shard holds about ``SHARD_TOKENS`` tokens:
it indexes its rests by term, and takes the next unused one as the seed of a window. The seed's terms are
looked up, scores of unused rests are summed, and in order of score those that fit are put in whole;
then the best that doesn't fit is cut so that the window is full. The cut rest is the next seed. Once
half of the index is used, the rest is indexed anew. The last window of a shard, which may not become
full, is cut into windows whose sizes are powers of two, so that nothing is padded.

Cases: a NULL or empty text has only its end id; repeated rows and rows that share an id, NULL ids among
them, are documents of their own; ties of scores go to the rest that comes first; an empty table gives
no pieces; other columns are not read. Every id of a document lies in exactly one piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import hashing, storage, wordpieces

WINDOW, END_ID = 4096, 2
SHARD_TOKENS = 1 << 20
#: Tokens dealt to a task.
TASK_TOKENS = 1 << 24
K1, B = 1.2, 0.75
#: Rests that aren't worth a new index.
_FEW = 64


class Statistics(NamedTuple):
    """Weight of each term by its document frequency, and the mean length of a document."""

    idf: np.ndarray
    mean_length: float


class Terms(NamedTuple):
    """Distinct terms of each document in order, with their counts."""

    doc: np.ndarray
    term: np.ndarray
    count: np.ndarray


def terms_of(lists: list[np.ndarray]) -> Terms:
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    flat = np.concatenate(lists) if lists else np.zeros(0, dtype=np.uint32)
    keys = np.sort(np.repeat(np.arange(len(lists), dtype=np.uint64), sizes) << np.uint64(32) | flat.astype(np.uint64))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    count = np.diff(np.append(first, len(keys)))
    return Terms((keys[first] >> np.uint64(32)).astype(np.int64), (keys[first] & np.uint64(0xFFFFFFFF)).astype(np.int64), count)


def bm25_weights(terms: Terms, lengths: np.ndarray, statistics: Statistics) -> np.ndarray:
    """What each term of a document adds to its score when asked for."""
    norm = K1 * (1 - B + B * lengths / statistics.mean_length)
    return statistics.idf[terms.term] * terms.count * (K1 + 1) / (terms.count + norm[terms.doc])


class Index:
    """Inverted index of documents: postings (document, weight) by term."""

    def __init__(self, lists: list[np.ndarray], statistics: Statistics):
        self.n = len(lists)
        lengths = np.fromiter(map(len, lists), dtype=np.float64, count=len(lists))
        terms = terms_of(lists)
        self.asked, self.ask_bounds = terms.term, np.searchsorted(terms.doc, np.arange(self.n + 1))
        order = np.argsort(terms.term, kind="stable")
        self.docs = terms.doc[order].astype(np.int32)
        self.weights = bm25_weights(terms, lengths, statistics)[order]
        self.bounds = np.searchsorted(terms.term[order], np.arange(len(statistics.idf) + 1))

    def scores(self, doc: int) -> np.ndarray:
        """Score of every document for the terms of one of them."""
        asked = self.asked[self.ask_bounds[doc] : self.ask_bounds[doc + 1]]
        first, n = self.bounds[asked], self.bounds[asked + 1] - self.bounds[asked]
        ends = np.cumsum(n)
        at = np.repeat(first - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        return np.bincount(self.docs[at], weights=self.weights[at], minlength=self.n)


class Piece(NamedTuple):
    """Ids [start, start + length) of a document, at ``offset`` of a sequence."""

    doc: int
    start: int
    length: int
    sequence: int
    offset: int


def _power_windows(filled: list[tuple[int, int, int]], sequence: int) -> Iterator[Piece]:
    """The pieces (document, start, length) of a window that isn't full, cut into windows of powers of two."""
    left = sum(n for _, _, n in filled)
    room, offset = 0, 0
    for doc, start, length in filled:
        while length:
            if not room:
                room, offset, sequence = 1 << (left.bit_length() - 1), 0, sequence + 1
                left -= room
            n = min(room, length)
            yield Piece(doc, start, n, sequence - 1, offset)
            start, length, room, offset = start + n, length - n, room - n, offset + n


def pack(lists: list[np.ndarray], statistics: Statistics, window: int = WINDOW, first_sequence: int = 0) -> Iterator[Piece]:
    """Pieces of all documents of a shard; sequences are numbered from ``first_sequence``."""
    sequence = first_sequence
    start = np.zeros(len(lists), dtype=np.int64)
    for doc, ids in enumerate(lists):
        for at in range(0, len(ids) - window + 1, window):
            yield Piece(doc, at, window, sequence, 0)
            sequence += 1
        start[doc] = len(ids) // window * window
    names = np.array([d for d, ids in enumerate(lists) if len(ids) > start[d]], dtype=np.int64)
    while len(names):  # an index serves until half of its rests are used
        rests = [lists[d][start[d] :] for d in names]
        index, left = Index(rests, statistics), np.fromiter(map(len, rests), dtype=np.int64, count=len(rests))
        n_left, pointer, cut = len(names), 0, -1
        while n_left and (2 * n_left > len(names) or n_left < _FEW):
            while not left[pointer]:
                pointer += 1
            at = seed = cut if cut >= 0 else pointer
            filled, free, ranked = [], window, None
            while True:
                doc, n = int(names[at]), min(int(left[at]), free)
                filled.append((doc, int(start[doc]), n))
                start[doc] += n
                left[at] -= n
                free -= n
                n_left -= not left[at]
                if not free or not n_left:
                    break
                ranked = np.argsort(-index.scores(seed), kind="stable") if ranked is None else ranked
                ranked = ranked[left[ranked] > 0]
                fits = np.flatnonzero(left[ranked] <= free)
                at = int(ranked[fits[0] if len(fits) else 0])
            cut = at if left[at] else -1
            if free:
                yield from _power_windows(filled, sequence)
                sequence += sum(n for _, _, n in filled).bit_count()
                continue
            offset = 0
            for doc, begin, n in filled:
                yield Piece(doc, begin, n, sequence, offset)
                offset += n
            sequence += 1
        order = np.flatnonzero(left)
        if cut >= 0:  # goes first
            order = np.concatenate([[cut], order[order != cut]])
        names = names[order]


def token_lists(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """(doc_id, n_tokens, ids): every text's ids and its end id, as little-endian numbers of two bytes, or four if the vocabulary is larger."""
    kind = id_kind(path)
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_tokens bigint, ids binary"

    def encode(batches):
        encoder = wordpieces.worker_encoder(path)
        for batch in batches:
            for texts in hashing.text_slices(batch.column(1)):
                ids, bounds = encoder.ids(texts)
                flat = np.insert(ids, bounds[1:], end_id).astype(kind)
                bounds = bounds + np.arange(len(bounds))
                ends = pa.py_buffer((bounds * kind.itemsize).astype(np.int32))
                lists = pa.BinaryArray.from_buffers(pa.binary(), texts.rows, [None, ends, pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(texts.first, texts.rows), pa.array(np.diff(bounds)), lists], names=["doc_id", "n_tokens", "ids"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(encode, schema)


def id_kind(path: str) -> np.dtype:
    return np.dtype("<u2" if len(wordpieces.pieces(path)) <= 1 << 16 else "<u4")


def _lists(column: pa.Array, kind: np.dtype) -> list[np.ndarray]:
    return [np.frombuffer(b.as_buffer(), dtype=kind) for b in column]


def _blocks(lists: list[np.ndarray], most: int) -> Iterator[slice]:
    """Runs of lists with about ``most`` ids."""
    first = n = 0
    for i, ids in enumerate(lists):
        n += len(ids)
        if n >= most:
            yield slice(first, i + 1)
            first, n = i + 1, 0
    if first < len(lists):
        yield slice(first, len(lists))


def statistics_of(tokens: DataFrame, path: str) -> Statistics:
    """Document frequency of each term over all documents, and their mean length."""
    kind, size = id_kind(path), len(wordpieces.pieces(path))

    def count(batches):
        found, docs, total = np.zeros(size, dtype=np.int64), 0, 0
        for batch in batches:
            lists = _lists(batch.column(0), kind)
            docs, total = docs + len(lists), total + sum(map(len, lists))
            for part in _blocks(lists, 1 << 18):
                found += np.bincount(terms_of(lists[part]).term, minlength=size)
        terms = np.flatnonzero(found)
        columns = [np.append(terms, [size, size + 1]), np.append(found[terms], [docs, total])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["term", "n"])

    counts = np.zeros(size + 2, dtype=np.float64)
    for r in tokens.select("ids").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[r.term] = r.n
    n, total = counts[size], counts[size + 1]
    return Statistics(np.log1p((n - counts[:size] + 0.5) / (counts[:size] + 0.5)), max(1.0, total / max(1.0, n)))


def _with_leading_terms(held, kind: np.dtype):
    """Adds the two terms of greatest weight as one number."""

    def lead(batches):
        for batch in batches:
            lists = _lists(batch.column(1), kind)
            for part in _blocks(lists, 1 << 18):
                some = lists[part]
                terms = terms_of(some)
                weights = bm25_weights(terms, np.fromiter(map(len, some), dtype=np.float64, count=len(some)), held.value)
                order = np.lexsort((terms.term, -weights, terms.doc))
                first = np.searchsorted(terms.doc, np.arange(len(some)))
                n = np.diff(np.append(first, len(terms.doc)))
                one = terms.term[order[first]]
                two = np.where(n > 1, terms.term[order[first + np.minimum(1, n - 1)]], 0)
                rows = batch.slice(part.start, len(some))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(one << 32 | two)], names=["doc_id", "ids", "row", "lead"])

    return lead


def _packed(held, kind: np.dtype, window: int, shard_tokens: int):
    def shard(ids: list, lists: list[np.ndarray], of_id: pa.DataType, first: int):
        found = list(pack(lists, held.value, window, first))
        wide = [lists[p.doc][p.start : p.start + p.length].astype("<u4").tobytes() for p in found]
        doc, start, length, sequence, offset = (np.array(c, dtype=np.int64) for c in zip(*found, strict=True))
        of_doc = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))[doc]
        names = pa.array(ids, of_id).take(pa.array(doc))
        columns = [names, *(pa.array(c) for c in (start, length, of_doc, sequence, offset)), pa.array(wide, pa.binary())]
        for a in range(0, len(found), 512):  # some megabytes a batch
            yield pa.RecordBatch.from_arrays([c.slice(a, 512) for c in columns], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    def run(batches):
        ids, lists, n, of_id = [], [], 0, None
        sequence = TaskContext.get().partitionId() << 32
        for batch in batches:
            of_id = batch.column(0).type
            for name, own in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(own.as_py(), dtype=kind)
                ids.append(name)
                lists.append(own)
                n += len(own)
                if n >= shard_tokens:
                    for out in shard(ids, lists, of_id, sequence):
                        yield out
                        sequence = max(sequence, out.column(4)[-1].as_py() + 1)
                    ids, lists, n = [], [], 0
        if lists:
            yield from shard(ids, lists, of_id, sequence)

    return run


def packed(
    docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text",
    shard_tokens: int = SHARD_TOKENS, task_tokens: int = TASK_TOKENS,
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids) per piece; ids as little-endian numbers of four bytes."""
    spark, kind = docs.sparkSession, id_kind(path)
    of_id = docs.schema[doc_id].dataType.simpleString()
    tokens = storage.written(token_lists(docs, path, doc_id, text, end_id), "token-lists")
    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    held = spark.sparkContext.broadcast(statistics_of(tokens, path))
    rows = tokens.select("doc_id", "ids", F.col("_metadata.row_index").alias("row"))
    led = rows.mapInArrow(_with_leading_terms(held, kind), f"doc_id {of_id}, ids binary, row bigint, lead bigint")
    # the row's place in its file parts equal rows, too
    dealt = led.repartitionByRange(1 + total // task_tokens, "lead", "row", "doc_id").sortWithinPartitions("lead", "row", "doc_id", "ids")
    out = dealt.select("doc_id", "ids").mapInArrow(
        _packed(held, kind, window, shard_tokens), f"doc_id {of_id}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    )
    return out
