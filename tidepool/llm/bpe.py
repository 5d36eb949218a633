"""BPE encoding and decoding with a table of distinct words.

A text is split into words, and plain words into the parts that the vocabulary never merges across
(``wordpieces.parts_of``), so the ids of a text are those of its parts in order; parts are the words
below. Each distinct word is encoded once, in a table, and its ids are joined back by position:

* frequent words: the distinct words of a sample of bounded size (``HEAD_BYTES`` of text, chosen by
  hash) are encoded in one table, which is broadcast. Which words it holds is a matter of speed only;
* all other words are rare, and most stand in one place. With ``rare="local"`` they are encoded where
  they lie, each once by a worker, and nothing is shuffled. With ``rare="join"`` each is encoded once
  in all: documents ask for their words, the distinct ones are encoded in one table, a shuffle join on
  the word answers, and answers meet the compressed texts. That costs a shuffle of about twice the
  input's size to save encoding some words again; results are the same.

Decoding joins ids with the pieces of the vocabulary, a table whose size the vocabulary fixes, and
puts one blank between pieces, as the library does for a vocabulary without decoder.

Cases: a NULL or empty text has no ids and decodes to the empty text; rows that share an id and
repeated rows are encoded each on its own; NULL ids of documents are kept; in decoding, NULL lists
give the empty text and numbers without a piece are left out; other columns are ignored.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm import hashing, storage, wordpieces
from tidepool.llm.hashing import Texts, Words
from tidepool.llm.wordpieces import WordTable

HEAD_BYTES = 32 << 20
#: Longer texts are left out of the sample, so that its size keeps to the bound.
_HEAD_TEXT = 1 << 20
_SEEN = 2_000_000
#: Rows, and ids, that a worker unpacks at a time.
_ROWS, _IDS = 256, 1 << 18
#: Rare words that a worker remembers; few of them come back.
_RARE_WORDS = 200_000


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), storage.row_hash(doc_id, text).alias("row_hash"), F.col(text).cast("string").alias("text"))


def _distinct_words(batches):
    """Words of a task, each mostly once: words seen in an earlier slice are not repeated."""
    seen = np.zeros(0, dtype=np.uint64)
    for batch in batches:
        for texts in hashing.text_slices(batch.column(0)):
            own, words, _ = wordpieces.parts_of(texts)
            distinct, index = np.unique(hashing.word_hashes(own, words), return_index=True)
            new = ~np.isin(distinct, seen, assume_unique=True)
            seen = np.union1d(seen, distinct[new]) if len(seen) < _SEEN else distinct
            index = index[new]
            yield pa.RecordBatch.from_arrays([wordpieces.word_array(own, Words(words.starts[index], words.ends[index], words.bounds))], names=["word"])


def word_table(words: DataFrame, path: str) -> DataFrame:
    """(word, ids) of each distinct word."""

    def encode(batches):
        for batch in batches:
            flat, n = wordpieces.flat_lists(wordpieces.encode_words(path, batch.column(0).to_pylist()))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["word", "ids"])

    return words.select("word").distinct().mapInArrow(encode, "word string, ids array<int>")


def head_of(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", head_bytes: int = HEAD_BYTES) -> WordTable:
    """Table of the words of a sample of about ``head_bytes`` of text."""
    rows = _rows(docs, doc_id, text).where(F.octet_length("text") <= _HEAD_TEXT)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    share = 1.0 if total <= head_bytes else head_bytes / total
    sample = rows.where(F.pmod(F.xxhash64("row_hash"), F.lit(1 << 30)) < share * float(1 << 30)).select("text")

    def hashed(batches):
        for batch in batches:  # one row for all words of a slice: the driver gets few and small values
            for texts in hashing.text_slices(batch.column(0)):
                words = Words(texts.offsets[:-1], texts.offsets[1:], np.arange(texts.rows + 1))  # a row is one word
                lists = batch.column(1).slice(texts.first, texts.rows)
                columns = (
                    *hashing.word_hash_pair(texts, words),
                    lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32),  # one word may have more than 65,535
                    lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32),
                )
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], names=["one", "two", "n", "ids"])

    table = word_table(sample.mapInArrow(_distinct_words, "word string"), path).mapInArrow(hashed, "one binary, two binary, n binary, ids binary")
    found = table.collect()
    one, two, lengths, ids = (
        np.frombuffer(b"".join(r[i] for r in found), dtype=t) for i, t in enumerate((np.uint64, np.uint64, np.int32, np.int32))
    )
    del found
    table = WordTable(len(one))
    table.learn(one, two, ids, lengths)
    return table.compact()


class Split(NamedTuple):
    """Distinct words of a slice: where each first stands, each position's word, and its place in the head (-1: none)."""

    texts: Texts
    words: Words
    index: np.ndarray
    inverse: np.ndarray
    at: np.ndarray


def split_words(head: WordTable, texts: Texts) -> Split:
    own, words, _ = wordpieces.parts_of(texts)
    hashes, others = hashing.word_hash_pair(own, words)
    _, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    at = head.find(hashes[index], others[index])
    return Split(own, words, index, inverse, at)


def _asked(texts: Texts, split: Split) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word, number within the row) of all words that rows of a slice ask for."""
    row = np.repeat(np.arange(texts.rows), split.words.counts)
    missing = split.at[split.inverse] < 0
    keys = np.unique(row[missing].astype(np.int64) << 32 | split.inverse[missing])
    rows, words = keys >> 32, keys & 0xFFFFFFFF
    number = np.arange(len(keys)) - np.searchsorted(rows, rows)
    return rows, words, number


@lru_cache(maxsize=1)
def _head_encoder(head: WordTable, path: str) -> wordpieces.WordEncoder:
    """The worker's encoder for words that the head lacks; one for all tasks of a broadcast."""
    return wordpieces.WordEncoder(path, _RARE_WORDS, head)


def _encode_locally(held, path: str):
    def encode(batches):
        encoder = _head_encoder(held.value, path)
        for batch in batches:
            for texts in hashing.text_slices(batch.column(1)):
                ids, ends = encoder.ids(texts)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(texts.first, texts.rows), lists], names=["doc_id", "ids"])

    return encode


def _in_parts(batches):
    for batch in batches:
        for first in range(0, batch.num_rows, _ROWS):
            yield batch.slice(first, _ROWS)


def encoded(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", head: WordTable | None = None, rare: str = "local") -> DataFrame:
    """(doc_id, ids) per row: the ids of its whole text."""
    if rare not in ("local", "join"):
        raise ValueError(f"rare words by {rare!r}")
    spark, of_id = docs.sparkSession, docs.schema[doc_id].dataType.simpleString()
    held = spark.sparkContext.broadcast(head if head is not None else head_of(docs, path, doc_id, text))
    rows = _rows(docs, doc_id, text)
    if rare == "local":
        return rows.select("doc_id", "text").mapInArrow(_encode_locally(held, path), f"doc_id {of_id}, ids array<int>")

    def ask(batches):
        for batch in batches:
            for texts in hashing.text_slices(batch.column(2)):
                split = split_words(held.value, texts)
                row, word, number = _asked(texts, split)
                at = split.index[word]
                names = wordpieces.word_array(split.texts, Words(split.words.starts[at], split.words.ends[at], split.words.bounds))
                where = pa.array(row + texts.first)
                columns = [names, batch.column(0).take(where), batch.column(1).take(where), pa.array(number, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "doc_id", "row_hash", "number"])

    asked = rows.mapInArrow(ask, f"word string, doc_id {of_id}, row_hash binary, number int")

    def shorten(batches):
        for batch in batches:  # ids as bytes: a third of the shuffle
            lists = batch.column(1)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int32) * 4
            flat = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), dtype="<i4")
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["word", "ids"])

    answers = asked.join(word_table(asked, path).mapInArrow(shorten, "word string, ids binary"), "word")
    lists = (
        answers.groupBy("doc_id", "row_hash")
        .agg(F.collect_set(F.struct("number", "ids")).alias("answers"))
        .withColumnsRenamed({"doc_id": "of_doc", "row_hash": "of_row"})
    )

    def pack(batches):
        for batch in _in_parts(batches):
            packed = [None if t is None else zlib.compress(t.encode(), 3) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc_id", "row_hash", "packed"])

    packed = rows.mapInArrow(pack, f"doc_id {of_id}, row_hash binary, packed binary")
    joined = packed.join(lists, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("row_hash") == F.col("of_row")), "left")

    def place(batches):
        head = held.value
        for batch in _in_parts(batches):
            plain = [b"" if t is None else zlib.decompress(t) for t in batch.column(1).to_pylist()]
            answers = batch.column(2)
            counts = answers.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            flat = answers.flatten()
            numbers = flat.field(0).to_numpy(zero_copy_only=False)
            lengths = pc.binary_length(flat.field(1)).to_numpy(zero_copy_only=False).astype(np.int64) // 4
            values = np.frombuffer(b"".join(flat.field(1).to_pylist()), dtype="<i4")
            starts = np.cumsum(lengths) - lengths
            for texts in hashing.text_slices(pa.array(plain, pa.binary()).cast(pa.large_binary()).view(pa.large_string())):
                split = split_words(held.value, texts)
                row, word, number = _asked(texts, split)
                a, b = bounds[texts.first], bounds[texts.first + texts.rows]
                of = np.repeat(np.arange(texts.rows), counts[texts.first : texts.first + texts.rows])
                order = np.lexsort((numbers[a:b], of))
                if b - a != len(row) or (of[order] != row).any() or (numbers[a:b][order] != number).any():
                    raise ValueError("a document got other words than it asked for")
                # positions of asked words point behind the head's lists
                which = split.at[split.inverse]
                lack = np.flatnonzero(which < 0)
                in_row = np.repeat(np.arange(texts.rows), split.words.counts)[lack]
                used, which = np.unique(which, return_inverse=True)
                used = used[used >= 0]
                which -= 1 if len(lack) else 0
                which[lack] = len(used) + np.searchsorted(row << 32 | word, in_row << 32 | split.inverse[lack])
                near, size = head.ids(used)
                ids = np.concatenate([near.astype(np.int32), values])
                begin = np.concatenate([np.cumsum(size) - size, len(near) + starts[a:b][order]])
                out, n = wordpieces.gathered(ids, begin, np.concatenate([size, lengths[a:b][order]]), which)
                ends = np.concatenate([[0], np.cumsum(n)])[split.words.bounds]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(texts.first, texts.rows), lists], names=["doc_id", "ids"])

    return joined.select("doc_id", "packed", "answers").mapInArrow(place, f"doc_id {of_id}, ids array<int>")


def decoded(tokens: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``tokens`` with the decoded text of each list of ids."""
    schema = T.StructType([*tokens.schema.fields, T.StructField(into, T.StringType())])
    held = tokens.sparkSession.sparkContext.broadcast(wordpieces.pieces(path))
    column = tokens.columns.index(ids)

    def join(batches):
        table = pa.array(held.value, pa.string())
        for batch in batches:
            counts = batch.column(column).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends, first = np.cumsum(counts), 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + _IDS, side="right")))
                part = batch.slice(first, last - first)
                flat = part.column(column).flatten().to_numpy(zero_copy_only=False)
                known = (flat >= 0) & (flat < len(table))
                row = np.repeat(np.arange(part.num_rows), counts[first:last])[known]
                bounds = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=part.num_rows))])
                names = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), table.take(pa.array(flat[known])))
                yield pa.RecordBatch.from_arrays([*part.columns, pc.binary_join(names, " ")], names=schema.names)
                first = last

    return tokens.mapInArrow(join, schema)

