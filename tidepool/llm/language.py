"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of the n-grams of each language come from a bounded, hash-chosen sample of labelled rows
(``FIT_DOCS`` per language, about) and are summed by Spark; the log-probability matrix, buckets by
languages, is broadcast after a check of its size. Scoring is one scan: every n-gram of a whole text
picks its row of the matrix, and rows are added up per document in numpy.

Cases: a NULL text or one without a letter is ``und`` with score 0, as is every text if there is
nothing to learn from; NULL labels are not learned; among equal scores the first language by name
wins; repeated rows are scored alike; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import hashing

ORDERS = (1, 2, 3)
BUCKET_BITS = 16
#: Labelled rows per language that the counts are taken from, about.
FIT_DOCS = 4000
SMOOTHING = 0.1
#: Largest broadcast matrix; more languages than fit are an error, never dropped.
MATRIX_BYTES = 256 << 20
UNKNOWN = "und"
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


class Model(NamedTuple):
    languages: list[str]
    prior: np.ndarray  # log, by language
    matrix: np.ndarray  # log probability, buckets x languages


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def ngram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams with a letter, their rows in ascending order, and which rows have a letter.

    Letters count in lower case; everything else reads as one blank.
    """
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    letter = _letters()[codes]
    values = np.where(letter, codes, 32).astype(np.uint64)
    buckets, rows = [], []
    for n in ORDERS:
        size = max(len(values) - n + 1, 0)
        h, any_letter = np.full(size, n, dtype=np.uint64), np.zeros(size, dtype=bool)
        for j in range(n):
            h += values[j : j + size] * _FACTORS[j]
            any_letter |= letter[j : j + size]
        keep = any_letter & (row[:size] == row[n - 1 : n - 1 + size])
        buckets.append((hashing.mixed(h[keep]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
        rows.append(row[:size][keep])
    at, of = np.concatenate(buckets), np.concatenate(rows)
    order = np.argsort(of, kind="stable")
    has = np.zeros(len(texts), dtype=bool)
    has[row[letter]] = True
    return at[order], of[order], has


def _count(batches):
    for batch in batches:
        languages = batch.column(1).to_pylist()
        for texts in hashing.text_slices(batch.column(0)):
            names = languages[texts.first : texts.first + texts.rows]
            known = sorted(set(names))
            buckets, rows, _ = ngram_buckets([texts.text(i) for i in range(texts.rows)])
            which = np.array([known.index(x) for x in names], dtype=np.int64)[rows]
            keys, n = np.unique(which << BUCKET_BITS | buckets, return_counts=True)
            name = pa.array(known).take(pa.array(keys >> BUCKET_BITS))
            yield pa.RecordBatch.from_arrays([name, pa.array(keys & ((1 << BUCKET_BITS) - 1)), pa.array(n)], names=["lang", "bucket", "n"])


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", fit_docs: int = FIT_DOCS) -> Model:
    """Learns from rows with text and label; the sample is chosen by a hash of id and text."""
    rows = labelled.select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"), F.xxhash64(doc_id, text).alias("at")
    ).where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()}
    languages = sorted(sizes)
    if len(languages) * 4 << BUCKET_BITS > MATRIX_BYTES:
        raise ValueError(f"{len(languages)} languages do not fit a broadcast matrix of {MATRIX_BYTES} bytes")
    counts = np.full((1 << BUCKET_BITS, len(languages)), SMOOTHING)
    if languages:
        share = F.lit(1.0)
        for name, n in sizes.items():
            if n > fit_docs:
                share = F.when(F.col("lang") == name, F.lit(fit_docs / n)).otherwise(share)
        sample = rows.where(F.pmod("at", F.lit(1 << 30)) < share * float(1 << 30)).select("text", "lang")
        sums = sample.mapInArrow(_count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        table = sums.toArrow()
        column = {name: i for i, name in enumerate(languages)}
        at = [column[x] for x in table.column("lang").to_pylist()]
        counts[table.column("bucket").to_numpy(), at] += table.column("n").to_numpy()
    total = max(1, sum(sizes.values()))
    prior = np.log(np.array([sizes[x] / total for x in languages], dtype=np.float64))
    return Model(languages, prior, np.log(counts / counts.sum(axis=0)).astype(np.float32))


def score_texts(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Posterior by row and language, and which rows have a letter."""
    buckets, rows, has = ngram_buckets(texts)
    scores = np.tile(model.prior, (len(texts), 1))
    step = max(4096, (8 << 20) // max(1, len(model.languages)))
    for a in range(0, len(buckets), step):
        part = rows[a : a + step]
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        scores[part[starts]] += np.add.reduceat(model.matrix[buckets[a : a + step]], starts, axis=0, dtype=np.float64)
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True), has


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) per row; score is the posterior of the predicted language."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for texts in hashing.text_slices(batch.column(1)):
                names, best = np.full(texts.rows, UNKNOWN, dtype=object), np.zeros(texts.rows)
                if held.value.languages:
                    posterior, has = score_texts(held.value, [texts.text(i) for i in range(texts.rows)])
                    top = posterior.argmax(axis=1)
                    names[has] = np.array(held.value.languages, dtype=object)[top[has]]
                    best[has] = posterior.max(axis=1)[has]
                rows = batch.column(0).slice(texts.first, texts.rows)
                yield pa.RecordBatch.from_arrays([rows, pa.array(names, pa.string()), pa.array(best)], names=["doc_id", "lang_pred", "score"])

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, lang_pred string, score double"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
