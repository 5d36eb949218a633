"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words; only the document has a label. Each
passage is described by counts of its bytes and words, encoded by a learned layer, and weighted by
gated attention (tanh and sigmoid branches, softmax over the document); the weighted sum of encodings
gives the score. Encoder, attention and output are trained together, by gradient descent in numpy on
the driver, from a bounded sample: at most ``FIT_DOCS`` labelled documents, half of each class where
there are enough, with all their passages. Scores then cover all passages of all documents in one scan, with the model (a few kilobytes) broadcast.

Cases: a NULL or blank text has no passage and scores the share of label 1; labels that are NULL, or
name no document, are not learned; several labels of one document count as their mean, rounded; with
one class only, or no label, every score is the share of label 1 (0.5 without labels); repeated rows
are scored alike; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import hashing
from tidepool.llm.hashing import Texts

PASSAGE_WORDS = 64
FIT_DOCS = 6000
ENCODED, ATTENTION = 32, 16
EPOCHS, BATCH, RATE, DECAY = 30, 256, 5e-3, 1e-4
_BIGRAM_BINS = 32
_KINDS = np.zeros((256, 6), dtype=np.float32)  # upper, lower, digit, punctuation, beyond ASCII, line end
_KINDS[65:91, 0] = _KINDS[97:123, 1] = _KINDS[48:58, 2] = _KINDS[128:, 4] = _KINDS[10, 5] = 1
_KINDS[[b for b in range(33, 127) if not chr(b).isalnum()], 3] = 1
N_FEATURES = 6 + 6 + _BIGRAM_BINS


class Model(NamedTuple):
    base: float
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None
    shift: float = 0.0


def passages(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of a slice, and the bounds of each row's passages."""
    words = hashing.words_of(texts)
    n = -(-words.counts // PASSAGE_WORDS)
    bounds = np.concatenate([[0], np.cumsum(n)])
    total = int(bounds[-1])
    if not total:
        return np.zeros((0, N_FEATURES), dtype=np.float32), bounds
    row = np.repeat(np.arange(texts.rows), n)
    first = words.bounds[row] + (np.arange(total) - bounds[row]) * PASSAGE_WORDS
    last = np.minimum(first + PASSAGE_WORDS, words.bounds[row + 1])
    count = (last - first).astype(np.float64)
    start, end = words.starts[first], words.ends[last - 1]
    # passages without the blanks between them, one after another
    size = end - start
    ends = np.cumsum(size)
    which = np.repeat(np.arange(total), size)
    data = texts.data[np.repeat(start - (ends - size), size) + np.arange(ends[-1])]
    kinds = np.stack([np.bincount(which, weights=_KINDS[data, j], minlength=total) for j in range(_KINDS.shape[1])], axis=1)
    pair = (data[:-1].astype(np.uint32) << 8 | data[1:]) * np.uint32(2654435761) >> np.uint32(27)
    inner = which[:-1] == which[1:]
    bigrams = np.bincount(which[:-1][inner] * _BIGRAM_BINS + pair[inner], minlength=total * _BIGRAM_BINS).reshape(total, _BIGRAM_BINS)
    length = (words.ends - words.starts).astype(np.float64)
    of_word = np.repeat(np.arange(total), last - first)
    hashes = hashing.word_hashes(texts, words, lower=True)
    sums = np.bincount(of_word, weights=length, minlength=total) / count
    squares = np.bincount(of_word, weights=length * length, minlength=total) / count
    again = np.bincount(of_word[1:], weights=(hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1]), minlength=total)
    distinct = np.diff(hashing.distinct_in_rows(hashing.Windows(hashes, np.append(first, len(hashes)))).bounds)
    marked = np.bincount(of_word, weights=_KINDS[texts.data[words.ends - 1], 3], minlength=total)
    stats = np.stack([np.log1p(count), sums, np.sqrt(np.maximum(squares - sums**2, 0)), again / count, 1 - distinct / count, marked / count], axis=1)
    scale = np.maximum(size, 1)[:, None]
    return np.concatenate([kinds / scale, stats, bigrams / scale], axis=1).astype(np.float32), bounds


def _segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _forward(w: dict[str, np.ndarray], x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Bags of at least one passage each."""
    bag = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    e = x @ w["encode"] + w["encode_bias"]
    h = np.maximum(e, 0)
    t, g = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-(h @ w["gate"])))
    s = (t * g) @ w["attend"]
    a = np.exp(s - np.maximum.reduceat(s, bounds[:-1])[bag])
    a /= np.add.reduceat(a, bounds[:-1])[bag]
    z = np.add.reduceat(a[:, None] * h, bounds[:-1], axis=0)
    return {"bag": bag, "e": e, "h": h, "t": t, "g": g, "a": a, "z": z, "logit": z @ w["out"] + w["out_bias"]}


def _gradient(w: dict[str, np.ndarray], x: np.ndarray, bounds: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the weighted mean log loss of the bags."""
    f = _forward(w, x, bounds)
    d = (1 / (1 + np.exp(-f["logit"])) - y) * weight / len(y)
    of_z = (d[:, None] * w["out"])[f["bag"]]
    of_a = (f["h"] * of_z).sum(axis=1)
    of_s = f["a"] * (of_a - np.add.reduceat(f["a"] * of_a, bounds[:-1])[f["bag"]])
    both = of_s[:, None] * w["attend"]
    of_t, of_g = both * f["g"] * (1 - f["t"] ** 2), both * f["t"] * f["g"] * (1 - f["g"])
    of_h = f["a"][:, None] * of_z + of_t @ w["tanh"].T + of_g @ w["gate"].T
    of_e = of_h * (f["e"] > 0)
    return {
        "out": f["z"].T @ d, "out_bias": d.sum(), "attend": (f["t"] * f["g"]).T @ of_s, "tanh": f["h"].T @ of_t,
        "gate": f["h"].T @ of_g, "encode": x.T @ of_e, "encode_bias": of_e.sum(axis=0),
    }


def train(bags: list[np.ndarray], labels: np.ndarray, base: float, epochs: int = EPOCHS) -> Model:
    """Adam over shuffled batches of bags, from a fixed seed."""
    if not len(bags) or labels.min() == labels.max():
        return Model(base)
    everything = np.concatenate(bags)
    mean, spread = everything.mean(axis=0), everything.std(axis=0) + np.float32(1e-6)
    del everything
    bags = [(b - mean) / spread for b in bags]
    # both classes weigh the same; the shift at the end restores the share that labels have
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    rng = np.random.default_rng(11)
    shapes = {"encode": (N_FEATURES, ENCODED), "tanh": (ENCODED, ATTENTION), "gate": (ENCODED, ATTENTION), "attend": (ATTENTION,), "out": (ENCODED,)}
    w = {k: rng.normal(0, 1 / np.sqrt(shape[0]), shape) for k, shape in shapes.items()} | {"encode_bias": np.zeros(ENCODED), "out_bias": np.zeros(())}
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for a in range(0, len(order), BATCH):
            batch = order[a : a + BATCH]
            bounds = np.concatenate([[0], np.cumsum([len(bags[i]) for i in batch])])
            grad = _gradient(w, np.concatenate([bags[i] for i in batch]).astype(np.float64), bounds, labels[batch], weight[batch])
            step += 1
            for k, d in grad.items():
                d = d + DECAY * w[k]
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                w[k] = w[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(base, mean.astype(np.float64), spread.astype(np.float64), w, float(np.log(base / (1 - base))))


def score_slice(model: Model, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: score, passages, and the passage with the largest weight (-1 without passages)."""
    x, bounds = passages(texts)
    n = np.diff(bounds)
    score, top = np.full(len(n), model.base), np.full(len(n), -1, dtype=np.int64)
    rows = np.flatnonzero(n)
    if len(rows) and model.weights is not None:
        own = np.append(bounds[rows], bounds[-1])
        f = _forward(model.weights, (x - model.mean) / model.spread, own)
        score[rows] = 1 / (1 + np.exp(-np.clip(f["logit"] + model.shift, -40, 40)))
        order = np.lexsort((-f["a"], f["bag"]))
        top[rows] = order[own[:-1]] - own[:-1]
    return score, n, top


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", fit_docs: int = FIT_DOCS) -> Model:
    """Learns from the documents that ``labels`` (doc_id, label) names."""
    marked = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(doc_id).alias("id"))
        .agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    )
    sizes = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    base = sizes.get(1, 0) / total if total else 0.5
    if len(sizes) < 2:
        return Model(base)
    half = fit_docs // 2
    share = {y: max(half, fit_docs - sizes[1 - y]) for y in (0, 1)}
    chosen = [marked.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(share[y]) for y in (0, 1)]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most fit_docs rows of two numbers
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).join(sample, "id").select("id", "y", "text")

    def features(batches):
        for batch in batches:
            for texts in hashing.text_slices(batch.column(2)):
                x, bounds = passages(texts)
                out = [x[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                rows = [batch.column(i).slice(texts.first, texts.rows) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(out, pa.binary())], names=["id", "y", "x"])

    schema = f"id {docs.schema[doc_id].dataType.simpleString()}, y int, x binary"
    # one row per document, whichever repeats
    found = rows.mapInArrow(features, schema).groupBy("id").agg(F.min("y").alias("y"), F.min("x").alias("x")).orderBy("id").collect()
    found = [r for r in found if len(r["x"])]
    bags = [np.frombuffer(bytes(r["x"]), dtype=np.float32).reshape(-1, N_FEATURES) for r in found]
    labels = np.array([r["y"] for r in found], dtype=np.float64)
    del found
    return train(bags, labels, base)


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, n_passages, top_passage) per row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for texts in hashing.text_slices(batch.column(1)):
                score, n, top = score_slice(held.value, texts)
                rows = batch.column(0).slice(texts.first, texts.rows)
                yield pa.RecordBatch.from_arrays([rows, pa.array(score), pa.array(n), pa.array(top)], names=["doc_id", "score", "n_passages", "top_passage"])

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, score double, n_passages bigint, top_passage bigint"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more."""
    held, column = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches):
        for batch in batches:
            scores = [score_slice(held.value, texts)[0] for texts in hashing.text_slices(batch.column(column))]
            yield batch.filter(pa.array(np.concatenate(scores) >= threshold)) if scores else batch

    return docs.mapInArrow(run, docs.schema)
