"""Hard negatives by a vertical scan (BOND) with min/max bounds.

Vectors are coded as integers, floor(256 * x), and compared by inner product. Anchors are broadcast in
blocks of bounded bytes; candidates are scanned where they lie, batch by batch, as columns of one
dimension each. Per anchor, dimensions are read in descending magnitude of the anchor's component. The
partial product of a candidate and the least and most that the dimensions not yet read can add, by the
column's minimum and maximum, bound its score, and candidates that can't count leave the bitmap:

* for positives (same label), those whose upper bound is below the k-th best lower bound, or below the
  k-th best score of earlier batches;
* for negatives (other labels), each positive of an anchor sets a window of scores. A candidate stays
  while its bounds meet a window and its upper bound reaches the k-th best lower bound of those that
  are surely inside it.

Once few are left, or all dimensions are read, scores are exact and windows are settled. The best of all
tasks are merged per anchor, and per anchor and positive. Positives come first, as they set the windows,
so the candidates are scanned twice per block of anchors. Nothing but anchors and results is shuffled,
hence neither a frequent label nor a frequent vector gathers anywhere.

Cases: rows with a NULL id, label or vector, or a NULL or non-finite component take no part; vectors of
different length aren't compared; an anchor's other rows are those with another id; repeated anchors
are one; repeated candidates count each on its own; ties go to the smaller id; a positive of negative
score has an empty window; products are taken as exact integers of any size, and a score that doesn't
fit 64 bits fails; other columns are ignored.
"""

from __future__ import annotations

import copy
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm import blocks, storage

SCALE = 256
#: Dimensions read between two looks at the bounds, and candidates that are few enough to finish.
_STEP, _FEW = 8, 64


class Columns:
    """Coded vectors of one length in order of their label, a row of ``values`` per dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(labels, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.values = np.ascontiguousarray(coded(vectors[order]).T)
        self.low, self.high = self.values.min(axis=1), self.values.max(axis=1)

        self._exact: Columns | None = None

    def exact(self) -> Columns:
        """The same in Python integers."""
        if self.values.dtype == object:
            return self
        if self._exact is None:
            self._exact = copy.copy(self)
            self._exact.values = _whole(self.values)
            self._exact.low, self._exact.high = _whole(self.low), _whole(self.high)
        return self._exact

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, side="right"))


def coded(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x) in doubles, where it is exact; Python integers if products might leave 2^53."""
    codes = np.floor(SCALE * vectors)
    if codes.size and float(np.abs(codes).max()) ** 2 * codes.shape[1] >= 2.0**52:
        whole = [[int(x) * SCALE if abs(x) >= 2.0**60 else int(c) for x, c in zip(v, code, strict=True)] for v, code in zip(vectors, codes, strict=True)]
        codes = np.empty(vectors.shape, dtype=object)
        codes[:] = whole
    return codes


class Best(NamedTuple):
    """The best (score, id) met so far, best first."""

    scores: np.ndarray
    ids: np.ndarray

    def least(self, k: int):
        """Score that a candidate must reach; None while there is room."""
        return self.scores[k - 1] if len(self.scores) >= k else None

    def merged(self, scores: np.ndarray, ids: np.ndarray, k: int) -> Best:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        if len(scores) > k:  # ties of the k-th stay until ids decide
            keep = scores >= _kth(scores, k)
            scores, ids = scores[keep], ids[keep]
        order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k] if scores.dtype == object else np.lexsort((ids, -scores))[:k]
        return Best(scores[order], ids[order])


NOTHING = Best(np.zeros(0), np.zeros(0, dtype=np.int64))


def _kth(scores: np.ndarray, k: int):
    return np.sort(scores)[-k] if scores.dtype == object else np.partition(scores, len(scores) - k)[len(scores) - k]


def vertical_scan(anchor: np.ndarray, columns: Columns, parts: list[tuple[int, int]], stays) -> tuple[np.ndarray, np.ndarray]:
    """Places of candidates in ``parts`` that survive, and their exact scores. ``stays(low, high)`` is the bitmap of those whose bounds may count."""
    alive = np.concatenate([np.arange(a, b) for a, b in parts]) if parts else np.zeros(0, dtype=np.int64)
    order = np.argsort(-np.abs(anchor).astype(np.float64), kind="stable")
    a = anchor[order]
    ends = a * columns.low[order], a * columns.high[order]
    # what the dimensions from each step on can add at least and at most
    least = np.append(np.cumsum(np.minimum(*ends)[::-1])[::-1], 0)
    most = np.append(np.cumsum(np.maximum(*ends)[::-1])[::-1], 0)
    partial = np.zeros(len(alive), dtype=np.result_type(anchor.dtype, columns.values.dtype))
    done, whole = 0, len(alive) == columns.values.shape[1]
    while done < len(order) and len(alive):
        step = len(order) - done if len(alive) <= _FEW else min(_STEP, len(order) - done)
        dims = order[done : done + step]
        read = columns.values[dims] if whole else columns.values[dims[:, None], alive]
        partial = partial + a[done : done + step] @ read
        done += step
        if done < len(order):
            keep = stays(partial + least[done], partial + most[done])
            if not keep.all():
                alive, partial, whole = alive[keep], partial[keep], False
    return alive, partial


def best_positives(anchor: np.ndarray, columns: Columns, own_id: int, label: int, k: int, before: Best) -> Best:
    a, b = columns.of_label(label)
    own = columns.ids[a:b] == own_id
    parts = [(a, b)] if not own.any() else [(a + i, a + j) for i, j in _runs(~own)]
    floor = before.least(k)

    def stays(low, high):
        need = [floor] if floor is not None else []
        if len(low) >= k:
            need.append(_kth(low, k))
        return high >= max(need) if need else np.ones(len(low), dtype=bool)

    at, scores = vertical_scan(anchor, columns, parts, stays)
    return before.merged(scores, columns.ids[at], k)


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def best_negatives(anchor: np.ndarray, columns: Columns, label: int, windows: list[tuple[int, int]], k: int, before: list[Best]) -> list[Best]:
    """Per window (least and greatest score), the best candidates of other labels in it."""
    a, b = columns.of_label(label)
    parts = [(i, j) for i, j in ((0, a), (b, len(columns.ids))) if i < j]
    floors = [w.least(k) for w in before]

    def stays(low, high):
        keep = np.zeros(len(low), dtype=bool)
        for (first, last), floor in zip(windows, floors, strict=True):
            need = first if floor is None else max(first, floor)
            sure = (low >= first) & (high <= last)
            if np.count_nonzero(sure) >= k:
                need = max(need, _kth(low[sure], k))
            keep |= (high >= need) & (low <= last)
        return keep

    at, scores = vertical_scan(anchor, columns, parts, stays)
    out = []
    for (first, last), best in zip(windows, before, strict=True):
        inside = (scores >= first) & (scores <= last)
        out.append(best.merged(scores[inside], columns.ids[at[inside]], k))
    return out


def _same_kind(anchor: np.ndarray, columns: Columns) -> tuple[np.ndarray, Columns]:
    """Both in Python integers if products might leave 2^53."""
    if not anchor.size or (anchor.dtype != object and columns.values.dtype != object and _largest(anchor) * max(_largest(columns.low), _largest(columns.high)) * len(anchor) < 2.0**52):
        return anchor, columns
    return _whole(anchor), columns.exact()


def _largest(values: np.ndarray) -> float:
    return float(np.abs(values).max())


def _whole(values: np.ndarray) -> np.ndarray:
    return values if values.dtype == object else np.vectorize(int, otypes=[object])(values)


def _batches(batches):
    for batch in batches:
        ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for size, rows, vectors in blocks.vectors_by_length(batch.column(2)):
            yield size, Columns(ids[rows], labels[rows], vectors)


def _anchors(block: pa.Table) -> dict[int, list[tuple[int, int, int, np.ndarray]]]:
    """(number, id, label, code) of the anchors of each length."""
    ids, labels = block.column("id").to_numpy(), block.column("label").to_numpy()
    return {
        size: [(int(r), int(ids[r]), int(labels[r]), code) for r, code in zip(rows, coded(vectors), strict=True)]
        for size, rows, vectors in blocks.vectors_by_length(block.column("v"))
    }


def _rows(found, names: list[str]):
    rows = [tuple(map(int, r)) for r in found]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)


def _scan_positives(held, k: int):
    def scan(batches):
        anchors, best = _anchors(held.value), {}
        for size, columns in _batches(batches):
            for number, own, label, code in anchors.get(size, []):
                best[number] = best_positives(*_same_kind(code, columns), own, label, k, best.get(number, NOTHING))
        yield from _rows(((n, i, s) for n, b in best.items() for s, i in zip(b.scores, b.ids, strict=True)), ["anchor", "id", "score"])

    return scan


def _scan_negatives(held, k: int):
    def scan(batches):
        block, windows = held.value
        anchors, best = _anchors(block), {}
        for size, columns in _batches(batches):
            for number, _, label, code in anchors.get(size, []):
                if number in windows:
                    of = [w for _, w in windows[number]]
                    best[number] = best_negatives(*_same_kind(code, columns), label, of, k, best.get(number, [NOTHING] * len(of)))
        rows = (
            (n, place, i, s) for n, all_of in best.items() for (place, _), b in zip(windows[n], all_of, strict=True) for s, i in zip(b.scores, b.ids, strict=True)
        )
        yield from _rows(rows, ["anchor", "place", "id", "score"])

    return scan


def score_window(positive: int, least_percent: int, most_percent: int) -> tuple[int, int]:
    """Least and greatest integer score between both percentages of a positive's."""
    return -(-least_percent * positive // 100), most_percent * positive // 100


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 10, least_percent: int = 30, most_percent: int = 90,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", block_bytes: int = blocks.BLOCK_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows ``anchors`` against ``rows``."""

    def prepared(df: DataFrame) -> DataFrame:
        named = df.select(F.col(vec_id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("v"))
        return named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & blocks.usable("v", zero=True))

    known, spark = prepared(rows), rows.sparkSession
    best = (F.col("score").desc(), "id")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    parts = []
    for block in blocks.query_blocks(prepared(anchors).distinct(), "v", block_bytes):
        held = spark.sparkContext.broadcast(block)
        found = known.mapInArrow(_scan_positives(held, n_positives), "anchor bigint, id bigint, score bigint")
        place = F.row_number().over(Window.partitionBy("anchor").orderBy(*best))
        positives = storage.written(found.withColumn("place", place).where(F.col("place") <= n_positives), "positives")
        # a few per anchor of the block
        ids = block.column("id").to_numpy()
        of, windows = {}, {}
        for r in positives.collect():
            first, last = score_window(r.score, least_percent, most_percent)
            of[r.anchor, r.place] = (int(ids[r.anchor]), r.id, r.score)
            if first <= last:
                windows.setdefault(r.anchor, []).append((r.place, (first, last)))
        wide = spark.sparkContext.broadcast((block, windows))
        held.destroy()
        found = known.mapInArrow(_scan_negatives(wide, n_negatives), "anchor bigint, place bigint, id bigint, score bigint")
        rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*best))
        ranked = found.withColumn("rank", rank).where(F.col("rank") <= n_negatives)
        names = spark.createDataFrame([(a, p, *x) for (a, p), x in of.items()], "anchor bigint, place bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
        out = ranked.join(F.broadcast(names), ["anchor", "place"]).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        parts.append(storage.written(out, "hard-negatives"))
        wide.destroy()
    return storage.joined_tables(spark, parts, schema)
