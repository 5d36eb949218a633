"""Nearest neighbours by a block matrix join: int8 product tiles with error bounds, then floats.

Queries are broadcast in blocks of bounded bytes, and candidates are scanned where they lie: a task
multiplies tiles of both as int8 codes. With v = s*q + r for each vector, the distance of two vectors
differs from that of their codes by at most |r1| + |r2|. A pair whose lower bound exceeds the k-th
smallest upper bound of its query can't be among its k nearest; all others are recomputed in double
precision from the original vectors and kept in one heap per query, which lasts for the whole task.
The best of all tasks are merged per query, where Spark limits each task's share before the shuffle.
The result is exact. Only queries and results are sent anywhere.

Cases: vectors that are NULL, zero, or hold NULL or non-finite components take no part; only vectors
of one length are compared; every row but those with the query's own id is a candidate, repeated rows
each on its own; a repeated query is asked once; finite components may have any size (bounds are taken
of vectors scaled by a power of two, and a distance whose squares overflow or vanish is scaled, too);
ties go to the smaller id; fewer candidates than k give them all; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm import blocks, storage

QUERY_TILE, CANDIDATE_TILE = 256, 4096
#: Vectors are scaled below this power of two, so that squares stay finite.
_TOP_EXPONENT = 400


def shift_of(*vectors: np.ndarray) -> int:
    """Power of two to divide by before coding; 0 for vectors of ordinary size."""
    most = max(float(np.abs(v).max(initial=0.0)) for v in vectors)
    return max(0, int(np.frexp(most)[1]) - _TOP_EXPONENT)


class Codes:
    """int8 codes of vectors over 2^shift, with scales, code norms and residual norms."""

    def __init__(self, vectors: np.ndarray, shift: int = 0):
        self.vectors = vectors
        vectors = np.ldexp(vectors, -shift) if shift else vectors
        self.scale = np.maximum(np.abs(vectors).max(axis=1), np.finfo(np.float64).tiny) / 127
        self.q = np.rint(vectors / self.scale[:, None]).astype(np.int8)
        code = self.q.astype(np.float64) * self.scale[:, None]
        self.norm2 = np.einsum("ij,ij->i", code, code)
        rest = vectors - code
        self.rest = np.sqrt(np.einsum("ij,ij->i", rest, rest))

    def products(self, of: slice, other: Codes, tile: slice) -> np.ndarray:
        # sums of int8 products are exact in float32 below 2^24
        kind = np.float32 if self.q.shape[1] * 127 * 127 < 1 << 24 else np.float64
        return (self.q[of].astype(kind) @ other.q[tile].astype(kind).T).astype(np.float64)


def _plain_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        d = a[:, j] - b[:, j]
        total += d * d
    return np.sqrt(total)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows; components are added in order. Where squares leave the range of doubles, rows are scaled."""
    with np.errstate(over="ignore", under="ignore"):
        out = _plain_distances(a, b)
        for i in np.flatnonzero(~np.isfinite(out) | (out < 1e-140)):
            low, high = np.ldexp(a[i], -2), np.ldexp(b[i], -2)  # a difference of finite numbers may overflow
            exponent = int(np.frexp(np.abs(low - high).max(initial=0.0))[1])
            scaled = np.ldexp(low, -exponent) - np.ldexp(high, -exponent) if exponent > 0 else np.ldexp(low - high, -exponent)
            out[i] = np.ldexp(np.sqrt(np.sum(scaled * scaled)), exponent + 2)
    return out


class Nearest:
    """The k nearest candidates met so far of each query of one length, as heaps of (-distance, -id)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.codes: dict[int, Codes] = {}

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        shift = shift_of(self.vectors, vectors)
        if shift not in self.codes:
            self.codes = {shift: Codes(self.vectors, shift)}
        candidates, queries = Codes(vectors, shift), self.codes[shift]
        for first in range(0, len(self.ids), QUERY_TILE):
            rows = slice(first, first + QUERY_TILE)
            own = self.ids[rows]
            best = np.full((len(own), self.k), np.inf)
            for i, heap in enumerate(self.heaps[rows]):
                best[i, : len(heap)] = np.ldexp([-d for d, _ in heap], -shift)
            for start in range(0, len(ids), CANDIDATE_TILE):
                tile = slice(start, start + CANDIDATE_TILE)
                r, c, best = self._near(rows, queries, tile, candidates, own[:, None] == ids[tile][None, :], best)
                exact = distances(self.vectors[rows][r], vectors[tile][c])
                for row, dist, i in zip(r.tolist(), exact.tolist(), ids[tile][c].tolist(), strict=True):
                    heap, item = self.heaps[first + row], (-dist, -i)
                    if len(heap) < self.k:
                        heapq.heappush(heap, item)
                    elif item > heap[0]:
                        heapq.heapreplace(heap, item)

    def _near(self, rows: slice, queries: Codes, tile: slice, candidates: Codes, same: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs that bounds leave, and the k smallest upper bounds of each query."""
        scales = queries.scale[rows][:, None] * candidates.scale[tile][None, :]
        near2 = queries.norm2[rows][:, None] + candidates.norm2[tile][None, :] - 2 * scales * queries.products(rows, candidates, tile)
        near = np.sqrt(np.maximum(near2, 0))
        # rounding of the expression above, for coordinates of any size
        size = np.sqrt(queries.norm2[rows])[:, None] + np.sqrt(candidates.norm2[tile])[None, :]
        slack = queries.rest[rows][:, None] + candidates.rest[tile][None, :] + 1e-6 * size + 1e-140
        upper = np.where(same, np.inf, near + slack)
        best = np.partition(np.concatenate([best, upper], axis=1), self.k - 1, axis=1)[:, : self.k]
        r, c = np.nonzero((near - slack <= best.max(axis=1)[:, None] * (1 + 1e-9)) & ~same)
        return r, c, best

    def found(self) -> pa.RecordBatch | None:
        rows = [(at, int(q), -i, -d) for at, (q, heap) in enumerate(zip(self.ids, self.heaps, strict=True)) for d, i in heap]
        if not rows:
            return None
        at, q, i, d = zip(*rows, strict=True)
        columns = [pa.array(at, pa.int64()), pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(d, pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=["query", "query_id", "vec_id", "score"])


def _scan(held, k: int):
    def scan(batches):
        block = held.value
        ids, asked = block.column("id").to_numpy(), {}
        number = np.arange(len(ids))
        for size, rows, vectors in blocks.vectors_by_length(block.column("v")):
            asked[size] = (number[rows], Nearest(ids[rows], vectors, k))
        for batch in batches:
            known = batch.column(0).to_numpy(zero_copy_only=False)
            for size, rows, vectors in blocks.vectors_by_length(batch.column(1)):
                if size in asked:
                    asked[size][1].meet(known[rows], vectors)
        for numbers, nearest_of in asked.values():
            found = nearest_of.found()
            if found is not None:
                at = numbers[found.column(0).to_numpy()]
                yield pa.RecordBatch.from_arrays([pa.array(at), *found.columns[1:]], names=found.schema.names)

    return scan


def nearest(candidates: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest candidates of every query."""

    def prepared(df: DataFrame) -> DataFrame:
        v = F.col(vector).cast("array<double>")
        return df.where(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("bigint").alias("id"), v.alias("v")).where(blocks.usable("v"))

    known = prepared(candidates)
    spark = known.sparkSession
    by_query = Window.partitionBy("query").orderBy("score", "vec_id")
    parts = []
    for block in blocks.query_blocks(prepared(queries).distinct(), "v", block_bytes):
        held = spark.sparkContext.broadcast(block)
        found = known.mapInArrow(_scan(held, k), "query bigint, query_id bigint, vec_id bigint, score double")
        ranked = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
        parts.append(storage.written(ranked.select("query_id", "rank", "vec_id", "score"), "nearest"))
        held.destroy()
    return storage.joined_tables(spark, parts, "query_id bigint, rank int, vec_id bigint, score double")
