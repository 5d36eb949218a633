"""Queries in blocks of bounded bytes, each broadcast while candidates are scanned where they lie."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm import storage

#: Bytes of query vectors, in double precision, that a broadcast holds.
BLOCK_BYTES = 16 << 20


def usable(vector: str, zero: bool = False) -> Column:
    """Condition on rows whose vector takes part; ``zero`` ones, too."""
    v = F.col(vector)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & sound & (F.lit(True) if zero else F.exists(v, lambda x: x != 0)), F.lit(False))


def query_blocks(queries: DataFrame, vector: str, block_bytes: int) -> Iterator[pa.Table]:
    """The rows of ``queries``, which are distinct, dealt by hash into blocks of about ``block_bytes``; none if there are none."""
    kept = storage.written(queries.withColumn("block_key", F.xxhash64(*queries.columns)), "queries")
    total = kept.agg(F.sum(F.size(vector) + 4)).first()[0] or 0
    n = math.ceil(total * 8 / block_bytes)
    for i in range(n):
        yield kept.where(F.pmod("block_key", F.lit(n)) == i).drop("block_key").toArrow().combine_chunks()


def vectors_by_length(lists: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, vectors) of a list column, which holds no NULL, for each length."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield size, rows, flat[starts[rows][:, None] + np.arange(size)].reshape(len(rows), size)
