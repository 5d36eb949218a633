"""Spreading small inputs over the cores before per-row Python work."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators.slicing import measured_bytes, plan_bytes

ENOUGH_BYTES = 8 << 20  # per core: larger inputs come in enough splits of their own
PIECE_BYTES = 256 << 10
TASK_BYTES = 4 << 20  # of stored columns that one task takes where rows grow large in memory


def balanced(df: DataFrame) -> DataFrame:
    """Repartition a frame too small to be split over all cores by its scan or last shuffle.

    Big-integer functions cost microseconds per row, so a few megabytes in one split
    keep one core busy while the others wait. Inputs of some size are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = plan_bytes(df)
    if size is None or size >= cores * ENOUGH_BYTES:
        return df
    pieces = min(cores, math.ceil(size / PIECE_BYTES))
    return df.repartition(pieces) if pieces > 1 else df


def pieces(df: DataFrame) -> int:
    """Parts into which to deal a frame whose rows grow large in memory, so that a task's share does not grow with it."""
    size = plan_bytes(df)
    if size is None:
        size = measured_bytes(df)
    return max(1, math.ceil(size / TASK_BYTES))


def in_pieces(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt out by hash of ``keys`` into such parts, if they are more than the cores; a small frame stays."""
    many = pieces(df)
    return df.repartition(many, F.xxhash64(*keys)) if many > df.sparkSession.sparkContext.defaultParallelism else df
