"""Joins of facts to dimensions that hold with large dimensions and hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators.slicing import measured_bytes

BROADCAST_BYTES = 64 << 20
SALTS = 32


def dimension_join(
    fact: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Left join of ``fact`` to ``dimension`` on equally named columns.

    A dimension whose measured size is within ``broadcast_bytes`` is broadcast.
    A larger one is joined on key and salt: fact rows are spread over ``salts``
    by a hash of the ``spread`` columns (stable when a task is run again) and each
    dimension row is present once per salt, so one hot key spans many tasks. The copies
    are merged, as Spark's estimate leaves out their number and would broadcast them all.
    """
    on = list(on)
    if broadcast_bytes >= 0 and measured_bytes(dimension) <= broadcast_bytes:
        return fact.join(F.broadcast(dimension), on, "left")
    salted = fact.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    copies = dimension.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), [*on, "__salt"], "left").drop("__salt")


def two_role_join(
    fact: DataFrame,
    dimension: DataFrame,
    roles: dict[str, str],
    key: str,
    spread: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Left join the same dimension once per role.

    ``roles`` maps an output struct column to the fact column holding its key; the
    struct is NULL where the key is unknown.
    """
    fields = dimension.columns
    for role, column in roles.items():
        side = dimension.select(F.col(key).alias(column), F.struct(*fields).alias(role))
        fact = dimension_join(fact, side, [column], spread, broadcast_bytes, salts)
    return fact


def frame_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows, with multiplicity, in one frame only; empty when both hold the same rows."""
    right = right.select(*left.columns)
    return (
        left.exceptAll(right)
        .withColumn("side", F.lit("left"))
        .unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))
    )
