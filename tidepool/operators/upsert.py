"""Upsert: update what matches, insert the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(batch: DataFrame, keys: Sequence[str], sequence: str | None = None) -> DataFrame:
    """One row per key: the one with the highest ``sequence``, kept by a partial aggregate.

    Without ``sequence`` a second row of a key is an error: which one is newer can't be told.
    """
    if sequence is None:
        row = F.struct(*batch.columns)
        single = F.when(F.count("*") > 1, F.raise_error(F.lit("several rows of one key in a batch; give a sequence"))).otherwise(F.first(row))
        return batch.groupBy(*(F.col(k).alias(f"__k_{k}") for k in keys)).agg(single.alias("__row")).select("__row.*")
    row = F.max_by(F.struct(*batch.columns), F.col(sequence)).alias("__row")
    return batch.groupBy(*(F.col(k).alias(f"__k_{k}") for k in keys)).agg(row).select("__row.*")


def merge_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], sequence: str | None = None) -> DataFrame:
    """Target rows without a newer version, and all batch rows."""
    newest = latest_per_key(batch, keys, sequence)
    kept = target.join(newest.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(newest, allowMissingColumns=True)
