"""Ordered series per key, as arrays of bounded length."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.operators.slicing import SLICE, cut_points, with_slices

PART_ROWS = 200_000


def series_parts(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    series: dict[str, Column],
    slices: int | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Sorted arrays of structs per key, numbered by ``part``.

    ``series`` maps an output to a struct whose first field is ``order``. Keys of up
    to ``part_rows`` rows have one part. A larger key spans several rows whose arrays,
    put one after the other, are the whole series; no task holds more than one part.
    Rows are numbered within slices of the order, whose number does not depend on
    ``part_rows``; rows of equal order share a part.
    """
    by = list(by)
    arrays = [F.sort_array(F.collect_list(point)).alias(name) for name, point in series.items()]
    cuts = cut_points(df, order, slices)
    if not cuts:
        return df.groupBy(*by).agg(*arrays).select(*by, F.lit(0).alias("part"), *series)

    sliced = with_slices(df, order, cuts)
    running = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.groupBy(*by, SLICE).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(running), F.lit(0)))
    places = before.select(*(F.col(k).alias(f"__{k}") for k in by), F.col(SLICE).alias("__in"), "__before")
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in by] + [F.col(SLICE) == F.col("__in")]
    within = F.rank().over(Window.partitionBy(*by, SLICE).orderBy(order)) - 1
    placed = sliced.withColumn("__at", within).join(places, reduce(lambda a, b: a & b, same))
    part = F.floor((F.col("__before") + F.col("__at")) / part_rows).cast("int")
    return placed.withColumn("part", part).groupBy(*by, "part").agg(*arrays).select(*by, "part", *series)
