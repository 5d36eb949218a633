"""Bounded ordered groups: cut a total order into slices of about equal row count.

Ordered operators (as-of, deltas, exact percentiles, series) must not put one
whole key into one task: a single key may hold most of the rows. They work per
``(key, slice)`` instead, where slices are cut by approximate quantiles of the
order itself, so no group exceeds about ``rows / slices`` whatever the keys look
like. What crosses slice borders is one small row per key and slice.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidepool.operators import staging

SLICE = "__slice"
SLICE_ROWS = 2_000_000
DEALT = "__dealt"  # of rows dealt by slice: 1 for each row, 0 for what is carried into a slice
DEALT_ROWS = 250_000  # of a dealt slice, which is sorted with all its columns
MIN_SLICES = 8  # small inputs are sliced like large ones
GRID = 512  # quantiles taken before the row count is known
UNKNOWN_BYTES = 1 << 60  # sources without statistics report about 2**63


def plan_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, which may be off either way; no job is run.

    ``None`` where the session gives no plan access or a source reports no size.
    """
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None
    return size if size < UNKNOWN_BYTES else None


def epoch_seconds(column: str | Column) -> Column:
    """Seconds with micros since 1970 as written, whatever the session's time zone."""
    c = F.col(column) if isinstance(column, str) else column
    day = F.unix_date(c.cast("date")).cast("decimal(20,0)")
    return day * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60 + F.extract(F.lit("SECOND"), c)


def position(df: DataFrame, order: str | Column) -> Column:
    """An order column as a double that never runs against the order."""
    c = F.col(order) if isinstance(order, str) else order
    kind = df.select(c.alias("c")).schema["c"].dataType
    if isinstance(kind, T.TimestampNTZType):
        c = epoch_seconds(c)
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c)
    return c.cast("double")


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as text, by a pass over them."""
    return df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()[0] or 0


def cut_points(
    df: DataFrame, order: str | Column, slices: int | None = None, slice_rows: int | None = None
) -> list[float]:
    """Borders between slices.

    With ``slices`` open, one pass over the order column gives its row count and
    quantiles together, and there are as many slices as rows ask for, ``MIN_SLICES`` at least.
    """
    grid = slices or GRID
    shares = [i / grid for i in range(1, grid)]
    if not shares:
        return []
    measured = df.agg(
        F.count(F.lit(1)).alias("rows"), F.percentile_approx(position(df, order), shares, 4 * grid).alias("cuts")
    ).first()
    cuts = measured.cuts or []
    if slices is None:
        wanted = max(MIN_SLICES, math.ceil(measured.rows / (slice_rows or SLICE_ROWS)))
        if wanted > GRID:
            return cut_points(df, order, wanted)
        cuts = [cuts[GRID * i // wanted - 1] for i in range(1, wanted)] if cuts else []
    return sorted(set(cuts))


def with_slices(df: DataFrame, order: str | Column, cuts: Sequence[float]) -> DataFrame:
    """Add the slice number of each row; equal order values share a slice."""
    if not cuts:
        return df.withColumn(SLICE, F.lit(0))
    splits = [-math.inf, *cuts, math.inf]
    cutter = Bucketizer(splits=splits, inputCol="__position", outputCol="__bucket", handleInvalid="keep")
    placed = cutter.transform(df.withColumn("__position", position(df, order)))
    return placed.withColumn(SLICE, F.col("__bucket").cast("int")).drop("__position", "__bucket")


class Carry(NamedTuple):
    """What an ordered step looks up: the last ``value`` before each row, per key. ``name`` tells the steps apart."""

    name: str
    by: list[str]
    value: Column
    sparse: bool = False


def _carried(sliced: DataFrame, by: list[str], key: Column, sparse: bool) -> DataFrame:
    """The ``__value`` that enters each (key, slice) from the slices before it, where there is one."""
    last = F.max_by("__value", F.when(F.col("__value").isNotNull(), key)).alias("__value")
    here = F.lit(True).alias("__here")
    if sparse:
        values = sliced.where(F.col("__value").isNotNull()).groupBy(*by, SLICE).agg(last)
        pairs = sliced.groupBy(*by, SLICE).agg(here)
        known = pairs.unionByName(values, allowMissingColumns=True)
    else:
        known = sliced.groupBy(*by, SLICE).agg(last, here)
    earlier = Window.partitionBy(*by).orderBy(SLICE).rangeBetween(Window.unboundedPreceding, -1)
    return (
        known.withColumn("__value", F.last("__value", ignorenulls=True).over(earlier))
        .where(F.col("__here") & F.col("__value").isNotNull())
        .drop("__here")
    )


def _entering(name: str) -> str:
    return f"__in_{name}"


def dealt(df: DataFrame, order: str, carries: Sequence[Carry], folder: str, slices: int | None = None) -> DataFrame:
    """The rows written by slice in ``folder``, with what each of ``carries`` brings into a slice as rows of their own.

    ``carry_last`` of the same names, one after the other, runs on them without a shuffle, as a
    bucket holds whole slices; so the rows are shuffled once, however many steps look back, and
    that shuffle goes before they run. ``gathered`` gives the rows back.
    """
    spark, table = df.sparkSession, f"dealt_{uuid.uuid4().hex}"
    cuts = cut_points(df, order, slices, DEALT_ROWS)
    buckets = len(cuts) + 1
    sliced = with_slices(df, order, cuts).withColumn(DEALT, F.lit(1))
    plain = sliced.withColumns({_entering(c.name): F.when(F.lit(False), c.value) for c in carries})

    def write(rows: DataFrame) -> None:
        with staging.shuffles_removed(spark):
            placed = rows.repartition(buckets, SLICE).write.mode("append").option("path", folder).option("compression", "zstd")
            placed.bucketBy(buckets, SLICE).saveAsTable(table)

    write(plain)
    written = spark.table(table)
    entering = []
    for c in carries:
        found = _carried(written.withColumn("__value", c.value), c.by, F.col(order), c.sparse)
        entering.append(found.select(*c.by, SLICE, F.col("__value").alias(_entering(c.name))))
    rows = entering[0]
    for more in entering[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in written.schema if f.name not in rows.columns and f.name != DEALT]
    write(rows.select("*", *lacking, F.lit(0).alias(DEALT)).select(written.columns))
    return spark.table(table)


def gathered(df: DataFrame) -> DataFrame:
    """Rows that were dealt, without what was carried beside them."""
    return df.where(F.col(DEALT) == 1).drop(DEALT, SLICE, *(c for c in df.columns if c.startswith(_entering(""))))


def carry_last(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: Column,
    alias: str,
    slices: int | None = None,
    sparse: bool = False,
    name: str | None = None,
) -> DataFrame:
    """Add the last non-NULL ``value`` strictly before each row, per key and order.

    ``order`` must be unique within a key. With ``slices`` of 1 this is a plain window.
    Otherwise the last value of every (key, slice) is found by a partial aggregate,
    carried forward over the slices of a key, and fed into its next slice as one
    extra leading row, so rows are shuffled once and no join is needed. ``sparse`` says
    that few rows have a value: only those are then sorted for the partial aggregate,
    and the (key, slice) pairs come from a hash aggregate. Rows that were ``dealt`` for the
    step ``name`` hold what enters their slice and are not shuffled.
    """
    by, order = list(by), list(order)
    if name and _entering(name) in df.columns:
        own = F.when(F.col(DEALT) == 1, value).otherwise(F.col(_entering(name)))
        within = Window.partitionBy(*by, SLICE).orderBy(DEALT, *order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn("__value", own).withColumn(alias, F.last("__value", ignorenulls=True).over(within)).drop("__value")
    tagged = df.withColumn("__value", value)
    cuts = cut_points(df, order[0], slices)
    if slices == 1:
        window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return tagged.withColumn(alias, F.last("__value", ignorenulls=True).over(window)).drop("__value")

    sliced = with_slices(tagged, order[0], cuts)
    key = F.struct(*order) if len(order) > 1 else F.col(order[0])
    carried = _carried(sliced, by, key, sparse).withColumn("__row", F.lit(0))
    within = Window.partitionBy(*by, SLICE).orderBy("__row", *order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.withColumn("__row", F.lit(1))
        .unionByName(carried, allowMissingColumns=True)
        .withColumn(alias, F.last("__value", ignorenulls=True).over(within))
        .where(F.col("__row") == 1)
        .drop("__value", "__row", SLICE)
    )
