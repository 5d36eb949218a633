"""Exact percentiles per key (linear interpolation, as ``percentile``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.operators.slicing import SLICE, cut_points, with_slices
from tidepool.operators.staging import staged

QUARTILE_SHARES = {1: 0.25, 2: 0.5, 3: 0.75}


def quartile(n: int, column: str | Column) -> Column:
    """Exact quartile 1, 2 or 3 as a plain aggregate."""
    if n not in QUARTILE_SHARES:
        raise ValueError("quartile must be 1, 2 or 3")
    return F.percentile(column, F.lit(QUARTILE_SHARES[n]))


def exact_percentiles(
    df: DataFrame,
    by: Sequence[str],
    outputs: Mapping[str, tuple[str | Column, float]],
    slices: int | None = None,
) -> DataFrame:
    """One row per key with each output ``name -> (column, share)``.

    Values are counted per slice of the value range, the slice holding each wanted rank
    is found from the slice counts, and ranks are taken only inside it. ``slices`` of 1 uses
    the built-in aggregate, whose state grows with the distinct values of a key.
    """
    by = list(by)
    if slices == 1:
        return df.groupBy(*by).agg(*(F.percentile(c, F.lit(q)).alias(o) for o, (c, q) in outputs.items()))

    sources: dict[object, tuple[str, Column]] = {}
    wanted = []
    for name, (column, share) in outputs.items():
        c = F.col(column) if isinstance(column, str) else column
        # two columns may print alike, so only names and the same object are shared
        same = column if isinstance(column, str) else id(column)
        source = sources.setdefault(same, (f"c{len(sources)}", c))[0]
        wanted.append((name, source, share))

    entries = F.array(
        *(F.struct(F.lit(s).alias("__source"), c.cast("double").alias("__v")) for s, c in sources.values())
    )
    values = df.select(*by, F.inline(entries)).where(F.col("__v").isNotNull())
    # read for the cuts, the slices and the ranks
    counts = staged(values.groupBy(*by, "__source", "__v").agg(F.count(F.lit(1)).alias("__n")))
    sliced = with_slices(counts, "__v", cut_points(counts, "__v", slices))

    per_slice = sliced.groupBy(*by, "__source", SLICE).agg(F.sum("__n").alias("__in_slice"))
    group = Window.partitionBy(*by, "__source")
    running = group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    located = per_slice.select(
        *by,
        "__source",
        SLICE,
        "__in_slice",
        F.coalesce(F.sum("__in_slice").over(running), F.lit(0)).alias("__before"),
        F.sum("__in_slice").over(group).alias("__total"),
    )

    # every output asks for the two ranks around its position
    asks = F.array(
        *(F.struct(F.lit(o).alias("__output"), F.lit(s).alias("__for"), F.lit(q).alias("__share")) for o, s, q in wanted)
    )
    position = F.col("__share") * (F.col("__total") - 1)
    ranks = (
        located.select("*", F.inline(asks))
        .where(F.col("__for") == F.col("__source"))
        .select("*", F.floor(position).alias("__low"), F.ceil(position).alias("__high"), position.alias("__position"))
        .where(
            (F.col("__low") < F.col("__before") + F.col("__in_slice")) & (F.col("__high") >= F.col("__before"))
        )
        .drop("__for", "__in_slice", "__total", "__share")
    )

    inside = Window.partitionBy(*by, "__source", SLICE).orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = sliced.withColumn("__first", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    left, right = ranked.alias("l"), ranks.alias("r")
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in by]
    same += [F.col(f"l.{k}") == F.col(f"r.{k}") for k in ("__source", SLICE)]
    first = F.col("__before") + F.col("__first")
    holds = lambda rank: (F.col(rank) >= first) & (F.col(rank) < first + F.col("__n"))
    picked = (
        left.join(right, reduce(lambda a, b: a & b, same))
        .groupBy(*(F.col(f"l.{k}").alias(k) for k in by), "__output")
        .agg(
            F.max(F.when(holds("__low"), F.col("__v"))).alias("__lo"),
            F.max(F.when(holds("__high"), F.col("__v"))).alias("__hi"),
            F.first("__position").alias("__position"),
        )
    )
    part = F.col("__position") - F.floor("__position")
    result = F.when(part == 0, F.col("__lo")).otherwise((1 - part) * F.col("__lo") + part * F.col("__hi"))
    wide = picked.groupBy(*by).agg(
        *(F.max(F.when(F.col("__output") == o, result)).alias(o) for o, _, _ in wanted)
    )
    # keys without any value keep their row of NULLs
    keys = df.select(*by).distinct()
    k, w = keys.alias("k"), wide.alias("w")
    on = [F.col(f"k.{c}").eqNullSafe(F.col(f"w.{c}")) for c in by]
    if not on:
        return wide
    return k.join(w, reduce(lambda a, b: a & b, on), "left").select(
        *(F.col(f"k.{c}").alias(c) for c in by), *(F.col(f"w.{o}").alias(o) for o, _, _ in wanted)
    )
