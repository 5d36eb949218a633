"""Statistics of every pool: prices, volumes, ticks, gas, fees and series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.aggregates import ubi_aggregate
from tidepool.functions.numeric import NumericConf
from tidepool.functions.scalars import DEFAULT, ubi_sign, ubi_to_double, ubid, ubim, ubis
from tidepool.operators.projections import PAIR, resolve_columns
from tidepool.operators.quantiles import exact_percentiles
from tidepool.operators.staging import finished, passing, shuffles_removed, staged
from tidepool.plans.catalog import DAY_SWAPS, as_published

GWEI = 1e9
POOL_KEYS = ("address", "pool")
DAY_KEYS = ("date", *POOL_KEYS)
#: Blocks of one row of a series.
SERIES_BLOCKS = 1000
# Fields of a point behind its order key, as published.
SERIES = {
    "priceSeries": (
        "price0", "price1", "priceDeltaPct0", "priceDeltaPct1", "netAmount0", "netAmount1", "volume0", "volume1", "baseVolume", "baseVolumeBis",
    ),
    "costSeries": ("volumeUsd", "gas", "gasXTipUsd", "gasXBaseFeeUsd", "LPFeeUsd", "tipGwei", "baseFeeGwei", "totalFeePct"),
}

RESOLVED = (
    *(f"{name}{i}" for name in ("firstPrice", "lastPrice", "minPrice", "maxPrice", "liquidityWeightedPrice") for i in PAIR),
    *(f"{name}{i}" for name in ("netAmount", "volume") for i in PAIR),
    "volumeBase",
    "volumeUsd",
    "avgVolumeBase",
    "avgVolumeUsd",
    "avgTotalFeesUsd",
    *(f"{name}{i}" for name in ("priceDelta", "priceRange") for i in PAIR),
)


def trend(price: Column, time: str = "timestamp") -> Column:
    """Population covariance over the product of sample deviations; NULL when flat."""
    spread = F.stddev(price) * F.stddev(time)
    return F.when(spread != 0, F.covar_pop(price, F.col(time)) / spread)


def distribution(column: Column, suffix: str) -> list[Column]:
    """Total absolute change, population skewness and excess kurtosis."""
    return [
        F.sum(F.abs(column)).alias(f"ttAbsPriceDeltaPct{suffix}"),
        F.skewness(column).alias(f"skewness{suffix}"),
        F.kurtosis(column).alias(f"kurtosis{suffix}"),
    ]


def _doubles(columns: dict[str, Column], conf: NumericConf) -> dict[str, Column]:
    return {name: ubi_to_double(column, conf) for name, column in columns.items()}


def _prepare(swaps: DataFrame, by: Sequence[str], conf: NumericConf) -> DataFrame:
    """What the aggregates read, with the doubles and weights that need Python, staged so that Python runs once."""
    doubles = _doubles(
        {
            "resolvedTip": F.col("tip"),
            "__price0": F.col("price0"),
            "__price1": F.col("price1"),
            "__volumeBase": F.col("baseAmounts")["volume"],
            "__volumeUsd": F.col("usdAmounts")["volume"],
            "__feesUsd": F.col("totalFeesUsd"),
        },
        conf,
    )
    weights = {"__Base": F.col("baseAmounts")["volume"], "__Usd": F.col("usdAmounts")["volume"]}
    for i in PAIR:
        depth = F.col(f"tickDepth{i}").cast("string")
        weights |= {f"__depth{i}": depth, f"__weighted{i}": ubim(depth, f"price{i}", conf)}
    sides = [f"{name}{i}" for name in ("price", "priceDeltaPct", "tickDepth", "volume", "netAmount", "token") for i in PAIR]
    single = ["logId", "timestamp", "tickDelta", "gas", "totalFeePct", "totalFeesUsd", "liquidity", "fee", "isBasePool"]
    return staged(swaps.withColumns(doubles | weights).select(*by, *sides, *single, *doubles, *weights))


def native_statistics(prepared: DataFrame, by: Sequence[str]) -> DataFrame:
    """Every statistic with a built-in partial aggregate, in one pass."""
    columns = [F.count(F.lit(1)).alias("swapCount")]
    for i in PAIR:
        columns += [
            F.min_by(f"price{i}", "logId").alias(f"firstPrice{i}"),
            F.max_by(f"price{i}", "logId").alias(f"lastPrice{i}"),
            *distribution(F.col(f"priceDeltaPct{i}"), i),
            trend(F.col(f"__price{i}")).alias(f"trend{i}"),
            F.avg(f"tickDepth{i}").alias(f"avgTickDepth{i}"),
        ]
    columns += [
        F.min("logId").alias("firstPriceLogId"),
        F.max("logId").alias("lastPriceLogId"),
        F.avg(F.abs("tickDelta")).alias("avgTicks"),
        F.avg("gas").alias("avgGas"),
        F.avg("totalFeePct").alias("avgTotalFeePct"),
        *(F.any_value(c).alias(c) for c in ("token0", "token1", "fee", "isBasePool")),
    ]
    return prepared.groupBy(*by).agg(*columns)


def percentile_statistics(prepared: DataFrame, by: Sequence[str], slices: int | None = None) -> DataFrame:
    outputs = {
        "medVolumeBase": ("__volumeBase", 0.5),
        "medVolumeUsd": ("__volumeUsd", 0.5),
        "medTicks": (F.abs("tickDelta"), 0.5),
        "medGas": ("gas", 0.5),
        "tipQ1": ("resolvedTip", 0.25),
        "tipQ2": ("resolvedTip", 0.5),
        "tipQ3": ("resolvedTip", 0.75),
        "medTotalFeePct": ("totalFeePct", 0.5),
        "medTotalFeesUsd": ("__feesUsd", 0.5),
    }
    return exact_percentiles(prepared, by, outputs, slices)


def fraction_statistics(prepared: DataFrame, by: Sequence[str], conf: NumericConf = DEFAULT) -> DataFrame:
    """Exact sums, averages and extremes, folded together in one pass."""
    aggregates: dict[str, tuple[str, Column | str]] = {"__liquidity": ("sum", "liquidity")}
    for i in PAIR:
        aggregates |= {
            f"minPrice{i}": ("min", f"price{i}"),
            f"maxPrice{i}": ("max", f"price{i}"),
            f"__depth{i}": ("sum", f"__depth{i}"),
            f"__weighted{i}": ("sum", f"__weighted{i}"),
            f"volume{i}": ("sum", f"volume{i}"),
            f"netAmount{i}": ("sum", f"netAmount{i}"),
        }
    for name in ("Base", "Usd"):
        aggregates |= {f"volume{name}": ("sum", f"__{name}"), f"avgVolume{name}": ("avg", f"__{name}")}
    aggregates["avgTotalFeesUsd"] = ("avg", "totalFeesUsd")
    sums = ubi_aggregate(prepared, by, aggregates, conf)
    return sums.withColumns(
        {
            f"liquidityWeightedPrice{i}": liquidity_weighted_price(
                F.col("__liquidity"), F.col(f"__weighted{i}"), F.col(f"__depth{i}"), conf
            )
            for i in PAIR
        }
    ).drop("__liquidity", *(f"__{n}{i}" for n in ("depth", "weighted") for i in PAIR))


def liquidity_weighted_price(liquidity: Column, weighted: Column, depth: Column, conf: NumericConf = DEFAULT) -> Column:
    """Depth-weighted price from sums: ``"0"`` without liquidity, NULL without depth."""
    usable = F.when((ubi_sign(liquidity) != 0) & (ubi_sign(depth) != 0), depth)
    return F.when(F.coalesce(ubi_sign(liquidity), F.lit(0)) == 0, F.lit("0")).otherwise(ubid(weighted, usable, conf))


def higher_level(stats: DataFrame, conf: NumericConf = DEFAULT) -> DataFrame:
    """Price change, range, volatility and price impact of finished statistics."""
    exact = {}
    for i in PAIR:
        exact[f"priceDelta{i}"] = ubis(f"lastPrice{i}", f"firstPrice{i}", conf)
        exact[f"priceRange{i}"] = ubis(f"maxPrice{i}", f"minPrice{i}", conf)
    ratios = {}
    for i in PAIR:
        change = ubi_to_double(ubid(f"priceDelta{i}", f"lastPrice{i}", conf), conf)
        spread = ubi_to_double(ubid(f"priceRange{i}", f"firstPrice{i}", conf), conf)
        ratios[f"priceDeltaPct{i}"] = change * 100
        ratios[f"volatility{i}"] = F.when(ubi_sign(f"priceRange{i}") != 0, spread * 100).otherwise(0.0)
    impact = (F.col("ttAbsPriceDeltaPct0") + F.col("ttAbsPriceDeltaPct1")) / 2
    whole_usd = F.round(ubi_to_double(F.nullif("volumeUsd", F.lit("")), conf))
    return (
        stats.withColumns(exact)
        .withColumns(ratios)
        .withColumn("volatility", (F.col("volatility0") + F.col("volatility1")) / 2)
        .withColumn("priceImpactPctFor1kUsd", F.try_divide(impact, whole_usd) * 1000)
    )


def pool_statistics(
    swaps: DataFrame,
    by: Sequence[str] = POOL_KEYS,
    slices: int | None = None,
    conf: NumericConf = DEFAULT,
) -> DataFrame:
    """One row per pool, everything but the series, as doubles.

    Three aggregates of different kinds are taken over the same staged columns (native,
    percentiles, exact fractions); each is bounded under a hot pool and the finished
    rows are joined by pool. What was staged goes once they are.
    """
    by = list(by)
    with passing(swaps.sparkSession):
        prepared = _prepare(swaps, by, conf)
        parts = [
            native_statistics(prepared, by),
            percentile_statistics(prepared, by, slices),
            fraction_statistics(prepared, by, conf),
        ]
        joined = reduce(lambda a, b: _join_keys(a, b, by), parts)
        return finished(resolve_columns(higher_level(joined, conf), RESOLVED, conf))


def _join_keys(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join finished rows on keys that may be NULL."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in by})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in by))
    return left.join(renamed, same).drop(*(f"__r_{k}" for k in by))


# -- series ------------------------------------------------------------------------


def pool_series(swaps: DataFrame, by: Sequence[str] = POOL_KEYS, conf: NumericConf = DEFAULT, blocks: int = SERIES_BLOCKS) -> DataFrame:
    """``priceSeries`` and ``costSeries`` of every pool in order, a row per pool and range of ``blocks`` blocks.

    The grain depends on the block alone, so a row holds the swaps of one pool in that many blocks, however
    many swaps there are in all, and a busy pool is spread over its ranges.
    """
    base, usd, gas = F.col("baseAmounts"), F.col("usdAmounts"), F.col("gas").cast("string")
    doubles = _doubles(
        {
            **{f"__{n}{i}": F.col(f"{n}{i}") for n in ("price", "netAmount", "volume") for i in PAIR},
            "__baseVolume": base["volume"],
            "__baseVolumeBis": base["volumeBis"],
            "__volumeUsd": usd["volume"],
            "__gasXTipUsd": ubim(gas, usd["tip"], conf),
            "__gasXBaseFeeUsd": ubim(gas, usd["baseFeePerGas"], conf),
            "__LPFeeUsd": usd["fee"],
            "__tip": F.col("tip"),
            "__baseFee": F.col("baseFeePerGas"),
        },
        conf,
    )
    own = {n: F.col(f"__{n}") for n in ("price0", "price1", "netAmount0", "netAmount1", "volume0", "volume1", "baseVolume", "baseVolumeBis", "volumeUsd", "gasXTipUsd", "gasXBaseFeeUsd", "LPFeeUsd")}
    own |= {"tipGwei": F.col("__tip") * GWEI, "baseFeeGwei": F.col("__baseFee") * GWEI}
    point = lambda names: F.struct("logId", *(own.get(n, F.col(n)).alias(n) for n in names))
    in_range = F.floor(F.col("logId") / blocks).cast("bigint").alias("blockRange")
    arrays = [F.sort_array(F.collect_list(point(names))).alias(series) for series, names in SERIES.items()]
    return swaps.withColumns(doubles).groupBy(*by, in_range).agg(*arrays)


def whole_series(series: DataFrame, by: Sequence[str] = POOL_KEYS) -> DataFrame:
    """The series of each pool in one row, its ranges one after the other."""
    ranges = F.array_sort(F.collect_list(F.struct("blockRange", *SERIES)))
    joined = series.groupBy(*by).agg(ranges.alias("__ranges"))
    return joined.select(*by, *(F.flatten(F.col("__ranges")[name]).alias(name) for name in SERIES))


def changed_days(changes: DataFrame, since: int) -> DataFrame:
    """Dates with a change (date, changed_at) after ``since``."""
    return changes.where(F.col("changed_at") > since).select(F.col("date").cast("date").alias("date")).distinct()


def swaps_of_days(rated: DataFrame, days: DataFrame) -> DataFrame:
    """Rated swaps of some dates. A table partitioned by date is pruned to them when the plan runs."""
    return rated.join(F.broadcast(days), "date", "left_semi")


def day_swaps(rated: DataFrame, date: str | None = None, slices: int | None = None, conf: NumericConf = DEFAULT, blocks: int = SERIES_BLOCKS) -> DataFrame:
    """Published daily rows: statistics with their series, one row per date and pool."""
    swaps = rated if date is None else rated.where(F.col("date") == F.lit(date).cast("date"))
    stats = pool_statistics(swaps, DAY_KEYS, slices, conf)
    ranges = staged(pool_series(swaps, DAY_KEYS, conf, blocks))
    return _join_keys(stats, whole_series(ranges, DAY_KEYS), DAY_KEYS)


def write_days(rows: DataFrame, path: str) -> None:
    """Replaces the partitions of the dates among ``rows``, and no others."""
    with shuffles_removed(rows.sparkSession):
        (
            as_published(rows, DAY_SWAPS)
            .repartition("date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date")
            .parquet(path)
        )
