"""Published tables and their partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.projections import null_extended

# Columns of the published tables.
_TOKEN = "STRUCT<symbol: STRING, decimals: DECIMAL(38,0), address: STRING>"
_QUOTE = "STRUCT<poolAddress: STRING, price: STRING, is1: BOOLEAN, logId: DECIMAL(38,18)>"
RATED_SWAPS = f"""
    address STRING, blockNumber BIGINT, transactionHash BINARY, event STRING, logIndex BIGINT,
    transactionIndex BIGINT, blockHash BINARY, contract STRING, epoch INT,
    amount0 STRING, amount1 STRING, liquidity STRING, recipient STRING, sender STRING,
    sqrtPriceX96 STRING, tick BIGINT, timestamp BIGINT, gas BIGINT, gasPrice STRING,
    baseFeePerGas STRING, gasFees STRING, tip STRING, pool STRING, fee BIGINT, tickSpacing BIGINT,
    token0 {_TOKEN}, token1 {_TOKEN}, logId DECIMAL(38,18), price1 STRING, price0 STRING,
    resolvedSqrtPrice DOUBLE, fee0 STRING, fee1 STRING, netAmount0 STRING, netAmount1 STRING,
    volume0 STRING, volume1 STRING, tickAmount0 DOUBLE, tickAmount1 DOUBLE, tickDepth0 DOUBLE,
    tickDepth1 DOUBLE, isBasePool BOOLEAN, is1 BOOLEAN, pairedToken {_TOKEN},
    pairedToken0 {_TOKEN}, pairedToken1 {_TOKEN}, blockNumberTs TIMESTAMP, lastPrice0 STRING,
    lastPrice1 STRING, priceDelta0 STRING, priceDelta1 STRING, priceDeltaPct0 DOUBLE,
    priceDeltaPct1 DOUBLE, tickDelta BIGINT, base0 {_QUOTE}, base1 {_QUOTE}, usdBase {_QUOTE},
    baseAmounts MAP<STRING, STRING>, totalFees STRING, totalFeePct DOUBLE,
    usdAmounts MAP<STRING, STRING>, totalFeesUsd STRING"""
_PRICE_POINT = """STRUCT<logId: DECIMAL(38,18), price0: DOUBLE, price1: DOUBLE, priceDeltaPct0: DOUBLE,
    priceDeltaPct1: DOUBLE, netAmount0: DOUBLE, netAmount1: DOUBLE, volume0: DOUBLE, volume1: DOUBLE,
    baseVolume: DOUBLE, baseVolumeBis: DOUBLE>"""
_COST_POINT = """STRUCT<logId: DECIMAL(38,18), volumeUsd: DOUBLE, gas: BIGINT, gasXTipUsd: DOUBLE,
    gasXBaseFeeUsd: DOUBLE, LPFeeUsd: DOUBLE, tipGwei: DOUBLE, baseFeeGwei: DOUBLE, totalFeePct: DOUBLE>"""
DAY_SWAPS = f"""
    address STRING, pool STRING, swapCount BIGINT,
    firstPrice0 DOUBLE, firstPrice1 DOUBLE, lastPrice0 DOUBLE, lastPrice1 DOUBLE,
    firstPriceLogId DECIMAL(38,18), lastPriceLogId DECIMAL(38,18),
    minPrice0 DOUBLE, minPrice1 DOUBLE, maxPrice0 DOUBLE, maxPrice1 DOUBLE,
    liquidityWeightedPrice0 DOUBLE, liquidityWeightedPrice1 DOUBLE,
    ttAbsPriceDeltaPct0 DOUBLE, ttAbsPriceDeltaPct1 DOUBLE, skewness0 DOUBLE, skewness1 DOUBLE,
    kurtosis0 DOUBLE, kurtosis1 DOUBLE, trend0 DOUBLE, trend1 DOUBLE, volume0 DOUBLE, volume1 DOUBLE,
    netAmount0 DOUBLE, netAmount1 DOUBLE, volumeBase DOUBLE, volumeUsd DOUBLE, avgVolumeBase DOUBLE,
    avgVolumeUsd DOUBLE, medVolumeBase DOUBLE, medVolumeUsd DOUBLE, avgTicks DOUBLE, medTicks DOUBLE,
    avgTickDepth0 DOUBLE, avgTickDepth1 DOUBLE, avgGas DOUBLE, medGas DOUBLE, tipQ1 DOUBLE,
    tipQ2 DOUBLE, tipQ3 DOUBLE, avgTotalFeePct DOUBLE, medTotalFeePct DOUBLE, avgTotalFeesUsd DOUBLE,
    medTotalFeesUsd DOUBLE, priceSeries ARRAY<{_PRICE_POINT}>, costSeries ARRAY<{_COST_POINT}>,
    token0 {_TOKEN}, token1 {_TOKEN}, fee BIGINT, isBasePool BOOLEAN,
    priceDelta0 DOUBLE, priceDelta1 DOUBLE, priceDeltaPct0 DOUBLE, priceDeltaPct1 DOUBLE,
    priceRange0 DOUBLE, priceRange1 DOUBLE, volatility0 DOUBLE, volatility1 DOUBLE, volatility DOUBLE,
    priceImpactPctFor1kUsd DOUBLE"""


def as_published(df: DataFrame, columns: str) -> DataFrame:
    """Shape rows to a published table: its columns and types, plus the date."""
    if "blockNumberTs" not in df.columns and "blockNumber" in df.columns:
        df = df.withColumn("blockNumberTs", F.timestamp_seconds("blockNumber"))
    schema = T.StructType(T.StructType.fromDDL(columns).fields + [T.StructField("date", T.StringType())])
    return null_extended(df, schema)


def create_table(spark: SparkSession, name: str, columns: str, location: str) -> None:
    """External Parquet table partitioned by date text."""
    database = name.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, date STRING) "
        f"USING parquet PARTITIONED BY (date) LOCATION '{location}'"
    )


def discover_partitions(spark: SparkSession, name: str) -> None:
    """Register partitions present in the table's location."""
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)


def missing_dates(spark: SparkSession, name: str, until: str | None = None) -> DataFrame:
    """Dates after the latest partition, up to ``until`` (tomorrow by default)."""
    latest = spark.sql(f"SHOW PARTITIONS {name}").select(
        F.to_date(F.max(F.element_at(F.split("partition", "="), 2))).alias("latest")
    )
    start = F.coalesce("latest", F.current_date())
    end = F.to_date(F.lit(until)) if until else F.date_add(F.current_date(), 1)
    days = F.when(start < end, F.sequence(F.date_add(start, 1), end))
    return latest.select(F.explode(days).alias("date"))


def add_partitions(spark: SparkSession, name: str, until: str | None = None) -> list[str]:
    """Add the missing daily partitions of a table in one statement."""
    dates = [str(r.date) for r in missing_dates(spark, name, until).collect()]
    if dates:
        clauses = " ".join(f"PARTITION (date='{d}')" for d in dates)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {clauses}")
    return dates
