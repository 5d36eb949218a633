"""Landed chain tables as frames: tokens, pools, transactions and swaps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.numeric import NumericConf
from tidepool.functions.scalars import DEFAULT, ubim, ubis
from tidepool.operators.joins import two_role_join
from tidepool.operators.market import Market

MARKET = Market()

# Event arguments as landed; big integers stay text so none lose digits.
SWAP_ARGS = T.StructType(
    [
        *(T.StructField(n, T.StringType()) for n in ("amount0", "amount1", "liquidity", "recipient", "sender", "sqrtPriceX96")),
        T.StructField("tick", T.LongType()),
    ]
)
POOL_ARGS = T.StructType(
    [
        T.StructField("token0", T.StringType()),
        T.StructField("token1", T.StringType()),
        T.StructField("fee", T.LongType()),
        T.StructField("tickSpacing", T.LongType()),
        T.StructField("pool", T.StringType()),
    ]
)
WEI_DECIMALS = 18
#: A swap belongs to the transaction of its block and hash.
SWAP_KEYS = ("blockNumber", "transactionHash")
#: Buckets of landed tables; a bucket of an epoch is what a join's task reads at most.
BUCKETS = 16


def read_epochs(spark: SparkSession, path: str, epochs: Sequence[int]) -> DataFrame:
    """Epoch partitions whose schemas may differ; fields absent in one are NULL there."""
    parts = [
        spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/epoch={epoch}") for epoch in epochs
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def warm_up_floor(epoch: int, market: Market = MARKET) -> int:
    """First block of a job: the epoch and the last unexpired blocks before it."""
    return epoch * market.epoch_length - market.block_expiry


def decode_args(df: DataFrame, schema: T.StructType, column: str = "args") -> DataFrame:
    """Replace the JSON arguments by typed columns."""
    decoded = df.withColumn("__args", F.from_json(column, schema)).drop(column)
    return decoded.select(*(c for c in decoded.columns if c != "__args"), "__args.*")


def encode_args(columns: Sequence[str]) -> Column:
    """JSON text of argument columns."""
    return F.to_json(F.struct(*columns))


def tokens(table: DataFrame) -> DataFrame:
    """Token dimension, one row per address."""
    return table.select("symbol", F.col("decimals").cast("decimal(38,0)").alias("decimals"), "address")


def pools(events: DataFrame, token_table: DataFrame) -> DataFrame:
    """Pools with both tokens and a label such as ``AAA_BBB_30``."""
    created = events.where((F.col("contract") == "Factory") & (F.col("event") == "PoolCreated"))
    args = created.select(F.from_json("args", POOL_ARGS).alias("a")).select("a.*")
    with_tokens = two_role_join(
        args.withColumnsRenamed({"token0": "__t0", "token1": "__t1"}),
        tokens(token_table),
        {"token0": "__t0", "token1": "__t1"},
        "address",
        ["pool"],
    )
    label = F.concat_ws("_", "token0.symbol", "token1.symbol", (F.col("fee") / 100).cast("int").cast("string"))
    return with_tokens.select(
        F.col("pool").alias("address"), label.alias("pool"), "fee", "tickSpacing", "token0", "token1"
    )


def flat_transactions(blocks: DataFrame) -> DataFrame:
    """One row per transaction with its block's number, time and base fee; the fee is NULL where the chain had none."""
    fee = F.col("baseFeePerGas") if "baseFeePerGas" in blocks.columns else F.lit(None)
    return blocks.select(
        F.col("number").alias("blockNumber"), "timestamp", fee.cast("string").alias("baseFeePerGas"), F.explode("transactions").alias("t"), "epoch"
    ).select(
        "blockNumber",
        F.col("t.hash").alias("transactionHash"),
        "timestamp",
        F.col("t.gas").alias("gas"),
        F.col("t.gasPrice").cast("string").alias("gasPrice"),
        "baseFeePerGas",
        "epoch",
    )


def epoch_transactions(flat: DataFrame, epoch: int, market: Market = MARKET) -> DataFrame:
    """Flat transactions of the epoch and its warm-up blocks, prices in the base coin."""
    wanted = flat.where(F.col("epoch").isin(epoch - 1, epoch) & (F.col("blockNumber") >= warm_up_floor(epoch, market)))
    wei = F.lit(f"e{WEI_DECIMALS}")
    base_fee = F.concat("baseFeePerGas", wei) if epoch >= market.first_base_fee_epoch else F.lit(None).cast("string")
    return wanted.select(
        "blockNumber", "timestamp", "transactionHash", "gas", F.concat("gasPrice", wei).alias("gasPrice"), base_fee.alias("baseFeePerGas")
    )


def with_fees(transactions: DataFrame, conf: NumericConf = DEFAULT) -> DataFrame:
    """Gas fees and tip; a Python step, which forgets buckets, so joins on them come before it."""
    return transactions.withColumns(
        {
            "gasFees": ubim(F.col("gas").cast("string"), "gasPrice", conf),
            "tip": ubis("gasPrice", "baseFeePerGas", conf),
        }
    )


def transactions(blocks: DataFrame, epoch: int, market: Market = MARKET, conf: NumericConf = DEFAULT) -> DataFrame:
    """Transactions of the epoch and its warm-up blocks with fees in the base coin."""
    return with_fees(epoch_transactions(flat_transactions(blocks), epoch, market), conf)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str] = SWAP_KEYS, buckets: int = BUCKETS) -> None:
    """Land ``df`` as the table ``table`` by epoch, in sorted buckets of its join keys.

    Tables landed with the same keys and number of buckets are joined on the keys without a shuffle,
    whatever epochs are read. A task writes one bucket, so an epoch has at most a file per bucket.
    """
    placed = df.repartition(buckets, *keys)
    placed.write.mode("overwrite").option("path", path).partitionBy("epoch").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def swaps(events: DataFrame, epoch: int, market: Market = MARKET) -> DataFrame:
    """Swap events of the epoch and its warm-up blocks with typed arguments."""
    wanted = events.where(
        (F.col("contract") == "Pool")
        & F.col("epoch").between(epoch - 1, epoch)
        & (F.col("blockNumber") >= warm_up_floor(epoch, market))
        & (F.col("event") == "Swap")
    )
    return decode_args(wanted, SWAP_ARGS)
