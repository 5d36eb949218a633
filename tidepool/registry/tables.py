"""The given tables, read as the frames the operators expect."""

from __future__ import annotations

import json
import tempfile
import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.balance import balanced
from tidepool.operators.market import Market
from tidepool.operators.slicing import epoch_seconds

# A small market over events: event types are pools, event ids are blocks.
BASE, USD = "eth", "usdc"
MARKET = Market(base_token=BASE, usd_token=USD, epoch_length=10**9, block_expiry=40, first_base_fee_epoch=1)
# pool -> (token0, token1); the same table as POOLS_SQL below
POOLS = {
    "purchase": (USD, BASE),
    "signup": ("ppp", BASE),
    "click": (BASE, "qqq"),
    "view": ("ppp", "qqq"),
    "error": ("qqq", "rrr"),
}
DECIMALS = {USD: 6, BASE: 18, "ppp": 8, "qqq": 2, "rrr": 0}
FEE = 3000
TICK_SPACING = 60


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """New folder under the session's shared checkpoint folder; local sessions without one use a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tidepool-{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix=f"tidepool-{name}-")


def use_checkpoints(spark: SparkSession) -> None:
    """Name a checkpoint folder where the session has none."""
    if spark.sparkContext.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        spark.sparkContext.setCheckpointDir(shared or scratch_folder(spark, "checkpoints"))


def rounded(column: Column, digits: int) -> Column:
    """Rounded double without negative zero."""
    return F.round(column, digits) + F.lit(0.0)


def cents(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column * 100).cast("bigint")


def text(column: Column) -> Column:
    return column.cast("string")


def lines(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """lineitem with price and quantity as integers and as exact text.

    ``spread`` is for queries with much work per row.
    """
    lineitem = read(spark, sf_dir, "lineitem")
    return (
        (balanced(lineitem) if spread else lineitem)
        .withColumns({"cents": cents("l_extendedprice"), "qty": F.col("l_quantity").cast("bigint")})
        .withColumns({"price": F.concat(text(F.col("cents")), F.lit("e2")), "quantity": text(F.col("qty"))})
    )


LINES_SQL = """lines AS (
    SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(l_quantity AS BIGINT) AS qty FROM lineitem
)"""


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with integers taken from value and props; a cent is added so that no price is zero."""
    return read(spark, sf_dir, "events").withColumns(
        {"cents": cents("value") + 1, "k": F.get_json_object("props", "$.k").cast("bigint")}
    )


TICKS_SQL = r"""ticks AS (
    SELECT *, CAST(round(value * 100) AS BIGINT) + 1 AS cents,
        CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS k
    FROM events
)"""


def _token(pool: Column, side: int) -> Column:
    address = F.lit(None).cast("string")
    for name, tokens in POOLS.items():
        address = F.when(pool == name, F.lit(tokens[side])).otherwise(address)
    return address


def token_struct(address: Column) -> Column:
    decimals = F.lit(None).cast("decimal(38,0)")
    for token, d in DECIMALS.items():
        decimals = F.when(address == token, F.lit(d).cast("decimal(38,0)")).otherwise(decimals)
    return F.struct(F.upper(address).alias("symbol"), decimals.alias("decimals"), address.alias("address"))


def raw_swaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as swaps before any maths: one block per event, one pool per event type."""
    e = balanced(ticks(spark, sf_dir))
    up = F.col("k") < 50
    amount = F.col("cents") * 1000
    return e.select(
        F.col("event_type").alias("address"),
        F.col("event_id").alias("blockNumber"),
        F.lit(1).cast("bigint").alias("transactionIndex"),
        F.col("k").alias("logIndex"),
        F.lit("Pool").alias("contract"),
        F.lit("Swap").alias("event"),
        F.lit(1).alias("epoch"),
        epoch_seconds("ts").cast("bigint").alias("timestamp"),
        F.concat(text(F.col("cents")), F.lit("0" * 25)).alias("sqrtPriceX96"),
        text(F.when(up, amount).otherwise(-amount)).alias("amount0"),
        text(F.when(up, -amount * 3).otherwise(amount * 3)).alias("amount1"),
        text(F.col("cents") * 1_000_000).alias("liquidity"),
        (F.col("k") * 10 - 500).alias("tick"),
        F.lit(FEE).cast("bigint").alias("fee"),
        F.lit(TICK_SPACING).cast("bigint").alias("tickSpacing"),
        F.concat(F.lit("P_"), F.col("event_type")).alias("pool"),
        token_struct(_token(F.col("event_type"), 0)).alias("token0"),
        token_struct(_token(F.col("event_type"), 1)).alias("token1"),
        (F.col("k") + 21000).alias("gas"),
        F.concat(text(F.col("k") * 1_000_000_000 + 7), F.lit("e18")).alias("gasPrice"),
        F.concat(text(F.col("k") * 900_000_000), F.lit("e18")).alias("baseFeePerGas"),
        F.concat(text((F.col("k") + 21000) * (F.col("k") * 1_000_000_000 + 7)), F.lit("e18b0/1e0b0")).alias("gasFees"),
        F.concat(text(F.col("k") * 100_000_000 + 7), F.lit("e18b0/1e0b0")).alias("tip"),
        "user_id",
        "cents",
        "k",
    )


# The same swaps in SQL, values as doubles; decimals are scaled out.
SWAPS_SQL = f"""{TICKS_SQL},
pools(address, t0, t1, d0, d1) AS (VALUES
    ('purchase', 'usdc', 'eth', 6, 18), ('signup', 'ppp', 'eth', 8, 18), ('click', 'eth', 'qqq', 18, 2),
    ('view', 'ppp', 'qqq', 8, 2), ('error', 'qqq', 'rrr', 2, 0)
),
swaps AS (
    SELECT p.address, event_id AS block, event_id + (100000 + k) / 1e10 AS pos, k, cents, t0, t1, d0, d1,
        pow(cents * 1e25 / pow(2.0::DOUBLE, 96), 2) * pow(10.0::DOUBLE, d0 - d1) AS price1,
        1 / (pow(cents * 1e25 / pow(2.0::DOUBLE, 96), 2) * pow(10.0::DOUBLE, d0 - d1)) AS price0,
        CASE WHEN k < 50 THEN 1 ELSE -1 END * cents * 1000 / pow(10.0::DOUBLE, d0) AS amount0,
        CASE WHEN k < 50 THEN -1 ELSE 1 END * cents * 3000 / pow(10.0::DOUBLE, d1) AS amount1,
        cents * 1e25 / pow(2.0::DOUBLE, 96) AS root, cents * 1e6 AS liquidity, k * 10 - 500 AS tick,
        k + 21000 AS gas, (k * 1e9 + 7) / 1e18 AS gas_price, k * 9e8 / 1e18 AS base_fee,
        (k + 21000) * (k * 1e9 + 7) / 1e18 AS gas_fees, (k * 1e8 + 7) / 1e18 AS tip,
        CAST(floor(epoch(ts)) AS BIGINT) AS unix, ts
    FROM ticks JOIN pools p ON p.address = event_type
)"""


# -- the same market as landed chain tables -----------------------------------------


def half_chain(spark: SparkSession, sf_dir: str) -> Market:
    """The market with two epochs: blocks (event ids) up to the middle, and those after it."""
    last = read(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    return replace(MARKET, epoch_length=last // 2 + 1)


def chain_events(spark: SparkSession, sf_dir: str, market: Market) -> DataFrame:
    """Swap events with JSON arguments, and a factory event per pool."""
    raw = raw_swaps(spark, sf_dir).withColumns({"recipient": F.lit("r"), "sender": F.lit("s")})
    args = F.to_json(F.struct("amount0", "amount1", "liquidity", "recipient", "sender", "sqrtPriceX96", "tick"))
    log = ["contract", "event", "blockNumber", "address", "transactionHash", "transactionIndex", "logIndex", "args", "epoch"]
    epoch = F.floor(F.col("blockNumber") / market.epoch_length).cast("int")
    found = raw.withColumns({"args": args, "epoch": epoch, "transactionHash": _hash("blockNumber")}).select(log)
    made = [(json.dumps({"token0": a, "token1": b, "fee": FEE, "tickSpacing": TICK_SPACING, "pool": p}),) for p, (a, b) in POOLS.items()]
    factory = spark.createDataFrame(made, "args string").select(
        F.lit("Factory").alias("contract"), F.lit("PoolCreated").alias("event"), F.lit(0).cast("bigint").alias("blockNumber"), F.lit("f").alias("address"),
        F.lit("0x").alias("transactionHash"), F.lit(0).cast("bigint").alias("transactionIndex"), F.lit(0).cast("bigint").alias("logIndex"), "args", F.lit(0).alias("epoch"),
    )
    return found.unionByName(factory)


def _hash(block: str) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(block)))


def chain_blocks(spark: SparkSession, sf_dir: str, market: Market) -> DataFrame:
    """A block per event with its one transaction."""
    k = F.col("k")
    transaction = F.struct(_hash("event_id").alias("hash"), (k + 21000).alias("gas"), (k * 1_000_000_000 + 7).alias("gasPrice"))
    return ticks(spark, sf_dir).select(
        F.col("event_id").alias("number"),
        epoch_seconds("ts").cast("bigint").alias("timestamp"),
        (k * 900_000_000).alias("baseFeePerGas"),
        F.array(transaction).alias("transactions"),
        F.floor(F.col("event_id") / market.epoch_length).cast("int").alias("epoch"),
    )


def chain_tokens(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a, a.upper(), d) for a, d in DECIMALS.items()], "address string, symbol string, decimals int")
