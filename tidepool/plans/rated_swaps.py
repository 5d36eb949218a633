"""From landed events, blocks and tokens to swaps rated in the base token and USD."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.numeric import NumericConf
from tidepool.functions.scalars import DEFAULT
from tidepool.operators import pricing, slicing, staging, valuation
from tidepool.operators.balance import balanced
from tidepool.operators.joins import dimension_join
from tidepool.operators.market import Market
from tidepool.operators.projections import event_date, log_id
from tidepool.operators.staging import staged
from tidepool.sources import chain

MARKET = Market()


def join_transactions(swaps: DataFrame, transactions: DataFrame) -> DataFrame:
    """Swaps with their transaction, where it is known; sides landed in buckets of the two keys meet as they lie."""
    return swaps.join(transactions.hint("merge"), list(chain.SWAP_KEYS), "left")


def join_pools(swaps: DataFrame, pools: DataFrame) -> DataFrame:
    return dimension_join(swaps, pools, ["address"], ["blockNumber", "transactionIndex", "logIndex"])


def join_swaps(swaps: DataFrame, transactions: DataFrame, pools: DataFrame) -> DataFrame:
    """Swaps with their transaction and pool; both sides are optional."""
    return join_pools(join_transactions(swaps, transactions), pools)


def price_swaps(swaps: DataFrame, market: Market = MARKET, conf: NumericConf = DEFAULT) -> DataFrame:
    """Order key, prices, volumes, tick liquidity and rate preparation."""
    ordered = swaps.withColumn("logId", log_id("blockNumber", "transactionIndex", "logIndex"))
    priced = pricing.tick_liquidity(pricing.swap_price_volume(ordered, conf))
    return valuation.exchange_rate_prep(priced, market)


def rate_swaps(
    priced: DataFrame,
    market: Market = MARKET,
    epoch: int | None = None,
    slices: int | None = None,
    conf: NumericConf = DEFAULT,
    folder: str | None = None,
) -> DataFrame:
    """Deltas, exchange rates and valuation of priced swaps.

    ``epoch`` drops the warm-up rows once the ordered steps have used them. The priced rows are
    dealt once for all ordered steps, in ``folder`` or in the checkpoint folder of the session, where it has one.
    """
    top = staging.folder(priced.sparkSession)
    folder = folder or (f"{top}/tidepool-dealt-{uuid.uuid4().hex}" if top else None)
    return value_swaps(rated_quotes(priced, folder, market, slices, conf), market, epoch, conf)


def rated_quotes(
    priced: DataFrame, folder: str | None, market: Market = MARKET, slices: int | None = None, conf: NumericConf = DEFAULT
) -> DataFrame:
    """Deltas and exchange rates of priced swaps, dealt in ``folder`` for these steps."""
    if folder is None or slices == 1:
        return quoted_swaps(staged(priced), market, slices, conf)
    rows = valuation.dealt_for_rates(priced, folder, market, slices, [pricing.delta_carry()])
    return slicing.gathered(quoted_swaps(rows, market, slices, conf))


def quoted_swaps(rows: DataFrame, market: Market = MARKET, slices: int | None = None, conf: NumericConf = DEFAULT) -> DataFrame:
    """Deltas and exchange rates by the ordered steps one after the other."""
    # the deltas come last: Spark forgets how rows are dealt when they pass through Python
    rated = valuation.usd_exchange_rate(valuation.base_exchange_rate(rows, market, slices), market, slices)
    return pricing.swap_delta(rated, market.block_expiry, slices=slices, conf=conf)


def value_swaps(rated: DataFrame, market: Market = MARKET, epoch: int | None = None, conf: NumericConf = DEFAULT) -> DataFrame:
    """The steps after the rates, none of which depend on other rows."""
    if epoch is not None:
        rated = rated.where(F.col("epoch") == epoch)
    return valuation.value_amounts(balanced(rated), market, conf).withColumn("date", event_date("timestamp"))


def rated_swaps(
    events: DataFrame,
    blocks: DataFrame,
    tokens: DataFrame,
    epoch: int,
    market: Market = MARKET,
    slices: int | None = None,
    conf: NumericConf = DEFAULT,
) -> DataFrame:
    """The whole batch pipeline of one epoch."""
    joined = join_swaps(
        chain.swaps(events, epoch, market),
        chain.transactions(blocks, epoch, market, conf),
        chain.pools(events, tokens),
    )
    return rate_swaps(price_swaps(joined, market, conf), market, epoch, slices, conf)


def land_swaps(events: DataFrame, blocks: DataFrame, tables: tuple[str, str], folder: str, buckets: int = chain.BUCKETS) -> None:
    """Lands swap events and flat transactions as the two ``tables``, in buckets of block and transaction."""
    wanted = events.where((F.col("contract") == "Pool") & (F.col("event") == "Swap"))
    chain.write_bucketed(wanted, tables[0], f"{folder}/swaps", buckets=buckets)
    chain.write_bucketed(chain.flat_transactions(blocks), tables[1], f"{folder}/transactions", buckets=buckets)


def landed_swaps(spark: SparkSession, tables: tuple[str, str], pools: DataFrame, epoch: int, market: Market = MARKET, conf: NumericConf = DEFAULT) -> DataFrame:
    """Swaps of an epoch and its warm-up blocks with transaction and pool, from tables of ``land_swaps``."""
    swaps, transactions = (spark.table(t) for t in tables)
    joined = join_transactions(chain.swaps(swaps, epoch, market), chain.epoch_transactions(transactions, epoch, market))
    return join_pools(chain.with_fees(joined, conf), pools)


def rated_epoch(
    spark: SparkSession,
    tables: tuple[str, str],
    pools: DataFrame,
    epoch: int,
    market: Market = MARKET,
    slices: int | None = None,
    conf: NumericConf = DEFAULT,
) -> DataFrame:
    """The swap job of one epoch over landed tables."""
    return rate_swaps(price_swaps(landed_swaps(spark, tables, pools, epoch, market, conf), market, conf), market, epoch, slices, conf)
