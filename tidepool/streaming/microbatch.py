"""Rated swaps per micro-batch with the batch operators.

The keyed stream of ``stateful`` puts all rows of a key into one task. Here every
micro-batch is rated by the sliced window operators instead, so neither a hot pool
nor the single USD rate limits it. What one batch hands to the next is a small table:
the last swap of every pool, the last quote of every token and the last USD quote.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepool.functions.numeric import NumericConf
from tidepool.functions.scalars import DEFAULT
from tidepool.operators import pricing, slicing, valuation
from tidepool.operators.market import Market
from tidepool.plans.catalog import RATED_SWAPS, as_published
from tidepool.plans.rated_swaps import quoted_swaps, value_swaps
from tidepool.streaming.sink import TableFiles, upsert_path, with_trigger

MARKET = Market()
KEPT = "__kept"


def carried_rows(swaps: DataFrame, market: Market = MARKET) -> DataFrame:
    """The rows later swaps may refer to: last per pool, last quote per token, last USD quote."""
    newest = swaps.agg(F.max("logId")).first()[0]
    if newest is not None:  # a last row that has expired isn't kept, so only rows of the last blocks are compared
        swaps = swaps.where(F.lit(newest) - F.col("logId") <= market.block_expiry)
    row = F.struct(*swaps.columns)
    is_usd = (F.col("token0.address") == market.usd_token) | (F.col("token1.address") == market.usd_token)
    quotes = swaps.where("isBasePool")
    last = F.max_by(row, F.col("logId")).alias("r")
    parts = [
        swaps.groupBy("address").agg(last),
        quotes.groupBy(F.col("pairedToken0.address").alias("address")).agg(last),
        quotes.where(is_usd).groupBy(F.lit("usd").alias("address")).agg(last),
    ]
    return reduce(DataFrame.unionByName, parts).select("r.*").dropDuplicates(["logId"])


def dealt_batch(batch: DataFrame, kept: DataFrame | None, folder: str, market: Market = MARKET, slices: int | None = None) -> DataFrame:
    """A batch and the rows kept from earlier ones, dealt in ``folder`` for the ordered steps."""
    rows = batch.withColumn(KEPT, F.lit(False))
    if kept is not None:
        rows = rows.unionByName(kept.withColumn(KEPT, F.lit(True)))
    return valuation.dealt_for_rates(rows, folder, market, slices, [pricing.delta_carry()])


def rate_batch(dealt: DataFrame, market: Market = MARKET, slices: int | None = None, conf: NumericConf = DEFAULT) -> DataFrame:
    """Deltas and exchange rates of a dealt batch."""
    return slicing.gathered(quoted_swaps(dealt, market, slices, conf)).where(~F.col(KEPT)).drop(KEPT)


def late_swaps(batch: DataFrame, kept: DataFrame) -> DataFrame:
    """Swaps at or before the last known swap of their pool."""
    last = kept.groupBy("address").agg(F.max("logId").alias("__last"))
    return batch.join(last, "address").where(F.col("logId") <= F.col("__last")).drop("__last")


def rated_batches(
    stream: DataFrame,
    target: str,
    state: str,
    checkpoint: str,
    market: Market = MARKET,
    live: bool = False,
    slices: int | None = None,
    conf: NumericConf = DEFAULT,
) -> StreamingQuery:
    """Rate and value a stream of priced swaps and merge it into ``target`` by date.

    ``state`` holds a small table for each of the last two batches, so a batch that is run
    again starts from the same rows and gives the same result.
    """
    schema = stream.schema

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # a missing state folder of an earlier batch is an error, not "no state"
        kept = spark.read.schema(schema).parquet(f"{state}/{batch_id - 1}") if batch_id else None
        files, folder = TableFiles(spark, state), f"{state}/_dealt-{batch_id}"
        files.delete(folder)
        dealt = dealt_batch(batch, kept, folder, market, slices)  # read by the check, the rating and the carried rows
        known = slicing.gathered(dealt)
        if kept is not None and not late_swaps(known.where(~F.col(KEPT)), kept).isEmpty():
            raise AssertionError("swaps found at or before the last known swap of their pool")
        rated = rate_batch(dealt, market, slices, conf)
        upsert_path(as_published(value_swaps(rated, market, conf=conf), RATED_SWAPS), target, batch_id=batch_id)
        carried_rows(known.select(schema.names), market).write.mode("overwrite").parquet(f"{state}/{batch_id}")
        files.delete(folder)
        files.delete(f"{state}/{batch_id - 2}")

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return with_trigger(writer, live).start()
