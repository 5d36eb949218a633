"""Stateful steps on the swap stream: deltas per pool and as-of exchange rates.

One keyed operator serves all of them: it remembers the last value offered under a
key and hands it to the rows that follow until it expires. The swap itself travels
as one JSON text, so only the few columns the operator needs are decoded.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidepool.functions.numeric import NumericConf
from tidepool.functions.scalars import DEFAULT
from tidepool.operators.market import Market
from tidepool.operators.pricing import with_deltas

MARKET = Market()
EVENT_TIME = "blockNumberTs"
AT_TYPE = "decimal(38,18)"
QUOTE_TYPE = "poolAddress STRING, price STRING, is1 BOOLEAN, logId DECIMAL(38,18)"
PREVIOUS_TYPE = "price0 STRING, price1 STRING, tick BIGINT"
#: Blocks of a range at least: a key's rows of that many blocks meet in one group.
RANGE_BLOCKS = 2000


class LateRow(AssertionError):
    """A row at or before the value already held under its key."""


class CarryLast(StatefulProcessor):
    """Per key: the last offered text, given to later rows within ``expiry`` blocks."""

    def __init__(self, order: str, offer: str, found: str, columns: list[str], expiry: int, late: str):
        self.order, self.offer, self.found = order, offer, found
        self.columns, self.expiry, self.late = columns, expiry, late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("at", T.DecimalType(38, 18))])
        self.held = handle.getValueState("held", schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        times = batch[self.order].tolist()
        offers = batch[self.offer].tolist()
        known = self.held.exists()
        text, at = self.held.get() if known else (None, None)
        if known and min(times) <= at and self.late == "fail":
            raise LateRow(f"{min(times)} found after {at} under {key}")

        chosen, found, newest = [], [], None
        before = at
        for i in sorted(range(len(times)), key=times.__getitem__):
            now = times[i]
            if before is not None and now <= before:
                continue  # late, to be dropped
            chosen.append(i)
            found.append(text if at is not None and now - at <= self.expiry else None)
            if isinstance(offers[i], str):
                text, at = offers[i], now
            newest = now
        if not chosen:
            return

        if at is not None:
            self.held.update((text, at))
            if known:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
            self.handle.registerTimer((int(newest) + 1 + self.expiry) * 1000)
        out = batch.iloc[chosen].copy()
        out[self.found] = pd.Series(found, dtype=object, index=out.index)
        yield out[self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        return iter([])

    def close(self) -> None:
        pass


def event_time(block: str | Column) -> Column:
    """Block number read as seconds; shifted by one so that block 0 is not at the initial watermark."""
    block = F.col(block) if isinstance(block, str) else block
    return F.timestamp_seconds(block + 1)


def carry_stream(
    df: DataFrame, key: str | Sequence[str], offer: str, found: str, expiry: int, order: str = "logId", late: str = "fail"
) -> DataFrame:
    """Add ``found``: the last text offered earlier under the key (``late``: fail or drop).

    The rows of a key in a micro-batch are one group; ``carry_in_ranges`` cuts busy keys.
    """
    if late not in ("fail", "drop"):
        raise ValueError("late must be fail or drop")
    schema = T.StructType(df.schema.fields + [T.StructField(found, T.StringType())])
    processor = CarryLast(order, offer, found, schema.names, expiry, late)
    return df.groupBy(*([key] if isinstance(key, str) else key)).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="append",
        timeMode="EventTime",
        eventTimeColumnName=EVENT_TIME,
    )


def opened(messages: DataFrame, schema: T.StructType, market: Market = MARKET) -> DataFrame:
    """Messages with the columns the stateful steps need, watermarked on synthetic time."""
    d = F.from_json("value", schema)
    parsed = messages.select("value", d.alias("d"))
    trades_usd = (F.col("d.token0.address") == market.usd_token) | (F.col("d.token1.address") == market.usd_token)
    quote = F.to_json(
        F.struct(
            F.col("d.address").alias("poolAddress"),
            F.col("d.price1").alias("price"),
            F.col("d.is1").alias("is1"),
            F.col("d.logId").cast(AT_TYPE).alias("logId"),
        )
    )
    is_base = F.coalesce(F.col("d.isBasePool"), F.lit(False))
    return parsed.select(
        "value",
        event_time("d.blockNumber").alias(EVENT_TIME),
        F.col("d.logId").cast(AT_TYPE).alias("logId"),
        F.coalesce("d.address", F.lit("")).alias("address"),
        F.coalesce("d.pairedToken0.address", F.lit("")).alias("paired0"),
        F.coalesce("d.pairedToken1.address", F.lit("")).alias("paired1"),
        F.lit("").alias("all"),
        F.col("d.blockNumber").cast("bigint").alias("block"),
        F.to_json(F.struct("d.price0", "d.price1", "d.tick")).alias("offerSwap"),
        F.when(is_base, quote).alias("offerBase"),
        F.when(is_base & F.coalesce(trades_usd, F.lit(False)), quote).alias("offerUsd"),
    ).withWatermark(EVENT_TIME, f"{market.block_expiry} seconds")


def carry_in_ranges(
    stream: DataFrame, key: str, offer: str, found: str, expiry: int, late: str = "fail", blocks: int = RANGE_BLOCKS
) -> DataFrame:
    """``carry_stream`` per key and range of blocks, with the same result; needs ``block`` and ``value``.

    No offer outlives ``expiry`` blocks, so those of a range's last blocks are also sent, without their
    swap, to the next range. Those of its first blocks are sent to the range before, where they tell
    late rows. However busy a key is, a group has the rows of one range and the offers beside it.
    """
    length = max(expiry, blocks)
    own, inside = F.floor(F.col("block") / length).cast("bigint"), F.pmod("block", F.lit(length))
    # an order key lies between its block and the next one
    places = F.filter(
        F.array(
            own,
            F.when(F.col(offer).isNotNull() & (inside + 1 + expiry >= length), own + 1),
            F.when(F.col(offer).isNotNull() & (inside <= expiry), own - 1),
        ),
        lambda place: place.isNotNull(),
    )
    placed = stream.withColumn("blockRange", F.explode(places)).withColumn("copied", F.col("blockRange") != own)
    bare = placed.withColumn("value", F.when(~F.col("copied"), F.col("value")))
    carried = carry_stream(bare, [key, "blockRange"], offer, found, expiry, late=late)
    return carried.where(~F.col("copied")).drop("blockRange", "copied")


def rated_stream(
    messages: DataFrame,
    schema: T.StructType,
    market: Market = MARKET,
    late: str = "fail",
    conf: NumericConf = DEFAULT,
) -> DataFrame:
    """Deltas, base quotes of both tokens and the USD quote for a stream of swaps.

    A pool may be busy, and the USD quote is one for all swaps; all four steps carry per range of blocks.
    """
    stream = opened(messages, schema, market).observe("rows_in", F.count(F.lit(1)).alias("rows"))
    for key, offer, found in (
        ("address", "offerSwap", "foundSwap"),
        ("paired0", "offerBase", "found0"),
        ("paired1", "offerBase", "found1"),
        ("all", "offerUsd", "foundUsd"),
    ):
        stream = carry_in_ranges(stream, key, offer, found, market.block_expiry, late)
    stream = stream.observe("rows_out", F.count(F.lit(1)).alias("rows"))

    def quote(found: str, offer: str) -> Column:
        return F.when(F.col(offer).isNull(), F.from_json(found, QUOTE_TYPE))

    rows = stream.select(
        F.from_json("value", schema).alias("d"),
        EVENT_TIME,
        F.from_json("foundSwap", PREVIOUS_TYPE).alias("__previous"),
        quote("found0", "offerBase").alias("base0"),
        quote("found1", "offerBase").alias("base1"),
        quote("foundUsd", "offerUsd").alias("usdBase"),
    ).select("d.*", EVENT_TIME, "__previous", "base0", "base1", "usdBase")
    return with_deltas(rows, F.col("__previous"), conf).drop("__previous")


def rows_conserved(progress: dict) -> bool:
    """Whether a progress report shows as many rows out of the stateful steps as in."""
    seen = progress.get("observedMetrics") or {}
    counts = {name: (row["rows"] if isinstance(row, dict) else row.rows) for name, row in seen.items()}
    return counts.get("rows_in") == counts.get("rows_out")
