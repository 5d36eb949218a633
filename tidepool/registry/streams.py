"""Streams over the given tables, run to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators import staging, valuation
from tidepool.operators.pricing import swap_price, with_deltas
from tidepool.operators.projections import log_id
from tidepool.plans.rated_swaps import price_swaps
from tidepool.registry.market import _QUOTES
from tidepool.registry.ordered import _ASOF_KEYED, _DELTAS, DELTA_EXPIRY, KEYED_EXPIRY
from tidepool.registry.tables import MARKET, cents, raw_swaps, read, rounded, scratch_folder, text
from tidepool.streaming import buffer, logtail, microbatch, sink, stateful


def _use_state_store(spark):
    """Stateful steps with timers need the RocksDB store."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def _table_stream(spark, sf_dir, table):
    schema = read(spark, sf_dir, table).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)


def _run(stream, spark, name):
    """Drain a stream into files and read them."""
    folder = scratch_folder(spark, name)
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out")
    sink.drain(sink.with_trigger(writer.option("checkpointLocation", f"{folder}/checkpoint"), live=False).start())
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def _ticks(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("bigint")
    return _table_stream(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "user_id",
        (cents("value") + 1).alias("cents"),
        k.alias("k"),
        F.col("event_id").cast(stateful.AT_TYPE).alias("logId"),
        stateful.event_time("event_id").alias(stateful.EVENT_TIME),
    ).withWatermark(stateful.EVENT_TIME, "10000 seconds")


def stream_asof(spark, sf_dir):
    """Latest purchase of the same user, in a stream."""
    _use_state_store(spark)
    offered = _ticks(spark, sf_dir).withColumn("offer", F.when(F.col("event_type") == "purchase", text(F.col("cents"))))
    rated = stateful.carry_stream(offered, "user_id", "offer", "rate", KEYED_EXPIRY)
    done = _run(rated, spark, "stream-asof")
    return done.select(
        "event_id", "user_id", "event_type", "cents", F.when(F.col("offer").isNull(), F.col("rate").cast("bigint")).alias("rate")
    )


def stream_deltas(spark, sf_dir):
    """Change to the previous event of the same user, in a stream."""
    _use_state_store(spark)
    prices = {
        "price0": F.concat(text(F.col("cents")), F.lit("e2")),
        "price1": F.concat(text(F.col("k") + 1), F.lit("e1")),
        "tick": F.col("k"),
    }
    offered = _ticks(spark, sf_dir).withColumns(prices).withColumn("offer", F.to_json(F.struct(*prices)))
    carried = stateful.carry_stream(offered, "user_id", "offer", "found", DELTA_EXPIRY)
    previous = carried.withColumn("previous", F.from_json("found", stateful.PREVIOUS_TYPE))
    done = _run(with_deltas(previous, F.col("previous")), spark, "stream-deltas")
    return done.select(
        "event_id",
        F.col("user_id").alias("address"),
        "lastPrice0",
        "priceDelta0",
        "priceDelta1",
        rounded(F.col("priceDeltaPct0"), 6).alias("pct0"),
        rounded(F.col("priceDeltaPct1"), 6).alias("pct1"),
        "tickDelta",
    )


def stream_exchange_rates(spark, sf_dir):
    """The whole stateful chain over the buffered swaps of the market."""
    _use_state_store(spark)
    swaps = raw_swaps(spark, sf_dir).withColumn("logId", log_id("blockNumber", "transactionIndex", "logIndex"))
    prepared = valuation.exchange_rate_prep(swap_price(swaps), MARKET)
    folder = scratch_folder(spark, "buffer") + "/messages"
    buffer.write_buffer(prepared, folder)
    rated = stateful.rated_stream(buffer.read_buffer(spark, folder), prepared.schema, MARKET)
    bases = ("base0", "base1", "usdBase")
    done = _run(rated.select("blockNumber", *bases), spark, "stream-rates")
    return done.select(
        "blockNumber",
        *(F.col(f"{b}.poolAddress").alias(f"{b}_pool") for b in bases),
        *(F.col(f"{b}.logId").cast("bigint").alias(f"{b}_at") for b in bases),
    )


def stream_rated_batches(spark, sf_dir):
    """Quotes of the rated table after three micro-batches, each a part of the market's swaps."""
    folder = scratch_folder(spark, "rated-batches")
    last = raw_swaps(spark, sf_dir).agg(F.max("blockNumber")).first()[0]
    borders = [0, last // 3, last // 2, last + 1]
    for low, high in zip(borders[:-1], borders[1:]):
        part = price_swaps(raw_swaps(spark, sf_dir).where((F.col("blockNumber") >= low) & (F.col("blockNumber") < high)), MARKET)
        with staging.shuffles_removed(spark):
            part.write.mode("append").option("compression", "zstd").parquet(f"{folder}/arrived")
        arrived = spark.readStream.schema(part.schema).parquet(f"{folder}/arrived")
        sink.drain(microbatch.rated_batches(arrived, f"{folder}/rated", f"{folder}/state", f"{folder}/checkpoint", MARKET))
    bases = ("base0", "base1", "usdBase")
    return spark.read.parquet(f"{folder}/rated").select(
        "blockNumber",
        *(F.col(f"{b}.poolAddress").alias(f"{b}_pool") for b in bases),
        *(F.col(f"{b}.logId").cast("bigint").alias(f"{b}_at") for b in bases),
    )


def stream_log_lines(spark, sf_dir):
    """Container lines that arrive in two parts, tailed, joined with their pods' labels and rolled by date."""
    folder, schema = scratch_folder(spark, "tail"), "time TIMESTAMP, stream STRING, log STRING, pod_name STRING, app STRING, date DATE"
    e = read(spark, sf_dir, "events")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    plain = F.concat(stamp, F.lit(" stderr F line "), text(F.col("event_id")))
    as_json = F.to_json(F.struct(F.concat(F.lit("line "), text(F.col("event_id"))).alias("log"), F.lit("stdout").alias("stream"), stamp.alias("time")))
    lines = e.select(F.when(F.col("event_id") % 2 == 0, plain).otherwise(as_json).alias("value"), "event_id", F.col("event_type").alias("pod"))
    types = e.select(F.col("event_type").alias("pod_name")).distinct()
    pods = types.where("pod_name <> 'error'").select("pod_name", F.upper("pod_name").alias("app"))
    for part in (0, 1):
        # a folder per pod stands for its log file's name
        lines.where(F.col("event_id") % 3 == 0 if part == 0 else F.col("event_id") % 3 > 0).select("value", "pod").write.mode("append").partitionBy("pod").text(f"{folder}/lines")
        stream = logtail.tail_logs(spark, f"{folder}/lines", pods, r"/pod=([^/]+)/")
        sink.drain(logtail.roll_logs(stream, f"{folder}/rolled", f"{folder}/checkpoint"))
    rolled = spark.read.schema(schema).json(f"{folder}/rolled")
    return rolled.select(F.col("date").cast("string").alias("date"), F.unix_millis("time").alias("ms"), "stream", "log", "pod_name", "app")


def stream_upsert(spark, sf_dir):
    """Orders streamed into a table partitioned by status, twice over, keyed by order."""
    folder = scratch_folder(spark, "upsert")
    for run in (1, 2):
        orders = _table_stream(spark, sf_dir, "orders").select(
            F.col("o_orderstatus").alias("date"), F.col("o_orderkey").alias("logId"), (F.col("o_custkey") * run).alias("v")
        )
        sink.drain(sink.upsert_stream(orders, f"{folder}/table", f"{folder}/checkpoint{run}"))
    return spark.read.parquet(f"{folder}/table").select("date", "logId", "v")


QUERIES = {
    "stream_asof": (stream_asof, _ASOF_KEYED),
    "stream_deltas": (stream_deltas, _DELTAS),
    "stream_exchange_rates": (stream_exchange_rates, _QUOTES),
    "stream_rated_batches": (stream_rated_batches, _QUOTES),
    "stream_log_lines": (
        stream_log_lines,
        """SELECT strftime(ts, '%Y-%m-%d') AS date, epoch_us(ts) // 1000 AS ms, CASE WHEN event_id % 2 = 0 THEN 'stderr' ELSE 'stdout' END AS stream,
            concat('line ', event_id) AS log, event_type AS pod_name, CASE WHEN event_type <> 'error' THEN upper(event_type) END AS app FROM events""",
    ),
    "stream_upsert": (
        stream_upsert,
        "SELECT o_orderstatus AS date, o_orderkey AS logId, o_custkey * 2 AS v FROM orders",
    ),
}
