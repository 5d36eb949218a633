"""Chain sources, landing jobs, logs and published tables over the given tables."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from tidepool.functions import ubi_canonical
from tidepool.operators import projections
from tidepool.plans import catalog
from tidepool.registry.tables import LINES_SQL, MARKET, TICKS_SQL, cents, epoch_seconds, lines, raw_swaps, read, rounded, scratch_folder, text, ticks
from tidepool.sources import chain, landing, logs
from tidepool.streaming.buffer import messages

# warm-up as long as the epoch, so that the epoch filter keeps every row
WHOLE_CHAIN = replace(MARKET, block_expiry=MARKET.epoch_length)

# -- chain sources ---------------------------------------------------------------


def factory_events(spark, sf_dir):
    """part as pool creations: brand and type are the tokens."""
    args = F.to_json(
        F.struct(
            F.col("p_brand").alias("token0"),
            F.col("p_type").alias("token1"),
            (F.col("p_size") * 100).alias("fee"),
            F.lit(60).alias("tickSpacing"),
            F.when(F.col("p_size") != 7, text(F.col("p_partkey"))).alias("pool"),
        )
    )
    return read(spark, sf_dir, "part").select(
        F.lit("Factory").alias("contract"),
        F.lit("PoolCreated").alias("event"),
        args.alias("args"),
        F.col("p_partkey").alias("blockNumber"),
        (F.col("p_size") % 5).alias("epoch"),
    )


def token_table(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    brands = part.select(F.col("p_brand").alias("address")).distinct()
    return brands.select(F.lower("address").alias("symbol"), F.length("address").alias("decimals"), "address")


def pools(spark, sf_dir):
    found = chain.pools(factory_events(spark, sf_dir), token_table(spark, sf_dir))
    return found.select("address", "pool", "fee", "tickSpacing", F.col("token0.symbol").alias("symbol0"),
        F.col("token0.decimals").cast("int").alias("decimals0"), F.col("token1.symbol").alias("symbol1"))


def blocks(spark, sf_dir):
    """orders as blocks, their lines as transactions."""
    spent = lines(spark, sf_dir).groupBy("l_orderkey").agg(
        F.collect_list(
            F.struct(
                F.concat_ws("-", "l_partkey", "l_suppkey").alias("hash"),
                F.col("qty").alias("gas"),
                F.col("cents").alias("gasPrice"),
                (F.col("cents").cast("decimal(38,0)") * F.lit("1" + "0" * 20).cast("decimal(38,0)")).cast("decimal(38,0)").alias("value"),
            )
        ).alias("transactions")
    )
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("number"),
        epoch_seconds("o_orderdate").cast("bigint").alias("timestamp"),
        (cents("o_totalprice") % 1000).alias("baseFeePerGas"),
        (F.col("o_orderkey").cast("decimal(38,0)") * F.lit("1" + "0" * 25).cast("decimal(38,0)")).cast("decimal(38,0)").alias("totalDifficulty"),
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("epoch"),
    )
    return orders.join(spent, F.col("number") == F.col("l_orderkey")).drop("l_orderkey")


def transactions(spark, sf_dir):
    found = chain.transactions(blocks(spark, sf_dir), 1, WHOLE_CHAIN)
    return found.select("blockNumber", "timestamp", "transactionHash", "gas", "gasPrice", "baseFeePerGas", "gasFees", "tip")


def swaps(spark, sf_dir):
    """Swap events with JSON arguments, decoded; big integers keep all digits."""
    raw = raw_swaps(spark, sf_dir).withColumns({"recipient": F.lit("r"), "sender": F.lit("s")})
    args = chain.encode_args(["amount0", "amount1", "liquidity", "recipient", "sender", "sqrtPriceX96", "tick"])
    events = raw.select("address", "blockNumber", "contract", "event", "epoch", args.alias("args"))
    return chain.swaps(events, 1, WHOLE_CHAIN).drop("contract", "event", "epoch")


# -- landing -----------------------------------------------------------------------


def _logs(spark, sf_dir):
    return ticks(spark, sf_dir).select(
        F.col("event_type").alias("topic"),
        text(F.col("user_id")).alias("address"),
        F.col("event_id").alias("blockNumber"),
        "k",
        "cents",
    )


def _contracts(spark, sf_dir):
    nations = ["AUTOMOBILE", "BUILDING", "MACHINERY"]
    return (
        read(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment").isin(*nations))
        .select(text(F.col("c_custkey")).alias("address"), F.col("c_mktsegment").alias("contract"))
    )


def land_events(spark, sf_dir):
    topics = ["click", "purchase", "view"]
    return landing.land_events(_logs(spark, sf_dir), _contracts(spark, sf_dir), topics, ["k", "cents"])


def landed_partitions(spark, sf_dir):
    """Landed events written by contract and epoch, read back with one partition filter."""
    path = scratch_folder(spark, "events") + "/landed"
    landing.write_partitioned(land_events(spark, sf_dir), path, ["contract", "epoch"])
    back = spark.read.parquet(path).where((F.col("contract") == "BUILDING") & (F.col("epoch") >= 0))
    return back.groupBy("topic", "contract", "epoch").agg(F.count(F.lit(1)).alias("n"))


def decode_words(spark, sf_dir):
    def word(x):
        return F.concat(F.when(x < 0, F.repeat(F.lit("f"), F.lit(48))).otherwise(F.repeat(F.lit("0"), F.lit(48))), F.lpad(F.lower(F.hex(x)), 16, "0"))

    data = F.concat(F.lit("0x"), word(F.col("k") - 50), word(F.col("cents")), F.lpad(F.lower(F.hex("event_id")), 64, "0"))
    decoded = landing.decode_words(data, {"delta": "int", "amount": "uint", "owner": "address"})
    return ticks(spark, sf_dir).select("event_id", decoded.alias("d")).select(
        "event_id", F.col("d.delta").cast("bigint").alias("delta"), F.col("d.amount").cast("bigint").alias("amount"), F.col("d.owner").alias("owner")
    )


def discover_pools(spark, sf_dir):
    created = factory_events(spark, sf_dir)
    found = landing.discover_pools(created, 3, created.where(F.col("epoch") == 3))
    return found.select("address", "startBlock", "name")


def start_epoch(spark, sf_dir):
    starts = read(spark, sf_dir, "orders").groupBy("o_custkey").agg((F.min("o_orderkey") + 70_000).alias("startBlock"))
    return landing.start_epoch(starts)


def hash_workers(spark, sf_dir):
    """Every address has one worker in range."""
    placed = landing.hash_partition(read(spark, sf_dir, "customer"), "c_name", 96)
    per_name = placed.groupBy("c_name").agg(F.countDistinct("worker").alias("workers"), F.min("worker").alias("low"), F.max("worker").alias("high"))
    return per_name.agg(
        F.count(F.lit(1)).alias("names"), F.max("workers").alias("most"),
        F.min(F.when((F.col("low") >= 0) & (F.col("high") < 96), 1).otherwise(0)).alias("in_range"),
    )


def land_blocks(spark, sf_dir):
    landed = landing.land_blocks(blocks(spark, sf_dir).drop("epoch"))
    return landed.select(F.col("number"), "totalDifficulty", "epoch", F.explode("transactions").alias("t")).select(
        "number", "totalDifficulty", "epoch", F.col("t.hash").alias("hash"), F.col("t.value").alias("value")
    )


def discover_tokens(spark, sf_dir):
    return landing.discover_tokens(factory_events(spark, sf_dir), ["args.token0", "args.token1", "event"])


def token_metadata(spark, sf_dir):
    found = discover_tokens(spark, sf_dir)
    return landing.token_metadata(found, token_table(spark, sf_dir))


def next_epoch(spark, sf_dir):
    markers = read(spark, sf_dir, "orders").select(
        F.floor(F.col("o_orderkey") / 100).cast("int").alias("epoch"),
        (F.floor(F.col("o_orderkey") / 100) * 30_000 + F.when(F.col("o_orderkey") < 2000, 60_000).otherwise(59_999)).alias("last_block"),
    )
    return landing.next_epoch(markers, 1)


# -- logs ----------------------------------------------------------------------------


def _log_lines(spark, sf_dir):
    """events as container log lines carrying operation profiles."""
    e = ticks(spark, sf_dir)
    body = F.to_json(
        F.struct(F.upper(F.substring("event_type", 1, 1)).alias("op"), F.col("cents").alias("ns"), *(
            (F.col("k") * i).alias(f"t{i}") for i in (1, 2, 3)
        ))
    )
    line = F.when(F.col("k") % 10 == 3, F.concat(F.lit("removed timed out "), F.col("event_type"), F.lit(" state in base0 mapping")))
    return e.select(
        F.coalesce(line, F.concat(F.lit("24/01/01 INFO root: "), body)).alias("log"),
        F.col("ts").alias("time"),
        F.struct(
            F.concat(F.lit("run-pool-swaps-"), F.col("event_type"), F.lit("-exec-"), text(F.col("user_id") % 7)).alias("pod_name"),
            F.struct(F.lit("pool").alias("app"), F.lit("executor").alias("spark-role")).alias("labels"),
        ).alias("kubernetes"),
        "event_id",
    )


def pods(spark, sf_dir):
    found = logs.pods(_log_lines(spark, sf_dir), "%swaps%")
    return found.withColumn("start_time", (epoch_seconds("start_time") * 1_000_000).cast("bigint"))


def expiry_lines(spark, sf_dir):
    found = logs.matching_lines(_log_lines(spark, sf_dir), "run-pool-swaps-%-exec-%", "%removed timed out % state in base0 mapping%")
    return found.groupBy("exec", "log").agg(F.count(F.lit(1)).alias("n"))


def _profile(spark, sf_dir):
    return logs.profile_records(_log_lines(spark, sf_dir), "run-pool-swaps-%", "op")


def profile_records(spark, sf_dir):
    return _profile(spark, sf_dir).groupBy("exec", "op", "t1").agg(F.count(F.lit(1)).alias("n"), F.sum("ns").alias("ns"))


def operation_costs(spark, sf_dir):
    costs = logs.operation_costs(_profile(spark, sf_dir))
    return costs.withColumn("avg_ns", rounded(F.col("avg_ns"), 4))


def phase_costs(spark, sf_dir):
    return logs.phase_costs(_profile(spark, sf_dir), "S").select(*(rounded(F.col(f"avg_t{i}"), 4).alias(f"avg_t{i}") for i in (1, 2, 3)))


def log_table(spark, sf_dir):
    """Logs as JSON files, some lines cut short, declared as a table; profiles of it are kept and read twice."""
    folder, name = scratch_folder(spark, "log-table"), f"profiles_{uuid.uuid4().hex}"
    lines = _log_lines(spark, sf_dir)
    body = F.to_json(F.struct("log", "time", F.lit("stderr").alias("stream"), "kubernetes"))
    cut = F.when(F.col("event_id") % 50 == 0, F.substring(body, 1, 30)).otherwise(body)
    lines.select(cut.alias("value")).write.text(folder)
    table = logs.declare_log_table(spark, folder, f"log_{uuid.uuid4().hex}")
    sound = table.where(F.col("corrupt").isNull())
    kept = logs.cache_lazily(logs.profile_records(sound, "run-pool-swaps-%", "op").select("exec", "op", "ns"), name)
    total = F.sum("ns").alias("ns")
    parts = [
        kept.groupBy(F.lit("exec").alias("kind"), F.col("exec").alias("name")).agg(F.count("*").alias("n"), total),
        kept.groupBy(F.lit("op").alias("kind"), F.col("op").alias("name")).agg(F.count("*").alias("n"), total),
        table.where(F.col("corrupt").isNotNull() & F.col("stream").isNull()).groupBy(F.lit("corrupt").alias("kind"), F.substring("corrupt", 1, 6).alias("name")).agg(
            F.count("*").alias("n"), F.lit(None).cast("bigint").alias("ns")
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def landed_templates(spark, sf_dir):
    """Customers as discovered contracts, named by segment, with file and events of their template."""
    templates = [
        {"name": n, "source": {"abi": n}, "mapping": {"abis": [{"name": "Other", "file": "other.json"}, {"name": n, "file": f"{n.lower()}.json"}], "eventHandlers": [{"event": e} for e in events]}}
        for n, events in (("AUTOMOBILE", ["Swap", "Mint"]), ("BUILDING", ["Swap"]), ("MACHINERY", []))
    ]
    found = read(spark, sf_dir, "customer").select(text(F.col("c_custkey")).alias("address"), F.col("c_mktsegment").alias("name"))
    attached = landing.attach_templates(found, landing.contract_templates(spark, {"templates": templates}))
    return attached.select("address", "name", "abi", F.array_join("events", ",").alias("events"))


def null_extended(spark, sf_dir):
    """Ticks in the shape of rated swaps, sides swapped by the names' twins; what they lack is a typed NULL."""
    sides = ticks(spark, sf_dir).select(F.col("event_id").alias("blockNumber"), F.col("event_type").alias("address"), text(F.col("cents")).alias("amount0"), text(F.col("k")).alias("amount1"))
    swapped = sides.select("blockNumber", "address", *(F.col(projections.twin(n)).alias(n) for n in ("amount0", "amount1")))
    shaped = catalog.as_published(swapped, catalog.RATED_SWAPS)
    odd = F.concat_ws(",", *(F.when(F.col(f.name).isNull(), f.name) for f in shaped.schema if f.name in ("date", "tick", "usdBase", "usdAmounts")))
    return shaped.select("blockNumber", "address", "amount0", "amount1", F.unix_seconds("blockNumberTs").alias("seconds"), odd.alias("missing"), F.lit(len(shaped.columns)).alias("width"))


def container_lines(spark, sf_dir):
    e = ticks(spark, sf_dir)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    plain = F.concat(stamp, F.lit(" stderr F "), F.col("event_type"))
    as_json = F.to_json(F.struct(F.col("event_type").alias("log"), F.lit("stdout").alias("stream"), stamp.alias("time")))
    parsed = logs.parse_container_lines(e.select("event_id", F.when(F.col("k") % 2 == 0, plain).otherwise(as_json).alias("value")), keep=("event_id",))
    return parsed.select("event_id", F.unix_millis("time").alias("ms"), "stream", "log", text(F.col("date")).alias("date"))


def counter_rates(slices):
    def query(spark, sf_dir):
        samples = read(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").alias("time"), "value")
        found = logs.counter_rates(samples, ["user_id", "event_type"], ["event_type"], 3600, slices)
        return found.select(epoch_seconds("start").cast("bigint").alias("start"), "event_type", rounded(F.col("rate"), 8).alias("rate"))

    return query


def gauges(negate):
    def query(spark, sf_dir):
        samples = read(spark, sf_dir, "events").where(F.col("event_type").rlike("^(click|view)$")).select(
            "user_id", "event_type", F.col("ts").alias("time"), "value"
        )
        found = logs.latest_gauges(samples, ["user_id", "event_type"], ["event_type"], negate)
        return found.select("event_type", rounded(F.col("value"), 4).alias("value"))

    return query


# -- buffer and published tables --------------------------------------------------------


def ordered_messages(spark, sf_dir):
    """Buffer messages in event order, decoded again."""
    e = ticks(spark, sf_dir).select(F.col("event_type").alias("address"), F.col("event_id").alias("logId"), "cents")
    back = messages(e).select("key", F.from_json("value", "address STRING, logId BIGINT, cents BIGINT").alias("d"))
    return back.select("key", "d.*")


def published_table(spark, sf_dir):
    """Daily table: create, write one partition per day, discover, add empty days, read one query."""
    location = scratch_folder(spark, "daily") + "/table"
    name = "tidepool_daily_events"
    e = ticks(spark, sf_dir).withColumn("date", text(F.to_date("ts")))
    daily = e.groupBy("event_type", "date").agg(F.sum("cents").alias("cents"))
    landing.write_partitioned(daily, location, ["date"])
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    catalog.create_table(spark, name, "event_type STRING, cents BIGINT", location)
    catalog.discover_partitions(spark, name)
    catalog.add_partitions(spark, name, "2024-02-03")
    days = spark.sql(f"SHOW PARTITIONS {name}").select(F.split("partition", "=")[1].alias("date"))
    table = spark.table(name).select("event_type", "cents", text(F.col("date")).alias("date"))
    return days.join(table, "date", "left").select("date", "event_type", "cents")


def canonical(spark, sf_dir):
    """Plain decimals in printed form."""
    part = read(spark, sf_dir, "part")
    plain = F.concat(text(F.col("p_partkey")), F.lit("."), F.lpad(text(F.col("p_size")), 2, "0"))
    return part.select("p_partkey", ubi_canonical(plain).alias("v"))


_BLOCKS = f"""{LINES_SQL}, blocks AS (
    SELECT o_orderkey AS number, CAST(epoch(o_orderdate) AS BIGINT) AS timestamp,
        CAST(round(o_totalprice * 100) AS BIGINT) % 1000 AS base_fee, l_partkey, l_suppkey, qty, cents
    FROM orders JOIN lines ON o_orderkey = l_orderkey
)"""
_LOGS = f"""{TICKS_SQL}, logs AS (
    SELECT *, concat('run-pool-swaps-', event_type, '-exec-', user_id % 7) AS pod, k % 10 = 3 AS expired,
        CAST(user_id % 7 AS VARCHAR) AS exec, upper(event_type[1]) AS op FROM ticks
)"""
_RATES = """WITH s AS (
    SELECT *, lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts) AS b FROM events
) SELECT CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS start, event_type,
    round(sum(CASE WHEN b IS NULL THEN 0 WHEN value < b THEN value ELSE value - b END) / 3600, 8) + 0.0 AS rate
FROM s GROUP BY 1, 2"""


def _gauge_sql(sign):
    return f"""WITH l AS (SELECT event_type, user_id, max_by(value, ts) AS v FROM events
        WHERE event_type IN ('click', 'view') GROUP BY ALL)
    SELECT event_type, round({sign} sum(v), 4) + 0.0 AS value FROM l GROUP BY ALL"""


QUERIES = {
    "log_table": (
        log_table,
        f"""WITH {_LOGS}, sound AS (SELECT * FROM logs WHERE event_id % 50 <> 0 AND NOT expired)
        SELECT 'exec' AS kind, exec AS name, count(*) AS n, CAST(sum(cents) AS BIGINT) AS ns FROM sound GROUP BY exec
        UNION ALL SELECT 'op', op, count(*), CAST(sum(cents) AS BIGINT) FROM sound GROUP BY op
        UNION ALL SELECT 'corrupt', '{{"log"', count(*), NULL FROM logs WHERE event_id % 50 = 0 GROUP BY ALL""",
    ),
    "landed_templates": (
        landed_templates,
        """SELECT CAST(c_custkey AS VARCHAR) AS address, c_mktsegment AS name,
            CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') THEN concat(lower(c_mktsegment), '.json') END AS abi,
            CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Swap,Mint' WHEN 'BUILDING' THEN 'Swap' WHEN 'MACHINERY' THEN '' END AS events FROM customer""",
    ),
    "null_extended": (
        null_extended,
        f"""WITH {TICKS_SQL} SELECT event_id AS blockNumber, event_type AS address, CAST(k AS VARCHAR) AS amount0, CAST(cents AS VARCHAR) AS amount1,
            event_id AS seconds, 'tick,usdBase,usdAmounts,date' AS missing, CAST(63 AS INTEGER) AS width FROM ticks""",
    ),
    "pools": (
        pools,
        """SELECT CASE WHEN p_size <> 7 THEN CAST(p_partkey AS VARCHAR) END AS address,
            concat(lower(p_brand), '_', p_size) AS pool, CAST(p_size AS BIGINT) * 100 AS fee, CAST(60 AS BIGINT) AS tickSpacing,
            lower(p_brand) AS symbol0, CAST(length(p_brand) AS INTEGER) AS decimals0, CAST(NULL AS VARCHAR) AS symbol1 FROM part""",
    ),
    "transactions": (
        transactions,
        f"""WITH {_BLOCKS} SELECT number AS blockNumber, timestamp, concat(l_partkey, '-', l_suppkey) AS transactionHash,
            qty AS gas, concat(cents, 'e18') AS gasPrice, concat(base_fee, 'e18') AS baseFeePerGas,
            concat(qty * cents, 'e18b0/1e0b0') AS gasFees, concat(cents - base_fee, 'e18b0/1e0b0') AS tip FROM blocks""",
    ),
    "swap_events": (
        swaps,
        f"""WITH {TICKS_SQL} SELECT event_type AS address, event_id AS blockNumber,
            CAST(CASE WHEN k < 50 THEN 1 ELSE -1 END * cents * 1000 AS VARCHAR) AS amount0,
            CAST(CASE WHEN k < 50 THEN -1 ELSE 1 END * cents * 3000 AS VARCHAR) AS amount1,
            CAST(cents * 1000000 AS VARCHAR) AS liquidity, 'r' AS recipient, 's' AS sender,
            concat(cents, repeat('0', 25)) AS sqrtPriceX96, k * 10 - 500 AS tick FROM ticks""",
    ),
    "land_events": (
        land_events,
        f"""WITH {TICKS_SQL} SELECT event_type AS topic, CAST(user_id AS VARCHAR) AS address, event_id AS blockNumber,
            c_mktsegment AS contract, CAST(event_id // 30000 AS INTEGER) AS epoch,
            concat('{{"k":', k, ',"cents":', cents, '}}') AS args
        FROM ticks JOIN customer ON c_custkey = user_id
        WHERE event_type IN ('click', 'purchase', 'view') AND c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')""",
    ),
    "landed_partitions": (
        landed_partitions,
        """SELECT event_type AS topic, c_mktsegment AS contract, CAST(event_id // 30000 AS INTEGER) AS epoch, count(*) AS n
        FROM events JOIN customer ON c_custkey = user_id
        WHERE event_type IN ('click', 'purchase', 'view') AND c_mktsegment = 'BUILDING' GROUP BY ALL""",
    ),
    "decode_words": (
        decode_words,
        f"""WITH {TICKS_SQL} SELECT event_id, k - 50 AS delta, cents AS amount,
            concat('0x', lpad(lower(hex(event_id)), 40, '0')) AS owner FROM ticks""",
    ),
    "discover_pools": (
        discover_pools,
        """SELECT CAST(p_partkey AS VARCHAR) AS address, p_partkey AS startBlock, 'Pool' AS name
        FROM part WHERE p_size <> 7 AND p_size % 5 <= 3""",
    ),
    "start_epoch": (start_epoch, "SELECT CAST((min(o_orderkey) + 70000) // 30000 AS INTEGER) AS epoch FROM orders"),
    "hash_workers": (
        hash_workers,
        "SELECT count(DISTINCT c_name) AS names, CAST(1 AS BIGINT) AS most, 1 AS in_range FROM customer",
    ),
    "land_blocks": (
        land_blocks,
        f"""WITH {_BLOCKS} SELECT number, CASE WHEN number = 0 THEN '0' ELSE concat(number, repeat('0', 25)) END AS totalDifficulty,
            CAST(number // 30000 AS INTEGER) AS epoch, concat(l_partkey, '-', l_suppkey) AS hash,
            concat(cents, repeat('0', 20)) AS value FROM blocks""",
    ),
    "discover_tokens": (
        discover_tokens,
        "SELECT p_brand AS address FROM part UNION SELECT p_type FROM part UNION SELECT 'PoolCreated' FROM part",
    ),
    "token_metadata": (
        token_metadata,
        """SELECT p_brand AS address, lower(p_brand) AS symbol, CAST(length(p_brand) AS INTEGER) AS decimals FROM part
        UNION SELECT p_type, p_type, 0 FROM part UNION SELECT 'PoolCreated', 'PoolCreated', 0 FROM part""",
    ),
    "next_epoch": (
        next_epoch,
        """WITH m AS (SELECT o_orderkey // 100 AS e, max(CASE WHEN o_orderkey < 2000 THEN 60000 ELSE 59999 END) AS ahead
            FROM orders GROUP BY ALL)
        SELECT CAST(min(c.e) AS INTEGER) AS epoch FROM (SELECT 1 AS e UNION SELECT e + 1 FROM m WHERE ahead >= 60000) c
        WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.e = c.e AND ahead >= 60000)""",
    ),
    "log_pods": (
        pods,
        f"""WITH {_LOGS} SELECT pod AS pod_name, 'pool' AS app, 'executor' AS role, count(*) AS logs,
            epoch_us(min(ts)) AS start_time FROM logs GROUP BY ALL""",
    ),
    "log_expiry_lines": (
        expiry_lines,
        f"""WITH {_LOGS} SELECT exec, concat('removed timed out ', event_type, ' state in base0 mapping') AS log, count(*) AS n
        FROM logs WHERE expired GROUP BY ALL""",
    ),
    "log_profile": (
        profile_records,
        f"""WITH {_LOGS} SELECT exec, op, k AS t1, count(*) AS n, CAST(sum(cents) AS BIGINT) AS ns FROM logs WHERE NOT expired GROUP BY ALL""",
    ),
    "log_operation_costs": (
        operation_costs,
        f"""WITH {_LOGS} SELECT op, count(*) AS ops, CAST(sum(cents) AS BIGINT) AS total_ns, round(avg(cents), 4) + 0.0 AS avg_ns
        FROM logs WHERE NOT expired GROUP BY ALL""",
    ),
    "log_phase_costs": (
        phase_costs,
        f"""WITH {_LOGS} SELECT round(avg(k), 4) + 0.0 AS avg_t1, round(avg(k * 2), 4) + 0.0 AS avg_t2, round(avg(k * 3), 4) + 0.0 AS avg_t3
        FROM logs WHERE NOT expired AND op = 'S'""",
    ),
    "container_lines": (
        container_lines,
        f"""WITH {TICKS_SQL} SELECT event_id, epoch_us(ts) // 1000 AS ms, CASE WHEN k % 2 = 0 THEN 'stderr' ELSE 'stdout' END AS stream,
            event_type AS log, CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM ticks""",
    ),
    "counter_rates": (counter_rates(None), _RATES),
    "counter_rates_sliced": (counter_rates(6), _RATES),
    "gauges": (gauges(False), _gauge_sql("")),
    "outflow_gauges": (gauges(True), _gauge_sql("-")),
    "ordered_messages": (
        ordered_messages,
        f"WITH {TICKS_SQL} SELECT event_type AS key, event_type AS address, event_id AS logId, cents FROM ticks",
    ),
    "published_table": (
        published_table,
        f"""WITH {TICKS_SQL}, d AS (SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, CAST(sum(cents) AS BIGINT) AS cents
            FROM ticks GROUP BY ALL),
        days AS (SELECT DISTINCT date FROM d UNION SELECT CAST(CAST(x AS DATE) AS VARCHAR) FROM generate_series(
            (SELECT CAST(max(ts) AS DATE) FROM events) + INTERVAL 1 DAY, TIMESTAMP '2024-02-03', INTERVAL 1 DAY) t(x))
        SELECT date, event_type, cents FROM days LEFT JOIN d USING (date)""",
    ),
    "ubi_canonical": (
        canonical,
        "SELECT p_partkey, concat(p_partkey * 100 + p_size, 'e2b0/1e0b0') AS v FROM part",
    ),
}
