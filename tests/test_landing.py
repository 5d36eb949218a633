"""Landing jobs, chain sources, logs, published tables and the whole batch plan."""

import datetime
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidepool.operators.market import BASE_TOKEN, EPOCH_LENGTH, USD_TOKEN
from tidepool.plans import catalog, pool_day, rated_swaps
from tidepool.sources import chain, landing, logs
from tidepool.streaming.sink import upsert_path

SAMPLE = {
    "amount0": "94027150752759122855288085421985",
    "amount1": "-94027150752759122855288085421986",
    "liquidity": "133781798900345601581411106757",
    "recipient": "0xA9B",
    "sender": "0xC0D",
    "sqrtPriceX96": "1461446703485210103287273052203988822378723970341",
    "tick": 887271,
}


def test_json_round_trip_keeps_big_integers(spark):
    numbers = {k: (int(v) if k.startswith(("amount", "liq", "sqrt")) else v) for k, v in SAMPLE.items()}
    df = spark.createDataFrame([(json.dumps(SAMPLE),), (json.dumps(numbers),)], "args string")
    for row in chain.decode_args(df, chain.SWAP_ARGS).withColumn("back", chain.encode_args(list(SAMPLE))).collect():
        assert json.loads(row.back) == SAMPLE


CONFIG = {
    "dataSources": [
        {
            "source": {"address": "0xf", "abi": "Factory", "startBlock": 61_000},
            "mapping": {"abis": [{"name": "Factory", "file": "f.json"}, {"name": "ERC20", "file": "e.json"}], "eventHandlers": [{"event": "PoolCreated"}]},
        }
    ],
    "templates": [
        {
            "name": "Pool",
            "source": {"abi": "Pool"},
            "mapping": {"abis": [{"name": "Pool", "file": "p.json"}], "eventHandlers": [{"event": "Swap"}, {"event": "Mint"}]},
        }
    ],
}


def test_sources_and_templates(spark):
    sources = landing.contract_sources(spark, CONFIG)
    assert tuple(sources.first()) == ("0xf", 61_000, "Factory", "f.json", ["PoolCreated"], True)
    assert landing.start_epoch(sources).first().epoch == 2
    found = spark.createDataFrame([("0xa", 1, "Pool"), ("0xb", 2, "Other")], "address string, startBlock long, name string")
    rows = {r.address: (r.abi, r.events) for r in landing.attach_templates(found, landing.contract_templates(spark, CONFIG)).collect()}
    assert rows == {"0xa": ("p.json", ["Swap", "Mint"]), "0xb": (None, None)}


def test_words(spark):
    words = [(-5) % 2**256, 2**256 - 1, 2**200 + 7]
    data = "0x" + "".join(f"{w:064x}" for w in words)
    df = spark.createDataFrame([(data,), (None,)], "data string")
    rows = df.select(landing.decode_words("data", {"a": "int", "b": "uint", "c": "address"}).alias("d")).collect()
    assert rows[0].d.a == "-5" and rows[0].d.b == str(2**256 - 1) and rows[0].d.c == "0x" + f"{words[2]:064x}"[24:]
    assert rows[1].d.a is None


def test_words_are_decoded_without_python(spark):
    rng = random.Random(6)
    values = [0, 1, 10**18 - 1, 10**18, 2**32, 2**255 - 1, 2**255, 2**256 - 1, 2**256 - 10**18, 2**256 - 2**32] + [rng.randrange(2 ** rng.choice((8, 64, 128, 255, 256))) for _ in range(200)]
    rows = [(i, "0x" + f"{v:064x}" * 2) for i, v in enumerate(values)] + [(1000, "0x"), (1001, "0xAb"), (1002, "ff" * 32 + "0F")]
    decoded = spark.createDataFrame(rows, "id int, data string").select("id", landing.decode_words("data", {"a": "int", "b": "uint"}).alias("d"))
    assert "Python" not in decoded._jdf.queryExecution().executedPlan().toString()
    got = {r.id: (r.d.a, r.d.b) for r in decoded.collect()}
    for i, v in enumerate(values):
        assert got[i] == (str(v - (v >> 255 << 256)), str(v))
    assert [got[i] for i in (1000, 1001, 1002)] == [(None, None), ("171", None), ("-1", "15")]
    with pytest.raises(Exception, match="isn't hex"):
        spark.createDataFrame([("0xzz",)], "data string").select(landing.decode_words("data", {"a": "int"})).collect()


def test_pool_discovery_drops_unknown_addresses(spark):
    created = [(json.dumps({"pool": "0x1"}), 10, 0, "PoolCreated"), (json.dumps({}), 11, 0, "PoolCreated"), (json.dumps({"pool": "0x2"}), 12, 5, "PoolCreated"), (json.dumps({"pool": "0x3"}), 13, 0, "Other")]
    df = spark.createDataFrame(created, "args string, blockNumber long, epoch int, event string")
    ahead = spark.createDataFrame([(json.dumps({"pool": "0x9"}), 99)], "args string, blockNumber long")
    assert sorted(map(tuple, landing.discover_pools(df, 5, ahead).collect())) == [("0x1", 10, "Pool"), ("0x9", 99, "Pool")]


@pytest.mark.parametrize("marks, expected", [([], 5), ([(5, 210_000), (6, 240_000), (9, 999_999)], 7), ([(5, 209_999)], 5), ([(6, 999_999)], 5)])
def test_next_epoch(spark, marks, expected):
    markers = spark.createDataFrame(marks, "epoch int, last_block long")
    assert landing.next_epoch(markers, 5).first().epoch == expected


def test_words_around_the_short_form(spark):
    edges = [0, 1, 2**60 - 1, 2**60, 2**60 + 1, 2**63, 2**64]
    values = edges + [(-v) % 2**256 for v in edges]
    rows = [(i, f"0x{v:064x}" + f"{v:064X}") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, data string")
    decoded = df.select("id", landing.decode_words("data", {"a": "int", "b": "uint"}).alias("d")).collect()
    assert {r.id: (r.d.a, r.d.b) for r in decoded} == {i: (str(v - (v >> 255 << 256)), str(v)) for i, v in enumerate(values)}


def test_next_epoch_past_the_range_of_int_blocks(spark):
    markers = spark.createDataFrame([(5, 210_000), (80_000, 2_400_060_000)], "epoch int, last_block long")
    assert landing.next_epoch(markers, 5).first().epoch == 6
    assert landing.next_epoch(markers, 80_000).first().epoch == 80_001


def fixture_tables(spark):
    """Two epochs with three pools; epoch 433 follows the base-fee fork."""
    epoch = 433
    start = epoch * EPOCH_LENGTH
    tokens = spark.createDataFrame(
        [(BASE_TOKEN, "WETH", 18), (USD_TOKEN, "USDC", 6), ("0xt", "TTT", 8)], "address string, symbol string, decimals int"
    )
    made = [("0xusd", USD_TOKEN, BASE_TOKEN), ("0xteth", "0xt", BASE_TOKEN), ("0xtusd", "0xt", USD_TOKEN)]
    rows = [
        ("Factory", "PoolCreated", 10, "0xf", bytes([i]), 0, 0, b"b", json.dumps({"token0": a, "token1": b, "fee": 3000, "tickSpacing": 60, "pool": p}), 400)
        for i, (p, a, b) in enumerate(made)
    ]
    blocks = []

    def swap(block, pool, root, amount0, amount1, tick):
        args = {"amount0": amount0, "amount1": amount1, "liquidity": 10**18, "recipient": "r", "sender": "s", "sqrtPriceX96": root, "tick": tick}
        tx = block.to_bytes(8, "big")
        e = block // EPOCH_LENGTH
        rows.append(("Pool", "Swap", block, pool, tx, 3, 7, b"h", json.dumps(args), e))
        fee = 10**10 if e >= epoch else None
        blocks.append((block, 1_700_000_000 + block, fee, "1", [(tx, 21_000, 3 * 10**10, "0")], e))

    root = 2**96
    swap(start - 20_000, "0xteth", root, 10**8, -(10**18), 1)  # before the warm-up: expired
    swap(start - 50, "0xusd", 22_360_679_775 * 2**96 // 10**6, 10**9, -5 * 10**17, 2)
    swap(start + 1, "0xteth", root * 10**4, -(10**8), 10**16, 3)
    swap(start + 2, "0xtusd", root, 2 * 10**8, -(10**6), 4)
    swap(start + 3, "0xteth", root * 10**4 * 2, 10**8, -(10**16), 9)
    swap(start + 20_000, "0xtusd", root, 10**8, -(10**6), 5)  # all quotes expired
    events = spark.createDataFrame(
        rows, "contract string, event string, blockNumber long, address string, transactionHash binary, transactionIndex long, logIndex long, blockHash binary, args string, epoch int"
    )
    block_table = spark.createDataFrame(
        blocks, "number long, timestamp long, baseFeePerGas long, totalDifficulty string, transactions array<struct<hash: binary, gas: long, gasPrice: long, value: string>>, epoch int"
    )
    return events, block_table, tokens, epoch


@pytest.fixture(scope="module")
def rated(spark):
    return rated_swaps.rated_swaps(*fixture_tables(spark)[:4], slices=3).checkpoint()


def test_whole_batch_plan(spark, rated):
    events, _, tokens, epoch = fixture_tables(spark)
    pool = {r.address: r for r in chain.pools(events, tokens).collect()}
    assert pool["0xtusd"].pool == "TTT_USDC_30" and pool["0xtusd"].token0.decimals == 8

    start = epoch * EPOCH_LENGTH
    rows = {r.blockNumber - start: r for r in rated.collect()}
    assert sorted(rows) == [1, 2, 3, 20_000]  # warm-up rows are used and then dropped
    assert rows[1].logId == Decimal(start + 1) + Decimal("0.0000300007")
    assert rows[1].usdBase.poolAddress == "0xusd"  # quoted in the warm-up blocks
    assert rows[1].priceDelta0 is None and rows[3].priceDeltaPct1 == 300.0 and rows[3].tickDelta == 6
    assert rows[2].base0.poolAddress == "0xteth" and rows[2].base1.poolAddress == "0xusd"
    assert rows[20_000].usdBase is None and rows[20_000].usdAmounts["volume"] is None
    usd = rated.where(F.col("blockNumber") == start + 2).select(
        F.expr("usdAmounts['volumeBis']").alias("bis"), F.expr("usdAmounts['volume']").alias("v"), "tip", "gasFees"
    ).first()
    assert usd.gasFees == f"{21_000 * 3 * 10**10}e18b0/1e0b0" and usd.tip == f"{2 * 10**10}e18b0/1e0b0"
    assert usd.v is not None and usd.bis is not None


def _below(plan, join):
    """Lines of a plan's text below its first line with ``join``."""
    lines = plan.split("\n")
    at = next(i for i, x in enumerate(lines) if join in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-*(0123456789)"))
    end = next((i for i in range(at + 1, len(lines)) if depth(lines[i]) <= depth(lines[at])), len(lines))
    return "\n".join(lines[at + 1 : end])


def test_landed_tables_join_without_a_shuffle(spark, rated, tmp_path):
    events, blocks, tokens, epoch = fixture_tables(spark)
    tables = ("swaps_of_test", "transactions_of_test")
    rated_swaps.land_swaps(events, blocks, tables, str(tmp_path), buckets=4)
    pools = chain.pools(events, tokens)
    joined = rated_swaps.landed_swaps(spark, tables, pools, epoch)
    below = _below(joined._jdf.queryExecution().executedPlan().toString(), "SortMergeJoin [blockNumber")
    assert "transactions_of_test" in below and "Exchange" not in below
    assert "PartitionFilters" in below and "Bucketed: true" in below and "SelectedBucketsCount: 4 out of 4" in below
    unlanded = rated_swaps.join_swaps(chain.swaps(events, epoch), chain.transactions(blocks, epoch), pools)
    assert "Exchange" in _below(unlanded._jdf.queryExecution().executedPlan().toString(), "SortMergeJoin [blockNumber")

    again = rated_swaps.rated_epoch(spark, tables, pools, epoch, slices=3).select(rated.columns)
    key = "blockNumber"
    assert sorted(again.collect(), key=lambda r: r[key]) == sorted(rated.collect(), key=lambda r: r[key])
    # the warm-up reaches back over the epoch's border, and no further than quotes live
    floor = chain.warm_up_floor(epoch)
    blocks_read = sorted(r.blockNumber - epoch * EPOCH_LENGTH for r in joined.collect())
    assert blocks_read == [-50, 1, 2, 3, 20_000] and floor == epoch * EPOCH_LENGTH - 10_000
    for t in tables:
        spark.sql(f"DROP TABLE {t}")


def test_published_columns_and_days(spark, rated, tmp_path):
    table = str(tmp_path / "rswaps")
    published = catalog.as_published(rated, catalog.RATED_SWAPS)
    upsert_path(published, table)
    upsert_path(published, table)  # the same batch again changes nothing
    assert spark.read.parquet(table).count() == 4

    names = [c.split(" ")[0] for c in _columns(catalog.RATED_SWAPS)]
    assert set(names) - {"blockNumberTs"} <= set(rated.columns)
    date = rated.first().date
    day = pool_day.day_swaps(rated, str(date), slices=2)
    assert {c.split(" ")[0] for c in _columns(catalog.DAY_SWAPS)} | {"date"} == set(day.columns)
    pool_day.write_days(day, str(tmp_path / "agg"))
    pool_day.write_days(day, str(tmp_path / "agg"))

    catalog.create_table(spark, "pools_db.day_swaps", catalog.DAY_SWAPS, str(tmp_path / "agg"))
    catalog.discover_partitions(spark, "pools_db.day_swaps")
    rows = {r.address: r for r in spark.table("pools_db.day_swaps").collect()}
    on_day = rated.where(F.col("date") == F.lit(date)).count()
    assert sum(r.swapCount for r in rows.values()) == on_day
    teth = rows["0xteth"]
    assert len(teth.priceSeries) == teth.swapCount == len(teth.costSeries) == 2
    ranges = pool_day.pool_series(rated.where("address = '0xteth'"), blocks=1).orderBy("blockRange")
    assert [len(r.priceSeries) for r in ranges.collect()] == [1, 1]
    merged = pool_day.whole_series(ranges).first()
    assert merged.priceSeries == teth.priceSeries and merged.costSeries == teth.costSeries
    assert teth.token1.symbol == "WETH" and teth.maxPrice1 == pytest.approx(4 * teth.minPrice1)

    tomorrow = str(date + datetime.timedelta(days=2))
    assert len(catalog.add_partitions(spark, "pools_db.day_swaps", tomorrow)) == 2
    assert catalog.add_partitions(spark, "pools_db.day_swaps", tomorrow) == []
    catalog.create_table(spark, "pools_db.rated_swaps", catalog.RATED_SWAPS, table)
    catalog.discover_partitions(spark, "pools_db.rated_swaps")
    assert len(spark.table("pools_db.rated_swaps").columns) == 63  # with the date
    assert spark.table("pools_db.rated_swaps").where("usdBase IS NOT NULL").count() == 3
    spark.sql("DROP DATABASE pools_db CASCADE")


def test_changed_days_are_pruned_and_replaced_alone(spark, rated, tmp_path):
    first = rated.first().date
    days = [first + datetime.timedelta(days=i) for i in range(4)]
    for day in days:
        rated.withColumn("date", F.lit(day)).write.mode("append").partitionBy("date").parquet(str(tmp_path / "rated"))
    table = spark.read.parquet(str(tmp_path / "rated"))
    changes = spark.createDataFrame([(str(d), 10 * (i + 1)) for i, d in enumerate(days)], "date string, changed_at long")
    changes.write.parquet(str(tmp_path / "changes"))
    changes = spark.read.parquet(str(tmp_path / "changes"))
    target = tmp_path / "days"
    pool_day.write_days(pool_day.day_swaps(pool_day.swaps_of_days(table, pool_day.changed_days(changes, 0)), slices=2), str(target))
    files = lambda: {str(f.relative_to(target)): f.stat().st_mtime_ns for f in target.rglob("part-*.parquet")}
    before = files()
    assert {f.split("/")[0] for f in before} == {f"date={d}" for d in days}

    some = pool_day.swaps_of_days(table, pool_day.changed_days(changes, 25))
    assert "dynamicpruning" in some._jdf.queryExecution().executedPlan().toString()
    assert {r.date for r in some.select("date").distinct().collect()} == set(days[2:])
    pool_day.write_days(pool_day.day_swaps(some, slices=2), str(target))
    after = files()
    old, new = (lambda found, of: {f: t for f, t in found.items() if f.split("/")[0] in {f"date={d}" for d in of}}), days[:2]
    assert old(after, new) == old(before, new) and not set(old(after, days[2:])) & set(old(before, days[2:]))
    rows = spark.read.parquet(str(target)).groupBy("date").agg(F.sum("swapCount").alias("n")).collect()
    assert {r.n for r in rows} == {rated.count()} and len(rows) == 4


def _columns(ddl):
    depth, start, out = 0, 0, []
    for i, c in enumerate(ddl):
        depth += c in "<(" 
        depth -= c in ">)"
        if c == "," and not depth:
            out.append(ddl[start:i].strip())
            start = i + 1
    return [*out, ddl[start:].strip()]


def test_weighted_price(spark):
    rows = [(1, "2", "1", "a"), (4, "1", "1", "a"), (3, "5", "0", "b")]
    df = spark.createDataFrame(rows, "tickDepth0 int, price0 string, liquidity string, k string")
    from tidepool.functions import ubi_aggregate, ubi_resolve, ubim

    depth = F.col("tickDepth0").cast("string")
    sums = ubi_aggregate(
        df.withColumns({"d": depth, "w": ubim(depth, "price0")}), ["k"], {"l": ("sum", "liquidity"), "w": ("sum", "w"), "d": ("sum", "d")}
    )
    got = sums.select("k", ubi_resolve(pool_day.liquidity_weighted_price(F.col("l"), F.col("w"), F.col("d"))).alias("v"))
    assert {r.k: r.v for r in got.collect()} == {"a": "1.2", "b": "0"}


def test_epoch_partitions_with_different_schemas(spark, tmp_path):
    path = str(tmp_path / "blocks")
    spark.sql("SELECT 1L AS number").write.parquet(f"{path}/epoch=432")
    spark.sql("SELECT 2L AS number, 5L AS baseFeePerGas").write.parquet(f"{path}/epoch=433")
    rows = {r.number: (r.baseFeePerGas, r.epoch) for r in chain.read_epochs(spark, path, [432, 433]).collect()}
    assert rows == {1: (None, 432), 2: (5, 433)}


def test_cached_profile(spark):
    line = 'x INFO root: {"gcd": 3, "search": 4, "compute": 5}'
    df = spark.createDataFrame([(line, ("a-b-c-d-e-7", ("x", "y")))], "log string, kubernetes struct<pod_name: string, labels: struct<app: string, `spark-role`: string>>")
    logs.cache_as(logs.profile_records(df, "a-b%", "gcd"), "gcds")
    assert tuple(spark.table("gcds").first()) == ("7", 5, 3, 4)
    spark.catalog.uncacheTable("gcds")
