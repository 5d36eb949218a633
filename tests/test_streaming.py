"""Streams: buffer round trip, stateful steps equal to batch, upsert, logs."""

import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_market import EXPECTED, steps

from tidepool.operators import pricing, valuation
from tidepool.operators.joins import frame_difference
from tidepool.operators.market import Market
from tidepool.sources.logs import log_table
from tidepool.streaming import buffer, logtail, sink, stateful


def run(stream, spark, name, path):
    query = (
        stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(path)).trigger(availableNow=True).start()
    )
    sink.drain(query, 300)
    return query, spark.table(name)


def test_buffer_round_trip(spark, tmp_path):
    rows = [(f"pool{i % 4}", (i * 17) % 23) for i in range(14)]
    df = spark.createDataFrame(rows, "address string, logId int")
    buffer.write_buffer(df, str(tmp_path / "buf"))
    stream = buffer.decode(buffer.read_buffer(spark, str(tmp_path / "buf")), df.schema)
    _, got = run(stream, spark, "round_trip", tmp_path / "cp")
    assert frame_difference(got, df).count() == 0


def with_prices(df):
    return df.withColumns({"price0": F.lit("1"), "tick": F.col("blockNumber")})


def test_exchange_rates_in_stream(spark, tmp_path):
    df = with_prices(steps(spark))
    buffer.write_buffer(df, str(tmp_path / "buf"))
    stream = stateful.rated_stream(buffer.read_buffer(spark, str(tmp_path / "buf")), df.schema)
    query, got = run(stream, spark, "rates", tmp_path / "cp")
    prices = [(r.b0, r.b1, r.u) for r in got.orderBy("logId").selectExpr("base0.price b0", "base1.price b1", "usdBase.price u").collect()]
    assert prices == EXPECTED
    assert tuple(got.where("logId = 3").select("base0.*").first()) == ("a", "1", False, Decimal(1))
    reports = [p for p in query.recentProgress if p["numInputRows"]]
    assert reports and all(stateful.rows_conserved(p) for p in reports)


def random_swaps(spark, n=400, seed=11):
    rng = random.Random(seed)
    base, usd = Market().base_token, Market().usd_token
    tokens = {"E": ("E", 18, base), "U": ("U", 6, usd), "P": ("P", 8, "p"), "Q": ("Q", 18, "q"), "R": ("R", 0, "r")}
    pools = {"eu": "EU", "pe": "PE", "eq": "EQ", "pq": "PQ", "qr": "QR", "rp": "RP"}
    rows, block = [], 5
    for _ in range(n):
        block += rng.choice([1, 1, 3, 50, 6000])
        pool = rng.choice(list(pools))
        t0, t1 = (tokens[c] for c in pools[pool])
        rows.append((block, Decimal(block), pool, t0, t1, str(rng.randrange(1, 50)), str(rng.randrange(1, 50)), rng.randrange(100)))
    token = "struct<symbol:string,decimals:decimal(38,0),address:string>"
    rows = [(b, i, p, (a[0], Decimal(a[1]), a[2]), (c[0], Decimal(c[1]), c[2]), x, y, t) for b, i, p, a, c, x, y, t in rows]
    return rows, f"blockNumber long, logId decimal(31,10), address string, token0 {token}, token1 {token}, price1 string, price0 string, tick long"


def test_stream_equals_batch_over_micro_batches(spark, tmp_path):
    rows, schema = random_swaps(spark)
    whole = valuation.exchange_rate_prep(spark.createDataFrame(rows, schema))
    batch = pricing.swap_delta(whole, 10_000, slices=5)
    batch = valuation.usd_exchange_rate(valuation.base_exchange_rate(batch, slices=4), slices=3)

    source, checkpoint = str(tmp_path / "buf"), tmp_path / "cp"
    for i in range(0, len(rows), 150):  # three runs of one stream, restarted from its checkpoint
        part = valuation.exchange_rate_prep(spark.createDataFrame(rows[i : i + 150], schema))
        buffer.write_buffer(part, source)
        stream = stateful.rated_stream(buffer.read_buffer(spark, source), whole.schema)
        query = (
            stream.writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(checkpoint))
            .trigger(availableNow=True)
            .start()
        )
        sink.drain(query, 300)
    columns = ["logId", "lastPrice0", "priceDelta1", "priceDeltaPct0", "tickDelta"]
    structs = [f"to_json({b}) AS {b}" for b in ("base0", "base1", "usdBase")]
    widen = lambda df: df.withColumns({b: F.col(b).cast(f"struct<{stateful.QUOTE_TYPE.replace(' ', ':').replace(',:', ',')}>") for b in ("base0", "base1", "usdBase")})
    streamed = spark.read.parquet(str(tmp_path / "out")).selectExpr(*columns, *structs)
    expected = widen(batch).selectExpr(*columns, *structs)
    assert streamed.count() == len(rows)
    assert frame_difference(streamed, expected).count() == 0


def test_late_rows(spark, tmp_path):
    df = spark.createDataFrame([("k", 100, "x")], "k string, logId long, offer string")
    shape = df.withColumn("logId", F.col("logId").cast(stateful.AT_TYPE)).withColumn(
        stateful.EVENT_TIME, stateful.event_time("logId")
    )

    def stream(source, late):
        raw = spark.readStream.schema(shape.schema).parquet(source).withWatermark(stateful.EVENT_TIME, "10000 seconds")
        return stateful.carry_stream(raw, "k", "offer", "found", 10_000, late=late)

    def go(late):
        source, out = str(tmp_path / f"in_{late}"), str(tmp_path / f"out_{late}")
        writer = stream(source, late).writeStream.format("parquet").option("path", out)
        writer = writer.option("checkpointLocation", str(tmp_path / f"cp_{late}"))
        sink.drain(writer.trigger(availableNow=True).start(), 120)
        return spark.read.parquet(out).count()

    for late in ("drop", "fail"):
        source = str(tmp_path / f"in_{late}")
        shape.write.parquet(source)
        assert go(late) == 1
        shape.withColumn("logId", F.lit(50).cast(stateful.AT_TYPE)).write.mode("append").parquet(source)
    assert go("drop") == 1
    with pytest.raises(Exception, match="found after"):
        go("fail")


def test_state_is_dropped_by_timer(spark, tmp_path):
    source, cp = str(tmp_path / "in"), str(tmp_path / "cp")

    def put(k, block, offer):
        df = spark.createDataFrame([(k, block, offer)], "k string, b long, offer string")
        df = df.select("k", F.col("b").cast(stateful.AT_TYPE).alias("logId"), "offer", stateful.event_time("b").alias(stateful.EVENT_TIME))
        df.coalesce(1).write.mode("append").parquet(source)
        return df.schema

    def go(schema):
        raw = spark.readStream.schema(schema).parquet(source).withWatermark(stateful.EVENT_TIME, "10 seconds")
        stream = stateful.carry_stream(raw, "k", "offer", "found", 10)
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", cp).trigger(availableNow=True).start()
        sink.drain(query, 120)
        return query.lastProgress["stateOperators"][0]

    go(put("a", 1, "x"))
    go(put("b", 1000, "y"))
    go(put("b", 1001, None))
    found = {(r.k, int(r.logId)): r.found for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == {("a", 1): None, ("b", 1000): None, ("b", 1001): "y"}
    state = spark.read.format("statestore").option("stateVarName", "held").load(cp)
    assert [r.key.k for r in state.select("key").collect()] == ["b"]


def test_streaming_upsert(spark, tmp_path):
    source, target, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "date string, logId int, v string"

    def go(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)
        sink.drain(sink.upsert_stream(spark.readStream.schema(schema).json(source), target, cp), 120)
        return sorted((r.date if isinstance(r.date, str) else str(r.date), r.logId, r.v) for r in spark.read.parquet(target).collect())

    assert go([("d1", 1, "a"), ("d1", 2, "b"), ("d2", 1, "z")]) == [("d1", 1, "a"), ("d1", 2, "b"), ("d2", 1, "z")]
    assert go([("d1", 2, "c"), ("d3", 9, "n")]) == [("d1", 1, "a"), ("d1", 2, "c"), ("d2", 1, "z"), ("d3", 9, "n")]


def _files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("part-*.parquet") if "_staging" not in str(f)}


def test_merge_rewrites_only_files_with_a_match(spark, tmp_path, monkeypatch):
    table, schema = tmp_path / "table", "date string, logId int, v string"
    rows = [(f"day {i % 3}", i, "old") for i in range(90)]
    for part in (rows[:45], rows[45:]):  # two files a day
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").partitionBy("date").parquet(str(table))
    before = _files(table)
    assert len(before) == 6
    batch = spark.createDataFrame([("day 0", 3, "new"), ("day 0", 500, "more"), ("day 1", 501, "more"), ("day 9", 1, "more")], schema)
    sink.upsert_path(batch, str(table))
    after = _files(table)
    kept = {n for n in before if after.get(n) == before[n]}
    assert len(kept) == 5  # the one with id 3 is gone
    want = {(d, i): "new" if i == 3 else v for d, i, v in rows} | {("day 0", 500): "more", ("day 1", 501): "more", ("day 9", 1): "more"}
    read = lambda: {(r.date, r.logId): r.v for r in spark.read.schema(schema).parquet(str(table)).collect()}
    assert read() == want and not list((table / "_staging").iterdir())

    # a merge that stops while files are moved is carried on by the next run of its batch
    change = spark.createDataFrame([("day 2", 5, "newer"), ("day 2", 86, "newer")], schema)
    monkeypatch.setattr(sink.TableFiles, "forget", lambda self, uri: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        sink.upsert_path(change, str(table), batch_id=7)
    monkeypatch.undo()
    sink.upsert_path(change, str(table), batch_id=7)
    sink.upsert_path(change, str(table), batch_id=7)  # once more changes nothing
    assert read() == want | {("day 2", 5): "newer", ("day 2", 86): "newer"}
    assert spark.read.parquet(str(table)).count() == len(want)
    with pytest.raises(Exception, match="several rows of one key"):
        sink.upsert_path(change.unionAll(change), str(table), batch_id=8)
    assert read() == want | {("day 2", 5): "newer", ("day 2", 86): "newer"}


def test_log_tail(spark, tmp_path):
    source = tmp_path / "containers"
    source.mkdir()
    lines = [
        json.dumps({"log": "hello", "stream": "stdout", "time": "2024-01-02T03:04:05.678Z"}),
        "2024-01-03T03:04:05.678+00:00 stderr F plain message",
    ]
    (source / "pod-1_ns_main-0abc.log").write_text("\n".join(lines))
    stream = logtail.tail_logs(spark, str(source))
    sink.drain(logtail.roll_logs(stream, str(tmp_path / "out"), str(tmp_path / "cp")), 120)
    got = spark.read.json(str(tmp_path / "out")).orderBy("time").collect()
    assert [(r.pod_name, r.stream, r.log, str(r.date)) for r in got] == [
        ("pod-1", "stdout", "hello", "2024-01-02"),
        ("pod-1", "stderr", "plain message", "2024-01-03"),
    ]
    table = log_table(spark, str(tmp_path / "out"))
    assert table.count() == 2 and spark.sql("SELECT log FROM log WHERE log LIKE '%hello%' LIMIT 3").count() == 1


def priced_market(spark, sf_dir):
    from tidepool.plans.rated_swaps import price_swaps
    from tidepool.registry.tables import MARKET, raw_swaps

    return price_swaps(raw_swaps(spark, sf_dir), MARKET), MARKET


def test_micro_batches_equal_batch(spark, sf_dir, tmp_path):
    """Three runs of one stream, each with a part of the swaps, equal the batch plan."""
    from tidepool.plans.rated_swaps import rate_swaps
    from tidepool.streaming import microbatch

    priced, market = priced_market(spark, sf_dir)
    priced = priced.checkpoint()
    rows = priced.count()
    target, state, cp, source = (str(tmp_path / n) for n in ("out", "state", "cp", "in"))
    for low, high in ((0, 300), (300, 340), (340, rows)):
        part = priced.where((F.col("blockNumber") >= low) & (F.col("blockNumber") < high))
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(priced.schema).parquet(source)
        sink.drain(microbatch.rated_batches(stream, target, state, cp, market, slices=3), 300)
    expected = rate_swaps(priced, market)
    columns = ["blockNumber", "lastPrice0", "priceDelta1", "tickDelta", "totalFees", "totalFeesUsd", "base0.price AS b0", "usdBase.price AS u"]
    got = spark.read.parquet(target)
    assert got.count() == rows
    assert frame_difference(got.selectExpr(*columns), expected.selectExpr(*columns)).count() == 0

    priced.where("blockNumber = 5").write.mode("append").parquet(source)
    with pytest.raises(Exception, match="at or before"):
        sink.drain(microbatch.rated_batches(spark.readStream.schema(priced.schema).parquet(source), target, state, cp, market), 300)


def test_busy_key_is_cut_into_ranges(spark, tmp_path):
    """No group of a stateful step holds more than a range of a key; borders carry quotes as before."""
    import pandas as pd

    n = 3 * stateful.RANGE_BLOCKS
    df = spark.range(n).selectExpr("id AS block", "'k' AS k", "CAST(id AS STRING) AS value", "IF(id % 7 = 0, CAST(id AS STRING), NULL) AS offer").withColumns(
        {"logId": F.col("block").cast(stateful.AT_TYPE), stateful.EVENT_TIME: stateful.event_time("block")}
    )
    df.write.parquet(str(tmp_path / "in"))
    raw = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")).withWatermark(stateful.EVENT_TIME, "5 seconds")
    stream = stateful.carry_in_ranges(raw, "k", "offer", "found", 5)
    _, got = run(stream, spark, "ranges", tmp_path / "cp")
    rows = got.select("block", "value", "found").toPandas().sort_values("block")
    assert rows["block"].tolist() == list(range(n)) and rows["value"].tolist() == [str(i) for i in range(n)]
    expected = [str((i - 1) // 7 * 7) if i and i - (i - 1) // 7 * 7 <= 5 else None for i in range(n)]
    assert [None if pd.isna(f) else f for f in rows["found"]] == expected


def test_buffer_comes_in_order_in_several_batches(spark, tmp_path, monkeypatch):
    """A large buffer is compressed, read in event order by several micro-batches, and gives the batch result."""
    rows, schema = random_swaps(spark, 120)
    whole = valuation.exchange_rate_prep(spark.createDataFrame(rows, schema))
    monkeypatch.setattr(buffer, "BATCH_BYTES", 1)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        buffer.write_buffer(whole, str(tmp_path / "buf"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = sorted((tmp_path / "buf").glob("part-*"))
    assert len(files) > 1 and all(f.name.endswith(".gz") for f in files)
    stamps = [f.stat().st_mtime_ns for f in files]
    assert stamps == sorted(set(stamps))
    rated = stateful.rated_stream(buffer.read_buffer(spark, str(tmp_path / "buf")), whole.schema)
    query, got = run(rated.select("logId", "lastPrice0", F.to_json("usdBase").alias("usd")), spark, "ordered_rates", tmp_path / "cp")
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == len(files)
    batch = valuation.usd_exchange_rate(pricing.swap_delta(whole, 10_000, slices=5), slices=3)
    want = {(int(r.logId), r.lastPrice0, r.usdBase and r.usdBase.price) for r in batch.collect()}
    assert {(int(r.logId), r.lastPrice0, r.usd and json.loads(r.usd).get("price")) for r in got.collect()} == want


def test_upsert_merges_some_partitions_at_a_time(spark, tmp_path, monkeypatch):
    schema, table = "date string, logId int, v string", str(tmp_path / "table")
    rows = [(f"day {i % 5}", i, "old") for i in range(50)]
    sink.upsert_path(spark.createDataFrame(rows, schema), table)
    monkeypatch.setattr(sink, "GROUP_BYTES", 1)
    merge, calls = sink._merge, []
    monkeypatch.setattr(sink, "_merge", lambda *a: calls.append(a[0].count()) or merge(*a))
    sink.upsert_path(spark.createDataFrame([(d, i, "new") for d, i, _ in rows if i % 2], schema), table, batch_id=1)
    assert calls == [5] * 5
    assert sorted(tuple(r) for r in spark.read.parquet(table).select("logId", "v").collect()) == [(i, "new" if i % 2 else "old") for _, i, _ in rows]


def test_carried_rows_compare_recent_swaps_only(spark):
    from tidepool.streaming import microbatch

    rows, schema = random_swaps(spark)
    priced = valuation.exchange_rate_prep(spark.createDataFrame(rows, schema))
    carried = microbatch.carried_rows(priced)
    last = max(r[0] for r in rows)
    newest = {}
    for block, _, pool, *_ in rows:
        if last - block <= 10_000:
            newest[pool] = max(block, newest.get(pool, 0))
    got = {int(r.blockNumber) for r in carried.collect()}
    assert set(newest.values()) <= got and min(got) >= last - 10_000
    assert carried.columns == priced.columns
