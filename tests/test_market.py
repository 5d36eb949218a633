"""Swap maths, conversion and as-of valuation on known rows."""

import random
from decimal import Decimal
from fractions import Fraction

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool import functions as U
from tidepool.functions import ubid, ubim
from tidepool.operators import pricing, valuation
from tidepool.operators.joins import frame_difference
from tidepool.operators.market import BASE_TOKEN, USD_TOKEN, Market
from tidepool.operators.projections import log_id, null_extended, pair_columns, resolve_columns, twin
from tidepool.operators.series import series_parts
from tidepool.operators.upsert import merge_upsert

TOKEN = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("decimals", T.DecimalType(38, 0)),
        T.StructField("address", T.StringType()),
    ]
)
BASE = T.StructType(
    [
        T.StructField("poolAddress", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("is1", T.BooleanType()),
        T.StructField("logId", T.DecimalType(38, 18)),
    ]
)
WBTC = ("WBTC", Decimal(8), "0x2260FAC5E5542a773Aa44fBCfeDf7C193bc2C599")
USDT = ("USDT", Decimal(6), "0xdAC17F958D2ee523a2206206994597C13D831ec7")


def test_convert_by_own_price(spark):
    df = spark.sql(
        "SELECT true AS isBasePool, true AS is1, '1' AS fee0, '2' AS price1, "
        "named_struct('price', CAST(NULL AS STRING), 'is1', CAST(NULL AS BOOLEAN)) AS base0"
    )
    assert df.select(valuation.convert(F.col("fee0"), "base0").alias("v")).first().v == "2e0b0/1e0b0"


def test_real_swap_is_worth_its_usd(spark):
    row = {
        "token0": WBTC,
        "token1": USDT,
        "price0": "1e2b0/2645809970288966871220430322152061218317819773293375026117264e0b192",
        "price1": "2645809970288966871220430322152061218317819773293375026117264e-2b192/1e0b0",
        "fee0": "6099198000e14b0/1e0b0",
        "fee1": "0",
        "volume0": "2026966802000e14b0/1e0b0",
        "volume1": "854403634e6b0/1e0b0",
        "base0": (
            "a",
            "907334895169304099592376346996265340613152495870046552845371787198225e10b192/1e0b0",
            True,
            Decimal("13320818.0008600133"),
        ),
        "base1": ("b", "18322227182269616037841953581097896229670063757649e-12b192/1e0b0", False, Decimal("13320829.0018100225")),
        "usdBase": (
            "c",
            "2148930618079446334171198021437466595445357402245217269710901634724e12b192/1e0b0",
            True,
            Decimal("13320830.0003400038"),
        ),
        "gasFees": "18608586517127222e18b0/1e0b0",
        "tip": "1825346000e18b0/1e0b0",
        "baseFeePerGas": "104818396254e18",
        "isBasePool": False,
        "is1": None,
    }
    types = {"token0": TOKEN, "token1": TOKEN, "base0": BASE, "base1": BASE, "usdBase": BASE}
    types |= {"isBasePool": T.BooleanType(), "is1": T.BooleanType()}
    schema = T.StructType([T.StructField(k, types.get(k, T.StringType())) for k in row])
    df = spark.createDataFrame([tuple(row.values())], schema)
    rated = valuation.usd_amounts(valuation.total_fees(valuation.base_amounts(df)))
    got = rated.select(
        U.ubi_to_double(F.col("usdAmounts")["volume"]).alias("usd"),
        U.ubi_to_double("volume1").alias("v1"),
        U.ubi_to_double(F.col("usdAmounts")["volumeBis"]).alias("bis"),
        U.ubi_to_double("totalFeesUsd").alias("fees"),
        U.ubi_to_double(F.col("usdAmounts")["gasFees"]).alias("gas"),
        U.ubi_to_double(F.col("usdAmounts")["fee"]).alias("lp"),
        "totalFeePct",
    ).first()
    # the quote of token1 is the more recent one, so the volume is taken from token1
    assert got.usd / got.v1 == pytest.approx(1, abs=1e-3)
    assert got.bis / got.v1 == pytest.approx(1, abs=5e-3)
    assert got.fees == pytest.approx(got.gas + got.lp)
    assert 0.3 < got.totalFeePct < 10


ETH, USDC, X, Y = ("ETH", Decimal(18), BASE_TOKEN), ("USDC", Decimal(6), USD_TOKEN), ("X", Decimal(0), "x"), ("Y", Decimal(0), "y")
STEPS = [
    (1, "a", ETH, X, "1"),
    (2, "d", ETH, USDC, "0.5"),
    (3, "b", X, Y, "2"),
    (4, "a", ETH, X, "1.5"),
    (5, "c", Y, X, "2"),
    (6, "b", X, Y, "2"),
    (10007, "b", X, Y, "2"),
]


def steps(spark):
    schema = T.StructType(
        [
            T.StructField("blockNumber", T.LongType()),
            T.StructField("logId", T.DecimalType(31, 10)),
            T.StructField("address", T.StringType()),
            T.StructField("token0", TOKEN),
            T.StructField("token1", TOKEN),
            T.StructField("price1", T.StringType()),
        ]
    )
    rows = [(b, Decimal(b), a, t0, t1, p) for b, a, t0, t1, p in STEPS]
    return valuation.exchange_rate_prep(spark.createDataFrame(rows, schema))


EXPECTED = [(None, None, None)] * 2 + [("1", None, "0.5"), (None, None, "0.5"), (None, "1.5", "0.5"), ("1.5", None, "0.5"), (None, None, None)]


@pytest.mark.parametrize("slices", [1, 3, 7])
def test_exchange_rates(spark, slices):
    rated = valuation.usd_exchange_rate(valuation.base_exchange_rate(steps(spark), slices=slices), slices=slices)
    got = [(r.b0, r.b1, r.u) for r in rated.orderBy("logId").selectExpr("base0.price b0", "base1.price b1", "usdBase.price u").collect()]
    assert got == EXPECTED
    third = rated.where("logId = 3").select("base0.*").first()
    assert tuple(third) == ("a", "1", False, Decimal(1))


def test_rolling_quotes_have_no_expiry(spark):
    rated = valuation.rolling_base_quotes(steps(spark), slices=2)
    last = rated.where("logId = 10007").selectExpr("base0.price AS b0", "usdBase.price AS u").first()
    assert last.u == "0.5" and last.b0 == "2"  # the row itself is the latest of its token


@pytest.mark.parametrize("slices", [1, 4])
def test_deltas(spark, slices):
    rows = [("a", 0, "1", "1", 0), ("a", 2, "0.5", "2", 1), ("a", 4, "1", "1", 0), ("b", 1, "1", "1", 5), ("b", 3, "0.5", "2", 2), ("b", 10004, "1", "1", 1)]
    df = spark.createDataFrame(rows, "address string, logId long, price0 string, price1 string, tick long")
    got = {
        (r.address, r.logId): (r.lastPrice0, r.priceDelta0, r.priceDelta1, r.priceDeltaPct0, r.priceDeltaPct1, r.tickDelta)
        for r in pricing.swap_delta(df, 10_000, slices=slices).collect()
    }
    none = (None,) * 6
    assert got == {
        ("a", 0): none,
        ("a", 2): ("1", "-5e1b0/1e0b0", "1e0b0/1e0b0", -50.0, 100.0, 1),
        ("a", 4): ("0.5", "5e1b0/1e0b0", "-1e0b0/1e0b0", 100.0, -50.0, -1),
        ("b", 1): none,
        ("b", 3): ("1", "-5e1b0/1e0b0", "1e0b0/1e0b0", -50.0, 100.0, -3),
        ("b", 10004): none,
    }


def swaps(spark, n=60):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        root = rng.randrange(2**90, 2**110)
        amount = rng.randrange(1, 10**24)
        up = rng.random() < 0.5
        rows.append((i, str(root), str(amount if up else -amount), str(-amount * 3 if up else amount * 3), rng.choice([500, 3000, None]), rng.choice([0, 6, 18]), 18, rng.randrange(-1000, 1000), 60, str(rng.randrange(10**20))))
    df = spark.createDataFrame(
        rows,
        "id int, sqrtPriceX96 string, amount0 string, amount1 string, fee long, d0 int, d1 int, tick long, tickSpacing long, liquidity string",
    )
    token = lambda i: F.struct(F.lit("S").alias("symbol"), F.col(f"d{i}").cast("decimal(38,0)").alias("decimals"), F.lit(f"t{i}").alias("address"))
    return df.withColumn("token0", token(0)).withColumn("token1", token(1)).drop("d0", "d1")


def test_fused_pass_equals_composed_functions(spark):
    columns = ["id", *(f.name for f in pricing.FUSED_TYPE.fields)]
    fused = pricing.swap_price_volume(swaps(spark)).select(*columns).orderBy("id").collect()
    composed = pricing.swap_volume(pricing.swap_price(swaps(spark))).select(*columns).orderBy("id").collect()
    assert fused == composed
    source = {r.id: r for r in swaps(spark).collect()}
    for r in fused:
        s = source[r.id]
        price = Fraction(int(s.sqrtPriceX96) ** 2, 2**192) * Fraction(10) ** int(s.token0.decimals - s.token1.decimals)
        n, rest = r.price1.split("/")[0].split("e")
        scale, bits = rest.split("b")
        assert Fraction(int(n), 2 ** int(bits)) * Fraction(10) ** -int(scale) == price
        assert r.resolvedSqrtPrice == pytest.approx(int(s.sqrtPriceX96) / 2**96, rel=1e-15)


def test_tick_liquidity(spark):
    priced = pricing.tick_liquidity(pricing.swap_price_volume(swaps(spark)))
    for r in priced.collect():
        low = (r.tick // 60) * 60
        lower, upper = 1.0001 ** (low / 2), 1.0001 ** ((low + 60) / 2)
        assert r.tickDepth1 == pytest.approx(float(r.liquidity) * (upper - lower) / 10**18, rel=1e-9)
        assert r.tickDepth0 == pytest.approx(float(r.liquidity) * (upper - lower) / (upper * lower) / 10 ** int(r.token0.decimals), rel=1e-9)


def test_projection_helpers(spark):
    df = spark.sql("SELECT 12 AS blockNumber, 3 AS transactionIndex, 45 AS logIndex, '1/2' AS x0, '3/4' AS x1")
    row = df.select(log_id("blockNumber", "transactionIndex", "logIndex").alias("v")).first()
    assert row.v == Decimal("12.0000300045")
    assert df.select(log_id("blockNumber", "transactionIndex", "logIndex")).schema.fields[0].dataType == T.DecimalType(31, 10)
    with pytest.raises(Exception, match="99999"):
        df.select(log_id("blockNumber", F.lit(100000), "logIndex", strict=True)).collect()
    assert twin("price0") == "price1" and twin("price1") == "price0"
    summed = df.withColumns(pair_columns("y", ["x", "x"], U.ubia)).first()
    assert (summed.y0, summed.y1) == ("2e0b0/2e0b0", "6e0b0/4e0b0")
    shape = T.StructType([T.StructField("x0", T.StringType()), T.StructField("base", BASE), T.StructField("tick", T.LongType())])
    empty = null_extended(df, shape)
    assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in shape]
    assert empty.first() == ("1/2", None, None)


def test_resolve_columns_reaches_into_series(spark):
    df = spark.sql(
        "SELECT '1/2' AS p, array(named_struct('logId', 1, 'v', '3/4'), named_struct('logId', 2, 'v', CAST(NULL AS STRING))) AS s "
        "UNION ALL SELECT NULL, NULL UNION ALL SELECT '', array()"
    )
    got = resolve_columns(df, ["p", "s"]).collect()
    assert got[0].p == 0.5 and [tuple(x) for x in got[0].s] == [(1, 0.75), (2, None)]
    assert got[1].p is None and got[1].s is None
    assert got[2].p is None and got[2].s == []


@pytest.mark.parametrize("slices", [None, 1, 8])
def test_series_parts_are_whole(spark, slices):
    df = spark.range(100).selectExpr("id % 2 AS k", "id AS logId", "id * 2 AS v").repartition(4)
    rows = series_parts(df, ["k"], "logId", {"s": F.struct("logId", "v")}, slices, 15).orderBy("k", "part").collect()
    assert max(len(r.s) for r in rows) <= (50 if slices == 1 else 30)
    assert len(rows) == 2 if slices == 1 else len(rows) > 4
    for k in (0, 1):
        whole = [tuple(x) for r in rows if r.k == k for x in r.s]
        assert whole == [(i, i * 2) for i in range(k, 100, 2)]


def test_small_series_parts_need_no_more_slices(spark, monkeypatch):
    """Parts of a few rows are counted off, not cut by as many quantiles."""
    from tidepool.operators import series

    seen, with_slices = [], series.with_slices
    monkeypatch.setattr(series, "with_slices", lambda df, order, cuts: seen.append(len(cuts)) or with_slices(df, order, cuts))
    df = spark.range(3000).selectExpr("id % 2 AS k", "id AS logId", "id * 2 AS v")
    rows = series_parts(df, ["k"], "logId", {"s": F.struct("logId", "v")}, None, 15).collect()
    assert seen and max(seen) <= 8
    assert len(rows) == 200 and {len(r.s) for r in rows} == {15} and {r.part for r in rows} == set(range(100))


def test_merge_upsert(spark):
    target = spark.createDataFrame([("d1", 1, "a"), ("d1", 2, "b")], "date string, logId int, v string")
    batch = spark.createDataFrame([("d1", 2, "c", 1), ("d1", 2, "e", 2), ("d2", 3, "d", 1)], "date string, logId int, v string, seq int")
    got = merge_upsert(target.withColumn("seq", F.lit(0)), batch, ["date", "logId"], "seq").drop("seq")
    assert sorted(map(tuple, got.collect())) == [("d1", 1, "a"), ("d1", 2, "e"), ("d2", 3, "d")]


def test_market_is_a_setting(spark):
    small = Market(base_token="x", usd_token="y", block_expiry=1)
    prepared = valuation.exchange_rate_prep(steps(spark).select("blockNumber", "logId", "address", "token0", "token1", "price1"), small)
    rated = valuation.usd_exchange_rate(valuation.base_exchange_rate(prepared, small, 1), small, 1)
    assert [r.p for r in rated.orderBy("logId").selectExpr("usdBase.price p").collect()][3] == "2"
    assert [r.isBasePool for r in rated.orderBy("logId").collect()] == [True, False, True, True, True, True, True]


def test_staged_rows_lie_in_columns(spark):
    """What is staged is written as Parquet, and is read back with its rows and types."""
    from tidepool.plans.rated_swaps import staged

    df = spark.range(50).selectExpr("id", "map('a', CAST(id AS STRING)) AS m", "CAST(NULL AS DECIMAL(38,18)) AS d", "named_struct('x', id) AS s")
    kept = staged(df)
    assert kept.inputFiles() and all(f.endswith(".parquet") for f in kept.inputFiles())
    assert kept.dtypes == df.dtypes and sorted(map(str, kept.collect())) == sorted(map(str, df.collect()))
    assert staged(df.limit(0)).count() == 0


def wide_swaps(spark, n=600):
    rows = [(i, ("eu", "pe", "eq", "pq")[i * 7 % 4], str(1 + i * 13 % 97)) for i in range(n)]
    df = spark.createDataFrame(rows, "logId long, address string, price1 string")
    base, usd = Market().base_token, Market().usd_token
    sides = {"eu": (base, usd), "pe": ("p", base), "eq": (base, "q"), "pq": ("p", "q")}
    token = lambda i: F.struct(F.create_map(*(F.lit(x) for p, s in sides.items() for x in (p, s[i])))[F.col("address")].alias("address"))
    named = df.withColumns({"token0": token(0), "token1": token(1), "price0": F.lit("1"), "tick": F.col("logId")})
    return valuation.exchange_rate_prep(named)


@pytest.mark.parametrize("slices", [None, 5])
def test_ordered_steps_share_one_shuffle(spark, tmp_path, slices):
    """Dealt rows pass all ordered steps without another shuffle, and give what each step alone gives."""
    from tidepool.operators import slicing
    from tidepool.plans.rated_swaps import quoted_swaps

    df = wide_swaps(spark)
    dealt = valuation.dealt_for_rates(df, str(tmp_path / "dealt"), slices=slices, carries=[pricing.delta_carry()])
    rated = slicing.gathered(quoted_swaps(dealt, slices=slices))
    assert "Exchange" not in rated._jdf.queryExecution().executedPlan().toString()
    alone = quoted_swaps(df, slices=3)
    assert rated.count() == 600 and frame_difference(rated, alone).count() == 0


def test_scaled_amounts_are_computed_in_columns(spark, monkeypatch):
    """Mixed factors and divisors give the texts of the row functions, without them for plain numbers."""
    rows = [("3e0b0/7e0b0", "5e1", True), ("3e0b0/7e0b0", "5e1", False), (None, "1", True), ("-2e4", "0", False), ("12", None, False), ("", "2", True), ("9", "4", None)] * 3
    df = spark.createDataFrame(rows, "a string, r string, up boolean")
    got = [r[0] for r in df.select(valuation.ubi_scale(F.col("a"), F.col("r"), F.col("up"))).collect()]
    want = df.select(F.when(F.coalesce("up", F.lit(False)), ubim("a", "r")).otherwise(ubid("a", "r")).alias("v"))
    assert got == [r.v for r in want.collect()]
    seen = []
    monkeypatch.setattr(valuation.limbs, "binary", lambda step, *a: seen.append((step, len(a[1]))) or pa.nulls(len(a[1]), pa.string()))
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.bool_()))]
    valuation._scale(valuation.DEFAULT).func(*columns)
    assert seen == [("multiply", 9), ("divide", 12)]


def test_passing_tables_go(spark, tmp_path):
    from tidepool.operators import staging

    with staging.passing(spark):
        inner = staging.staged(spark.range(5))
        out = staging.finished(inner.selectExpr("id + 1 AS id"))
    assert sorted(r.id for r in out.collect()) == [1, 2, 3, 4, 5]
    with pytest.raises(Exception, match="(?i)not.?(found|exist)"):
        inner.collect()


def test_statistics_leave_only_their_rows(spark, tmp_path, monkeypatch):
    """Tables that percentiles and statistics stage are gone when the finished rows are."""
    from tidepool.operators import staging
    from tidepool.operators.quantiles import exact_percentiles

    monkeypatch.setattr(staging, "folder", lambda spark: str(tmp_path))
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    with staging.passing(spark):
        rows = staging.finished(exact_percentiles(df, ["k"], {"m": ("v", 0.5)}, 4))
        assert len(list(tmp_path.iterdir())) == 2  # the counts, read three times, and the rows
    assert len(list(tmp_path.iterdir())) == 1 and sorted(tuple(r) for r in rows.collect()) == [(0, 49.5), (1, 49.0), (2, 50.0)]
