"""The swap pipeline and pool statistics over events read as swaps."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidepool.functions import ubi_to_double
from tidepool.operators import pricing, slicing, staging, valuation
from tidepool.operators.projections import log_id
from tidepool.plans import pool_day, rated_swaps
from tidepool.registry.tables import BASE, MARKET, FEE, SWAPS_SQL, USD, chain_blocks, chain_events, chain_tokens, half_chain, raw_swaps, rounded, scratch_folder, use_checkpoints
from tidepool.sources import chain

EXPIRY = MARKET.block_expiry


def _volumes(df):
    names = ["amount0", "amount1", "fee0", "fee1", "netAmount0", "netAmount1", "volume0", "volume1"]
    return df.select("blockNumber", *names)


def fused(spark, sf_dir):
    return _volumes(pricing.swap_price_volume(raw_swaps(spark, sf_dir)))


def composed(spark, sf_dir):
    return _volumes(pricing.swap_volume(raw_swaps(spark, sf_dir)))


def prices(step):
    def query(spark, sf_dir):
        priced = step(raw_swaps(spark, sf_dir))
        # six significant digits: the pools' decimals differ by up to 16 places
        unit = F.pow(F.lit(10.0), (F.col("token0.decimals") - F.col("token1.decimals")).cast("double"))
        return priced.select(
            "blockNumber",
            rounded(ubi_to_double("price1") / unit, 6).alias("price1"),
            rounded(ubi_to_double("price0") * unit * 1e-8, 6).alias("price0"),
            rounded(F.col("resolvedSqrtPrice"), 6).alias("root"),
        )

    return query


def liquidity(spark, sf_dir):
    priced = pricing.tick_liquidity(pricing.swap_price_volume(raw_swaps(spark, sf_dir)))
    unit0, unit1 = (F.pow(F.lit(10.0), F.col(f"token{i}.decimals").cast("double")) for i in "01")
    return priced.select(
        "blockNumber",
        rounded(F.col("tickAmount1") * unit1, 0).alias("tickAmount1"),
        rounded(F.col("tickDepth0") * unit0, 0).alias("tickDepth0"),
        rounded(F.col("tickDepth1") * unit1, 0).alias("tickDepth1"),
    )


def _rated(spark, sf_dir, slices=None, folder=None):
    return rated_swaps.rate_swaps(rated_swaps.price_swaps(raw_swaps(spark, sf_dir), MARKET), MARKET, slices=slices, folder=folder)


def _rated_once(spark, sf_dir, slices=None):
    """Rated swaps for a plan that reads them once and stages what it reads again; they need no table of their own."""
    use_checkpoints(spark)
    return _rated(spark, sf_dir, slices)


def _quotes(df):
    return df.select("blockNumber", *(F.col(f"{b}.poolAddress").alias(f"{b}_pool") for b in ("base0", "base1", "usdBase")), *(
        F.col(f"{b}.logId").cast("bigint").alias(f"{b}_at") for b in ("base0", "base1", "usdBase")
    ))


def exchange_rates(slices):
    def query(spark, sf_dir):
        swaps = raw_swaps(spark, sf_dir).withColumn("logId", log_id("blockNumber", "transactionIndex", "logIndex"))
        prepared = valuation.exchange_rate_prep(pricing.swap_price(swaps), MARKET)
        return _quotes(valuation.usd_exchange_rate(valuation.base_exchange_rate(prepared, MARKET, slices), MARKET, slices))

    return query


def rate_preparation(spark, sf_dir):
    prepared = valuation.exchange_rate_prep(raw_swaps(spark, sf_dir), MARKET)
    tokens = {n: F.col(f"{n}.symbol").alias(n) for n in ("pairedToken", "pairedToken0", "pairedToken1")}
    return prepared.groupBy("address", "isBasePool", "is1", *tokens.values()).agg(F.count(F.lit(1)).alias("n"))


def amounts(spark, sf_dir):
    return _amounts(_rated(spark, sf_dir))


def amounts_composed(spark, sf_dir):
    """The same amounts by the separate steps."""
    priced = rated_swaps.price_swaps(raw_swaps(spark, sf_dir), MARKET)
    dealt = valuation.dealt_for_rates(priced, scratch_folder(spark, "dealt"), MARKET)
    rated = slicing.gathered(valuation.usd_exchange_rate(valuation.base_exchange_rate(dealt, MARKET), MARKET))
    return _amounts(valuation.usd_amounts(valuation.total_fees(valuation.base_amounts(rated, MARKET)), MARKET))


def _amounts(rated):
    base, usd = F.col("baseAmounts"), F.col("usdAmounts")
    d = ubi_to_double
    # tokens and pools differ by many orders of magnitude: ten significant digits each
    return rated.select(
        "blockNumber",
        significant(d(base["volume"])).alias("volume"),
        significant(d(base["volumeBis"])).alias("volume_bis"),
        significant(d(base["fee"])).alias("fee"),
        significant(d("totalFees")).alias("total_fees"),
        significant(F.col("totalFeePct")).alias("total_fee_pct"),
        significant(d(usd["volume"])).alias("usd_volume"),
        significant(d(usd["gasFees"])).alias("usd_gas"),
        significant(d("totalFeesUsd")).alias("usd_fees"),
    )


def amount_entries(spark, sf_dir):
    """Entries of both maps, counted by key and presence."""
    rated = _rated(spark, sf_dir, 6)
    base = F.transform_keys("baseAmounts", lambda key, _: F.concat(F.lit("base_"), key))
    both = rated.select("address", F.explode(F.map_concat(base, F.col("usdAmounts"))))
    return both.groupBy("address", "key").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("known"))


def landed(spark, sf_dir):
    """The chain of the given events landed in buckets: its tables, pools and market."""
    market, name = half_chain(spark, sf_dir), uuid.uuid4().hex
    events, tables = chain_events(spark, sf_dir, market), (f"swaps_{name}", f"transactions_{name}")
    rated_swaps.land_swaps(events, chain_blocks(spark, sf_dir, market), tables, scratch_folder(spark, "landed"))
    return tables, chain.pools(events, chain_tokens(spark)), market


def swap_job(spark, sf_dir):
    """Both epochs of the swap job, each with its warm-up blocks, as one frame."""
    use_checkpoints(spark)
    tables, pools, market = landed(spark, sf_dir)
    epochs = [rated_swaps.rated_epoch(spark, tables, pools, e, market) for e in (0, 1)]
    return epochs[0].unionByName(epochs[1])


AMOUNT_KEYS = {"base": ("volume", "volumeBis", "fee"), "usd": ("volume", "volumeBis", "fee", "gasFees", "tip", "baseFeePerGas")}


# Digits of the job's many amounts: the SQL has doubles, whose tenth digit a rounding may tip. Short
# decimals lie right between two of eight digits, so both sides are nudged past that place.
JOB_DIGITS, NUDGE = 8, 1 + 1e-12


def job_amounts(spark, sf_dir):
    """Every rated swap of the job with all amounts of both maps."""
    rated = swap_job(spark, sf_dir)
    texts = {f"{n}_{k}": F.col(f"{n}Amounts")[k] for n, keys in AMOUNT_KEYS.items() for k in keys}
    texts |= {"gas_fees": F.col("gasFees"), "tip": F.col("tip"), "total_fees": F.col("totalFees"), "total_fees_usd": F.col("totalFeesUsd")}
    return rated.select(
        "blockNumber", "epoch", F.col("date").cast("string").alias("date"), "address", "pool", "transactionHash",
        *(significant(ubi_to_double(c) * NUDGE, JOB_DIGITS).alias(n) for n, c in texts.items()),
    )


# Digits compared: more than exact amounts have, fewer than moments of doubles agree on.
DIGITS = 10
MOMENTS = ("skewness1", "kurtosis1", "trend1")


def significant(x, digits=DIGITS):
    """Leading digits as an integer, since values span many orders of magnitude."""
    magnitude = F.floor(F.log10(F.abs(x)))
    scaled = F.round(x / F.pow(F.lit(10.0), magnitude) * float(10 ** (digits - 1))).cast("bigint")
    return F.when(x == 0, F.lit(0)).otherwise(scaled)


def _significant_sql(x, digits=DIGITS):
    shifted = f"{x} / pow(10.0::DOUBLE, floor(log10(abs({x}))))"
    return f"CASE WHEN {x} = 0 THEN 0 ELSE CAST(round({shifted} * 1e{digits - 1}) AS BIGINT) END"


STAT_COLUMNS = (
    "firstPrice1",
    "lastPrice1",
    "minPrice1",
    "maxPrice1",
    "liquidityWeightedPrice1",
    "volume0",
    "netAmount1",
    "volumeBase",
    "volumeUsd",
    "avgVolumeBase",
    "avgVolumeUsd",
    "medVolumeBase",
    "medVolumeUsd",
    "avgTicks",
    "medTicks",
    "avgTickDepth1",
    "avgGas",
    "medGas",
    "tipQ1",
    "tipQ2",
    "tipQ3",
    "avgTotalFeesUsd",
    "medTotalFeesUsd",
    "ttAbsPriceDeltaPct1",
    "skewness1",
    "kurtosis1",
    "trend1",
    "priceDelta1",
    "priceDeltaPct1",
    "priceRange1",
    "volatility",
    "avgTotalFeePct",
    "medTotalFeePct",
    "priceImpactPctFor1kUsd",
)


def statistics(slices):
    def query(spark, sf_dir):
        stats = pool_day.pool_statistics(_rated_once(spark, sf_dir), slices=slices)
        return stats.select(
            "address",
            "swapCount",
            *(significant(F.col(c)).alias(c) for c in STAT_COLUMNS if c not in MOMENTS),
            *(rounded(F.col(c), 7).alias(c) for c in MOMENTS),
        )

    return query


def series(name):
    def query(spark, sf_dir):
        """Every point of every series with all its fields."""
        points = pool_day.pool_series(_rated_once(spark, sf_dir), blocks=300).select("address", F.inline(name))
        return points.select("address", F.col("logId").cast("bigint").alias("block"), *(significant(F.col(c) * NUDGE, JOB_DIGITS).alias(c) for c in pool_day.SERIES[name]))

    return query


def published_days(spark, sf_dir):
    """All days published from rated swaps that lie by date, as read back from the published table."""
    folder = scratch_folder(spark, "days")
    use_checkpoints(spark)
    with staging.shuffles_removed(spark):
        _rated(spark, sf_dir, folder=f"{folder}/dealt").write.option("compression", "zstd").partitionBy("date").parquet(f"{folder}/rated")
    staging.remove(spark, f"{folder}/dealt")
    rated = spark.read.parquet(f"{folder}/rated")
    changes = rated.groupBy("date").agg(F.max("timestamp").alias("changed_at"))
    # the changes since the start of time: every day
    days = pool_day.changed_days(changes, 0)
    pool_day.write_days(pool_day.day_swaps(pool_day.swaps_of_days(rated, days)), f"{folder}/days")
    return spark.read.parquet(f"{folder}/days")


DAY_MOMENTS = tuple(f"{n}{i}" for n in ("skewness", "kurtosis", "trend") for i in (0, 1))
DAY_COLUMNS = (
    *(f"{n}{i}" for n in ("firstPrice", "lastPrice", "minPrice", "maxPrice", "liquidityWeightedPrice", "ttAbsPriceDeltaPct", "volume", "netAmount",
        "avgTickDepth", "priceDelta", "priceDeltaPct", "priceRange", "volatility") for i in (0, 1)),
    "volumeBase", "volumeUsd", "avgVolumeBase", "avgVolumeUsd", "medVolumeBase", "medVolumeUsd", "avgTicks", "medTicks", "avgGas", "medGas",
    "tipQ1", "tipQ2", "tipQ3", "avgTotalFeePct", "medTotalFeePct", "avgTotalFeesUsd", "medTotalFeesUsd", "volatility", "priceImpactPctFor1kUsd",
)


def days(spark, sf_dir):
    """Every published row with all its columns; series by their length and ends."""
    rows = published_days(spark, sf_dir)
    ends = {f"{s}_{n}": F.element_at(F.col(s), at)["logId"].cast("bigint") for s in pool_day.SERIES for n, at in (("from", 1), ("to", -1))}
    return rows.select(
        F.col("date").cast("string").alias("date"), "address", "pool", "swapCount", "fee", "isBasePool",
        *(F.col(f"token{i}.{f}").cast("string").alias(f"{f}{i}") for i in (0, 1) for f in ("symbol", "decimals", "address")),
        F.col("firstPriceLogId").cast("bigint").alias("first_block"), F.col("lastPriceLogId").cast("bigint").alias("last_block"),
        *(significant(F.col(c) * NUDGE, JOB_DIGITS).alias(c) for c in DAY_COLUMNS),
        *(rounded(F.col(c), 6).alias(c) for c in DAY_MOMENTS),
        *(F.size(s).alias(f"{s}_points") for s in pool_day.SERIES),
        *(c.alias(n) for n, c in ends.items()),
    )


_PRICES = f"""WITH {SWAPS_SQL} SELECT block AS blockNumber, round(root * root, 6) + 0.0 AS price1,
    round(1 / (root * root) * 1e-8, 6) + 0.0 AS price0, round(root, 6) + 0.0 AS root FROM swaps"""




def _volume_sql():
    def side(i, sign, a):
        up = "k < 50" if sign > 0 else "k >= 50"
        return f"""concat({a}, 'e', d{i}) AS amount{i},
            CASE WHEN {up} THEN concat(CAST({a} AS HUGEINT) * 3000, 'e', d{i} + 6, 'b0/1e0b0') ELSE '0' END AS fee{i},
            CASE WHEN {up} THEN concat(CAST({a} AS HUGEINT) * 997000, 'e', d{i} + 6, 'b0/1e0b0')
                ELSE concat({a}, 'e', d{i}, 'b0/1e0b0') END AS netAmount{i},
            CASE WHEN {up} THEN concat(CAST({a} AS HUGEINT) * 997000, 'e', d{i} + 6, 'b0/1e0b0')
                ELSE concat(-({a}), 'e', d{i}, 'b0/1e0b0') END AS volume{i}"""

    a0 = "CASE WHEN k < 50 THEN cents * 1000 ELSE -cents * 1000 END"
    a1 = "CASE WHEN k < 50 THEN -cents * 3000 ELSE cents * 3000 END"
    return f"WITH {SWAPS_SQL} SELECT block AS blockNumber, {side(0, 1, a0)}, {side(1, -1, a1)} FROM swaps"


_QUOTES_CTE = f"""{SWAPS_SQL},
flags AS (
    SELECT *, '{BASE}' IN (t0, t1) AS is_base, '{BASE}' IN (t0, t1) AND '{USD}' IN (t0, t1) AS is_usd,
        CASE WHEN '{BASE}' IN (t0, t1) THEN CASE WHEN t1 = '{BASE}' THEN t0 ELSE t1 END ELSE t0 END AS p0,
        CASE WHEN '{BASE}' IN (t0, t1) THEN CASE WHEN t1 = '{BASE}' THEN t0 ELSE t1 END ELSE t1 END AS p1
    FROM swaps
),
held AS (
    SELECT *,
        last_value(CASE WHEN is_base THEN {{'pool': address, 'price': price1, 'is1': t1 = '{BASE}', 'pos': pos}} END IGNORE NULLS) OVER w0 AS h0,
        last_value(CASE WHEN is_base THEN {{'pool': address, 'price': price1, 'is1': t1 = '{BASE}', 'pos': pos}} END IGNORE NULLS) OVER w1 AS h1,
        last_value(CASE WHEN is_usd THEN {{'pool': address, 'price': price1, 'is1': t1 = '{BASE}', 'pos': pos}} END IGNORE NULLS) OVER wu AS hu
    FROM flags
    WINDOW w0 AS (PARTITION BY p0 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        w1 AS (PARTITION BY p1 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        wu AS (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
quoted AS (
    SELECT * EXCLUDE (h0, h1, hu),
        CASE WHEN NOT is_base AND pos - h0.pos <= {EXPIRY} THEN h0 END AS b0,
        CASE WHEN NOT is_base AND pos - h1.pos <= {EXPIRY} THEN h1 END AS b1,
        CASE WHEN NOT is_usd AND pos - hu.pos <= {EXPIRY} THEN hu END AS bu
    FROM held
)"""
_QUOTES = f"""WITH {_QUOTES_CTE} SELECT block AS blockNumber, b0.pool AS base0_pool, b1.pool AS base1_pool, bu.pool AS usdBase_pool,
    CAST(floor(b0.pos) AS BIGINT) AS base0_at, CAST(floor(b1.pos) AS BIGINT) AS base1_at, CAST(floor(bu.pos) AS BIGINT) AS usdBase_at FROM quoted"""

# volumes and fees, then conversion by own price in base pools, else by the quote
_VALUED_CTE = f"""{_QUOTES_CTE},
nets AS (
    SELECT *, CASE WHEN amount0 > 0 THEN amount0 * 0.003 ELSE 0 END AS fee0, CASE WHEN amount1 > 0 THEN amount1 * 0.003 ELSE 0 END AS fee1,
        CASE WHEN is_base THEN price1 ELSE b0.price END AS r0, CASE WHEN is_base THEN t1 = '{BASE}' ELSE b0.is1 END AS m0,
        CASE WHEN is_base THEN price1 ELSE b1.price END AS r1, CASE WHEN is_base THEN t1 = '{BASE}' ELSE b1.is1 END AS m1
    FROM quoted
),
sides AS (
    SELECT *, amount0 - fee0 AS net0, amount1 - fee1 AS net1,
        CASE WHEN t0 = '{BASE}' THEN abs(amount0 - fee0) WHEN m0 THEN abs(amount0 - fee0) * r0 ELSE abs(amount0 - fee0) / r0 END AS v0,
        CASE WHEN t1 = '{BASE}' THEN abs(amount1 - fee1) WHEN m1 THEN abs(amount1 - fee1) * r1 ELSE abs(amount1 - fee1) / r1 END AS v1,
        CASE WHEN t0 = '{BASE}' THEN fee0 WHEN m0 THEN fee0 * r0 ELSE fee0 / r0 END AS f0,
        CASE WHEN t1 = '{BASE}' THEN fee1 WHEN m1 THEN fee1 * r1 ELSE fee1 / r1 END AS f1
    FROM nets
),
based AS (
    SELECT *, CASE WHEN lead0 THEN v0 ELSE v1 END AS volume, CASE WHEN lead0 THEN v1 ELSE v0 END AS volume_bis, f0 + f1 AS fee,
        gas_fees + f0 + f1 AS total_fees,
        CASE WHEN is_usd THEN CASE WHEN t1 = '{BASE}' THEN 1 / price1 ELSE price1 END
            WHEN bu.is1 THEN 1 / bu.price ELSE bu.price END AS usd
    FROM (SELECT *, coalesce(CASE WHEN t0 = '{BASE}' THEN true WHEN t1 = '{BASE}' THEN false
        ELSE b1.pos IS NULL OR b0.pos >= b1.pos END, false) AS lead0 FROM sides)
)"""
_S = _significant_sql


def _nudged(x):
    return _significant_sql(f"({x} * {NUDGE!r})", JOB_DIGITS)


_AMOUNTS = f"""WITH {_VALUED_CTE} SELECT block AS blockNumber, {_S('volume')} AS volume, {_S('volume_bis')} AS volume_bis,
    {_S('fee')} AS fee, {_S('total_fees')} AS total_fees, {_S('(total_fees / volume * 100)')} AS total_fee_pct,
    {_S('(volume * usd)')} AS usd_volume, {_S('(gas_fees * usd)')} AS usd_gas, {_S('(gas_fees * usd + fee * usd)')} AS usd_fees
FROM based"""
_EPOCHS = "middle AS (SELECT max(event_id) // 2 + 1 AS length FROM events)"
_JOB_VALUES = {
    "gas_fees": "gas_fees", "tip": "own_tip", "base_volume": "volume", "base_volumeBis": "volume_bis", "base_fee": "fee",
    "usd_volume": "(volume * usd)", "usd_volumeBis": "(volume_bis * usd)", "usd_fee": "(fee * usd)", "usd_gasFees": "(gas_fees * usd)",
    "usd_tip": "(own_tip * usd)", "usd_baseFeePerGas": "(own_fee * usd)", "total_fees": "total_fees", "total_fees_usd": "(gas_fees * usd + fee * usd)",
}
_JOB = f"""WITH {_VALUED_CTE}, {_EPOCHS}, e AS (
    SELECT *, block // length AS epoch, CASE WHEN block // length >= 1 THEN tip END AS own_tip, CASE WHEN block // length >= 1 THEN base_fee END AS own_fee
    FROM based, middle
) SELECT block AS blockNumber, CAST(epoch AS INTEGER) AS epoch, strftime(ts, '%Y-%m-%d') AS date, address,
    concat(upper(t0), '_', upper(t1), '_30') AS pool, concat('0x', lower(to_hex(block))) AS transactionHash,
    {", ".join(f'{_nudged(x)} AS "{name}"' for name, x in _JOB_VALUES.items())}
FROM e"""
_ENTRIES = f"""WITH {_VALUED_CTE}, e AS (
    SELECT address,
        unnest(['base_volume', 'base_volumeBis', 'base_fee', 'volume', 'volumeBis', 'fee', 'gasFees', 'tip', 'baseFeePerGas']) AS key,
        unnest([volume, volume_bis, fee, volume * usd, volume_bis * usd, fee * usd, gas_fees * usd, tip * usd, base_fee * usd]) AS value
    FROM based
) SELECT address, key, count(*) AS n, count(value) AS known FROM e GROUP BY ALL"""

# deltas of a pool's own order, depths, fees and points of both series
_MOVED_CTE = f"""{_VALUED_CTE},
moved AS (
    SELECT *, CASE WHEN pos - lag(pos) OVER w <= {EXPIRY} THEN (price1 / lag(price1) OVER w - 1) * 100 END AS pct1,
        CASE WHEN pos - lag(pos) OVER w <= {EXPIRY} THEN (price0 / lag(price0) OVER w - 1) * 100 END AS pct0,
        CASE WHEN pos - lag(pos) OVER w <= {EXPIRY} THEN tick - lag(tick) OVER w END AS dt,
        liquidity * (hi - lo) / pow(10.0::DOUBLE, d1) AS depth1, liquidity * (hi - lo) / (lo * hi) / pow(10.0::DOUBLE, d0) AS depth0,
        total_fees / volume * 100 AS fee_pct, volume * usd AS vu, gas_fees * usd + fee * usd AS fu, strftime(ts, '%Y-%m-%d') AS day,
        unix - 1704067200 AS since  -- a trend is the same from any start, and so keeps its digits
    FROM (SELECT *, pow(1.0001::DOUBLE, floor(tick / 60.0) * 60 / 2) AS lo, pow(1.0001::DOUBLE, (floor(tick / 60.0) * 60 + 60) / 2) AS hi FROM based)
    WINDOW w AS (PARTITION BY address ORDER BY pos)
)"""


def _stats_cte(keys: str) -> str:
    """Statistics of both sides by ``keys``, in the steps g (aggregates), c (central moments) and h."""
    both = lambda form: ", ".join(form.replace("#", i) for i in "01")
    return f"""{_MOVED_CTE},
g AS (
    SELECT {keys}, count(*) AS swapCount, any_value(t0) AS t0, any_value(t1) AS t1, any_value(d0) AS d0, any_value(d1) AS d1, any_value(is_base) AS is_base,
        min(block) AS first_block, max(block) AS last_block,
        {both("min_by(price#, pos) AS firstPrice#, max_by(price#, pos) AS lastPrice#, min(price#) AS minPrice#, max(price#) AS maxPrice#")},
        {both("sum(depth# * price#) / sum(depth#) AS liquidityWeightedPrice#, sum(abs(net#)) AS volume#, sum(net#) AS netAmount#, avg(depth#) AS avgTickDepth#")},
        {both("sum(abs(pct#)) AS ttAbsPriceDeltaPct#, avg(pct#) AS mu#, covar_pop(price#, since) / (stddev_samp(price#) * stddev_samp(since)) AS trend#")},
        sum(volume) AS volumeBase, sum(vu) AS volumeUsd, avg(volume) AS avgVolumeBase, avg(vu) AS avgVolumeUsd,
        quantile_cont(volume, 0.5) AS medVolumeBase, quantile_cont(vu, 0.5) AS medVolumeUsd, avg(abs(dt)) AS avgTicks,
        quantile_cont(abs(dt)::DOUBLE, 0.5) AS medTicks, avg(gas) AS avgGas, quantile_cont(gas::DOUBLE, 0.5) AS medGas,
        quantile_cont(tip, 0.25) AS tipQ1, quantile_cont(tip, 0.5) AS tipQ2, quantile_cont(tip, 0.75) AS tipQ3,
        avg(fu) AS avgTotalFeesUsd, quantile_cont(fu, 0.5) AS medTotalFeesUsd, avg(fee_pct) AS avgTotalFeePct, quantile_cont(fee_pct, 0.5) AS medTotalFeePct
    FROM moved GROUP BY {keys}
),
c AS (SELECT {keys}, {both("avg(pow(pct# - mu#, 2)) AS m2#, avg(pow(pct# - mu#, 3)) AS m3#, avg(pow(pct# - mu#, 4)) AS m4#")}
    FROM moved JOIN g USING ({keys}) GROUP BY {keys}),
h AS (
    SELECT *, {both("m3# / pow(m2#, 1.5) AS skewness#, m4# / (m2# * m2#) - 3 AS kurtosis#, lastPrice# - firstPrice# AS priceDelta#")},
        {both("(lastPrice# - firstPrice#) / lastPrice# * 100 AS priceDeltaPct#, maxPrice# - minPrice# AS priceRange#")},
        {both("(maxPrice# - minPrice#) / firstPrice# * 100 AS volatility#")},
        ((maxPrice1 - minPrice1) / firstPrice1 + (maxPrice0 - minPrice0) / firstPrice0) * 50 AS volatility,
        CASE WHEN round(volumeUsd) <> 0 THEN (ttAbsPriceDeltaPct0 + ttAbsPriceDeltaPct1) / 2 / round(volumeUsd) * 1000 END AS priceImpactPctFor1kUsd
    FROM g JOIN c USING ({keys})
)"""


_STATS = f"""WITH {_stats_cte('address')}
SELECT address, swapCount, {", ".join(f"{_S(c)} AS {c}" for c in STAT_COLUMNS if c not in MOMENTS)},
    {", ".join(f"round({c}, 7) + 0.0 AS {c}" for c in MOMENTS)} FROM h"""
_DAYS = f"""WITH {_stats_cte('day, address')}
SELECT day AS date, address, concat('P_', address) AS pool, swapCount, {FEE} AS fee, is_base AS isBasePool,
    {", ".join(f"upper(t{i}) AS symbol{i}, CAST(d{i} AS VARCHAR) AS decimals{i}, t{i} AS address{i}" for i in (0, 1))}, first_block, last_block,
    {", ".join(f'{_nudged(c)} AS "{c}"' for c in DAY_COLUMNS)}, {", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in DAY_MOMENTS)},
    {", ".join(f'swapCount AS "{s}_points", first_block AS "{s}_from", last_block AS "{s}_to"' for s in pool_day.SERIES)} FROM h"""
_POINT_VALUES = {
    "price0": "price0", "price1": "price1", "priceDeltaPct0": "pct0", "priceDeltaPct1": "pct1", "netAmount0": "net0", "netAmount1": "net1",
    "volume0": "abs(net0)", "volume1": "abs(net1)", "baseVolume": "volume", "baseVolumeBis": "volume_bis", "volumeUsd": "vu", "gas": "gas",
    "gasXTipUsd": "(gas * tip * usd)", "gasXBaseFeeUsd": "(gas * base_fee * usd)", "LPFeeUsd": "(fee * usd)", "tipGwei": "(tip * 1e9)",
    "baseFeeGwei": "(base_fee * 1e9)", "totalFeePct": "fee_pct",
}
_SERIES = {
    name: f"""WITH {_MOVED_CTE} SELECT address, block, {", ".join(f'{_nudged(_POINT_VALUES[c])} AS "{c}"' for c in fields)} FROM moved"""
    for name, fields in pool_day.SERIES.items()
}

QUERIES = {
    "swap_price": (prices(pricing.swap_price), _PRICES),
    "swap_price_fused": (prices(pricing.swap_price_volume), _PRICES),
    "swap_volume": (composed, _volume_sql()),
    "swap_volume_fused": (fused, _volume_sql()),
    "tick_liquidity": (
        liquidity,
        f"""WITH {SWAPS_SQL}, t AS (SELECT *, pow(1.0001::DOUBLE, floor(tick / 60.0) * 60 / 2) AS lo,
            pow(1.0001::DOUBLE, (floor(tick / 60.0) * 60 + 60) / 2) AS hi FROM swaps)
        SELECT block AS blockNumber, round(liquidity * (root - lo), 0) + 0.0 AS tickAmount1,
            round(liquidity * (hi - lo) / (lo * hi), 0) + 0.0 AS tickDepth0, round(liquidity * (hi - lo), 0) + 0.0 AS tickDepth1 FROM t""",
    ),
    "exchange_rate_prep": (
        rate_preparation,
        f"""WITH {SWAPS_SQL}, p AS (SELECT address, '{BASE}' IN (t0, t1) AS isBasePool,
            CASE WHEN '{BASE}' IN (t0, t1) THEN t1 = '{BASE}' END AS is1,
            CASE WHEN t1 = '{BASE}' THEN upper(t0) WHEN t0 = '{BASE}' THEN upper(t1) END AS pairedToken, t0, t1 FROM swaps)
        SELECT address, isBasePool, is1, pairedToken, coalesce(pairedToken, upper(t0)) AS pairedToken0,
            coalesce(pairedToken, upper(t1)) AS pairedToken1, count(*) AS n FROM p GROUP BY ALL""",
    ),
    "exchange_rates": (exchange_rates(None), _QUOTES),
    "exchange_rates_sliced": (exchange_rates(7), _QUOTES),
    "rated_amounts": (amounts, _AMOUNTS),
    "rated_amounts_composed": (amounts_composed, _AMOUNTS),
    "rated_amount_entries": (amount_entries, _ENTRIES),
    "rated_swaps": (job_amounts, _JOB),
    "pool_statistics": (statistics(None), _STATS),
    "pool_statistics_sliced": (statistics(6), _STATS),
    "price_series": (series("priceSeries"), _SERIES["priceSeries"]),
    "cost_series": (series("costSeries"), _SERIES["costSeries"]),
    "day_swaps": (days, _DAYS),
}
