"""Valuation of swaps in the base token and in USD."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions import limbs
from tidepool.functions.numeric import Arithmetic, NumericConf
from tidepool.functions.scalars import DEFAULT, ubi_sign, ubi_to_double, ubia, ubid
from tidepool.operators.asof import asof_quote, quote_carry, rolling_latest
from tidepool.operators.market import Market
from tidepool.operators.slicing import Carry, dealt

MARKET = Market()


def _trades(token: str) -> Column:
    return (F.col("token0.address") == token) | (F.col("token1.address") == token)


def exchange_rate_prep(df: DataFrame, market: Market = MARKET) -> DataFrame:
    """Tell base pools apart and name the token every side is rated by."""
    is_base = F.lit(market.base_token).isin(F.col("token0.address"), F.col("token1.address"))
    flagged = df.withColumn("isBasePool", is_base).withColumn(
        "is1", F.when(F.col("isBasePool"), F.col("token1.address") == market.base_token)
    )
    other = F.when(F.col("is1"), F.col("token0")).otherwise(F.col("token1"))
    paired = flagged.withColumn("pairedToken", F.when(F.col("isBasePool"), other))
    return paired.withColumns(
        {
            f"pairedToken{i}": F.when(F.col("isBasePool"), F.col("pairedToken")).otherwise(F.col(f"token{i}"))
            for i in "01"
        }
    )


def quote_struct() -> Column:
    return F.struct(
        F.col("address").alias("poolAddress"), F.col("price1").alias("price"), F.col("is1"), F.col("logId")
    )


def _paired(df: DataFrame) -> DataFrame:
    """With the tokens by which both sides are rated, which dealt rows have already."""
    return df.withColumns({f"__paired{i}": F.col(f"pairedToken{i}.address") for i in "01" if f"__paired{i}" not in df.columns})


def _is_base_quote(market: Market) -> Column:
    return F.col("isBasePool") & _trades(market.base_token)


def _is_usd_quote(market: Market) -> Column:
    return F.col("isBasePool") & _trades(market.usd_token)


def rate_carries(market: Market = MARKET) -> list[Carry]:
    """What ``base_exchange_rate`` and ``usd_exchange_rate`` look up, for rows dealt for them."""
    sides = [quote_carry([f"__paired{i}"], "logId", _is_base_quote(market), quote_struct(), f"base{i}") for i in "01"]
    return [*sides, quote_carry([], "logId", _is_usd_quote(market), quote_struct(), "usdBase")]


def base_exchange_rate(df: DataFrame, market: Market = MARKET, slices: int | None = None) -> DataFrame:
    """``base0`` and ``base1``: latest unexpired base-pool quote of either token."""
    keyed = _paired(df)
    for i in "01":
        keyed = asof_quote(
            keyed, [f"__paired{i}"], "logId", _is_base_quote(market), quote_struct(), f"base{i}", market.block_expiry, slices
        )
    return keyed.drop("__paired0", "__paired1")


def usd_exchange_rate(df: DataFrame, market: Market = MARKET, slices: int | None = None) -> DataFrame:
    """``usdBase``: latest unexpired quote of the base/USD pools, one for all rows."""
    return asof_quote(df, [], "logId", _is_usd_quote(market), quote_struct(), "usdBase", market.block_expiry, slices)


def rolling_base_quotes(df: DataFrame, market: Market = MARKET, slices: int | None = None) -> DataFrame:
    """Inclusive form of the quote search: any row of a token counts, and none expires."""
    keyed = _paired(df)
    for i in "01":
        keyed = rolling_latest(keyed, [f"__paired{i}"], "logId", F.lit(True), quote_struct(), f"base{i}", slices)
    usd = _trades(market.usd_token)
    return rolling_latest(keyed, [], "logId", usd, quote_struct(), "usdBase", slices).drop("__paired0", "__paired1")


def _scale(conf: NumericConf):
    math = Arithmetic(conf)

    def row(amount, rate, multiply):
        if amount is None or rate is None:
            return None
        x, y = math.parse(amount), math.parse(rate)
        if x is None or y is None:
            return None
        return math.text(math.multiply(x, y) if multiply else math.divide(x, y))

    def column(amount, rate, multiplied):
        step = "multiply" if multiplied else "divide"
        if limbs.most_digits(conf):
            return limbs.binary(step, conf, amount, rate, lambda a, r: row(a, r, multiplied))
        return pa.array([row(a, r, multiplied) for a, r in zip(amount.to_pylist(), rate.to_pylist())], type=pa.string())

    @F.arrow_udf("string")
    def scale(amount: pa.Array, rate: pa.Array, multiply: pa.Array) -> pa.Array:
        up = np.asarray(multiply.fill_null(False).to_numpy(zero_copy_only=False), dtype=bool)
        parts, places = [], []
        for at, multiplied in ((np.flatnonzero(up), True), (np.flatnonzero(~up), False)):
            if len(at):
                parts.append(column(amount.take(pa.array(at)), rate.take(pa.array(at)), multiplied))
                places.append(at)
        if len(parts) < 2:
            return parts[0] if parts else pa.array([], type=pa.string())
        return pa.concat_arrays(parts).take(pa.array(np.argsort(np.concatenate(places))))

    return scale


def ubi_scale(amount: Column, rate: Column, multiply: Column, conf: NumericConf = DEFAULT) -> Column:
    """Amount times or over a rate, chosen per row."""
    return _scale(conf)(amount, rate, multiply)


def convert(amount: Column, base: str, conf: NumericConf = DEFAULT) -> Column:
    """Amount in the base token: by the quote, or by the own price in an unquoted base pool."""
    rate, multiply = _base_rate(base)
    return ubi_scale(amount, rate, multiply, conf)


def _base_rate(base: str) -> tuple[Column, Column]:
    """Price that turns an amount into the base token, and whether it multiplies."""
    own = F.col(f"{base}.price").isNull() & F.coalesce(F.col("isBasePool"), F.lit(False))
    rate = F.when(own, F.col("price1")).otherwise(F.col(f"{base}.price"))
    return rate, F.coalesce(F.when(own, F.col("is1")).otherwise(F.col(f"{base}.is1")), F.lit(False))


def _usd_rate(market: Market) -> tuple[Column, Column]:
    """Price between base token and USD, and whether it divides a base amount."""
    own = F.coalesce(F.col("isBasePool") & _trades(market.usd_token), F.lit(False))
    rate = F.when(own, F.col("price1")).otherwise(F.col("usdBase.price"))
    return rate, F.coalesce(F.when(own, F.col("is1")).otherwise(F.col("usdBase.is1")), F.lit(False))


def _first_leads(own0: Column, own1: Column) -> Column:
    """Whether the volume is taken from token0: it is the base token or has the newer quote."""
    at0, at1 = F.col("base0.logId"), F.col("base1.logId")
    return F.coalesce(F.when(own0, True).when(own1, False).otherwise(at1.isNull() | (at0 >= at1)), F.lit(False))


def dealt_for_rates(df: DataFrame, folder: str, market: Market = MARKET, slices: int | None = None, carries: Sequence[Carry] = ()) -> DataFrame:
    """Rows dealt once for both exchange rates and other ``carries``; ``gathered`` gives them back."""
    return dealt(_paired(df), "logId", [*carries, *rate_carries(market)], folder, slices)


def base_amounts(df: DataFrame, market: Market = MARKET, conf: NumericConf = DEFAULT) -> DataFrame:
    """Map of volume, counter volume and fee in the base token.

    A side that is the base token counts as it is; otherwise the side with the more
    recent quote gives the volume.
    """
    is_base = {i: F.coalesce(F.col(f"token{i}.address") == market.base_token, F.lit(False)) for i in "01"}
    parts = {}
    for i in "01":
        for kind in ("volume", "fee"):
            amount = F.col(f"{kind}{i}")
            converted = convert(F.when(~is_base[i], amount), f"base{i}", conf)
            parts[f"__{kind}{i}"] = F.when(is_base[i], amount).otherwise(converted)
    sides = df.withColumns(parts)
    first_leads = _first_leads(is_base["0"], is_base["1"])
    v0, v1 = F.col("__volume0"), F.col("__volume1")
    return (
        sides.withColumn("__fee", ubia("__fee0", "__fee1", conf))
        .withColumn(
            "baseAmounts",
            F.create_map(
                F.lit("volume"),
                F.when(first_leads, v0).otherwise(v1),
                F.lit("volumeBis"),
                F.when(first_leads, v1).otherwise(v0),
                F.lit("fee"),
                F.col("__fee"),
            ),
        )
        .drop("__fee", *parts)
    )


def total_fees(df: DataFrame, conf: NumericConf = DEFAULT) -> DataFrame:
    """Gas plus liquidity fees in the base token and their share of the volume."""
    volume = F.col("baseAmounts")["volume"]
    nonzero = F.when(ubi_sign(volume) != 0, volume)
    return df.withColumn("totalFees", ubia("gasFees", F.col("baseAmounts")["fee"], conf)).withColumn(
        "totalFeePct", ubi_to_double(ubid("totalFees", nonzero, conf), conf) * 100
    )


def usd_amounts(df: DataFrame, market: Market = MARKET, conf: NumericConf = DEFAULT) -> DataFrame:
    """The base amounts, gas fees, tip and base fee in USD.

    USD is the paired token of the base, so quotes apply the other way round; a
    base/USD pool uses its own price.
    """
    rate, divide = _usd_rate(market)
    amounts = {k: F.col("baseAmounts")[k] for k in ("volume", "volumeBis", "fee")}
    amounts |= {k: F.col(k) for k in ("gasFees", "tip", "baseFeePerGas")}
    priced = df.withColumns({f"__usd_{k}": ubi_scale(a, rate, ~divide, conf) for k, a in amounts.items()})
    entries = [c for k in amounts for c in (F.lit(k), F.col(f"__usd_{k}"))]
    return (
        priced.withColumn("usdAmounts", F.when(F.col("baseAmounts").isNotNull(), F.create_map(*entries)))
        .withColumn("totalFeesUsd", ubia("__usd_gasFees", "__usd_fee", conf))
        .drop(*(f"__usd_{k}" for k in amounts))
    )


_VALUES = ("volume", "volumeBis", "fee", "totalFees", "usdVolume", "usdVolumeBis", "usdFee", "usdGas", "usdTip", "usdBaseFee", "totalFeesUsd")
VALUED_TYPE = T.StructType([T.StructField(n, T.StringType()) for n in _VALUES] + [T.StructField("pct", T.DoubleType())])


def _value(conf: NumericConf):
    math = Arithmetic(conf)

    def apply_rate(amount, rate, multiply):
        if amount is None or rate is None:
            return None
        return math.multiply(amount, rate) if multiply else math.divide(amount, rate)

    def plus(x, y):
        return None if x is None or y is None else math.add(x, y)

    def row(volume0, volume1, fee0, fee1, rate0, rate1, usd, gas, tip, base_fee, up0, up1, usd_up, own0, own1, leads):
        parse = math.parse
        r0, r1, r = parse(rate0), parse(rate1), parse(usd)
        v0, f0 = parse(volume0), parse(fee0)
        v1, f1 = parse(volume1), parse(fee1)
        if not own0:
            v0, f0 = apply_rate(v0, r0, up0), apply_rate(f0, r0, up0)
        if not own1:
            v1, f1 = apply_rate(v1, r1, up1), apply_rate(f1, r1, up1)
        volume, bis = (v0, v1) if leads else (v1, v0)
        fee, gas = plus(f0, f1), parse(gas)
        total = plus(gas, fee)
        pct = None
        if total is not None and volume is not None and math.sign(volume):
            pct = math.to_float(math.divide(total, volume)) * 100
        dollars = [apply_rate(x, r, usd_up) for x in (volume, bis, fee, gas, parse(tip), parse(base_fee))]
        values = [volume, bis, fee, total, *dollars, plus(dollars[3], dollars[2])]
        return [None if x is None else math.text(x) for x in values] + [pct]

    @F.arrow_udf(VALUED_TYPE)
    def value(
        volume0: pa.Array,
        volume1: pa.Array,
        fee0: pa.Array,
        fee1: pa.Array,
        rate0: pa.Array,
        rate1: pa.Array,
        usd: pa.Array,
        gas: pa.Array,
        tip: pa.Array,
        base_fee: pa.Array,
        up0: pa.Array,
        up1: pa.Array,
        usd_up: pa.Array,
        own0: pa.Array,
        own1: pa.Array,
        leads: pa.Array,
    ) -> pa.Array:
        inputs = (volume0, volume1, fee0, fee1, rate0, rate1, usd, gas, tip, base_fee, up0, up1, usd_up, own0, own1, leads)
        rows = [row(*r) for r in zip(*(a.to_pylist() for a in inputs))]
        types = [pa.float64() if f.name == "pct" else pa.string() for f in VALUED_TYPE.fields]
        arrays = [pa.array([r[i] for r in rows], type=t) for i, t in enumerate(types)]
        return pa.StructArray.from_arrays(arrays, names=[f.name for f in VALUED_TYPE.fields])

    return value


def value_amounts(df: DataFrame, market: Market = MARKET, conf: NumericConf = DEFAULT) -> DataFrame:
    """``base_amounts``, ``total_fees`` and ``usd_amounts`` in one Arrow pass.

    Which rate applies to which side is decided by native expressions; the pass reads
    every text once.
    """
    own = [F.coalesce(F.col(f"token{i}.address") == market.base_token, F.lit(False)) for i in "01"]
    rate0, up0 = _base_rate("base0")
    rate1, up1 = _base_rate("base1")
    usd, divide = _usd_rate(market)
    valued = _value(conf)(
        *(F.col(c) for c in ("volume0", "volume1", "fee0", "fee1")),
        rate0,
        rate1,
        usd,
        *(F.col(c) for c in ("gasFees", "tip", "baseFeePerGas")),
        up0,
        up1,
        ~divide,
        *own,
        _first_leads(own[0], own[1]),
    )
    v = F.col("__valued")

    def amounts(fields: dict[str, str]) -> Column:
        return F.create_map(*(c for k, f in fields.items() for c in (F.lit(k), v[f])))

    return (
        df.withColumn("__valued", valued)
        .withColumns(
            {
                "baseAmounts": amounts({"volume": "volume", "volumeBis": "volumeBis", "fee": "fee"}),
                "totalFees": v["totalFees"],
                "totalFeePct": v["pct"],
                "usdAmounts": amounts(
                    {
                        "volume": "usdVolume",
                        "volumeBis": "usdVolumeBis",
                        "fee": "usdFee",
                        "gasFees": "usdGas",
                        "tip": "usdTip",
                        "baseFeePerGas": "usdBaseFee",
                    }
                ),
                "totalFeesUsd": v["totalFeesUsd"],
            }
        )
        .drop("__valued")
    )
