"""Prices, volumes, deltas and tick liquidity of single swaps."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.numeric import Arithmetic, NumericConf
from tidepool.functions.scalars import DEFAULT, ubi_abs, ubi_sign, ubi_to_double, ubid, ubim, ubis
from tidepool.operators.asof import previous_carry, previous_row
from tidepool.operators.slicing import Carry
from tidepool.operators.projections import pair_columns

# Fractional bits of a square-root price, hence of a price; fee unit.
ROOT_BITS = 96
PRICE_BITS = 192
FEE_DECIMALS = 6
TICK_BASE = 1.0001


def swap_price(df: DataFrame, conf: NumericConf = DEFAULT) -> DataFrame:
    """``price1`` (token1 per token0), its inverse ``price0`` and the root as a double.

    The square of the 96-bit root is an integer that only needs its label changed
    to 192 bits and to the difference of the token decimals.
    """
    label = F.concat(
        F.lit("e"), (F.col("token1.decimals") - F.col("token0.decimals")).cast("string"), F.lit(f"b{PRICE_BITS}/")
    )
    square = ubim("sqrtPriceX96", "sqrtPriceX96", conf)
    return (
        df.withColumn("price1", F.regexp_replace(square, F.lit("e0b0/"), label))
        .withColumn("price0", ubid(F.lit("1"), "price1", conf))
        .withColumn("resolvedSqrtPrice", ubi_to_double(ubid("sqrtPriceX96", F.lit(str(1 << ROOT_BITS)), conf), conf))
    )


def swap_volume(df: DataFrame, conf: NumericConf = DEFAULT) -> DataFrame:
    """Amounts with decimals, liquidity provider fees, net amounts and volumes."""
    scaled = pair_columns("amount", ["amount", "token"], _with_decimals)
    fee = F.concat(F.col("fee").cast("string"), F.lit(f"e{FEE_DECIMALS}"))
    fees = pair_columns(
        "fee", ["amount"], lambda a: F.when(ubi_sign(a) > 0, ubim(a, fee, conf)).otherwise(F.lit("0"))
    )
    return (
        df.withColumns(scaled)
        .withColumns(fees)
        .withColumns(pair_columns("netAmount", ["amount", "fee"], lambda a, f: ubis(a, f, conf)))
        .withColumns(pair_columns("volume", ["netAmount"], lambda n: ubi_abs(n, conf)))
    )


def _with_decimals(amount: Column, token: Column) -> Column:
    decimals = token["decimals"].cast("string")
    return F.when(decimals.isNull(), amount).otherwise(F.concat(amount, F.lit("e"), decimals))


FUSED_TYPE = T.StructType(
    [
        T.StructField(n, T.DoubleType() if n == "resolvedSqrtPrice" else T.StringType())
        for n in (
            "price1",
            "price0",
            "resolvedSqrtPrice",
            "amount0",
            "amount1",
            "fee0",
            "fee1",
            "netAmount0",
            "netAmount1",
            "volume0",
            "volume1",
        )
    ]
)


def _price_volume(conf: NumericConf):
    math = Arithmetic(conf)
    one, root_unit, nothing = math.parse("1"), math.parse(str(1 << ROOT_BITS)), math.parse("0")

    def side(amount, decimals, fee):
        if amount is None:
            return None, None, None, None
        text = amount if decimals is None else f"{amount}e{decimals}"
        value = math.parse(text)
        if math.sign(value) <= 0:
            charged, charged_text = nothing, "0"
        elif fee is None:
            return text, None, None, None
        else:
            charged = math.multiply(value, (fee, FEE_DECIMALS, 0, 1, 0, 0))
            charged_text = math.text(charged)
        net = math.subtract(value, charged)
        return text, charged_text, math.text(net), math.text(math.absolute(net))

    def price(root, decimals0, decimals1):
        if root is None:
            return None, None, None
        value = math.parse(root)
        resolved = math.to_float(math.divide(value, root_unit))
        if decimals0 is None or decimals1 is None:
            return None, None, resolved
        square = math.multiply(value, value)
        price1 = (square[0], decimals1 - decimals0, PRICE_BITS) + square[3:]
        return math.text(price1), math.text(math.divide(one, math.parse(math.text(price1)))), resolved

    @F.arrow_udf(FUSED_TYPE)
    def compute(
        root: pa.Array, amount0: pa.Array, amount1: pa.Array, fee: pa.Array, decimals0: pa.Array, decimals1: pa.Array
    ) -> pa.Array:
        columns = [[] for _ in FUSED_TYPE.fields]
        rows = zip(*(a.to_pylist() for a in (root, amount0, amount1, fee, decimals0, decimals1)))
        for r, a0, a1, f, d0, d1 in rows:
            prices = price(r, d0, d1)
            t0, f0, n0, v0 = side(a0, d0, f)
            t1, f1, n1, v1 = side(a1, d1, f)
            for column, v in zip(columns, (*prices, t0, t1, f0, f1, n0, n1, v0, v1)):
                column.append(v)
        types = [pa.float64() if f.name == "resolvedSqrtPrice" else pa.string() for f in FUSED_TYPE.fields]
        arrays = [pa.array(c, type=t) for c, t in zip(columns, types)]
        return pa.StructArray.from_arrays(arrays, names=[f.name for f in FUSED_TYPE.fields])

    return compute


def swap_price_volume(df: DataFrame, conf: NumericConf = DEFAULT) -> DataFrame:
    """``swap_price`` and ``swap_volume`` in one Arrow pass that reads every text once."""
    inputs = [
        F.col("sqrtPriceX96"),
        F.col("amount0"),
        F.col("amount1"),
        F.col("fee").cast("bigint"),
        F.col("token0.decimals").cast("int"),
        F.col("token1.decimals").cast("int"),
    ]
    computed = df.withColumn("__swap", _price_volume(conf)(*inputs))
    return computed.withColumns({f.name: F.col("__swap")[f.name] for f in FUSED_TYPE.fields}).drop("__swap")


def tick_liquidity(df: DataFrame) -> DataFrame:
    """Amounts of both tokens in the current tick range and its depth in either token.

    Native doubles; meant for aggregated reading.
    """
    lower_tick = F.floor(F.try_divide(F.col("tick"), F.col("tickSpacing"))) * F.col("tickSpacing")

    def root(tick: Column) -> Column:
        return F.pow(F.lit(TICK_BASE), tick / 2)

    ranged = df.withColumns({"__lower": root(lower_tick), "__upper": root(lower_tick + F.col("tickSpacing"))})
    lower, upper, now = F.col("__lower"), F.col("__upper"), F.col("resolvedSqrtPrice")
    liquidity = F.col("liquidity").cast("double")
    unit0, unit1 = (F.pow(F.lit(10.0), F.col(f"token{i}.decimals").cast("double")) for i in "01")
    return ranged.withColumns(
        {
            "tickAmount0": F.try_divide(liquidity * (upper - now), now * upper) / unit0,
            "tickAmount1": liquidity * (now - lower) / unit1,
            "tickDepth0": F.try_divide(liquidity * (upper - lower), lower * upper) / unit0,
            "tickDepth1": liquidity * (upper - lower) / unit1,
        }
    ).drop("__lower", "__upper")


MOVE_TYPE = T.StructType([T.StructField("delta", T.StringType()), T.StructField("pct", T.DoubleType())])


def _move(conf: NumericConf):
    math = Arithmetic(conf)
    arrow = pa.struct([("delta", pa.string()), ("pct", pa.float64())])

    def row(now, before):
        if now is None or before is None:
            return None
        x, y = math.parse(now), math.parse(before)
        delta = math.subtract(x, y)
        pct = math.to_float(math.divide(delta, y)) * 100 if y[0] else None  # no share of nothing
        return {"delta": math.text(delta), "pct": pct}

    @F.arrow_udf(MOVE_TYPE)
    def move(now: pa.Array, before: pa.Array) -> pa.Array:
        return pa.array([row(*v) for v in zip(now.to_pylist(), before.to_pylist())], type=arrow)

    return move


def price_move(now, before, conf: NumericConf = DEFAULT) -> Column:
    """Exact difference to an earlier price and its percentage, in one pass."""
    return _move(conf)(now, before)


def with_deltas(df: DataFrame, previous: Column, conf: NumericConf = DEFAULT) -> DataFrame:
    """Delta columns from a struct ``(price0, price1, tick)`` of the previous swap."""
    moved = df.withColumns(
        {
            "lastPrice0": previous["price0"],
            "lastPrice1": previous["price1"],
            "tickDelta": F.col("tick") - previous["tick"],
        }
    ).withColumns({f"__move{i}": price_move(F.col(f"price{i}"), F.col(f"lastPrice{i}"), conf) for i in "01"})
    return moved.withColumns(
        {
            **{f"priceDelta{i}": F.col(f"__move{i}.delta") for i in "01"},
            **{f"priceDeltaPct{i}": F.col(f"__move{i}.pct") for i in "01"},
        }
    ).drop("__move0", "__move1")


def _moving() -> Column:
    return F.struct("price0", "price1", "tick")


def delta_carry(by: tuple[str, ...] = ("address",), order: str = "logId") -> Carry:
    """What ``swap_delta`` looks up, for rows dealt for it."""
    return previous_carry(by, order, _moving(), "__previous")


def swap_delta(
    df: DataFrame,
    expiry: int,
    by: tuple[str, ...] = ("address",),
    order: str = "logId",
    slices: int | None = None,
    conf: NumericConf = DEFAULT,
) -> DataFrame:
    """Change of prices and tick against the pool's previous swap, unless it expired."""
    found = previous_row(df, by, order, _moving(), "__previous", expiry, slices)
    return with_deltas(found, F.col("__previous"), conf).drop("__previous")
