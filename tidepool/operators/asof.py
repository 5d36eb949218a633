"""As-of quotes and deltas to the previous row, both with an expiry in order units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.slicing import Carry, carry_last


def _quoted(order: str, is_quote: Column, quote: Column) -> Column:
    return F.when(F.coalesce(is_quote, F.lit(False)), F.struct(quote.alias("quote"), F.col(order).alias("at")))


def quote_carry(by: Sequence[str], order: str, is_quote: Column, quote: Column, alias: str) -> Carry:
    """What ``asof_quote`` looks up, for rows dealt for it."""
    return Carry(alias, list(by), _quoted(order, is_quote, quote), sparse=True)


def _before(order: str, fields: Column) -> Column:
    return F.struct(fields.alias("fields"), F.col(order).alias("at"))


def previous_carry(by: Sequence[str], order: str, fields: Column, alias: str) -> Carry:
    """What ``previous_row`` looks up, for rows dealt for it."""
    return Carry(alias, list(by), _before(order, fields))


def asof_quote(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    is_quote: Column,
    quote: Column,
    alias: str,
    expiry: int | None,
    slices: int | None = None,
) -> DataFrame:
    """Latest earlier quote of the same key.

    A quote row sets the quote for later rows and gets none itself; a quote older
    than ``expiry`` order units gives NULL. With no key columns this is one global
    rate for all rows.
    """
    flag = F.coalesce(is_quote, F.lit(False))
    found = carry_last(df, by, [order], _quoted(order, is_quote, quote), "__held", slices, sparse=True, name=alias)
    usable = ~flag
    if expiry is not None:
        usable &= F.col(order) - F.col("__held.at") <= expiry
    return found.withColumn(alias, F.when(usable, F.col("__held.quote"))).drop("__held")


def previous_row(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    fields: Column,
    alias: str,
    expiry: int | None,
    slices: int | None = None,
) -> DataFrame:
    """Struct ``fields`` of the previous row of the key unless it is older than ``expiry``."""
    found = carry_last(df, by, [order], _before(order, fields), "__held", slices, name=alias)
    value = F.col("__held.fields")
    if expiry is not None:
        value = F.when(F.col(order) - F.col("__held.at") <= expiry, value)
    return found.withColumn(alias, value).drop("__held")


def rolling_latest(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    counts: Column,
    value: Column,
    alias: str,
    slices: int | None = None,
) -> DataFrame:
    """``value`` of the latest row that counts, up to and including each row, without expiry."""
    held = F.when(F.coalesce(counts, F.lit(False)), F.struct(value.alias("value")))
    found = carry_last(df.withColumn("__own", held), by, [order], F.col("__own"), "__held", slices, sparse=True)
    return found.withColumn(alias, F.coalesce("__own", "__held")["value"]).drop("__own", "__held")
