"""Column helpers shared by the pipelines."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.numeric import Arithmetic, NumericConf
from tidepool.functions.scalars import DEFAULT, ubi_to_double

PAIR = ("0", "1")
INDEX_DIGITS = 5


def log_id(block: str | Column, transaction: str | Column, log: str | Column, strict: bool = False) -> Column:
    """Event order as ``block.TTTTTLLLLL``: the integer part is the block.

    Indexes past 99999 would lose digits; ``strict`` makes them fail.
    """
    block, transaction, log = (F.col(c) if isinstance(c, str) else c for c in (block, transaction, log))

    def padded(index: Column) -> Column:
        if strict:
            index = F.when(index >= 10**INDEX_DIGITS, F.raise_error(F.lit("index past 99999"))).otherwise(index)
        return F.lpad(index.cast("string"), INDEX_DIGITS, "0")

    fraction = F.concat(F.lit("0."), padded(transaction), padded(log)).cast("decimal(25,10)")
    return block.cast("bigint") + fraction


def twin(name: str) -> str:
    """``price0`` for ``price1`` and the other way round."""
    return name[:-1] + PAIR[1 - PAIR.index(name[-1])]


def pair_columns(name: str, args: Sequence[str], fn: Callable[..., Column]) -> dict[str, Column]:
    """One expression over the ``0`` columns and over the ``1`` columns, for ``withColumns``."""
    return {name + side: fn(*(F.col(arg + side) for arg in args)) for side in PAIR}


def null_extended(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Shape a frame to ``schema``: columns it lacks become typed NULLs."""
    have = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def event_date(seconds: str | Column) -> Column:
    """Date of a unix time in seconds."""
    return F.to_date(F.timestamp_seconds(seconds))


def _resolved_array(element: T.StructType, conf: NumericConf):
    """Doubles for the text fields of an array of structs, the other fields as they are."""
    fields = [
        T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.StringType) else f.dataType)
        for f in element.fields
    ]
    text = [isinstance(f.dataType, T.StringType) for f in element.fields]
    math = Arithmetic(conf)

    @F.arrow_udf(T.ArrayType(T.StructType(fields)))
    def resolve(series: pa.Array) -> pa.Array:
        points = series.flatten()
        columns = []
        for i, is_text in enumerate(text):
            column = points.field(i)
            if is_text:
                column = pa.array([math.to_float(math.parse(v)) for v in column.to_pylist()], type=pa.float64())
            columns.append(column)
        rows = pa.StructArray.from_arrays(columns, names=[f.name for f in element.fields])
        lengths = [0 if v is None else v for v in series.value_lengths().to_pylist()]
        offsets = [0]
        for length in lengths:
            offsets.append(offsets[-1] + length)
        return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), rows, mask=series.is_null())

    return resolve


def resolve_columns(df: DataFrame, names: Sequence[str], conf: NumericConf = DEFAULT) -> DataFrame:
    """Turn fraction columns, and the text fields of series columns, into doubles."""
    resolved: Mapping[str, Column] = {}
    for name in names:
        kind = df.schema[name].dataType
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            resolved[name] = _resolved_array(kind.elementType, conf)(F.col(name))
        else:
            resolved[name] = ubi_to_double(name, conf)
    return df.withColumns(resolved)
