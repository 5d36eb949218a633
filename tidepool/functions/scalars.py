"""Scalar fraction functions as Arrow-batched column functions.

Every public function takes column names or columns and returns a column. Text
goes in and out in the form ``1e8b96/2e0b0``; NULL in gives NULL out. Validation,
sign and the struct view of canonical text stay inside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions import limbs
from tidepool.functions.numeric import Arithmetic, NumericConf

DEFAULT = NumericConf()

# Accepted text forms.
PART_FORM = r"-?\d+(e-?\d+(b\d+)?)?"
POINT_FORM = r"(-?\d+\.\d+|-?\d+\.?\d*E-?\d+)"
FRACTION_FORM = rf"^({PART_FORM}/{PART_FORM}|{PART_FORM}|{POINT_FORM})$"
CANONICAL_FORM = r"^-?\d+e-?\d+b\d+/-?\d+e-?\d+b\d+$"

FRACTION_TYPE = T.StructType(
    [T.StructField(p + f, T.StringType() if f == "n" else T.IntegerType()) for p in ("", "d") for f in ("n", "s", "b")]
)


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _vectorized(row: Callable, arity: int, sql_type: str, arrow_type: pa.DataType, columns: Callable | None):
    """Arrow function of whole columns, or applying ``row`` to each tuple without NULLs."""
    if arity == 1:

        @F.arrow_udf(sql_type)
        def apply(x: pa.Array) -> pa.Array:
            return columns(row, x) if columns else pa.array([None if v is None else row(v) for v in x.to_pylist()], type=arrow_type)

    else:

        @F.arrow_udf(sql_type)
        def apply(x: pa.Array, y: pa.Array) -> pa.Array:
            if columns:
                return columns(row, x, y)
            return pa.array(
                [None if u is None or v is None else row(u, v) for u, v in zip(x.to_pylist(), y.to_pylist())],
                type=arrow_type,
            )

    return apply


def _binary(operation: str, conf: NumericConf):
    math = Arithmetic(conf)
    compute = getattr(math, operation)

    def row(left: str, right: str):
        x, y = math.parse(left), math.parse(right)
        return None if x is None or y is None else math.text(compute(x, y))

    return row


def _resolve(conf: NumericConf):
    math = Arithmetic(conf)

    def row(text: str):
        f = math.parse(text)
        return "" if f is None else str(math.resolve(f))

    return row


def _try_resolve(conf: NumericConf):
    math = Arithmetic(conf)

    def row(text: str):
        f = math.try_parse(text)
        return None if f is None or f[3] == 0 else str(math.resolve(f))

    return row


def _quick_resolve(conf: NumericConf):
    math = Arithmetic(conf)

    def row(text: str):
        f = math.parse(text)
        value = None if f is None else math.resolve_rounded(f)
        return None if value is None else str(value)

    return row


def _to_double(conf: NumericConf):
    math = Arithmetic(conf)

    def row(text: str):
        return math.to_float(math.parse(text))

    return row


def _absolute(conf: NumericConf):
    math = Arithmetic(conf)

    def row(text: str):
        f = math.parse(text)
        return None if f is None else math.text(math.absolute(f))

    return row


def _canonical(conf: NumericConf):
    math = Arithmetic(conf)

    def row(text: str):
        f = math.parse(text)
        return None if f is None else math.text(f)

    return row


def _order_key(conf: NumericConf):
    math = Arithmetic(conf)

    def row(text: str):
        return math.order_key(math.parse(text))

    return row


def _of_columns(operation: str):
    return lambda conf: lambda row, x, y: limbs.binary(operation, conf, x, y, row)


# name -> (row function factory, factory of its form on whole columns, arity, Spark type, Arrow type)
_SCALARS = {
    "ubim": (lambda c: _binary("multiply", c), _of_columns("multiply"), 2, "string", pa.string()),
    "ubid": (lambda c: _binary("divide", c), _of_columns("divide"), 2, "string", pa.string()),
    "ubia": (lambda c: _binary("add", c), _of_columns("add"), 2, "string", pa.string()),
    "ubis": (lambda c: _binary("subtract", c), _of_columns("subtract"), 2, "string", pa.string()),
    "ubi_resolve": (_resolve, None, 1, "string", pa.string()),
    "try_ubi_resolve": (_try_resolve, None, 1, "string", pa.string()),
    "ubi_resolve_fast": (_quick_resolve, None, 1, "string", pa.string()),
    "ubi_to_double": (_to_double, lambda c: lambda row, x: limbs.to_doubles(c, x, row), 1, "double", pa.float64()),
    "ubi_abs": (_absolute, lambda c: lambda row, x: limbs.unary(c, x, row, limbs.absolute), 1, "string", pa.string()),
    "ubi_canonical": (_canonical, lambda c: lambda row, x: limbs.unary(c, x, row), 1, "string", pa.string()),
    "ubi_order_key": (_order_key, None, 1, "string", pa.string()),
}
_BOUND: dict = {}


def bound(name: str, conf: NumericConf = DEFAULT):
    """The Arrow function ``name`` under a numeric context."""
    key = (name, conf)
    if key not in _BOUND:
        make, columns, arity, sql_type, arrow_type = _SCALARS[name]
        whole = columns(conf) if columns and limbs.most_digits(conf) else None
        _BOUND[key] = _vectorized(make(conf), arity, sql_type, arrow_type, whole)
    return _BOUND[key]


def _binary_column(name: str, left, right, conf: NumericConf) -> Column:
    return bound(name, conf)(as_column(left), as_column(right))


def ubim(left, right, conf: NumericConf = DEFAULT) -> Column:
    """Exact product."""
    return _binary_column("ubim", left, right, conf)


def ubid(left, right, conf: NumericConf = DEFAULT) -> Column:
    """Exact quotient; a zero divisor only fails when resolved."""
    return _binary_column("ubid", left, right, conf)


def ubia(left, right, conf: NumericConf = DEFAULT) -> Column:
    """Exact sum."""
    return _binary_column("ubia", left, right, conf)


def ubis(left, right, conf: NumericConf = DEFAULT) -> Column:
    """Exact difference."""
    return _binary_column("ubis", left, right, conf)


def ubi_resolve(x, conf: NumericConf = DEFAULT) -> Column:
    """Decimal text of a fraction; the empty string stays empty, zero denominators fail."""
    return bound("ubi_resolve", conf)(as_column(x))


def try_ubi_resolve(x, conf: NumericConf = DEFAULT) -> Column:
    """``ubi_resolve`` giving NULL for malformed text and zero denominators."""
    return bound("try_ubi_resolve", conf)(as_column(x))


def ubi_resolve_fast(x, conf: NumericConf = DEFAULT) -> Column:
    """Quick decimal text: fractional bits are rounded away first."""
    return bound("ubi_resolve_fast", conf)(as_column(x))


def ubi_to_double(x, conf: NumericConf = DEFAULT) -> Column:
    """Double value of a fraction, NULL for NULL and the empty string."""
    return bound("ubi_to_double", conf)(as_column(x))


def ubi_abs(x, conf: NumericConf = DEFAULT) -> Column:
    return bound("ubi_abs", conf)(as_column(x))


def ubi_canonical(x, conf: NumericConf = DEFAULT) -> Column:
    """Full printed form of any accepted text."""
    return bound("ubi_canonical", conf)(as_column(x))


def ubi_order_key(x, conf: NumericConf = DEFAULT) -> Column:
    """Text key sorting like the value; makes native ``min_by``/``max_by`` exact."""
    return bound("ubi_order_key", conf)(as_column(x))


def ubi_is_valid(x) -> Column:
    """Whether a text has an accepted form (native)."""
    return as_column(x).rlike(FRACTION_FORM)


def _part_struct(text: Column, prefix: str = "") -> list[Column]:
    number = rf"^(-?\d+)(?:e(-?\d+))?(?:b(\d+))?$"
    return [
        F.regexp_extract(text, number, 1).alias(prefix + "n"),
        F.coalesce(F.nullif(F.regexp_extract(text, number, 2), F.lit("")), F.lit("0")).cast("int").alias(prefix + "s"),
        F.coalesce(F.nullif(F.regexp_extract(text, number, 3), F.lit("")), F.lit("0")).cast("int").alias(prefix + "b"),
    ]


def ubi_parse(x) -> Column:
    """Struct view ``(n, s, b, dn, ds, db)`` of integer and fraction text (native).

    Parts are shown as written; plain decimals and scientific notation need
    ``ubi_canonical`` first. Anything else is NULL.
    """
    text = as_column(x)
    sides = F.split(text, "/")
    den = F.when(F.size(sides) > 1, F.element_at(sides, -1)).otherwise(F.lit("1"))
    view = F.struct(*_part_struct(F.element_at(sides, 1)), *_part_struct(den, "d"))
    return F.when(text.rlike(rf"^{PART_FORM}(/{PART_FORM})?$"), view)


def ubi_sign_sql(x: str) -> str:
    """Native sign expression over the text expression ``x``."""
    den = rf"regexp_extract({x}, '/(-?\d+)', 1)"
    return rf"""CASE
        WHEN {x} IS NULL OR {x} = '' THEN NULL
        WHEN {x} RLIKE '^[-0.]*(e|E|b|/|$)' THEN 0
        WHEN {den} RLIKE '^-?0+$' OR startswith({x}, '-') != startswith({den}, '-') THEN -1
        ELSE 1 END"""


def ubi_sign(x) -> Column:
    """-1, 0 or 1 without leaving the JVM."""
    text = as_column(x)
    den = F.regexp_extract(text, r"/(-?\d+)", 1)
    return (
        F.when(text.isNull() | (text == ""), None)
        .when(text.rlike(r"^[-0.]*(e|E|b|/|$)"), 0)
        .when(den.rlike(r"^-?0+$") | (text.startswith("-") != den.startswith("-")), -1)
        .otherwise(1)
        .cast("int")
    )


SCALAR_NAMES = tuple(_SCALARS)
