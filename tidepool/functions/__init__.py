"""Column and SQL functions on fractions of big integers."""

from tidepool.functions.aggregates import (
    register_functions,
    ubi_aggregate,
    ubi_avg,
    ubi_max,
    ubi_min,
    ubi_sum,
    ubi_sum_limbs,
)
from tidepool.functions.numeric import NumericConf
from tidepool.functions.scalars import (
    try_ubi_resolve,
    ubi_abs,
    ubi_canonical,
    ubi_is_valid,
    ubi_order_key,
    ubi_parse,
    ubi_resolve,
    ubi_resolve_fast,
    ubi_sign,
    ubi_to_double,
    ubia,
    ubid,
    ubim,
    ubis,
)

__all__ = [
    "NumericConf",
    "register_functions",
    "try_ubi_resolve",
    "ubi_abs",
    "ubi_aggregate",
    "ubi_avg",
    "ubi_canonical",
    "ubi_is_valid",
    "ubi_max",
    "ubi_min",
    "ubi_order_key",
    "ubi_parse",
    "ubi_resolve",
    "ubi_resolve_fast",
    "ubi_sign",
    "ubi_sum",
    "ubi_sum_limbs",
    "ubi_to_double",
    "ubia",
    "ubid",
    "ubim",
    "ubis",
]
