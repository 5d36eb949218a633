"""Scalar fraction functions over lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool import functions as U
from tidepool.registry.tables import LINES_SQL, lines, text
from tidepool.sources.logs import operand_sizes

KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
KEYS_SQL = ", ".join(KEYS)


def _per_line(column):
    def query(spark, sf_dir):
        return lines(spark, sf_dir, spread=True).select(*KEYS, column().alias("v"))

    return query


def _sql(expression):
    return f"WITH {LINES_SQL} SELECT {KEYS_SQL}, {expression} AS v FROM lines"


def _signed():
    shifted = text(F.col("cents") - 5_000_000)
    den = F.when(F.col("l_returnflag") == "R", "-3").when(F.col("l_returnflag") == "A", "0").otherwise("2e4")
    return F.concat(shifted, F.lit("e2/"), den)


def parse(spark, sf_dir):
    f = U.ubi_parse(F.concat("price", F.lit("b7/"), "quantity"))
    return lines(spark, sf_dir).select(*KEYS, *(f[n].alias(n) for n in ("n", "s", "b", "dn", "ds", "db")))


def valid(spark, sf_dir):
    tail = F.when(F.col("l_returnflag") == "A", "e2").when(F.col("l_returnflag") == "N", ".5").otherwise("x")
    return (
        lines(spark, sf_dir)
        .groupBy("l_returnflag", U.ubi_is_valid(F.concat(text(F.col("cents")), tail)).alias("valid"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def sql_functions(spark, sf_dir):
    U.register_functions(spark)
    lines(spark, sf_dir, spread=True).createOrReplaceTempView("tidepool_lines")
    return spark.sql(
        f"""SELECT {KEYS_SQL},
            ubim(price, quantity) AS m, ubid(price, quantity) AS d, ubia(price, quantity) AS a,
            ubis(quantity, price) AS s, ubi_abs(ubis(quantity, price)) AS ab, ubi_sign(ubis(quantity, price)) AS sg,
            CAST(ubi_resolve(price) AS DECIMAL(20,2)) AS r
        FROM tidepool_lines"""
    )


def try_resolve(spark, sf_dir):
    risky = F.concat("price", F.lit("/"), F.when(F.col("l_returnflag") == "R", "0").otherwise("4"))
    odd = F.when(F.col("l_returnflag") == "N", F.lit("n/a")).otherwise(risky)
    value = (U.try_ubi_resolve(odd).cast("decimal(30,8)") * 10_000).cast("bigint")
    return lines(spark, sf_dir, spread=True).select(*KEYS, value.alias("v"))


def profile(spark, sf_dir):
    sized = operand_sizes(lines(spark, sf_dir, spread=True).withColumn("x", U.ubid("price", "quantity")), "x")
    names = [c for c in sized.columns if c.startswith("x_")]
    return sized.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


def common_divisor(spark, sf_dir):
    """Digits past the threshold are divided by the common divisor and lose bits past 192."""
    wide = F.concat(text(F.col("cents") * 6), F.lit("0" * 100 + "/4" + "0" * 100))
    return lines(spark, sf_dir, spread=True).select(*KEYS, U.ubi_canonical(wide).alias("v"))


QUERIES = {
    "ubi_multiply": (
        _per_line(lambda: U.ubim("price", "quantity")),
        _sql("concat(cents * qty, 'e2b0/1e0b0')"),
    ),
    "ubi_divide": (
        _per_line(lambda: U.ubid("price", "quantity")),
        _sql("concat(cents, 'e2b0/', qty, 'e0b0')"),
    ),
    "ubi_add": (
        _per_line(lambda: U.ubia("price", "quantity")),
        _sql("concat(cents + qty * 100, 'e2b0/1e0b0')"),
    ),
    "ubi_add_denominators": (
        _per_line(lambda: U.ubia(F.concat("price", F.lit("/3")), F.concat("quantity", F.lit("e0b2/7")))),
        _sql("concat(cents * 28 + qty * 300, 'e2b2/21e0b0')"),
    ),
    "ubi_subtract": (
        _per_line(lambda: U.ubis("quantity", "price")),
        _sql("concat(qty * 100 - cents, 'e2b0/1e0b0')"),
    ),
    "ubi_resolve": (
        _per_line(
            lambda: (U.ubi_resolve(U.ubid("price", F.lit("8"))).cast("decimal(20,6)") * 1_000_000).cast("bigint")
        ),
        _sql("cents * 1250"),
    ),
    "ubi_resolve_bits": (
        _per_line(lambda: (U.ubi_resolve(F.concat("price", F.lit("b5"))).cast("decimal(30,10)") * 10**7).cast("bigint")),
        _sql("cents * 3125"),
    ),
    "ubi_resolve_fast": (
        _per_line(lambda: U.ubi_resolve_fast(F.concat(text(F.col("cents")), F.lit("e0b3"))).cast("bigint")),
        _sql("(cents + 4) // 8"),
    ),
    "ubi_try_resolve": (
        try_resolve,
        _sql("CASE WHEN l_returnflag = 'A' THEN cents * 25 END"),
    ),
    "ubi_abs": (
        _per_line(lambda: U.ubi_abs(F.concat(F.lit("-"), "price", F.lit("/-2")))),
        _sql("concat(cents, 'e2b0/2e0b0')"),
    ),
    "ubi_sign": (
        _per_line(lambda: U.ubi_sign(_signed())),
        _sql(
            "CASE WHEN cents = 5000000 THEN 0 WHEN l_returnflag = 'A' THEN -1 "
            "WHEN (cents < 5000000) = (l_returnflag = 'R') THEN 1 ELSE -1 END"
        ),
    ),
    "ubi_parse": (
        parse,
        f"WITH {LINES_SQL} SELECT {KEYS_SQL}, CAST(cents AS VARCHAR) AS n, 2 AS s, 7 AS b, "
        "CAST(qty AS VARCHAR) AS dn, 0 AS ds, 0 AS db FROM lines",
    ),
    "ubi_is_valid": (
        valid,
        "SELECT l_returnflag, l_returnflag <> 'R' AS valid, count(*) AS n FROM lineitem GROUP BY ALL",
    ),
    "ubi_sql_functions": (
        sql_functions,
        f"""WITH {LINES_SQL} SELECT {KEYS_SQL}, concat(cents * qty, 'e2b0/1e0b0') AS m,
            concat(cents, 'e2b0/', qty, 'e0b0') AS d, concat(cents + qty * 100, 'e2b0/1e0b0') AS a,
            concat(qty * 100 - cents, 'e2b0/1e0b0') AS s, concat(abs(qty * 100 - cents), 'e2b0/1e0b0') AS ab,
            CAST(sign(qty * 100 - cents) AS INTEGER) AS sg, CAST(cents / 100.0 AS DECIMAL(20,2)) AS r FROM lines""",
    ),
    "ubi_common_divisor": (
        common_divisor,
        _sql("concat(cents * 6 // gcd(cents * 6, 4), 'e0b0/', 4 // gcd(cents * 6, 4), 'e0b0')"),
    ),
    "ubi_operand_sizes": (
        profile,
        f"""WITH {LINES_SQL} SELECT length(CAST(cents AS VARCHAR)) AS x_num_digits, 2 AS x_num_scale, 0 AS x_num_bits,
            length(CAST(qty AS VARCHAR)) AS x_den_digits, 0 AS x_den_scale, 0 AS x_den_bits, count(*) AS n
        FROM lines GROUP BY ALL""",
    ),
}
