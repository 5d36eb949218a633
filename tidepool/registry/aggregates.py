"""Fraction aggregates, moments and percentiles over lineitem and events."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tidepool import functions as U
from tidepool.operators.balance import in_pieces, pieces
from tidepool.operators.quantiles import exact_percentiles, quartile
from tidepool.plans.pool_day import distribution, trend
from tidepool.registry.tables import LINES_SQL, TICKS_SQL, epoch_seconds, lines, rounded, text, ticks

FLAGS = ["l_returnflag", "l_linestatus"]
LINE = ["l_orderkey", "l_linenumber"]


def revenue(spark, sf_dir):
    """Exact revenue per return flag and line status."""
    return U.ubi_aggregate(lines(spark, sf_dir, spread=True), FLAGS, {"revenue": ("sum", U.ubim("price", "quantity"))})


def limb_sum(spark, sf_dir):
    return U.ubi_sum_limbs(lines(spark, sf_dir, spread=True), FLAGS, "price", "total")


def grouped_sum(spark, sf_dir):
    return lines(spark, sf_dir, spread=True).groupBy("l_suppkey").agg(U.ubi_sum("price").alias("total"), U.ubi_avg("price").alias("mean"))


def sql_aggregates(spark, sf_dir):
    U.register_functions(spark)
    lines(spark, sf_dir, spread=True).createOrReplaceTempView("tidepool_lines")
    return spark.sql(
        """SELECT l_suppkey, ubi_sum(price) AS total, ubi_avg(price) AS mean,
            ubi_min(price) AS low, ubi_max(price) AS high FROM tidepool_lines GROUP BY l_suppkey"""
    )


def wide_sum(spark, sf_dir):
    """Sums far past 38 digits."""
    wide = F.concat(text(F.col("cents") * F.when(F.col("l_returnflag") == "R", -1).otherwise(1)), F.lit("0" * 70))
    df = lines(spark, sf_dir, spread=True).withColumn("wide", wide)
    folded = U.ubi_aggregate(df, ["l_linestatus"], {"total": ("sum", "wide")})
    limbs = U.ubi_sum_limbs(df, ["l_linestatus"], "wide", "total_limbs")
    return folded.join(limbs, "l_linestatus")


def averages(spark, sf_dir):
    return U.ubi_aggregate(lines(spark, sf_dir, spread=True), ["l_suppkey"], {"mean": ("avg", "price")})


def extremes(spark, sf_dir):
    return U.ubi_aggregate(lines(spark, sf_dir, spread=True), ["l_suppkey"], {"low": ("min", "price"), "high": ("max", "price")})


def native_extremes(spark, sf_dir):
    unit = U.ubid("price", "quantity")
    # rows are sorted for extremes of texts; a task sorts one piece
    df = in_pieces(lines(spark, sf_dir, spread=True).select(*LINE, "l_suppkey", "price", "quantity"), *LINE)
    return df.groupBy("l_suppkey").agg(
        rounded(U.ubi_to_double(U.ubi_min(unit)), 6).alias("low"), rounded(U.ubi_to_double(U.ubi_max(unit)), 6).alias("high")
    )


def mixed_denominators(spark, sf_dir):
    """Sum of unit prices: one encoding per quantity, folded exactly."""
    unit = U.ubid("price", "quantity")
    df = U.ubi_aggregate(lines(spark, sf_dir, spread=True), FLAGS, {"total": ("sum", unit)})
    return df.select(*FLAGS, rounded(U.ubi_to_double("total"), 4).alias("total"))


def moments(spark, sf_dir):
    df = ticks(spark, sf_dir).withColumn("unix", epoch_seconds("ts"))
    stats = [c for c in distribution(F.col("value"), "0")]
    out = df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), *stats, trend(F.col("value"), "unix").alias("trend0"))
    names = ["ttAbsPriceDeltaPct0", "skewness0", "kurtosis0", "trend0"]
    return out.select("event_type", "n", *(rounded(F.col(c), 6).alias(c) for c in names))


def quartiles(spark, sf_dir):
    return ticks(spark, sf_dir).groupBy("event_type").agg(
        *(rounded(quartile(q, "value"), 6).alias(f"q{q}") for q in (1, 2, 3)),
        rounded(quartile(2, F.abs(F.col("k") - 50)), 6).alias("med_k"),
    )


def sliced_percentiles(spark, sf_dir):
    outputs = {"q1": ("value", 0.25), "q2": ("value", 0.5), "q3": ("value", 0.75), "med_k": (F.abs(F.col("k") - 50), 0.5)}
    got = exact_percentiles(ticks(spark, sf_dir), ["event_type"], outputs, slices=8)
    return got.select("event_type", *(rounded(F.col(c), 6).alias(c) for c in outputs))


def first_last(spark, sf_dir):
    return ticks(spark, sf_dir).groupBy("user_id").agg(
        F.min_by("cents", "event_id").alias("first"),
        F.max_by("cents", "event_id").alias("last"),
        F.min("event_id").alias("first_at"),
        F.max("event_id").alias("last_at"),
        F.any_value(F.col("user_id") * 2).alias("twice"),
    )


_QUARTILE_SQL = f"""WITH {TICKS_SQL} SELECT event_type,
    round(quantile_cont(CAST(value AS DOUBLE), 0.25), 6) + 0.0 AS q1, round(quantile_cont(CAST(value AS DOUBLE), 0.5), 6) + 0.0 AS q2,
    round(quantile_cont(CAST(value AS DOUBLE), 0.75), 6) + 0.0 AS q3,
    round(quantile_cont(CAST(abs(k - 50) AS DOUBLE), 0.5), 6) + 0.0 AS med_k
FROM ticks GROUP BY event_type"""



def product_and_quotient(spark, sf_dir):
    """Two functions of the same two columns."""
    price, quantity = F.col("price"), F.col("quantity")
    sums = {"product": ("sum", U.ubim(price, quantity)), "quotient": ("sum", U.ubid(price, quantity))}
    df = U.ubi_aggregate(lines(spark, sf_dir, spread=True), FLAGS, sums)
    return df.select(*FLAGS, "product", rounded(U.ubi_to_double("quotient"), 4).alias("quotient"))


def many_denominators(spark, sf_dir):
    """A sum over more denominators than rows of most keys, the same text whatever the partitions."""
    df = lines(spark, sf_dir).withColumn("part", text(F.col("l_partkey") * 2 + 3)).select(*LINE, *FLAGS, "price", "part")
    size = math.ceil(pieces(df) / 3)  # parts of which a task gets one, whatever the table's size
    forms = [
        U.ubi_aggregate(df.repartition(parts * size, F.xxhash64(*LINE)), FLAGS, {f"t{parts}": ("sum", U.ubid("price", "part"))}) for parts in (3, 7)
    ]
    both = forms[0].join(forms[1], FLAGS)
    return both.select(*FLAGS, rounded(U.ubi_to_double("t3"), 4).alias("total"), (F.col("t3") == F.col("t7")).alias("same"))


def tiny_and_huge(spark, sf_dir):
    """Sums of values below 10**-290 and of values past 10**150."""
    df = lines(spark, sf_dir, spread=True).select(
        "l_linestatus",
        F.concat(text(F.col("cents")), F.lit("e300")).alias("tiny"),
        F.concat(text(F.col("cents")), F.lit("0" * 150)).alias("huge"),
    )
    return U.ubi_aggregate(df, ["l_linestatus"], {"tiny": ("sum", "tiny"), "huge": ("sum", "huge")})


def line_sums(spark, sf_dir):
    """One key per order line."""
    return U.ubi_aggregate(lines(spark, sf_dir, spread=True), ["l_orderkey", "l_linenumber"], {"total": ("sum", "price")})


QUERIES = {
    "ubi_product_and_quotient_sums": (
        product_and_quotient,
        f"""WITH {LINES_SQL} SELECT l_returnflag, l_linestatus, concat(sum(CAST(cents AS HUGEINT) * qty), 'e2b0/1e0b0') AS product,
            round(sum(cents / 100.0::DOUBLE / qty), 4) + 0.0 AS quotient FROM lines GROUP BY ALL""",
    ),
    "ubi_sum_many_denominators": (
        many_denominators,
        f"""WITH {LINES_SQL} SELECT l_returnflag, l_linestatus, round(sum(cents / 100.0::DOUBLE / (l_partkey * 2 + 3)), 4) + 0.0 AS total,
            true AS same FROM lines GROUP BY ALL""",
    ),
    "ubi_sum_tiny_and_huge": (
        tiny_and_huge,
        f"""WITH {LINES_SQL} SELECT l_linestatus, concat(sum(cents), 'e300b0/1e0b0') AS tiny,
            concat(sum(cents), repeat('0', 150), 'e0b0/1e0b0') AS huge FROM lines GROUP BY ALL""",
    ),
    "ubi_sum_by_line": (
        line_sums,
        f"""WITH {LINES_SQL} SELECT l_orderkey, l_linenumber, concat(sum(cents), 'e2b0/1e0b0') AS total FROM lines GROUP BY ALL""",
    ),
    "exact_revenue": (
        revenue,
        f"""WITH {LINES_SQL} SELECT l_returnflag, l_linestatus,
            concat(sum(CAST(cents AS HUGEINT) * qty), 'e2b0/1e0b0') AS revenue FROM lines GROUP BY ALL""",
    ),
    "ubi_sum_limbs": (
        limb_sum,
        f"""WITH {LINES_SQL} SELECT l_returnflag, l_linestatus,
            concat(sum(CAST(cents AS HUGEINT)), 'e2b0/1e0b0') AS total FROM lines GROUP BY ALL""",
    ),
    "ubi_sum_grouped": (
        grouped_sum,
        f"""WITH {LINES_SQL} SELECT l_suppkey, concat(sum(cents), 'e2b0/1e0b0') AS total,
            concat(sum(cents), 'e2b0/', count(*), 'e0b0') AS mean FROM lines GROUP BY ALL""",
    ),
    "ubi_sql_aggregates": (
        sql_aggregates,
        f"""WITH {LINES_SQL} SELECT l_suppkey, concat(sum(cents), 'e2b0/1e0b0') AS total,
            concat(sum(cents), 'e2b0/', count(*), 'e0b0') AS mean, concat(min(cents), 'e2b0/1e0b0') AS low,
            concat(max(cents), 'e2b0/1e0b0') AS high FROM lines GROUP BY ALL""",
    ),
    "ubi_sum_wide": (
        wide_sum,
        f"""WITH {LINES_SQL}, sums AS (SELECT l_linestatus,
            concat(sum(CASE WHEN l_returnflag = 'R' THEN -cents ELSE cents END), repeat('0', 70), 'e0b0/1e0b0') AS total
            FROM lines GROUP BY ALL) SELECT l_linestatus, total, total AS total_limbs FROM sums""",
    ),
    "ubi_avg": (
        averages,
        f"""WITH {LINES_SQL} SELECT l_suppkey, concat(sum(cents), 'e2b0/', count(*), 'e0b0') AS mean
            FROM lines GROUP BY ALL""",
    ),
    "ubi_min_max": (
        extremes,
        f"""WITH {LINES_SQL} SELECT l_suppkey, concat(min(cents), 'e2b0/1e0b0') AS low,
            concat(max(cents), 'e2b0/1e0b0') AS high FROM lines GROUP BY ALL""",
    ),
    "ubi_min_max_native": (
        native_extremes,
        f"""WITH {LINES_SQL} SELECT l_suppkey, round(min(cents / 100.0::DOUBLE / qty), 6) + 0.0 AS low,
            round(max(cents / 100.0::DOUBLE / qty), 6) + 0.0 AS high FROM lines GROUP BY ALL""",
    ),
    "ubi_sum_mixed": (
        mixed_denominators,
        f"""WITH {LINES_SQL} SELECT l_returnflag, l_linestatus, round(sum(cents / 100.0::DOUBLE / qty), 4) + 0.0 AS total
            FROM lines GROUP BY ALL""",
    ),
    "distribution_trend": (
        moments,
        """WITH m AS (SELECT event_type, count(*) AS n, avg(value) AS mu, sum(abs(value)) AS tt,
                covar_pop(value, CAST(epoch(ts) AS BIGINT)) AS cov,
                stddev_samp(value) * stddev_samp(CAST(epoch(ts) AS BIGINT)) AS spread FROM events GROUP BY ALL),
            c AS (SELECT e.event_type, avg(pow(value - mu, 2)) AS m2, avg(pow(value - mu, 3)) AS m3,
                avg(pow(value - mu, 4)) AS m4 FROM events e JOIN m USING (event_type) GROUP BY ALL)
        SELECT event_type, n, round(tt, 6) + 0.0 AS ttAbsPriceDeltaPct0, round(m3 / pow(m2, 1.5), 6) + 0.0 AS skewness0,
            round(m4 / (m2 * m2) - 3, 6) + 0.0 AS kurtosis0, round(cov / spread, 6) + 0.0 AS trend0
        FROM m JOIN c USING (event_type)""",
    ),
    "quartiles": (quartiles, _QUARTILE_SQL),
    "percentiles_sliced": (sliced_percentiles, _QUARTILE_SQL),
    "first_last": (
        first_last,
        f"""WITH {TICKS_SQL} SELECT user_id, min_by(cents, event_id) AS first, max_by(cents, event_id) AS last,
            min(event_id) AS first_at, max(event_id) AS last_at, user_id * 2 AS twice FROM ticks GROUP BY user_id""",
    ),
}
