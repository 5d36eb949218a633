"""As-of quotes, deltas, joins, upserts and ordering over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.functions import ubi_to_double
from tidepool.operators.asof import asof_quote, rolling_latest
from tidepool.operators.joins import dimension_join, frame_difference, two_role_join
from tidepool.operators.pricing import swap_delta
from tidepool.operators.projections import log_id, pair_columns, resolve_columns
from tidepool.operators.series import series_parts
from tidepool.operators.upsert import merge_upsert
from tidepool.registry.tables import LINES_SQL, TICKS_SQL, lines, read, rounded, text, ticks

KEYED_EXPIRY = 400
GLOBAL_EXPIRY = 12
DELTA_EXPIRY = 300
SLICES = 8


def asof_keyed(slices):
    """Latest purchase of the same user, at most some events ago."""

    def query(spark, sf_dir):
        quoted = F.col("event_type") == "purchase"
        df = ticks(spark, sf_dir).select("event_id", "user_id", "event_type", "cents")
        return asof_quote(df, ["user_id"], "event_id", quoted, F.col("cents"), "rate", KEYED_EXPIRY, slices)

    return query


def asof_global(slices):
    """Latest signup of anyone, at most some events ago."""

    def query(spark, sf_dir):
        df = ticks(spark, sf_dir).select("event_id", "event_type", "cents")
        quoted = F.col("event_type") == "signup"
        return asof_quote(df, [], "event_id", quoted, F.col("cents"), "rate", GLOBAL_EXPIRY, slices)

    return query


def deltas(slices):
    def query(spark, sf_dir):
        df = ticks(spark, sf_dir).select(
            "event_id",
            F.col("user_id").alias("address"),
            F.concat(text(F.col("cents")), F.lit("e2")).alias("price0"),
            F.concat(text(F.col("k") + 1), F.lit("e1")).alias("price1"),
            F.col("k").alias("tick"),
        )
        moved = swap_delta(df, DELTA_EXPIRY, order="event_id", slices=slices)
        return moved.select(
            "event_id",
            "address",
            "lastPrice0",
            "priceDelta0",
            "priceDelta1",
            rounded(F.col("priceDeltaPct0"), 6).alias("pct0"),
            rounded(F.col("priceDeltaPct1"), 6).alias("pct1"),
            "tickDelta",
        )

    return query


def rolling(slices):
    def query(spark, sf_dir):
        df = ticks(spark, sf_dir).select("event_id", "user_id", "event_type", "cents")
        counts = F.col("event_type") == "purchase"
        return rolling_latest(df, ["user_id"], "event_id", counts, F.col("cents"), "rate", slices)

    return query


def two_roles(spark, sf_dir):
    """Nation of customer and of supplier of every order line."""
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    pairs = (
        read(spark, sf_dir, "lineitem")
        .join(read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "l_linenumber", "c_nationkey", "s_nationkey")
    )
    named = two_role_join(pairs, nation, {"buyer": "c_nationkey", "seller": "s_nationkey"}, "n_nationkey", ["l_orderkey", "l_linenumber"])
    return named.groupBy(F.col("buyer.n_name").alias("buyer"), F.col("seller.n_name").alias("seller")).agg(F.count(F.lit(1)).alias("n"))


def two_keys(spark, sf_dir):
    """Left join on two keys: lines with the totals of their order and supplier."""
    line = lines(spark, sf_dir)
    totals = line.groupBy("l_orderkey", "l_suppkey").agg(F.sum("cents").alias("total"))
    joined = line.join(totals, ["l_orderkey", "l_suppkey"], "left")
    return joined.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count("total").alias("matched"), F.sum("total").alias("total")
    )


def dimension(broadcast_bytes):
    def query(spark, sf_dir):
        parts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        joined = dimension_join(
            lines(spark, sf_dir), parts, ["l_partkey"], ["l_orderkey", "l_linenumber"], broadcast_bytes
        )
        return joined.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("total"))

    return query


def upsert(spark, sf_dir):
    """Orders merged with a newer, overlapping set of orders."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    target = orders.where(F.col("o_orderstatus").isin("F", "O"))
    batch = orders.where(F.col("o_orderstatus").isin("O", "P")).withColumn("o_custkey", -F.col("o_custkey"))
    return merge_upsert(target, batch, ["o_orderkey"])


def difference(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    left = orders.where(F.col("o_orderstatus").isin("F", "O"))
    right = orders.where(F.col("o_orderstatus").isin("O", "P"))
    return frame_difference(left, right).groupBy("side", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def order_key(spark, sf_dir):
    df = read(spark, sf_dir, "lineitem").select(
        "l_partkey",
        "l_suppkey",
        text(log_id("l_orderkey", "l_linenumber", "l_suppkey", strict=True)).alias("at"),
    )
    return df


def pairs(spark, sf_dir):
    df = lines(spark, sf_dir).withColumns({"amount0": F.col("cents"), "amount1": F.col("qty")})
    both = df.withColumns(pair_columns("twice", ["amount", "amount"], lambda a, b: a + b))
    return both.groupBy("l_returnflag").agg(F.sum("twice0").alias("twice0"), F.sum("twice1").alias("twice1"))


def series(slices):
    """Whole series of every user, read back row by row."""

    def query(spark, sf_dir):
        df = ticks(spark, sf_dir).withColumn("price", F.concat(text(F.col("cents")), F.lit("e2/3")))
        point = F.struct("event_id", "price", "k")
        parts = series_parts(df, ["user_id"], "event_id", {"points": point}, slices, 20)
        return resolve_columns(parts, ["points"]).select("user_id", F.inline("points")).select(
            "user_id", "event_id", rounded(F.col("price"), 6).alias("price"), "k"
        )

    return query


def resolved(spark, sf_dir):
    df = lines(spark, sf_dir).select("l_orderkey", "l_partkey", F.concat("price", F.lit("/7")).alias("x"))
    return df.select("l_orderkey", "l_partkey", rounded(ubi_to_double("x"), 4).alias("x"))


def union_of_years(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), "o_orderstatus")
    early = orders.where(F.col("y") < 1996).drop("o_orderstatus")
    late = orders.where(F.col("y") >= 1996)
    both = early.unionByName(late, allowMissingColumns=True)
    return both.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.count("o_orderstatus").alias("known"))


def sorted_top(spark, sf_dir):
    """Dearest lines: order and limit."""
    return (
        lines(spark, sf_dir)
        .orderBy(F.desc("cents"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .limit(50)
        .select("l_orderkey", "l_linenumber", "cents")
    )


_ASOF_KEYED = f"""WITH {TICKS_SQL}, held AS (
    SELECT event_id, user_id, event_type, cents,
        last_value(CASE WHEN event_type = 'purchase' THEN cents END IGNORE NULLS) OVER w AS q,
        last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER w AS pos
    FROM ticks WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
) SELECT event_id, user_id, event_type, cents,
    CASE WHEN event_type <> 'purchase' AND event_id - pos <= {KEYED_EXPIRY} THEN q END AS rate FROM held"""
_ASOF_GLOBAL = f"""WITH {TICKS_SQL}, held AS (
    SELECT event_id, event_type, cents,
        last_value(CASE WHEN event_type = 'signup' THEN cents END IGNORE NULLS) OVER w AS q,
        last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER w AS pos
    FROM ticks WINDOW w AS (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
) SELECT event_id, event_type, cents,
    CASE WHEN event_type <> 'signup' AND event_id - pos <= {GLOBAL_EXPIRY} THEN q END AS rate FROM held"""
_DELTAS = f"""WITH {TICKS_SQL}, prev AS (
    SELECT *, lag(cents) OVER w AS c0, lag(k) OVER w AS k0, lag(event_id) OVER w AS pos
    FROM ticks WINDOW w AS (PARTITION BY user_id ORDER BY event_id)
), near AS (
    SELECT event_id, user_id, cents, k, CASE WHEN event_id - pos <= {DELTA_EXPIRY} THEN c0 END AS c0,
        CASE WHEN event_id - pos <= {DELTA_EXPIRY} THEN k0 END AS k0 FROM prev
) SELECT event_id, user_id AS address, CASE WHEN c0 IS NOT NULL THEN concat(c0, 'e2') END AS lastPrice0,
    CASE WHEN c0 IS NOT NULL THEN concat(cents - c0, 'e2b0/1e0b0') END AS priceDelta0,
    CASE WHEN c0 IS NOT NULL THEN concat(k - k0, 'e1b0/1e0b0') END AS priceDelta1,
    round(CAST(cents - c0 AS DOUBLE) / c0 * 100, 6) + 0.0 AS pct0,
    round(CAST(k - k0 AS DOUBLE) / (k0 + 1) * 100, 6) + 0.0 AS pct1, k - k0 AS tickDelta FROM near"""
_ROLLING = f"""WITH {TICKS_SQL} SELECT event_id, user_id, event_type, cents,
    last_value(CASE WHEN event_type = 'purchase' THEN cents END IGNORE NULLS) OVER (
        PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rate FROM ticks"""
_DIMENSION = f"""WITH {LINES_SQL} SELECT p_brand, count(*) AS n, CAST(sum(cents) AS BIGINT) AS total
    FROM lines LEFT JOIN part ON p_partkey = l_partkey GROUP BY ALL"""
_SERIES = f"""WITH {TICKS_SQL} SELECT user_id, event_id, round(cents / 300.0::DOUBLE, 6) + 0.0 AS price, k FROM ticks"""

QUERIES = {
    "asof_keyed": (asof_keyed(None), _ASOF_KEYED),
    "asof_keyed_sliced": (asof_keyed(SLICES), _ASOF_KEYED),
    "asof_global": (asof_global(None), _ASOF_GLOBAL),
    "asof_global_sliced": (asof_global(SLICES), _ASOF_GLOBAL),
    "swap_delta": (deltas(None), _DELTAS),
    "swap_delta_sliced": (deltas(SLICES), _DELTAS),
    "rolling_latest": (rolling(None), _ROLLING),
    "rolling_latest_sliced": (rolling(SLICES), _ROLLING),
    "two_role_join": (
        two_roles,
        """SELECT b.n_name AS buyer, s.n_name AS seller, count(*) AS n
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
            JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation b ON c_nationkey = b.n_nationkey
            LEFT JOIN nation s ON s_nationkey = s.n_nationkey GROUP BY ALL""",
    ),
    "two_key_join": (
        two_keys,
        f"""WITH {LINES_SQL}, totals AS (SELECT l_orderkey, l_suppkey, CAST(sum(cents) AS BIGINT) AS total
            FROM lines GROUP BY ALL)
        SELECT l_returnflag, count(*) AS n, count(total) AS matched, CAST(sum(total) AS BIGINT) AS total
        FROM lines LEFT JOIN totals USING (l_orderkey, l_suppkey) GROUP BY ALL""",
    ),
    "dimension_join": (dimension(64 << 20), _DIMENSION),
    "dimension_join_salted": (dimension(-1), _DIMENSION),
    "merge_upsert": (
        upsert,
        """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE -o_custkey END AS o_custkey
        FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""",
    ),
    "frame_difference": (
        difference,
        """WITH l AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O')),
            r AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'P')),
            d AS (SELECT 'left' AS side, * FROM (FROM l EXCEPT ALL FROM r) UNION ALL
                SELECT 'right' AS side, * FROM (FROM r EXCEPT ALL FROM l))
        SELECT side, o_orderstatus, count(*) AS n FROM d GROUP BY ALL""",
    ),
    "event_order_key": (
        order_key,
        """SELECT l_partkey, l_suppkey, concat(l_orderkey, '.', lpad(CAST(l_linenumber AS VARCHAR), 5, '0'),
            lpad(CAST(l_suppkey AS VARCHAR), 5, '0')) AS at FROM lineitem""",
    ),
    "pair_columns": (
        pairs,
        f"""WITH {LINES_SQL} SELECT l_returnflag, CAST(sum(cents * 2) AS BIGINT) AS twice0,
            CAST(sum(qty * 2) AS BIGINT) AS twice1 FROM lines GROUP BY ALL""",
    ),
    "series": (series(None), _SERIES),
    "series_parts": (series(SLICES), _SERIES),
    "resolve_to_double": (
        resolved,
        f"WITH {LINES_SQL} SELECT l_orderkey, l_partkey, round(cents / 700.0::DOUBLE, 4) + 0.0 AS x FROM lines",
    ),
    "union_of_partitions": (
        union_of_years,
        """SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n,
            CAST(sum(CASE WHEN year(o_orderdate) >= 1996 THEN 1 ELSE 0 END) AS BIGINT) AS known
        FROM orders GROUP BY ALL""",
    ),
    "sort_limit": (
        sorted_top,
        f"""WITH {LINES_SQL} SELECT l_orderkey, l_linenumber, cents FROM lines
            ORDER BY cents DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 50""",
    ),
}
