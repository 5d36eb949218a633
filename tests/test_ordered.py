"""Ordered operators: sliced plans equal plain ones and a Python fold, under skew."""

import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators.asof import asof_quote, previous_row
from tidepool.operators.joins import dimension_join, frame_difference, two_role_join
from tidepool.operators.quantiles import exact_percentiles, quartile


@pytest.fixture(scope="module")
def ticks(spark):
    """A third of all rows on one key, NULL keys included."""
    rng = random.Random(5)
    rows, at = [], 0
    for i in range(3000):
        at += rng.choice([1, 1, 2, 40])
        key = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
        rows.append((at, key, rng.random() < 0.05, rng.randrange(100)))
    return rows


def fold_asof(rows, expiry, keyed):
    state, out = {}, {}
    for at, key, is_quote, v in rows:
        k = key if keyed else 0
        held = state.get(k)
        out[at] = held[1] if held and not is_quote and at - held[0] <= expiry else None
        if is_quote:
            state[k] = (at, v)
    return out


@pytest.mark.parametrize("slices", [1, 2, 13])
@pytest.mark.parametrize("keyed", [True, False])
def test_asof_equals_fold(spark, ticks, slices, keyed):
    df = spark.createDataFrame(ticks, "at long, k string, q boolean, v int").repartition(7)
    got = asof_quote(df, ["k"] if keyed else [], "at", F.col("q"), F.col("v"), "rate", 150, slices)
    assert {r["at"]: r.rate for r in got.collect()} == fold_asof(ticks, 150, keyed)
    assert got.columns == ["at", "k", "q", "v", "rate"]


@pytest.mark.parametrize("slices", [1, 9])
def test_previous_row_equals_fold(spark, ticks, slices):
    df = spark.createDataFrame(ticks, "at long, k string, q boolean, v int").repartition(7)
    got = previous_row(df, ["k"], "at", F.struct("v"), "prev", 30, slices)
    last, expected = {}, {}
    for at, key, _, v in ticks:
        p = last.get(key)
        expected[at] = p[1] if p and at - p[0] <= 30 else None
        last[key] = (at, v)
    assert {r["at"]: r.prev.v if r.prev else None for r in got.collect()} == expected


@pytest.mark.parametrize("slices", [2, 6])
def test_percentiles_equal_builtin(spark, slices):
    rng = random.Random(7)
    rows = [("hot" if i % 3 == 0 else rng.choice(["a", "b", None]), float(rng.choice([0, 0, i, i % 17])), i % 5 * 1.0 if i % 4 else None) for i in range(2000)]
    rows += [("empty", None, None), ("one", 3.5, None)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    outputs = {"x1": ("x", 0.25), "x2": ("x", 0.5), "y3": ("y", 0.75)}
    plain = {r.k: tuple(r) for r in exact_percentiles(df, ["k"], outputs, 1).collect()}
    sliced = {r.k: tuple(r) for r in exact_percentiles(df, ["k"], outputs, slices).collect()}
    assert plain.keys() == sliced.keys()
    for k in plain:
        assert sliced[k][1:] == pytest.approx(plain[k][1:])
    total = exact_percentiles(df, [], {"m": ("x", 0.5)}, slices).first().m
    assert total == df.agg(F.percentile("x", F.lit(0.5))).first()[0]


def test_quartile_argument():
    with pytest.raises(ValueError):
        quartile(4, "x")


def test_dimension_join_salted_equals_broadcast(spark):
    fact = spark.range(300).selectExpr("id", "if(id % 3 != 0, 1, id) AS k")
    dim = spark.range(0, 300).where("id % 2 = 0 OR id = 1").selectExpr("id AS k", "concat('n', id) AS name")
    small = dimension_join(fact, dim, ["k"], ["id"])
    large = dimension_join(fact, dim, ["k"], ["id"], broadcast_bytes=-1, salts=8)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert frame_difference(small, large).count() == 0
    assert frame_difference(small, large.where("id > 0")).count() == 1


def test_salted_copies_are_not_broadcast(spark):
    fact = spark.range(300).selectExpr("id", "id % 7 AS k")
    dim = spark.range(7).selectExpr("id AS k", "concat('n', id) AS name")
    salted = dimension_join(fact, dim, ["k"], ["id"], broadcast_bytes=-1)
    assert salted.count() == 300
    salted.collect()
    assert "BroadcastHashJoin" not in salted._jdf.queryExecution().executedPlan().toString()


def test_two_roles(spark):
    fact = spark.createDataFrame([(1, "x", "y"), (2, "y", "z")], "id long, t0 string, t1 string")
    dim = spark.createDataFrame([("x", 1), ("y", 2)], "address string, decimals int")
    rows = two_role_join(fact, dim, {"token0": "t0", "token1": "t1"}, "address", ["id"]).orderBy("id").collect()
    assert rows[0].token0.decimals == 1 and rows[0].token1.decimals == 2
    assert rows[1].token0.decimals == 2 and rows[1].token1 is None


def test_measured_rows_decide(spark, sf_dir, monkeypatch):
    from tidepool.operators import slicing

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert len(slicing.cut_points(events, "event_id")) == slicing.MIN_SLICES - 1
    exploded = events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50))))
    assert slicing.measured_bytes(exploded.select("event_id")) > 40 * slicing.measured_bytes(events.select("event_id"))
    monkeypatch.setattr(slicing, "SLICE_ROWS", 100)
    cuts = slicing.cut_points(events, "event_id")
    rows = events.count()
    assert len(cuts) == -(-rows // 100) - 1
    counts = slicing.with_slices(events, "event_id", cuts).groupBy(slicing.SLICE).count().collect()
    assert max(r["count"] for r in counts) <= 2 * 100
    assert sum(r["count"] for r in counts) == rows


def test_no_plan_puts_all_rows_into_one_task(spark, sf_dir):
    from tidepool.operators.asof import asof_quote, previous_row, rolling_latest

    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", "value")
    quote = F.col("event_type") == "purchase"
    frames = [
        asof_quote(events, [], "event_id", quote, F.col("value"), "q", 50),
        asof_quote(events, ["user_id"], "event_id", quote, F.col("value"), "q", None),
        previous_row(events, [], "event_id", F.struct("value"), "p", 50),
        rolling_latest(events, [], "event_id", quote, F.col("value"), "r"),
    ]
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        # only what is left of a slice, one row each, may meet in one task
        specs = [w.split("windowspecdefinition(")[1] for w in plan.split("\n") if "windowspecdefinition(" in w]
        by_event = [w for w in specs if "event_id#" in w]
        assert by_event and all("__slice#" in w for w in by_event)
