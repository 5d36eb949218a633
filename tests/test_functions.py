"""Fraction functions through columns and SQL."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidepool import functions as U
from tidepool.functions import aggregates
from tidepool.functions.scalars import bound

I = 1461446703485210103287273052203988822378723970342


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    U.register_functions(spark)


def one(spark, expression):
    return spark.sql(f"SELECT {expression} AS v").first().v


@pytest.mark.parametrize(
    "expression, expected",
    [
        ("ubim('2', '4')", "8e0b0/1e0b0"),
        ("UBID('2', '4')", "2e0b0/4e0b0"),
        ("ubia('2', '4')", "6e0b0/1e0b0"),
        ("ubis('2', '4')", "-2e0b0/1e0b0"),
        (f"ubid('{I}e18b96', '2/1e8')", f"{I}e26b96/2e0b0"),
        ("ubi_resolve('2e-1b1')", "10"),
        ("ubi_resolve('')", ""),
        ("ubi_abs('-3e1b1/-2')", "3e1b1/2e0b0"),
        ("ubi_sign('3/-2')", -1),
        ("ubi_sign('0e5')", 0),
        ("ubi_sign('-3/-2')", 1),
        ("ubi_sign('3/0')", -1),
        ("ubi_sign('0.01')", 1),
        ("ubi_sign('')", None),
        ("ubim('2', NULL)", None),
        ("try_ubi_resolve('1/0')", None),
        ("try_ubi_resolve('x')", None),
        ("ubi_is_valid('1e8b96/2')", True),
        ("ubi_is_valid('8.7E-4')", True),
        ("ubi_is_valid('8.7e-4')", False),
        ("ubi_is_valid('1.5/2')", False),
    ],
)
def test_sql_scalars(spark, expression, expected):
    assert one(spark, expression) == expected


def test_column_forms(spark):
    df = spark.createDataFrame([("2", "4")], ["a", "b"])
    row = df.select(
        U.ubim("a", "b").alias("m"),
        U.ubid("a", "b").alias("d"),
        U.ubia("a", "b").alias("p"),
        U.ubis("a", "b").alias("s"),
        U.ubi_sign("a").alias("g"),
        U.ubi_parse(F.lit("1e8b96/2")).alias("f"),
        U.ubi_to_double(U.ubid("a", "b")).alias("x"),
        U.ubi_resolve_fast(F.lit("5e0b2")).alias("q"),
    ).first()
    assert row[:5] == ("8e0b0/1e0b0", "2e0b0/4e0b0", "6e0b0/1e0b0", "-2e0b0/1e0b0", 1)
    assert tuple(row.f) == ("1", 8, 96, "2", 0, 0)
    assert row.x == 0.5 and row.q == "1"


def values(spark, rows):
    return spark.createDataFrame([(v,) for v in rows], "value string").repartition(3)


def check_all_forms(spark, rows, kind, expected):
    df = values(spark, rows)
    assert df.agg(getattr(U, f"ubi_{kind}")("value")).first()[0] == expected
    df.createOrReplaceTempView("vals")
    assert spark.sql(f"SELECT ubi_{kind}(value) FROM vals").first()[0] == expected
    assert U.ubi_aggregate(df, [], {"v": (kind, "value")}).first().v == expected
    if kind == "sum" and any(rows):
        assert U.ubi_sum_limbs(df, [], "value", "v").first().v == expected


@pytest.mark.parametrize(
    "rows, kind, expected",
    [
        ([f"{I}", f"{I + 10}", None, f"{I + 2}"], "max", f"{I + 10}e0b0/1e0b0"),
        ([f"{I + 10}", f"{I}", None, f"{I + 2}"], "min", f"{I}e0b0/1e0b0"),
        ([f"{I}", "2", None, "10"], "sum", f"{I + 12}e0b0/1e0b0"),
        ([f"{I}", "2", None, "10"], "avg", f"{I + 12}e0b0/3e0b0"),
        ([None, None], "sum", ""),
        ([None, None], "avg", ""),
        (["2", "4"], "avg", "6e0b0/2e0b0"),
        (["1/3", "1/3", "1/3"], "sum", "3e0b0/3e0b0"),
    ],
)
def test_aggregates(spark, rows, kind, expected):
    check_all_forms(spark, rows, kind, expected)


def test_sum_of_small_values_with_high_encoding(spark):
    df = values(spark, ["1e0b384/2e0b192", "1e0b0/1e0b192"])
    text = U.ubi_aggregate(df, [], {"v": ("sum", "value")}).first().v
    assert "/0" not in text and text.endswith("e191b192")


def test_grouped_sum_matches_python(spark):
    rows = [(i % 7 if i % 3 else 0, f"{(-1) ** i * (I * i + 7)}e{i % 4}b0/1e0b0") for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, v string").repartition(8)
    expected = {}
    for k, v in rows:
        n, s = v.split("b")[0].split("e")
        expected[k] = expected.get(k, Fraction(0)) + Fraction(int(n), 10 ** int(s))
    for result in (
        U.ubi_aggregate(df, ["k"], {"t": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v")}),
        U.ubi_sum_limbs(df, ["k"], "v", "t"),
    ):
        got = {}
        for r in result.collect():
            n, s = r.t.split("b")[0].split("e")
            got[r.k] = Fraction(int(n), 10 ** int(s))
        assert got == expected


def test_null_keys_and_many_encodings(spark):
    rows = [(None if i % 2 else "a", f"1/{i + 1}") for i in range(400)]
    df = spark.createDataFrame(rows, "k string, v string").repartition(5)
    got = {r.k: float(r.x) for r in U.ubi_aggregate(df, ["k"], {"t": ("sum", "v")}).select("k", U.ubi_to_double("t").alias("x")).collect()}
    for key in (None, "a"):
        exact = float(sum(Fraction(1, i + 1) for i in range(400) if (i % 2 == 1) == (key is None)))
        assert got[key] == pytest.approx(exact, rel=1e-12)


def test_native_min_max_keep_partial_aggregation(spark):
    df = spark.createDataFrame([(1, "1/3"), (1, "-5"), (1, "0.1"), (2, "7E2")], "k int, v string")
    got = {r.k: (r.lo, r.hi) for r in df.groupBy("k").agg(U.ubi_min("v").alias("lo"), U.ubi_max("v").alias("hi")).collect()}
    assert got == {1: ("-5e0b0/1e0b0", "1e0b0/3e0b0"), 2: ("7e-2b0/1e0b0",) * 2}


def test_limb_sum_rejects_decimal_text(spark):
    with pytest.raises(Exception, match="ubi_canonical"):
        U.ubi_sum_limbs(values(spark, ["1.5"]), [], "value", "v").collect()
    fixed = values(spark, ["1.5", "2"]).select(U.ubi_canonical("value").alias("value"))
    assert U.ubi_sum_limbs(fixed, [], "value", "v").first().v == "35e1b0/1e0b0"


def test_column_sum_is_exact_and_partial(spark):
    rows = []
    for i in range(2000):
        n = (-1) ** i * (I * i + 7)
        rows.append((i % 3, f"{n}e{i % 30}b0/1e0b0", f"{n}e-3b192/7e0b2", f"{n}e18b96/{i + 1}"))
    df = spark.createDataFrame(rows, "k int, whole string, common string, mixed string").repartition(6)
    columns = ("whole", "common", "mixed")
    got = df.groupBy("k").agg(*(U.ubi_sum(c).alias(c) for c in columns), F.count("*").alias("n"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and plan.count("ArrowEvalPython") <= 4
    folded = U.ubi_aggregate(df, ["k"], {c: ("sum", c) for c in columns})
    by_key = {r.k: r for r in folded.collect()}
    for r in got.collect():
        assert (r.whole, r.common) == (by_key[r.k].whole, by_key[r.k].common)
        exact = sum((value(x[3]) for x in rows if x[0] == r.k), Fraction(0))
        assert abs(value(r.mixed) - exact) < Fraction(1, 10**120)
        assert abs(value(by_key[r.k].mixed) - exact) < Fraction(1, 10**120)


def value(text):
    num, _, den = text.partition("/")

    def part(p):
        n, _, rest = p.partition("e")
        s, _, b = rest.partition("b")
        return Fraction(int(n)) / Fraction(10) ** int(s or 0) / 2 ** int(b or 0)

    return part(num) / part(den or "1")


def test_column_sum_refuses_what_it_cannot_hold(spark):
    df = values(spark, ["1e-230", "1"])
    with pytest.raises(Exception, match="ubi_aggregate"):
        df.agg(U.ubi_sum("value")).collect()
    assert U.ubi_aggregate(df, [], {"v": ("sum", "value")}).first().v.startswith("1" + "0" * 199)


def test_shared_columns_keep_their_own_function(spark):
    df = spark.createDataFrame([("x", "2", "1"), ("x", "4", "1"), ("x", "28", "1")], ["k", "a", "b"]).withColumn("b", F.lit("2"))
    a, b = F.col("a"), F.col("b")
    row = U.ubi_aggregate(df, ["k"], {"p": ("sum", U.ubim(a, b)), "q": ("sum", U.ubid(a, b)), "r": ("sum", "a"), "s": ("avg", "a")}).first()
    assert (row.p, row.q, row.r) == ("68e0b0/1e0b0", "17e0b0/1e0b0", "34e0b0/1e0b0") or float(Fraction(row.q.replace("e0b0", ""))) == 17


@pytest.mark.parametrize("n", [3, 64, 65, 300])
def test_sum_over_denominators_has_one_form(spark, n):
    texts = [f"1/{2 * i + 3}" for i in range(n)]
    got = {U.ubi_aggregate(values(spark, texts).repartition(parts), [], {"v": ("sum", "value")}).first().v for parts in (1, 3, 7)}
    assert len(got) == 1
    text = got.pop()
    assert text.endswith("/1e0b0")
    digits, scale = text.split("b")[0].split("e")
    exact = sum(Fraction(1, 2 * i + 3) for i in range(n))
    assert abs(Fraction(int(digits), 10 ** int(scale)) - exact) < Fraction(1, 10**190)


@pytest.mark.parametrize("n", [3, 90])
def test_zero_denominators_decide_at_any_count(spark, n):
    texts = ["1/0", "2/0"] + [f"1/{2 * i + 3}" for i in range(n)]
    for parts in (1, 4):
        assert U.ubi_aggregate(values(spark, texts).repartition(parts), [], {"v": ("sum", "value")}).first().v == "3e0b0/0e0b0"


def test_extremes_over_zero_agree(spark):
    df = values(spark, ["1/0", "2", "-3/0", "0", "4/2"])
    row = U.ubi_aggregate(df, [], {"lo": ("min", "value"), "hi": ("max", "value")}).first()
    native = df.agg(U.ubi_min("value").alias("lo"), U.ubi_max("value").alias("hi")).first()
    assert (row.lo, row.hi) == (native.lo, native.hi) == ("-3e0b0/0e0b0", "1e0b0/0e0b0")


def test_tiny_values_are_never_lost(spark):
    df = values(spark, ["1e300", "2e300"])
    assert U.ubi_aggregate(df, [], {"v": ("sum", "value")}).first().v == "3e300b0/1e0b0"
    for texts in (["1e300"], ["1e0b900"], ["1e300/3"]):
        with pytest.raises(Exception, match="below the range"):
            values(spark, texts).agg(U.ubi_sum("value")).first()


def test_results_come_key_by_key(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "RESULT_KEYS", 3)
    df = spark.range(100).select((F.col("id") % 40).alias("k"), F.when(F.col("id") % 40 > 0, F.col("id") % 7).alias("j"), F.lit("5").alias("v"))
    got = {(r.k, r.j): r.t for r in U.ubi_aggregate(df, ["k", "j"], {"t": ("sum", "v")}).collect()}
    want = {}
    for r in df.collect():
        want[r.k, r.j] = want.get((r.k, r.j), 0) + 5
    assert got == {k: f"{v}e0b0/1e0b0" for k, v in want.items()}


def test_small_operands_print_alike(spark):
    rng = random.Random(12)
    forms = ["0", "-0", "007", "1", "-1", "9" * 18, "-" + "9" * 18, "9" * 19, "5e0", "12e3", "-7e18", "3e999", "1e2b5", "2/3", "1.5", "", None, "4e-2", "8e15", "0e4", "1e1000"]
    pairs = [(rng.choice(forms), rng.choice(forms)) for _ in range(300)] + [(x, y) for x in forms for y in forms]
    df = spark.createDataFrame(pairs, "x string, y string")
    names = ("ubim", "ubid", "ubia", "ubis")
    got = df.select("x", "y", *(getattr(U, n)("x", "y").alias(n) for n in names), *(bound(n)(F.col("x"), F.col("y")).alias("py_" + n) for n in names)).collect()
    for r in got:
        for n in names:
            assert r[n] == r["py_" + n], (n, r.x, r.y)


def test_plain_numbers_are_folded_natively(spark):
    """Plain, odd, empty and missing texts of one column meet in one result; only the odd ones are folded row by row."""
    texts = ["7", "-3e2", "12e0b0/1e0b0", "1e2b0/3", "0.5", "", None, "9" * 18, "9" * 30, "-0", "250e2", "1e-2"]
    df = spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts * 5)] + [(9, None), (8, ""), (7, "4e2"), (7, "5e2")], "k int, x string")
    wanted = {"total": ("sum", "x"), "mean": ("avg", "x"), "low": ("min", "x"), "high": ("max", "x")}
    named = U.ubi_aggregate(df, ["k"], wanted)
    by_rows = U.ubi_aggregate(df, ["k"], {n: (kind, column) for column in [F.col("x")] for n, (kind, _) in wanted.items()})
    assert "HashAggregate" in named._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, named.collect())) == sorted(map(str, by_rows.collect()))
    few = {r.k: (r.total, r.low, r.high) for r in U.ubi_aggregate(df.where("k > 6"), ["k"], {n: wanted[n] for n in ("total", "low", "high")}).collect()}
    assert few == {9: ("", None, None), 8: ("", None, None), 7: ("9e2b0/1e0b0", "4e2b0/1e0b0", "5e2b0/1e0b0")}


def test_column_sums_keep_a_hash_table(spark):
    df = values(spark, ["1", "2e2", "3/7"])
    plan = df.groupBy("value").agg(U.ubi_sum("value"), U.ubi_avg("value"))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("den", ["7e1b3", f"{10**18}e0b0", f"{-(10**40) - 9}e3b0", f"{3**200}e-2b1"])
def test_column_sum_over_a_denominator_of_any_length(spark, den):
    df = values(spark, [f"{n}e2b0/{den}" for n in (5, -11, 10**30)] + [None, ""])
    for kind, form in (("sum", U.ubi_sum), ("avg", U.ubi_avg)):
        assert df.agg(form("value").alias("v")).first().v == U.ubi_aggregate(df, [], {"v": (kind, "value")}).first().v
    # denominators that agree in their lowest or highest limb only are told apart
    other = values(spark, [f"1/{7 + 10**18}", "1/7", f"1/{7 + 2 * 10**18}"])
    got = value(other.agg(U.ubi_sum("value").alias("v")).first().v)
    assert abs(got - sum(Fraction(1, 7 + i * 10**18) for i in range(3))) < Fraction(1, 10**120)
