"""Column arithmetic on limbs against the row functions."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidepool.functions import limbs
from tidepool.functions.numeric import Arithmetic, FormatError, NumericConf

CONTEXTS = (NumericConf(), NumericConf(precision=60, simplify=45), NumericConf(rescale=False))
ODD = [
    None, "", "0", "-0", "007", "-5", "5e-2", "12e3", "1e0b96", "-1e0b96/3", "3/-7", "0/5", "5/0", "1e2b3/-4e-5b6", "9" * 98, "9" * 99, "9" * 100, "-" + "9" * 210,
    "1" + "0" * 98 + "e98", "1e-98", "1e400", "1e400/3e399", "7e-30b500/1", "1.25", "3E-4", "79228162514264337593543950336",
]
BAD = ["x", "1/2/3", "--1", "1-", "e5", "1e", "1b5", "1e5b", "/3", "3/", "1e-", "-", "1e5b-3", "1e5e6", "1/-", "é", "1 2"]


def _texts(seed, n):
    rng = random.Random(seed)

    def side():
        digits = rng.choice((1, 2, 8, 9, 10, 17, 18, 19, 27, 30, 45, 50, 60, 98))
        return rng.choice(("", "", "-")) + str(rng.randrange(10**digits)) + rng.choice(("", f"e{rng.randint(-20, 40)}", f"e{rng.randint(-3, 3)}b{rng.choice((0, 0, 1, 64, 96, 192))}"))

    return [rng.choice(ODD) if rng.random() < 0.05 else side() if rng.random() < 0.5 else side() + "/" + rng.choice(("1e0b0", side())) for _ in range(n)]


def _row(math, operation):
    def row(x, y):
        a, b = math.parse(x), math.parse(y)
        return None if a is None or b is None else math.text(getattr(math, operation)(a, b))

    return row


def _outcome(call):
    try:
        return call()
    except ArithmeticError as e:
        return type(e)


@pytest.mark.parametrize("conf", CONTEXTS)
@pytest.mark.parametrize("operation", ["multiply", "divide", "add", "subtract"])
def test_operations_equal_the_rows(operation, conf):
    math = Arithmetic(conf)
    row = _row(math, operation)
    pairs = list(zip(_texts(1, 4000), _texts(2, 4000), strict=True)) + [(a, b) for a in ODD for b in ODD]
    # rows that fail do so alone
    want = [None if x is None or y is None else _outcome(lambda x=x, y=y: row(x, y)) for x, y in pairs]
    kept = [i for i, w in enumerate(want) if not isinstance(w, type)]
    x, y = (pa.array([pairs[i][j] for i in kept], pa.string()) for j in (0, 1))
    calls = []
    got = limbs.binary(operation, conf, x, y, lambda a, b: calls.append(1) or row(a, b))
    assert got.to_pylist() == [want[i] for i in kept]
    assert len(calls) < len(kept) * 0.8
    for i in set(range(len(pairs))) - set(kept):
        with pytest.raises(want[i]):
            limbs.binary(operation, conf, pa.array([pairs[i][0]]), pa.array([pairs[i][1]]), row)


def test_short_numbers_need_no_row_function():
    rng = random.Random(5)
    x = pa.array([f"{rng.randrange(10**8)}e2" for _ in range(500)])
    y = pa.array([f"-{rng.randrange(10**30)}e18b96/{rng.randrange(1, 10**9)}" for _ in range(500)])

    def fail(*_):
        raise AssertionError("a row was left over")

    for operation in ("multiply", "divide", "add", "subtract"):
        limbs.binary(operation, NumericConf(), x, y, fail)
    for operation in ("multiply", "divide"):
        limbs.binary(operation, NumericConf(), limbs.binary(operation, NumericConf(), x, y, fail), y, fail)


def test_one_column_equals_the_rows():
    math, conf = Arithmetic(), NumericConf()
    values = [v for v in _texts(3, 3000) + ODD if v is not None]
    column = pa.array([*values, None])

    def text(change):
        return lambda t: None if math.parse(t) is None else math.text(change(math.parse(t)))

    plain = text(lambda f: f)
    assert limbs.unary(conf, column, plain).to_pylist() == [*map(plain, values), None]
    absolute = text(math.absolute)
    assert limbs.unary(conf, column, absolute, limbs.absolute).to_pylist() == [*map(absolute, values), None]
    sound = [v for v in values if not math.parse(v) or math.parse(v)[3]]
    double = lambda t: math.to_float(math.parse(t))
    assert limbs.to_doubles(conf, pa.array([*sound, None]), double).to_pylist() == [*map(double, sound), None]


def test_texts_that_are_no_numbers_fail_as_rows_do():
    math = Arithmetic()
    for bad in BAD:
        for column in ([bad], ["1", bad, "2e3"]):
            with pytest.raises(FormatError):
                limbs.unary(NumericConf(), pa.array(column), lambda t: math.text(math.parse(t)))


def test_slices_and_empty_columns():
    column = pa.array(["1", "22e1", None, "-333/4", "5"])
    math = Arithmetic()
    text = lambda t: math.text(math.parse(t))
    assert limbs.unary(NumericConf(), column.slice(1, 3), text).to_pylist() == ["22e1b0/1e0b0", None, "-333e0b0/4e0b0"]
    assert limbs.unary(NumericConf(), column.slice(0, 0), text).to_pylist() == []
    assert limbs.unary(NumericConf(), pa.array([None, None], pa.string()), text).to_pylist() == [None, None]
    assert limbs.whole_texts(limbs.Whole(np.array([1, -1]), np.array([[0, 0, 0], [5, 0, 7]]))).to_pylist() == ["0", "-7000000000000000005"]
