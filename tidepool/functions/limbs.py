"""Fraction arithmetic on whole Arrow columns as matrices of nine-digit limbs.

A column of texts becomes two matrices of limbs (numerators and denominators, least limb first) with
signs, scales and bits, without a Python object per row. Rows are grouped by the pattern of their
characters that aren't digits, so each group is cut at the same places. Products are schoolbook
products of limb columns, carries are passes over the columns. Rows that the plain rules of
``Arithmetic`` would round, reduce or reject, and texts of other forms, are left to it one by one.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidepool.functions.numeric import NumericConf

DIGITS = 9
BASE = 10**DIGITS
_TENS = 10 ** np.arange(DIGITS, dtype=np.int64)
#: Scales and bits up to so many digits; larger ones are left to the row.
_SMALL_DIGITS = 6
#: Least precision under which matrices are worth it.
LEAST_DIGITS = 40
_KIND = np.full(256, 5, dtype=np.int64)
_KIND[48:58] = 0
for _i, _c in enumerate("-eb/", start=1):
    _KIND[ord(_c)] = _i
_MOST_MARKS = 9  # of a fraction with every sign: -e-b/-e-b
_FORM = re.compile(r"(-?)(?:(e)(-?)(?:(b))?)?(?:(/)(-?)(?:(e)(-?)(?:(b))?)?)?\Z")


class Whole(NamedTuple):
    """Integers: signs (1 or -1) and limbs, least first."""

    sign: np.ndarray
    limbs: np.ndarray

    def take(self, rows: np.ndarray) -> Whole:
        return Whole(self.sign[rows], self.limbs[rows])


class Fractions(NamedTuple):
    """Rows n * 10^-s * 2^-b over the same of d; ``sound`` rows only."""

    sound: np.ndarray
    n: Whole
    s: np.ndarray
    b: np.ndarray
    dn: Whole
    ds: np.ndarray
    db: np.ndarray

    def flipped(self) -> Fractions:
        return Fractions(self.sound, self.dn, self.ds, self.db, self.n, self.s, self.b)


def _limbs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Digits in [starts, ends) of each row as limbs."""
    width = max(1, -(-int((ends - starts).max(initial=1)) // DIGITS)) * DIGITS
    at = ends[:, None] - np.arange(width, 0, -1)[None, :]
    digits = np.where(at >= starts[:, None], data[np.maximum(at, 0)] - 48, 0).astype(np.int64)
    return (digits.reshape(len(starts), -1, DIGITS) @ _TENS[::-1])[:, ::-1].copy()


def _signed(sign: np.ndarray, limbs: np.ndarray) -> Whole:
    return Whole(np.where(limbs.any(axis=1), sign, 1), limbs)


def _padded(limbs: np.ndarray, width: int) -> np.ndarray:
    return limbs if limbs.shape[1] == width else np.pad(limbs, ((0, 0), (0, width - limbs.shape[1])))


def _carried(limbs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Limbs within [0, BASE), and what is carried out of the last (negative for a negative number)."""
    carry = np.zeros(len(limbs), dtype=np.int64)
    for i in range(limbs.shape[1]):
        limbs[:, i] += carry
        carry = limbs[:, i] // BASE
        limbs[:, i] -= carry * BASE
    return limbs, carry


def _trimmed(limbs: np.ndarray) -> np.ndarray:
    """Without limbs that are zero in every row, but one at least."""
    width = limbs.shape[1]
    while width > 1 and not limbs[:, width - 1].any():
        width -= 1
    return limbs[:, :width]


def _product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), x.shape[1] + y.shape[1]), dtype=np.int64)
    for i in range(x.shape[1]):
        if not x[:, i].any():
            continue
        part = x[:, i, None] * y
        high = part // BASE
        out[:, i : i + y.shape[1]] += part - high * BASE
        out[:, i + 1 : i + 1 + y.shape[1]] += high
    return _trimmed(_carried(out)[0])


def product(x: Whole, y: Whole) -> Whole:
    return _signed(x.sign * y.sign, _product(x.limbs, y.limbs))


def times_power(x: Whole, power: np.ndarray, base: int, step: int) -> Whole:
    """Each row times ``base ** power``; ``base ** step`` is below a limb's."""
    limbs, left = x.limbs, power.copy()
    while left.any():
        now = np.minimum(left, step)
        factor = base**now
        limbs = _trimmed(_carried(np.pad(limbs * factor[:, None], ((0, 0), (0, 1))))[0]) if int(factor.max()) > 1 else limbs
        left -= now
    return Whole(x.sign, limbs)


def total(x: Whole, y: Whole) -> Whole:
    width = max(x.limbs.shape[1], y.limbs.shape[1]) + 1
    plain = _padded(x.limbs, width) * x.sign[:, None] + _padded(y.limbs, width) * y.sign[:, None]
    limbs, carry = _carried(plain.copy())
    negative = carry < 0
    if negative.any():
        limbs[negative] = _carried(-plain[negative])[0]
    return _signed(np.where(negative, -1, 1), _trimmed(limbs))


def digit_counts(limbs: np.ndarray) -> np.ndarray:
    """Digits of each row; zero has one."""
    used = limbs != 0
    top = np.where(used.any(axis=1), limbs.shape[1] - 1 - used[:, ::-1].argmax(axis=1), 0)
    return top * DIGITS + np.maximum(1, np.searchsorted(_TENS, limbs[np.arange(len(limbs)), top], side="right"))


def _number(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sign: np.ndarray) -> np.ndarray:
    return _limbs(data, starts, ends)[:, 0] * sign


def parsed(column: pa.Array, most: int) -> Fractions:
    """Texts of integers and fractions with at most ``most`` digits a side; all others are unsound."""
    rows = len(column)
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + rows + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]] if rows else np.zeros(0, dtype=np.uint8)
    offsets = offsets - offsets[0] if rows else np.zeros(1, dtype=np.int64)
    kind = _KIND[data]
    mark = np.flatnonzero(kind)
    first = np.searchsorted(mark, offsets)
    count = np.diff(first)
    row = np.repeat(np.arange(rows), count)
    place = np.arange(len(mark)) - first[:-1][row]
    few = place < _MOST_MARKS
    # the marks of a row as a number in base six
    code = np.bincount(row[few], weights=(kind[mark[few]] * 6 ** place[few]), minlength=rows).astype(np.int64)
    code[count > _MOST_MARKS] = -1

    sound = np.zeros(rows, dtype=bool)
    found: list[tuple[np.ndarray, Whole, np.ndarray, np.ndarray, Whole, np.ndarray, np.ndarray]] = []
    for c in np.unique(code).tolist():
        own = np.flatnonzero(code == c)
        group = _group(c, own, data, offsets, mark, first, most)
        if group is not None:
            found.append(group)
            sound[group[0]] = True

    def whole(i: int) -> Whole:
        width = max([g[i].limbs.shape[1] for g in found], default=1)
        sign, limbs = np.ones(rows, dtype=np.int64), np.zeros((rows, width), dtype=np.int64)
        for g in found:
            sign[g[0]], limbs[g[0], : g[i].limbs.shape[1]] = g[i].sign, g[i].limbs
        return Whole(sign, limbs)

    def small(i: int) -> np.ndarray:
        out = np.zeros(rows, dtype=np.int64)
        for g in found:
            out[g[0]] = g[i]
        return out

    return Fractions(sound, whole(1), small(2), small(3), whole(4), small(5), small(6))


def _group(code: int, own: np.ndarray, data: np.ndarray, offsets: np.ndarray, mark: np.ndarray, first: np.ndarray, most: int):
    """Fields of rows whose marks have one pattern; None if no such text is a fraction."""
    if code < 0:
        return None
    marks = ""
    while code:
        code, m = divmod(code, 6)
        marks += " -eb/?"[m]
    form = _FORM.match(marks)
    if form is None:
        return None
    # fields lie between marks; a sign belongs to the field behind it
    at = [mark[first[own] + j] for j in range(len(marks))]
    fields, begin, negative = [], offsets[own], False
    for j, m in enumerate(marks):
        if m == "-":
            begin, negative = at[j] + 1, True
            continue
        fields.append((begin, at[j], negative))
        begin, negative = at[j] + 1, False
    fields.append((begin, offsets[own + 1], negative))
    kinds = "n" + "".join({"e": "s", "b": "b", "/": "n"}[m] for m in marks if m != "-")
    good = np.ones(len(own), dtype=bool)
    for (a, b, _), k in zip(fields, kinds, strict=True):
        good &= (b > a) & (b - a <= (most if k == "n" else _SMALL_DIGITS))
    # a sign stands right at the start of its field
    previous = offsets[own]
    for j, m in enumerate(marks):
        if m == "-":
            good &= at[j] == previous
        else:
            previous = at[j] + 1
    if not good.any():
        return None
    rows, zero = own[good], np.zeros(int(good.sum()), dtype=np.int64)
    parts = {"n": Whole(zero + 1, zero[:, None] + 1), "s": zero, "b": zero}
    sides: list[dict] = []
    for (a, b, negative), k in zip(fields, kinds, strict=True):
        sign = zero + (-1 if negative else 1)
        if k == "n":
            sides.append(dict(parts, n=_signed(sign, _limbs(data, a[good], b[good]))))
        else:
            sides[-1][k] = _number(data, a[good], b[good], sign)
    num, den = sides[0], sides[1] if len(sides) > 1 else parts
    s, ds = num["s"], den["s"]
    if len(sides) > 1:  # fractions are kept with a least scale of zero
        least = np.minimum(s, ds)
        s, ds = s - least, ds - least
    return rows, num["n"], s, num["b"], den["n"], ds, den["b"]


def _scaled(f: Fractions, most: int) -> Fractions:
    """Sound rows of at most ``most`` digits, with a least scale of zero."""
    least = np.minimum(f.s, f.ds)
    sound = f.sound & (digit_counts(f.n.limbs) <= most) & (digit_counts(f.dn.limbs) <= most)
    return f._replace(sound=sound, s=f.s - least, ds=f.ds - least)


def multiply(x: Fractions, y: Fractions, most: int) -> Fractions:
    return _scaled(Fractions(x.sound & y.sound, product(x.n, y.n), x.s + y.s, x.b + y.b, product(x.dn, y.dn), x.ds + y.ds, x.db + y.db), most)


def divide(x: Fractions, y: Fractions, most: int) -> Fractions:
    return multiply(x, y.flipped(), most)


def _same(x: Whole, y: Whole) -> np.ndarray:
    width = max(x.limbs.shape[1], y.limbs.shape[1])
    return (x.sign == y.sign) & (_padded(x.limbs, width) == _padded(y.limbs, width)).all(axis=1)


def add(x: Fractions, y: Fractions, most: int) -> Fractions:
    sound = x.sound & y.sound
    one = Whole(np.ones(len(sound), dtype=np.int64), np.ones((len(sound), 1), dtype=np.int64))
    alike = _same(x.dn, y.dn) & (x.ds == y.ds) & (x.db == y.db)

    def if_unlike(w: Whole) -> Whole:
        return Whole(np.where(alike, 1, w.sign), np.where(alike[:, None], _padded(one.limbs, w.limbs.shape[1]), w.limbs))

    def more(v: np.ndarray) -> np.ndarray:
        return np.where(alike, 0, v)

    xn, xs, xb = product(x.n, if_unlike(y.dn)), x.s + more(y.ds), x.b + more(y.db)
    yn, ys, yb = product(y.n, if_unlike(x.dn)), y.s + more(x.ds), y.b + more(x.db)
    bits, scale = np.maximum(xb, yb), np.maximum(np.maximum(xs, ys), 0)
    up_x, up_y, bits_x, bits_y = scale - xs, scale - ys, bits - xb, bits - yb
    # a shift of so many places can't stay within the digits, but for zero; both are left to the row
    sound &= (np.maximum(up_x, up_y) <= most) & (np.maximum(bits_x, bits_y) <= 3 * most)
    clip = lambda v: np.where(sound, v, 0)
    xn = times_power(times_power(xn, clip(bits_x), 2, 29), clip(up_x), 10, DIGITS)
    yn = times_power(times_power(yn, clip(bits_y), 2, 29), clip(up_y), 10, DIGITS)
    sound &= (digit_counts(xn.limbs) <= most) & (digit_counts(yn.limbs) <= most)
    den = product(x.dn, if_unlike(y.dn))
    return _scaled(Fractions(sound, total(xn, yn), scale, bits, den, x.ds + more(y.ds), x.db + more(y.db)), most)


def subtract(x: Fractions, y: Fractions, most: int) -> Fractions:
    return add(x, y._replace(n=_signed(-y.n.sign, y.n.limbs)), most)


def absolute(x: Fractions) -> Fractions:
    return x._replace(n=x.n._replace(sign=np.ones_like(x.n.sign)), dn=x.dn._replace(sign=np.ones_like(x.dn.sign)))


def whole_texts(x: Whole) -> pa.Array:
    """Decimal text of each integer."""
    rows, width = x.limbs.shape
    if width <= 2:
        value = x.limbs[:, 0] + (x.limbs[:, 1] * BASE if width == 2 else 0)
        return pa.array(value * x.sign).cast(pa.string())
    digits = np.empty((rows, width * DIGITS + 1), dtype=np.uint8)
    digits[:, 0] = 48
    for i in range(width):
        left, end = x.limbs[:, i].copy(), (width - i) * DIGITS
        for d in range(DIGITS):
            high = left // 10
            digits[:, end - d] = left - high * 10 + 48
            left = high
    size = digit_counts(x.limbs)
    negative = x.sign < 0
    begin = width * DIGITS + 1 - size - negative
    digits[np.flatnonzero(negative), begin[negative]] = 45
    sizes = size + negative
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    keep = np.arange(width * DIGITS + 1)[None, :] >= begin[:, None]
    return pa.StringArray.from_buffers(rows, pa.py_buffer(offsets), pa.py_buffer(digits[keep]))


def texts(f: Fractions) -> pa.Array:
    """Printed form of every row, sound or not."""
    parts = [whole_texts(f.n), "e", f.s, "b", f.b, "/", whole_texts(f.dn), "e", f.ds, "b", f.db]
    columns = [pa.array(p).cast(pa.string()) if isinstance(p, np.ndarray) else pa.scalar(p) if isinstance(p, str) else p for p in parts]
    return pc.binary_join_element_wise(*columns, "")


def doubles(f: Fractions) -> tuple[np.ndarray, np.ndarray]:
    """(sound, value): rows whose value is one division of integers that doubles hold exactly."""
    shift, bits = f.s - f.ds, f.b - f.db
    sound = f.sound & (np.abs(shift) <= 15) & (np.abs(bits) <= 900)
    clip = lambda v: np.where(sound, v, 0)
    n, dn = times_power(f.n, clip(np.maximum(-shift, 0)), 10, DIGITS), times_power(f.dn, clip(np.maximum(shift, 0)), 10, DIGITS)
    values = []
    for w in (n, dn):
        sound &= digit_counts(w.limbs) <= 15
        limbs = _padded(w.limbs, max(2, w.limbs.shape[1]))
        values.append(np.where(sound, limbs[:, 0] + limbs[:, 1] * BASE, 1).astype(np.float64) * w.sign)
    sound &= values[1] != 0
    return sound, np.ldexp(values[0] / np.where(values[1] != 0, values[1], 1), np.where(sound, -bits, 0).astype(np.int32))


def most_digits(conf: NumericConf) -> int:
    """Digits up to which nothing is rounded or reduced; 0 if matrices aren't used under ``conf``."""
    most = min(conf.precision, conf.simplify - 1)
    return most if most >= LEAST_DIGITS else 0


_BINARY: dict[str, Callable[[Fractions, Fractions, int], Fractions]] = {"multiply": multiply, "divide": divide, "add": add, "subtract": subtract}


def _completed(out: pa.Array, sound: np.ndarray, given: np.ndarray, row: Callable[[int], object]) -> pa.Array:
    """``out`` where sound, else what the row's own function gives; NULL where nothing is given."""
    rest = np.flatnonzero(given & ~sound)
    if len(rest) == 0 and given.all():
        return out
    found = pa.array([row(i) for i in rest.tolist()], type=out.type)
    source = np.arange(len(out))
    source[rest] = len(out) + np.arange(len(rest))
    return pa.concat_arrays([out.combine_chunks() if isinstance(out, pa.ChunkedArray) else out, found]).take(pa.array(source, mask=~given))


def _given(column: pa.Array) -> np.ndarray:
    return pc.is_valid(column).to_numpy(zero_copy_only=False)


def binary(operation: str, conf: NumericConf, x: pa.Array, y: pa.Array, row: Callable[[str, str], str | None]) -> pa.Array:
    """Texts of an operation on two columns; ``row`` computes a pair that matrices don't."""
    most = most_digits(conf)
    given = _given(x) & _given(y)
    out = _BINARY[operation](parsed(x, most), parsed(y, most), most)
    return _completed(texts(out), out.sound, given, lambda i: row(x[i].as_py(), y[i].as_py()))


def unary(conf: NumericConf, x: pa.Array, row: Callable[[str], str | None], change: Callable[[Fractions], Fractions] = lambda f: f) -> pa.Array:
    """Texts of a change of one column."""
    out = change(parsed(x, most_digits(conf)))
    return _completed(texts(out), out.sound, _given(x), lambda i: row(x[i].as_py()))


def to_doubles(conf: NumericConf, x: pa.Array, row: Callable[[str], float | None]) -> pa.Array:
    sound, values = doubles(parsed(x, most_digits(conf)))
    return _completed(pa.array(values), sound, _given(x), lambda i: row(x[i].as_py()))
