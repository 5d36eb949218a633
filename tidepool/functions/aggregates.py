"""Aggregates on fractions.

``ubi_aggregate`` is the one to use on large data: every task folds its own rows
into one small partial per key (the map side), only partials are shuffled, and a
second streaming fold merges them. A key holding most of the rows therefore costs
one partial per task, never one huge group.

``ubi_sum_limbs`` keeps the whole sum in the JVM for integer-like columns.
The column forms ``ubi_sum``, ``ubi_avg``, ``ubi_min`` and ``ubi_max`` are built from
native aggregates, so they combine with any other in one ``groupBy().agg()`` and
keep its map-side partial aggregation. Only the forms registered for SQL text see a
whole group in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions import scalars
from tidepool.functions.numeric import Arithmetic, NumericConf
from tidepool.functions.scalars import DEFAULT, SCALAR_NAMES, as_column, bound, ubi_canonical, ubi_order_key, ubi_parse

LIMB_DIGITS = 18
LIMBS = 12  # 216 digits, past the 200 digits a part can hold
WHOLE = (1, 0, 0)  # denominator of a whole number
MAX_KEYS = 50_000  # keys held by a map-side fold before its partials are emitted
PLAIN = r"^-?\d{1,18}(e\d{1,3}(b0/1e0b0)?)?$"  # whole numbers with a scale, small enough for native sums
PLAIN_REST = "b0/1e0b0"

RESULT_KEYS = 10_000  # finished keys in one result batch
PARTIAL_TYPE = T.StructType(
    [
        T.StructField("count", T.LongType()),
        T.StructField("sums", T.ArrayType(T.StringType())),
        T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("mixed", T.StringType()),
        T.StructField("mixed_size", T.LongType()),
        T.StructField("low", T.StringType()),
        T.StructField("high", T.StringType()),
    ]
)
ARROW_PARTIAL = pa.struct(
    [
        ("count", pa.int64()),
        ("sums", pa.list_(pa.string())),
        ("sizes", pa.list_(pa.int64())),
        ("mixed", pa.string()),
        ("mixed_size", pa.int64()),
        ("low", pa.string()),
        ("high", pa.string()),
    ]
)


class FractionFold:
    """Running count, exact sum and extremes of one column for one key.

    Values of equal encoding (scale, bits and denominator) are added as plain
    integers, so their sum neither rounds nor depends on the order of the rows. Terminating
    denominators (2**i * 5**j), and one other, are kept that way. From the second other
    denominator on, all values with one are added as decimals carrying more digits
    than any result shows. Zero denominators are kept apart and decide the result if
    there are any. So the form of a sum follows from the set of its denominators, not
    from how many rows there are, their order, or who folded them.
    """

    __slots__ = ("math", "extremes", "count", "sums", "divisor", "rest", "rest_size", "zero", "low", "high")

    def __init__(self, math: Arithmetic, extremes: bool):
        self.math, self.extremes = math, extremes
        self.count, self.sums, self.divisor = 0, {}, None
        self.rest, self.rest_size = None, 0
        self.zero = None
        self.low = self.high = None

    def add(self, f) -> None:
        self.count += 1
        self._put(f, 1)
        if self.extremes:
            self._extend(f)

    def merge(self, partial: Mapping) -> None:
        self.count += partial["count"]
        if partial["mixed"] is not None:
            self._spill()
            self._mix(Decimal(partial["mixed"]), partial["mixed_size"])
        for text, size in zip(partial["sums"], partial["sizes"]):
            num, den = text.split("/")
            n, s, b = num.replace("b", "e").split("e")
            dn, ds, db = den.replace("b", "e").split("e")
            self._put((int(n), int(s), int(b), int(dn), int(ds), int(db)), size)
        for text in (partial["low"], partial["high"]):
            if text is not None:
                self._extend(self.math.parse(text))

    def _put(self, f, size: int) -> None:
        encoding = f[1:]
        if encoding[2] == 0:
            zero = self.math.part_sum(self.zero[0], f[:3]) if self.zero else f[:3]
            self.zero = (zero, (self.zero[1] if self.zero else 0) + size)
            return
        if not _terminates(encoding[2]):
            if self.rest is None and self.divisor not in (None, encoding[2:]):
                self._spill()
            if self.rest is not None:
                self._mix(self.math.wide_value(f), size)
                return
            self.divisor = encoding[2:]
        entry = self.sums.get(encoding)
        if entry is None:
            self.sums[encoding] = [f[0], size]
        else:
            entry[0] += f[0]
            entry[1] += size

    def _spill(self) -> None:
        """Move what has a denominator to the decimals."""
        if self.rest is None:
            self.rest = Decimal(0)
        for encoding in sorted(e for e in self.sums if not _terminates(e[2])):
            n, size = self.sums.pop(encoding)
            self._mix(self.math.wide_value((n,) + encoding), size)
        self.divisor = None

    def _mix(self, value: Decimal, size: int) -> None:
        self.rest = self.math.wide.add(self.rest, value)
        self.rest_size += size

    def _extend(self, f) -> None:
        if self.low is None or self._before(f, self.low):
            self.low = f
        if self.high is None or self._before(self.high, f):
            self.high = f

    def _before(self, x, y) -> bool:
        """x < y by value, by text where equal (so ties do not depend on row order)."""
        if x[1:] == y[1:] and x[3] > 0:
            return x[0] < y[0]
        (p, q), (u, v) = _ratio(x), _ratio(y)
        left, right = p * v, u * q
        return left < right or (left == right and self.math.text(x) < self.math.text(y))

    def total(self):
        """One fraction for all encodings; over several denominators, a decimal."""
        if self.zero is not None:
            return self.zero[0] + (0, 0, 0)
        if self.rest is None:
            folded = self._folded()
            # adding over several denominators must not have cost digits
            if len({e[2:] for e in self.sums} - {WHOLE}) < 2 or self._holds(folded):
                return folded
        return self.math.from_decimal(self._wide_total()[0])

    def _folded(self):
        total = None
        for encoding in sorted(self.sums):
            n, size = self.sums[encoding]
            if size > 1:
                s, b = encoding[:2]
                f = self.math.simplify(self.math.part_sum((n, s, b), (0, s, b)) + encoding[2:])
            else:
                f = (n,) + encoding
            total = f if total is None else self.math.add(total, f)
        return total

    def _wide_total(self):
        """Sum of all values as one wide decimal, and the sum of their magnitudes."""
        wide = self.math.wide
        total = magnitude = Decimal(0)
        for encoding in sorted(self.sums):
            value = self.math.wide_value((self.sums[encoding][0],) + encoding)
            total, magnitude = wide.add(total, value), wide.add(magnitude, abs(value))
        if self.rest is not None:
            total, magnitude = wide.add(total, self.rest), wide.add(magnitude, abs(self.rest))
        return total, magnitude

    def _holds(self, folded) -> bool:
        total, magnitude = self._wide_total()
        wide = self.math.wide
        error = abs(wide.subtract(self.math.wide_value(folded), total))
        return error <= wide.multiply(magnitude, Decimal("1e-50"))

    def partial(self) -> dict:
        sums = [((v[0],) + k, v[1]) for k, v in self.sums.items()]
        if self.zero is not None:
            sums.append((self.zero[0] + (0, 0, 0), self.zero[1]))
        return {
            "count": self.count,
            "sums": [self.math.text(f) for f, _ in sums],
            "sizes": [size for _, size in sums],
            "mixed": None if self.rest is None else str(self.rest),
            "mixed_size": self.rest_size,
            "low": self.math.text(self.low) or None,
            "high": self.math.text(self.high) or None,
        }

    def average(self):
        total = self.total()
        return None if total is None else self.math.divide(total, (self.count, 0, 0, 1, 0, 0))


@lru_cache(maxsize=4096)
def _terminates(n: int) -> bool:
    """Whether 1 / n is a finite decimal."""
    n = abs(n) >> ((n & -n).bit_length() - 1)
    while n % 5 == 0:
        n //= 5
    return n == 1


def _ratio(f):
    """Value as integers p / q with q >= 0; over zero, the sign over zero, and 0/0 as zero."""
    n, s, b, dn, ds, db = f
    if dn == 0:
        return ((n > 0) - (n < 0), 0) if n else (0, 1)
    p, q = n << max(db - b, 0), dn << max(b - db, 0)
    p, q = p * 10 ** max(ds - s, 0), q * 10 ** max(s - ds, 0)
    return (-p, -q) if q < 0 else (p, q)


def _fold_rows(columns: Sequence[str], keys: int, extremes: Sequence[bool], conf: NumericConf):
    """Map side: rows of a task to partials, one per key."""

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        math = Arithmetic(conf)
        schema, table = None, {}
        for batch in batches:
            schema = batch.schema
            key_columns = [batch.column(i).to_pylist() for i in range(keys)]
            values = [batch.column(keys + i).to_pylist() for i in range(len(columns))]
            for i, key in enumerate(zip(*key_columns) if keys else [()] * batch.num_rows):
                folds = table.get(key)
                if folds is None:
                    folds = table[key] = [FractionFold(math, e) for e in extremes]
                for fold_, column in zip(folds, values):
                    f = math.parse(column[i])
                    if f is not None:
                        fold_.add(f)
            if len(table) > MAX_KEYS:
                yield _partial_batch(table, schema, keys)
                table = {}
        if table:
            yield _partial_batch(table, schema, keys)

    return fold


def _partial_batch(table, schema, keys) -> pa.RecordBatch:
    names = [schema.field(i).name for i in range(len(schema))]
    arrays = [pa.array([k[i] for k in table], type=schema.field(i).type) for i in range(keys)]
    for i in range(len(schema) - keys):
        arrays.append(pa.array([folds[i].partial() for folds in table.values()], type=ARROW_PARTIAL))
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _same_key(a: tuple, b: tuple) -> bool:
    return all(x is y or x == y or (x != x and y != y) for x, y in zip(a, b))


def _fold_partials(outputs: Sequence[tuple[str, str, int]], columns: int, keys: int, conf: NumericConf):
    """Reduce side: the partials of a partition come sorted by key; one key is held at a time."""

    only_texts = all(kind != "avg" for _, kind, _ in outputs)
    field = {"sum": "sums", "min": "low", "max": "high"}

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        math = Arithmetic(conf)
        schema, current, folds, done = None, None, None, []

        def finish() -> None:
            if isinstance(folds, dict):
                texts = [folds[field[kind]] for _, kind, _ in outputs]
                done.append(current + tuple(t[0] if isinstance(t, list) else t for t in texts))
                return
            texts = []
            for _, kind, position in outputs:
                f = folds[position]
                if kind == "sum":
                    texts.append(math.text(f.total()))
                elif kind == "avg":
                    texts.append(math.text(f.average()))
                else:
                    best = f.low if kind == "min" else f.high
                    texts.append(None if best is None else math.text(best))
            done.append(current + tuple(texts))

        def result() -> pa.RecordBatch:
            arrays = [pa.array([row[i] for row in done], type=schema.field(i).type) for i in range(keys)]
            arrays += [pa.array([row[keys + i] for row in done], type=pa.string()) for i in range(len(outputs))]
            names = [schema.field(i).name for i in range(keys)] + [name for name, _, _ in outputs]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        if not keys:
            current, folds = (), [FractionFold(math, True) for _ in range(columns)]
        for batch in batches:
            schema = batch.schema
            key_columns = [batch.column(i).to_pylist() for i in range(keys)]
            partials = [batch.column(keys + i).to_pylist() for i in range(columns)]
            for i, key in enumerate(zip(*key_columns) if keys else [()] * batch.num_rows):
                if current is None or not _same_key(key, current):
                    if current is not None:
                        finish()
                        if len(done) >= RESULT_KEYS:
                            yield result()
                    current = key
                    if only_texts and columns == 1 and _is_result(partials[0][i]):
                        folds = partials[0][i]  # the result, unless more of the key follows
                        continue
                    folds = [FractionFold(math, True) for _ in range(columns)]
                elif isinstance(folds, dict):
                    first, folds = folds, [FractionFold(math, True)]
                    folds[0].merge(first)
                for fold_, column in zip(folds, partials):
                    fold_.merge(column[i])
        if current is not None:
            finish()
        if done:
            yield result()

    return fold


def _is_result(partial: Mapping) -> bool:
    """Whether a partial of one whole number shows its sum as it would be printed."""
    return len(partial["sums"]) == 1 and partial["mixed"] is None and _PRINTED.match(partial["sums"][0]) is not None


_PRINTED = re.compile(r"-?\d{1,36}e\d+b0/1e0b0$")


def _plain_partials(rows: DataFrame, by: Sequence[str], column: str, extremes: bool) -> DataFrame:
    """Partials of the rows whose value is a plain number or missing, without leaving the JVM: one per key and scale."""
    text = F.col(column)
    n = F.regexp_extract(text, r"^(-?\d+)", 1).try_cast("bigint")
    scale = F.coalesce(F.regexp_extract(text, r"e(\d+)", 1).try_cast("int"), F.lit(0))
    value = F.coalesce(text != "", F.lit(False))
    numbers = rows.select(*by, F.when(value, n).alias("__n"), F.when(value, scale).alias("__s"))
    sums = numbers.groupBy(*by, "__s").agg(
        F.count("__n").alias("__size"), F.sum(F.col("__n").cast("decimal(28,0)")).alias("__sum"), F.min("__n").alias("__low"), F.max("__n").alias("__high")
    )
    printed = lambda x: F.concat(F.col(x).cast("string"), F.lit("e"), F.col("__s").cast("string"), F.lit(PLAIN_REST))
    known = F.col("__size") > 0
    nothing = F.lit(None).cast("string")
    partial = {
        "count": F.col("__size"),
        "sums": F.when(known, F.array(printed("__sum"))).otherwise(F.array().cast("array<string>")),
        "sizes": F.when(known, F.array("__size")).otherwise(F.array().cast("array<bigint>")),
        "mixed": nothing,
        "mixed_size": F.lit(0).cast("bigint"),
        "low": printed("__low") if extremes else nothing,
        "high": printed("__high") if extremes else nothing,
    }
    return sums.select(*by, F.struct(*(c.alias(k) for k, c in partial.items())).alias(column))


def _by_key(partials: DataFrame, by: Sequence[str]) -> DataFrame:
    return partials.repartition(*by).sortWithinPartitions(*by) if by else partials.repartition(1)


def ubi_aggregate(
    df: DataFrame,
    by: Sequence[str],
    aggregates: Mapping[str, tuple[str, str | Column]],
    conf: NumericConf = DEFAULT,
) -> DataFrame:
    """Exact ``sum``, ``avg``, ``min`` and ``max`` of fraction columns per key.

    ``aggregates`` maps an output name to ``(kind, column)``. A column given by the
    same name or object is read and folded once however many outputs use it. Sums and averages of
    nothing are ``""``; extremes of nothing are NULL. A single column given by its name is
    split: plain numbers are folded natively per key and scale, only other texts row by row.
    """
    by = list(by)
    inputs: dict[object, tuple[int, Column]] = {}
    outputs, extremes = [], []
    for name, (kind, column) in aggregates.items():
        if kind not in ("sum", "avg", "min", "max"):
            raise ValueError(f"unknown aggregate {kind!r}")
        c = as_column(column)
        # two columns may print alike, so only names and the same object are shared
        same = column if isinstance(column, str) else id(column)
        position = inputs.setdefault(same, (len(inputs), c))[0]
        if position == len(extremes):
            extremes.append(False)
        extremes[position] |= kind in ("min", "max")
        outputs.append((name, kind, position))

    columns = [f"__v{i}" for i in range(len(inputs))]
    rows = df.select(*by, *(c.alias(n) for n, (_, c) in zip(columns, inputs.values())))
    keys = rows.schema.fields[: len(by)]
    partial_schema = T.StructType(keys + [T.StructField(n, PARTIAL_TYPE) for n in columns])
    folding = _fold_rows(columns, len(by), extremes, conf)
    if len(inputs) == 1 and isinstance(next(iter(inputs)), str) and conf.precision >= LIMB_DIGITS * 2:
        plain = F.coalesce(F.col("__v0").rlike(PLAIN) | (F.col("__v0") == ""), F.lit(True))
        native = _plain_partials(rows.where(plain), by, "__v0", extremes[0])
        partials = native.unionByName(rows.where(~plain).mapInArrow(folding, partial_schema))
    else:
        partials = rows.mapInArrow(folding, partial_schema)
    merged = _by_key(partials, by)
    result_schema = T.StructType(keys + [T.StructField(n, T.StringType()) for n in aggregates])
    return merged.mapInArrow(_fold_partials(outputs, len(columns), len(by), conf), result_schema)


def ubi_sum_limbs(df: DataFrame, by: Sequence[str], column: str | Column, alias: str, conf: NumericConf = DEFAULT) -> DataFrame:
    """Exact sum of integer or fraction text with every row handled inside the JVM.

    Numerators are cut into 18-digit limbs and summed natively per encoding, with
    map-side partial sums; Python only sees one row per key and encoding.
    Text in decimal notation goes through ``ubi_canonical`` first.
    """
    by = list(by)
    text = as_column(column)
    parsed = df.where(text.isNotNull() & (text != "")).select(*by, ubi_parse(text).alias("__f"))
    n = F.col("__f.n")
    digits = F.ltrim(n, F.lit("-"))
    sign = F.when(n.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    width = LIMBS * LIMB_DIGITS
    checked = F.when(
        F.length(digits) > width, F.raise_error(F.lit(f"more than {width} digits; use ubi_canonical first"))
    ).otherwise(digits)
    prepared = parsed.select(
        *by,
        *(F.col(f"__f.{p}").alias(f"__{p}") for p in ("s", "b", "dn", "ds", "db")),
        F.when(F.col("__f").isNull(), F.raise_error(F.lit("not a fraction; use ubi_canonical first")))
        .otherwise(checked)
        .alias("__digits"),
        sign.alias("__sign"),
    )
    d = F.col("__digits")
    limbs = []
    for i in range(LIMBS):
        end = F.length(d) - F.lit(i * LIMB_DIGITS)
        start = F.greatest(end - LIMB_DIGITS, F.lit(0))
        limb = F.when(end > 0, d.substr(start + 1, end - start).cast("bigint") * F.col("__sign"))
        limbs.append(F.sum(limb.cast("decimal(28,0)")).alias(f"__l{i}"))
    encodings = ["__s", "__b", "__dn", "__ds", "__db"]
    sums = prepared.groupBy(*by, *encodings).agg(*limbs, F.count(F.lit(1)).alias("__size"))
    joined = F.concat_ws(",", *(F.coalesce(F.col(f"__l{i}"), F.lit(0)).cast("string") for i in range(LIMBS)))
    rest = F.format_string("e%db%d/%se%db%d", *encodings)
    classes = sums.select(*by, _class_partial(conf)(joined, rest, F.col("__size")).alias("__v"))
    merged = _by_key(classes, by)
    schema = T.StructType(classes.schema.fields[: len(by)] + [T.StructField(alias, T.StringType())])
    return merged.mapInArrow(_fold_partials([(alias, "sum", 0)], 1, len(by), conf), schema)


def _class_partial(conf: NumericConf):
    """Put the limb sums of one encoding together again."""

    @F.arrow_udf(PARTIAL_TYPE)
    def build(limbs: pa.Array, rest: pa.Array, size: pa.Array) -> pa.Array:
        out = []
        for text, tail, count in zip(limbs.to_pylist(), rest.to_pylist(), size.to_pylist()):
            n = sum(int(limb) * 10 ** (LIMB_DIGITS * i) for i, limb in enumerate(text.split(",")))
            out.append({"count": count, "sums": [f"{n}{tail}"], "sizes": [count], "mixed": None, "mixed_size": 0, "low": None, "high": None})
        return pa.array(out, type=ARROW_PARTIAL)

    return build


# -- column and SQL forms ------------------------------------------------------


def _grouped(kind: str, conf: NumericConf):
    math = Arithmetic(conf)

    @F.arrow_udf("string")
    def fold(values: pa.Array) -> str:
        state = FractionFold(math, kind in ("min", "max"))
        for text in values.to_pylist():
            f = math.parse(text)
            if f is not None:
                state.add(f)
        if kind == "sum":
            return math.text(state.total())
        if kind == "avg":
            return math.text(state.average())
        best = state.low if kind == "min" else state.high
        return None if best is None else math.text(best)

    return fold


SPREAD_LIMBS = 24  # fixed-point places of the column sums, 18 digits each
POINT = 12  # of which as many after the decimal point
POINT_DIGITS = POINT * LIMB_DIGITS
_SPREAD_FIELDS = [f"l{i}" for i in range(SPREAD_LIMBS)]
# A denominator as numbers: its places, scale, bits and limbs. Extremes of numbers are kept in a hash table per task,
# those of texts would have all rows of a task sorted.
_DEN_FIELDS = ["dp", "ds", "db", *(f"d{i}" for i in range(LIMBS))]
SPREAD_TYPE = T.StructType([T.StructField(n, T.LongType()) for n in (*_SPREAD_FIELDS, "s", "b", *_DEN_FIELDS)])


@lru_cache(maxsize=4096)
def _limbs_of(dn: int) -> tuple[int, ...]:
    """Limbs of a denominator, lowest first, each with its sign."""
    sign, rest, limbs = (-1, -dn, []) if dn < 0 else (1, dn, [])
    while rest:
        rest, limb = divmod(rest, 10**LIMB_DIGITS)
        limbs.append(sign * limb)
    if len(limbs) > LIMBS:
        raise OverflowError(f"a denominator of more than {LIMBS * LIMB_DIGITS} digits; use ubi_aggregate")
    return tuple(limbs)


def _spread(conf: NumericConf):
    """Cut a value into 18-digit places of one fixed-point grid, so that native sums add it up."""
    math = Arithmetic(conf)
    base = 10**LIMB_DIGITS

    def places(f):
        n, s, b, dn, ds, db = f
        if dn == 0:
            raise ZeroDivisionError(f"zero denominator in {math.text(f)}")
        shift, bits = s - ds, b - db
        if bits > 0:
            n, shift = n * 5**bits, shift + bits
        else:
            n <<= -bits
        up = POINT_DIGITS - shift
        first = 0
        if n and (abs(n) * 10 ** max(up, 0) < abs(dn) * 10 ** max(-up, 0) or (dn == 1 and up < 0 and n % 10**-up)):
            raise OverflowError(f"{math.text(f)} has digits below the range of ubi_sum; use ubi_aggregate")
        if dn != 1 or up < 0:
            num, den = n * 10 ** max(up, 0), dn * 10 ** max(-up, 0)
            m = (2 * num + den) // (2 * den)
        else:
            first, rest = divmod(up, LIMB_DIGITS)
            m = n * 10**rest
        sign, m = (-1, -m) if m < 0 else (1, m)
        i = first
        while m:
            m, limb = divmod(m, base)
            if i >= SPREAD_LIMBS:
                raise OverflowError(f"{math.text(f)} is past the range of ubi_sum; use ubi_aggregate")
            if limb:
                yield i, sign * limb
            i += 1

    @F.arrow_udf(SPREAD_TYPE)
    def spread(values: pa.Array) -> pa.Array:
        texts = values.to_pylist()
        columns = {f.name: [None] * len(texts) for f in SPREAD_TYPE.fields}
        sums, dens = [columns[n] for n in _SPREAD_FIELDS], [columns[f"d{i}"] for i in range(LIMBS)]
        s, b, dp, ds, db = (columns[n] for n in ("s", "b", "dp", "ds", "db"))
        for row, text in enumerate(texts):
            f = math.parse(text)
            if f is None:
                continue
            for i, limb in places(f):
                sums[i][row] = limb
            limbs = _limbs_of(f[3])
            for i, limb in enumerate(limbs):
                dens[i][row] = limb
            s[row], b[row], dp[row], ds[row], db[row] = f[1], f[2], len(limbs), f[4], f[5]
        arrays = [pa.array(c, type=pa.int64()) for c in columns.values()]
        return pa.StructArray.from_arrays(arrays, names=list(columns))

    return spread


def _gather(kind: str, conf: NumericConf):
    """Put the sums of all places together again."""
    math = Arithmetic(conf)

    def total(places: str, size: int, s: int, b: int, low: str, high: str):
        units = sum(int(limb) * 10 ** (LIMB_DIGITS * i) for i, limb in enumerate(places.split(",")))
        if low == high:
            # one denominator: its numerators add up to a whole number at the largest encoding
            _, ds, db, *limbs = map(int, low.split(","))
            dn = sum(limb * 10 ** (LIMB_DIGITS * i) for i, limb in enumerate(limbs))
            s = s if size == 1 else max(s, 0)
            num = units * dn * 10 ** max(s - ds, 0) << max(b - db, 0)
            den = 10 ** (POINT_DIGITS + max(ds - s, 0)) << max(db - b, 0)
            if size * abs(num) < den * abs(units or 1):  # rounding of all rows is below one half
                n = (2 * num + den) // (2 * den)
                f = math.fit(n, s, b) + (dn, ds, db)
                return f if size == 1 else math.simplify(f)
        return math.from_decimal(Decimal(units).scaleb(-POINT_DIGITS, math.wide))

    @F.arrow_udf("string")
    def gather(limbs: pa.Array, size: pa.Array, s: pa.Array, b: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
        out = []
        for row in zip(*(a.to_pylist() for a in (limbs, size, s, b, low, high))):
            if not row[1]:
                out.append("")
                continue
            f = total(*row)
            out.append(math.text(f if kind == "sum" else math.divide(f, (row[1], 0, 0, 1, 0, 0))))
        return pa.array(out, type=pa.string())

    return gather


def _summed(kind: str, x, conf: NumericConf) -> Column:
    parts = _bound_spread(conf)(as_column(x))
    sums = [F.coalesce(F.sum(parts[n].cast("decimal(28,0)")), F.lit(0)).cast("string") for n in _SPREAD_FIELDS]
    # limbs past a denominator's places are NULL and left out
    low, high = (F.concat_ws(",", *(extreme(parts[n]).cast("string") for n in _DEN_FIELDS)) for extreme in (F.min, F.max))
    return _gather(kind, conf)(F.concat_ws(",", *sums), F.count(parts["dp"]), F.max(parts["s"]), F.max(parts["b"]), low, high)


_SPREADS: dict = {}


def _bound_spread(conf: NumericConf):
    if conf not in _SPREADS:
        _SPREADS[conf] = _spread(conf)
    return _SPREADS[conf]


def ubi_sum(x, conf: NumericConf = DEFAULT) -> Column:
    """Exact sum with native partial aggregation.

    Exact for whole numbers and for one common denominator; sums over several
    denominators carry 216 decimal places. Values of 10**216 and more, below 10**-216,
    or whole with digits below that, fail and need ``ubi_aggregate``, which has no such
    range.
    """
    return _summed("sum", x, conf)


def ubi_avg(x, conf: NumericConf = DEFAULT) -> Column:
    """Exact average, see ``ubi_sum``."""
    return _summed("avg", x, conf)


def _ordered(x, conf: NumericConf) -> Column:
    """Order key, then text, so that ties do not depend on the order of rows; NULL without a value."""
    key = ubi_order_key(x, conf)
    return F.when(key.isNotNull(), F.struct(key.alias("key"), ubi_canonical(x, conf).alias("text")))


def ubi_min(x, conf: NumericConf = DEFAULT) -> Column:
    """Smallest value, with native partial aggregation."""
    return F.min(_ordered(x, conf))["text"]


def ubi_max(x, conf: NumericConf = DEFAULT) -> Column:
    """Largest value, with native partial aggregation."""
    return F.max(_ordered(x, conf))["text"]


def register_functions(spark: SparkSession, conf: NumericConf = DEFAULT) -> None:
    """Make every function callable from SQL text."""
    for name in SCALAR_NAMES:
        spark.udf.register(name, bound(name, conf))
    for kind in ("sum", "avg", "min", "max"):
        spark.udf.register(f"ubi_{kind}", _grouped(kind, conf))
    spark.sql(_sql_function("ubi_sign", "INT", scalars.ubi_sign_sql("x")))
    spark.sql(_sql_function("ubi_is_valid", "BOOLEAN", f"x RLIKE '{scalars.FRACTION_FORM}'"))


def _sql_function(name: str, returns: str, body: str) -> str:
    body = body.replace("\\", "\\\\")
    return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS {returns} RETURN {body}"
