"""Embedding whitening by the exact characteristic polynomial.

Entries become whole numbers, ``x = floor(64 * c) + 1000000``, so all that the
rows say about their covariance is one integer matrix, the scatter
``A = n * sum(x x') - S S'`` over the different vectors (``A = n**2 V``; the
shift of x drops out, and the code works without it). From there on nothing is
rounded until the end:

1. Tasks sum products of 20-bit limbs, which doubles hold exactly, and Spark
   adds the tasks' sums as decimals: ``A`` has no rounding error.
2. For each of enough primes a task brings A to Hessenberg form modulo the
   prime and takes its characteristic polynomial; Chinese remaindering of the
   primes' coefficients gives the integer polynomial.
3. All its roots are real, so the sign changes of the polynomial shifted to t
   count the roots above t exactly. A task per component isolates its root by
   bisection on these counts, to ``BITS`` bits.
4. The same task finds the null space of ``A - root * I`` by inverse iteration
   with ``DIGITS`` digits. Equal roots share a basis, each takes its own vector
   of it.

The matrices and the polynomial depend on the number of dimensions only, never
on the rows; rows are only summed over, and whitened in one pass.

Cases: vectors that are null, empty, or hold null or non-finite entries take no
part, nor do those with an entry of 2**55 or more, where x would not fit, nor
those of another length than the most frequent one (of equally frequent ones
the longest). Repeated rows are whitened each and count once in the fit.
Components with eigenvalue 0 are left out, as nothing can be divided by it;
with a single different vector, or an empty table, the result is empty. A
``deviation`` that does not fit a long is null. Null or repeated ids are
carried along; other columns are not read.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewater.llm.common import stage

SCALE, LIMB, CHUNK, BITS, DIGITS, TOP = 64, 20, 1 << 12, 120, 80, 16
SCHEMA = (
    "{id} {type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) >= float(1 << 55)))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def whole(vector: Column) -> Column:
    """Entries as ``floor(64 * c)``."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """Doubles of at most ``LIMB`` bits and a sign, least first; ``sum(l * 2**(LIMB * i))`` is ``y``."""
    sign, rest, out = np.sign(y), np.abs(y), []
    while not out or rest.any():
        out.append((sign * (rest & ((1 << LIMB) - 1))).astype(np.float64))
        rest = rest >> LIMB
    return out


def _vectors(batch: pa.RecordBatch, column: str) -> np.ndarray:
    got = batch.column(column)
    n = batch.num_rows
    return got.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1), np.int64)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of entries (j = -1) and of products (j <= i) by limb power."""
    n, sums, products = 0, {}, {}
    for batch in batches:
        y = _vectors(batch, "y")
        for lo in range(0, len(y), CHUNK):  # CHUNK products of two limbs stay below 2**53
            parts = limbs(y[lo : lo + CHUNK])
            n += len(parts[0])
            for a, left in enumerate(parts):
                sums[a] = sums.get(a, 0) + left.sum(0).astype(np.int64)
                for b, right in enumerate(parts):
                    products[a + b] = products.get(a + b, 0) + (left.T @ right).astype(np.int64)
    if not n:
        return
    i, j = np.tril_indices(len(sums[0]))
    rows = [(-1, -1, 0, n)]
    for power, s in sums.items():
        rows += [(k, -1, power, int(v)) for k, v in enumerate(s)]
    for power, m in products.items():
        rows += zip(i.tolist(), j.tolist(), [power] * len(i), m[i, j].tolist(), strict=True)
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(),) * 3 + (pa.int64(),), strict=True)], names=["i", "j", "power", "v"])


def scatter(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """``y`` (array<long>, all different) -> n, sums, and the integer scatter matrix."""
    summed = (
        fit.select("y").mapInArrow(_moments, "i int, j int, power int, v long")
        .groupBy("i", "j", "power").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    )
    n, s, m = 0, [0] * d, [[0] * d for _ in range(d)]
    for i, j, power, v in summed.collect():  # as many rows as the dimensions give
        v = int(v) << (LIMB * power)
        if i < 0:
            n = v
        elif j < 0:
            s[i] += v
        else:
            m[i][j] += v
    for i in range(d):
        for j in range(i + 1):
            m[i][j] = m[j][i] = n * m[i][j] - s[i] * s[j]
    return n, s, m


def probably_prime(p: int) -> bool:
    """Strong probable primes to these bases: all of them primes below 3.2e9."""
    d, r = p - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for base in (2, 3, 5, 7):
        powers = [pow(base, d << i, p) for i in range(r)]
        if powers[0] != 1 and p - 1 not in powers:
            return False
    return True


def primes_below(top: int, count: int) -> list[int]:
    out, p = [], top - 1 | 1
    while len(out) < count:
        p -= 2
        if probably_prime(p):
            out.append(p)
    return out


def polynomial_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x I - a) modulo a prime below 2**31, constant first."""
    h = a % p
    d = len(h)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        k = m + int(below[0])
        if k != m:
            h[[k, m]] = h[[m, k]]
            h[:, [k, m]] = h[:, [m, k]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m] % p) % p  # rows, then the inverse step on columns
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(1)) % p
    polys = [np.array([1], np.int64)]
    for k in range(d):
        new = np.zeros(k + 2, np.int64)
        new[1:] = polys[k]
        new[:-1] = (new[:-1] - int(h[k, k]) * polys[k]) % p
        t = 1
        for i in range(k - 1, -1, -1):
            t = t * int(h[i + 1, i]) % p
            if not t:
                break
            new[: i + 1] = (new[: i + 1] - t * int(h[i, k]) % p * polys[i]) % p
        polys.append(new)
    return polys[d]


def _residues(matrix: list[list[int]]):
    def of(batches):
        for batch in batches:
            out = []
            for p in batch.column("p").to_pylist():
                a = np.array([[v % p for v in row] for row in matrix], np.int64)
                out.append(polynomial_mod(a, p))
            yield pa.RecordBatch.from_arrays([batch.column("p"), pa.array(out, pa.list_(pa.int64()))], names=["p", "c"])

    return of


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients of det(x I - A), constant first; A is symmetric without negative eigenvalues."""
    d = len(matrix)
    # Every coefficient is at most the product of (1 + eigenvalue), which is at most (1 + trace / d)**d.
    bits = d * math.log2(2 + sum(matrix[i][i] for i in range(d)) // d) + 2
    primes = primes_below(1 << 31, math.ceil(bits / 30.99) + 1)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), 64))
    found = rows.mapInArrow(_residues(matrix), "p long, c array<long>").collect()
    product = math.prod(primes)
    total = [0] * (d + 1)
    for p, c in found:
        rest = product // p
        weight = rest * pow(rest, -1, p)
        total = [t + weight * v for t, v in zip(total, c, strict=True)]
    total = [t % product for t in total]
    return [t - product if 2 * t > product else t for t in total]


def roots_above(poly: list[int], a: int, s: int) -> int:
    """How many roots, each as often as it occurs, are above ``a / 2**s``; all roots must be real."""
    d = len(poly) - 1
    q = [c << (s * (d - k)) for k, c in enumerate(poly)]
    if a:
        for i in range(d):
            carry = q[d]
            for j in range(d - 1, i - 1, -1):
                carry = q[j] = q[j] + a * carry
    signs = [c > 0 for c in q if c]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def root(poly: list[int], k: int, bits: int = BITS) -> tuple[Fraction, int, int] | None:
    """The k-th largest root if it is positive, how many share its interval, and its place among them (from 0)."""
    if roots_above(poly, 0, 0) < k:
        return None
    lo, hi, s = 0, 1 << (-poly[-2]).bit_length(), 0  # no root is above the trace
    while (hi - lo) << bits > hi:
        if hi - lo == 1:
            lo, hi, s = 2 * lo, 2 * hi, s + 1
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if roots_above(poly, mid, s) >= k else (lo, mid)
    beyond = roots_above(poly, hi, s)
    return Fraction(lo + hi, 2 << s), roots_above(poly, lo, s) - beyond, k - 1 - beyond


def null_space(matrix: list[list[int]], value: Fraction, size: int) -> list[np.ndarray]:
    """``size`` orthonormal vectors that ``A - value`` sends to about nothing, by inverse iteration in decimals."""
    with decimal.localcontext() as context:
        context.prec = DIGITS
        d = len(matrix)
        shift = Decimal(value.numerator) / Decimal(value.denominator)
        a = np.array([[Decimal(v) for v in row] for row in matrix], object)
        tiny = max(abs(shift), Decimal(1)) * Decimal(10) ** (8 - DIGITS)
        for i in range(d):
            a[i, i] -= shift
        order = list(range(d))
        for m in range(d):  # L below the diagonal, U above, rows by largest pivot
            k = m + int(np.argmax(np.abs(a[m:, m])))
            if k != m:
                a[[k, m]] = a[[m, k]]
                order[k], order[m] = order[m], order[k]
            if abs(a[m, m]) < tiny:
                a[m, m] = tiny
            if m + 1 < d:
                a[m + 1 :, m] = a[m + 1 :, m] / a[m, m]
                a[m + 1 :, m + 1 :] -= np.multiply.outer(a[m + 1 :, m], a[m, m + 1 :])
        basis = [np.array([Decimal((i * 7919 + j * 104729 + i * j * 31) % 1009 - 504) for j in range(d)], object) for i in range(size)]
        for _ in range(3):
            done: list[np.ndarray] = []
            for v in basis:
                v = v[order]
                for m in range(d):
                    v[m + 1 :] -= a[m + 1 :, m] * v[m]
                for m in range(d - 1, -1, -1):
                    v[m] = (v[m] - (a[m, m + 1 :] * v[m + 1 :]).sum()) / a[m, m]
                v = v / max(abs(x) for x in v)
                for _twice in range(2):
                    for u in done:
                        v = v - u * (u * v).sum()
                    v = v / (v * v).sum().sqrt()
                done.append(v)
            basis = done
        return [np.array([float(x) for x in v]) for v in basis]


def _components(matrix: list[list[int]], poly: list[int]):
    def of(batches):
        for batch in batches:
            out = []
            for k in batch.column("component").to_pylist():
                found = root(poly, k)
                if found is not None:
                    value, size, place = found
                    out.append((k, str(value), null_space(matrix, value, size)[place]))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            types = (pa.int32(), pa.string(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["component", "value", "vector"])

    return of


def components(spark, matrix: list[list[int]], top: int = TOP) -> list[tuple[int, Fraction, np.ndarray]]:
    """``(component, eigenvalue, unit eigenvector)`` of an integer scatter matrix, by falling eigenvalue, only positive ones."""
    poly = characteristic_polynomial(spark, matrix)
    top = min(top, len(matrix))
    numbers = spark.createDataFrame([(k,) for k in range(1, top + 1)], "component int").repartition(top)
    schema = "component int, value string, vector array<double>"
    found = numbers.mapInArrow(_components(matrix, poly), schema).collect()
    return sorted((k, Fraction(v), np.array(x)) for k, v, x in found)


class Model:
    """What tasks need: the mean as whole part and rest, and a column for each component."""

    def __init__(self, n: int, sums: list[int], found: list, trace: int):
        whole = [round(Fraction(s, n)) for s in sums]
        self.n, self.mean = n, np.array(whole, np.int64)
        self.left = np.array([s - n * w for s, w in zip(sums, whole, strict=True)], np.int64)
        self.rest = self.left / n
        self.numbers = np.array([k for k, _, _ in found], np.int32)
        # Eigenvalues of V are those of the scatter over n**2.
        self.columns = np.stack([v / math.sqrt(Fraction(e, n * n)) for _, e, v in found], 1)
        self.explained = np.array([float(Fraction(e) / trace) for _, e, _ in found])

    def whiten(self, y: np.ndarray) -> np.ndarray:
        return ((y - self.mean) - self.rest) @ self.columns

    def deviation(self, y: np.ndarray) -> list[int | None]:
        off = y - self.mean
        about = ((off - self.rest) ** 2).sum(1) * float(self.n) ** 2
        with np.errstate(over="ignore"):  # sums are right modulo 2**64, so right where they fit
            out = ((self.n * off - self.left) ** 2).sum(1).tolist()
        for i in np.flatnonzero(about > 9e18):
            exact = sum((self.n * int(o) - int(r)) ** 2 for o, r in zip(off[i], self.left, strict=True))
            out[i] = exact if exact < 1 << 63 else None
        return out


def _spread(model: Model):
    """Task function: sums of the whitened entries (j = -1) and of their products."""

    def of(batches):
        k = len(model.numbers)
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.whiten(_vectors(batch, "y")) if batch.num_rows else np.zeros((0, k))
            total += w.sum(0)
            products += w.T @ w
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([i, np.arange(k)]).astype(np.int32)),
                pa.array(np.concatenate([j, np.full(k, -1)]).astype(np.int32)),
                pa.array(np.concatenate([products.ravel(), total])),
            ],
            names=["i", "j", "v"],
        )

    return of


def identity_error(fit: DataFrame, model: Model) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(model.numbers)
    summed = fit.select("y").mapInArrow(_spread(model), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    total, products = np.zeros(k), np.zeros((k, k))
    for i, j, v in summed.collect():
        if j < 0:
            total[i] = v
        else:
            products[i, j] = v
    mean = total / model.n
    return float(np.abs(products / model.n - np.outer(mean, mean) - np.eye(k)).max())


def _whitened(model: Model, error: float, schema: pa.Schema):
    def of(batches):
        k = len(model.numbers)
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            y = _vectors(batch, "y")
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(m), k)))
            deviation = pa.array(model.deviation(y), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
            columns = [
                ids, pa.array(np.tile(model.numbers, m)), pa.array(np.full(m * k, model.n)), deviation,
                pa.array(model.whiten(y).ravel()), pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema)

    return of


def whiten(vectors: DataFrame, row_id: str = "vec_id", vector: str = "embedding", top: int = TOP) -> DataFrame:
    """Each usable row's coordinates on the first ``top`` components, one row for each: the query's columns."""
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[row_id]
    schema = SCHEMA.format(id=row_id, type=kind)
    kept = vectors.select(row_id, F.when(usable(F.col(vector)), F.col(vector)).alias("v")).filter("v is not null")
    common = kept.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    d = common["d"]
    rows = kept.filter(F.size("v") == d).select(row_id, whole(F.col("v")).alias("y"))
    fit = stage(rows.select("y").distinct(), "fit")
    n, sums, matrix = scatter(fit, d)
    found = components(spark, matrix, top) if any(matrix[i][i] for i in range(d)) else []
    if not found:
        return spark.createDataFrame([], schema)
    model = Model(n, sums, found, sum(matrix[i][i] for i in range(d)))
    names = [part.split()[0] for part in schema.split(", ")]
    return rows.mapInArrow(_whitened(model, identity_error(fit, model), names), schema)
