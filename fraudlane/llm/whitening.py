"""Whitening of embedding vectors by the exact characteristic polynomial of their scatter matrix.

Entries become integers, so the scatter matrix n * sum(x x') - S S', n * n times the covariance, is a matrix of
integers and is summed exactly. Its characteristic polynomial is computed modulo many 31-bit primes, one Hessenberg
reduction for each prime, the primes spread over tasks, and put together by Chinese remaindering. All roots are real
and none is negative, so the signs of the shifted polynomial count the roots beyond any point exactly; bisection
isolates the largest ones to ``ROOT_BITS`` significant bits. Inverse iteration on the matrix less a root, with
``DIGITS`` digits, gives the null vector, the component.

What reaches the driver is the matrix and its polynomial: the square of the vectors' length, whatever their number.
Sums are made in each task by products of doubles that are small enough to be exact, and merged as whole numbers.

Defined results: a vector that is null, empty or holds a null, a NaN or a magnitude of 2**52 and more (so infinity too)
is left out; so is one whose length is not the commonest one (of equally common ones the longer). Repeated rows count
as often as they occur and are answered as often. There are at most as many components as eigenvalues above zero: none
for an empty table or for vectors that are all equal, which give an empty result. Vectors of one multiple eigenvalue
are some orthonormal basis. Of the two signs of a component the one is taken that makes its largest entry positive.
``deviation`` is null where it exceeds a long. Extra columns are ignored; a null ``vec_id`` is one like any other.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlane.scratch import materialise

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Significant bits of a root, and decimal digits of the inverse iteration.
ROOT_BITS, DIGITS = 120, 90
_TOO_LARGE = float(1 << 52)
#: Integers are cut to so many bits for products of doubles; so many rows of such products add up without rounding.
_LIMB, _ROWS = 18, 1 << 16
_TEN18 = 10**18
_WIDE = pa.decimal128(38, 0)


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and x, the whole-numbered vector, of every row that can be used."""
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _TOO_LARGE))
    usable = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(F.coalesce(fine, F.lit(False)))
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    return usable.select("vec_id", whole.alias("x"))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def gram(rows: np.ndarray) -> np.ndarray:
    """rows' times rows for integers of any size, exactly, as Python integers."""
    bits = int(np.abs(rows).max(initial=0)).bit_length()
    limbs, rest = [], rows
    for _ in range(max(1, -(-bits // _LIMB))):
        low = rest & ((1 << _LIMB) - 1)
        rest = rest >> _LIMB
        limbs.append(low)
    limbs[-1] = limbs[-1] + (rest << _LIMB)
    length = rows.shape[1]
    total = np.zeros((length, length), dtype=object)
    for at in range(0, len(rows), _ROWS):
        parts = [limb[at : at + _ROWS].astype(float) for limb in limbs]
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                total += (a.T @ b).astype(np.int64).astype(object) * (1 << (_LIMB * (i + j)))
    return total


def _sums(length: int):
    """(i, j, hi, lo) with hi * 10**18 + lo the sum of x_i x_j; i is -1 for the sum of x_j, and j too for the count."""
    upper = np.triu_indices(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(length, dtype=object), np.zeros((length, length), dtype=object)
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(0), length) - SHIFT
                n += len(rows)
                # Half words, so that no sum of a batch leaves a long.
                total += (rows >> 32).sum(axis=0).astype(object) * (1 << 32) + (rows & 0xFFFFFFFF).sum(axis=0).astype(object)
                products += gram(rows)
        values = [n, *total.tolist(), *products[upper].tolist()]
        split = [divmod(v, _TEN18) for v in values]
        i = np.concatenate([np.full(length + 1, -1), upper[0]])
        j = np.concatenate([np.arange(-1, length), upper[1]])
        hi, lo = (pa.array([decimal.Decimal(s[k]) for s in split], _WIDE) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), hi, lo], ["i", "j", "hi", "lo"])

    return run


def scatter(whole: DataFrame, length: int) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums S, and the scatter matrix n * sum(x x') - S S'."""
    each = whole.select("x").mapInArrow(_sums(length), "i long, j long, hi decimal(38,0), lo decimal(38,0)")
    merged = each.groupBy("i", "j").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo")).collect()
    value = {(r["i"], r["j"]): int(r["hi"]) * _TEN18 + int(r["lo"]) for r in merged}
    n = value.get((-1, -1), 0)
    sums = [value.get((-1, j), 0) for j in range(length)]
    matrix = [[0] * length for _ in range(length)]
    for i in range(length):
        for j in range(i, length):
            matrix[i][j] = matrix[j][i] = n * value.get((i, j), 0) - sums[i] * sums[j]
    return n, [s + n * SHIFT for s in sums], matrix


def _is_prime(n: int) -> bool:
    """Miller-Rabin, certain for n below 3,215,031,751 with these bases."""
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """31-bit primes, largest first, whose product exceeds ``bound``."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_mod(matrix: list[list[int]], prime: int) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo a 31-bit prime, lowest first, by reduction to Hessenberg form."""
    d, p = len(matrix), np.int64(prime)
    h = np.array([[v % prime for v in row] for row in matrix], dtype=np.int64)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factor = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, prime) % p
        h[k + 1 :] = (h[k + 1 :] - factor[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factor % p).sum(axis=1)) % p
    # The polynomials of the leading blocks, each from all before it.
    poly = np.zeros((d + 1, d + 1), dtype=np.int64)
    poly[0, 0] = 1
    for k in range(1, d + 1):
        poly[k, 1:] = poly[k - 1, :-1]
        poly[k] = (poly[k] - h[k - 1, k - 1] * poly[k - 1] % p) % p
        weight, chain = np.zeros(k, dtype=np.int64), 1
        for i in range(k - 1, 0, -1):
            chain = chain * int(h[i, i - 1]) % prime
            if not chain:
                break
            weight[i - 1] = int(h[i - 1, k - 1]) * chain % prime
        poly[k] = (poly[k] - (weight[:, None] * poly[:k] % p).sum(axis=0)) % p
    return poly[d]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x - matrix), lowest first, for a symmetric matrix without negative eigenvalues.

    The k-th elementary symmetric function of the eigenvalues is at most that of their mean, which bounds all coefficients.
    """
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    bound = max(math.comb(d, k) * (trace**k // d**k + 1) for k in range(d + 1))
    primes = primes_beyond(2 * bound + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = batch.column(0).to_pylist()
            rows = [polynomial_mod(matrix, p).tolist() for p in chosen]
            yield pa.RecordBatch.from_arrays([pa.array(chosen, pa.int64()), pa.array(rows, pa.list_(pa.int64()))], ["prime", "poly"])

    tasks = min(len(primes), 64)
    spread = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(tasks)
    residues = {r["prime"]: r["poly"] for r in spread.mapInArrow(run, "prime long, poly array<long>").collect()}
    total, modulus = [0] * (d + 1), 1
    for p in primes:
        inverse = pow(modulus, -1, p)
        total = [t + modulus * ((r - t) * inverse % p) for t, r in zip(total, residues[p], strict=True)]
        modulus *= p
    return [t - modulus if 2 * t > modulus else t for t in total]


def roots_above(poly: list[int], point: int) -> int:
    """How many roots of a polynomial with real roots only lie above ``point``, by Descartes' rule, exact for such."""
    shifted = list(poly)
    for i in range(len(shifted) - 1):
        for j in range(len(shifted) - 2, i - 1, -1):
            shifted[j] += point * shifted[j + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs[:-1], signs[1:], strict=True))


def _value(poly: list[int], point: int) -> int:
    total = 0
    for c in reversed(poly):
        total = total * point + c
    return total


def largest_roots(poly: list[int], count: int, bits: int = ROOT_BITS) -> list[Fraction]:
    """The ``count`` largest of the roots, multiple ones repeated, all real and positive, to ``bits`` significant bits."""
    found: list[Fraction] = []
    bound = 1 + max(-poly[-2], 0)
    for place in range(1, count + 1):
        if found and roots_above(_scaled(poly, last_scale), last_low) >= place:
            # Not told apart from the one before at that many bits.
            found.append(found[-1])
            continue
        scale, low, high = 0, 0, bound
        scaled, single = poly, False
        while high - low > 1 or low.bit_length() <= bits:
            if high - low == 1:
                scale, low, high = scale + 32, low << 32, high << 32
                scaled = _scaled(poly, scale)
            middle = (low + high) // 2
            if single:
                above = (_value(scaled, middle) > 0) != sign_above
                at_least = above
            else:
                at_least = roots_above(scaled, middle) >= place
            low, high = (middle, high) if at_least else (low, middle)
            if not single and roots_above(scaled, high) == place - 1 and roots_above(scaled, low) == place:
                end = _value(scaled, high)
                single, sign_above = end != 0, end > 0
        found.append(Fraction(2 * low + 1, 2 << scale))
        last_scale, last_low = scale, low
    return found


def _scaled(poly: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2**bits times those of ``poly``, times a power of two."""
    degree = len(poly) - 1
    return [c << (bits * (degree - k)) for k, c in enumerate(poly)]


def null_vectors(matrix: list[list[int]], roots: list[Fraction], digits: int = DIGITS) -> list[list[float]]:
    """Unit eigenvectors of the roots, largest first, by inverse iteration with ``digits`` decimal digits."""
    d = len(matrix)
    done: list[tuple[Fraction, np.ndarray]] = []
    with decimal.localcontext() as context:
        context.prec = digits
        exact = np.array([[decimal.Decimal(v) for v in row] for row in matrix], dtype=object)
        tiny = max(abs(v) for v in exact.ravel()) * decimal.Decimal(10) ** -digits
        for place, root in enumerate(roots):
            shift = decimal.Decimal(root.numerator) / decimal.Decimal(root.denominator)
            lower, order = exact.copy(), list(range(d))
            for i in range(d):
                lower[i, i] -= shift
            for k in range(d):
                pivot = max(range(k, d), key=lambda r: abs(lower[r, k]))
                lower[[k, pivot]] = lower[[pivot, k]]
                order[k], order[pivot] = order[pivot], order[k]
                if abs(lower[k, k]) < tiny:
                    lower[k, k] = tiny
                if k + 1 < d:
                    lower[k + 1 :, k] = lower[k + 1 :, k] / lower[k, k]
                    lower[k + 1 :, k + 1 :] -= np.outer(lower[k + 1 :, k], lower[k, k + 1 :])
            same = [v for r, v in done if r == root]
            # Start vectors differ, so that those of one root span its space.
            vector = np.array([decimal.Decimal(1 + (7 * i + 3 * i * i + 11 * place) % 13) for i in range(d)], dtype=object)
            for _ in range(3):
                y = vector[order]
                for k in range(1, d):
                    y[k] -= np.dot(lower[k, :k], y[:k])
                for k in range(d - 1, -1, -1):
                    y[k] = (y[k] - (np.dot(lower[k, k + 1 :], y[k + 1 :]) if k + 1 < d else 0)) / lower[k, k]
                for _ in range(2):
                    y = y / np.dot(y, y).sqrt()
                    for other in same:
                        y = y - other * np.dot(other, y)
                vector = y / np.dot(y, y).sqrt()
            largest = max(range(d), key=lambda i: (abs(vector[i]), -i))
            done.append((root, vector if vector[largest] > 0 else -vector))
    return [[float(v) for v in vector] for _, vector in done]


@dataclass(frozen=True)
class Whitening:
    """n and the sums of the fit list; the components, their eigenvalues of the covariance and shares of its trace."""

    length: int
    n: int
    sums: tuple[int, ...]
    vectors: tuple[tuple[float, ...], ...]
    values: tuple[float, ...]
    explained: tuple[float, ...]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of all usable rows of ``vectors`` (vec_id, embedding)."""
    whole = integer_vectors(vectors)
    common = whole.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if common is None:
        return Whitening(0, 0, (), (), (), ())
    length = common["length"]
    n, sums, matrix = scatter(whole.where(F.size("x") == length), length)
    trace = sum(matrix[i][i] for i in range(length))
    divisor = math.gcd(*(v for row in matrix for v in row))
    if not trace:
        return Whitening(length, n, tuple(sums), (), (), ())
    reduced = [[v // divisor for v in row] for row in matrix]
    poly = characteristic_polynomial(vectors.sparkSession, reduced)
    rank = length - next(i for i, c in enumerate(poly) if c)
    roots = largest_roots(poly[length - rank :], min(components, rank))
    axes = null_vectors(reduced, roots)
    values = tuple(float(r * divisor / (n * n)) for r in roots)
    return Whitening(length, n, tuple(sums), tuple(map(tuple, axes)), values, tuple(float(r * divisor / trace) for r in roots))


def _projected(model: Whitening):
    axes = np.array(model.vectors, dtype=float).T / np.sqrt(np.array(model.values))
    sums = np.array(model.sums, dtype=object)
    k = axes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), model.length)
            reach = model.n * int(np.abs(x).max()) + max(map(abs, model.sums))
            if reach < 1 << 62:
                apart = x * np.int64(model.n) - sums.astype(np.int64)
            else:
                apart = x.astype(object) * model.n - sums
            widest = int(np.abs(apart).max())
            if widest * widest * model.length < 1 << 63:
                squares = pa.array((apart * apart).sum(axis=1).astype(np.int64))
            else:
                exact = [sum(int(v) * int(v) for v in row) for row in apart]
                squares = pa.array([s if s < 1 << 63 else None for s in exact], pa.int64())
            white = (apart.astype(float) / float(model.n)) @ axes
            edge = np.arange(len(white) + 1, dtype=np.int32) * k
            lists = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), squares, lists], ["vec_id", "deviation", "whitened"])

    return run


def apply_whitening(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and the whitened vector, an array of doubles, of every usable row; none without components."""
    whole = integer_vectors(vectors).where(F.size("x") == model.length)
    made = whole.select("vec_id").schema.add("deviation", "long").add("whitened", T.ArrayType(T.DoubleType()))
    if not model.vectors:
        return vectors.sparkSession.createDataFrame([], made)
    return whole.mapInArrow(_projected(model), made)


def identity_error(whitened: DataFrame, components: int) -> float:
    """How far the covariance of the whitened rows, centred before multiplying, is from the identity at most."""
    parts: list[Column] = [F.get("whitened", F.lit(i)) for i in range(components)]
    means = whitened.agg(*(F.avg(p) for p in parts)).first()
    if means[0] is None:
        return 0.0
    centred = [p - F.lit(m) for p, m in zip(parts, means, strict=True)]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    found = whitened.agg(*(F.avg(centred[i] * centred[j]) for i, j in pairs)).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs, strict=True))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each usable row of ``vectors`` and component: the whitened coordinate and what the fit is worth."""
    model = fit(vectors, components)
    spark, k = vectors.sparkSession, len(model.vectors)
    rows = apply_whitening(vectors, model)
    if k:
        rows = materialise(rows, "whitened")
    error = identity_error(rows, k) if k else 0.0
    shares = F.array(*map(F.lit, model.explained)) if k else F.array().cast("array<double>")
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
