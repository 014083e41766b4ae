"""Whitening of embeddings by principal components whose eigenvalues come from an exact characteristic polynomial.

Vectors are put on an integer grid, so sums and products over all of them are exact whole numbers, added up in any
order. The characteristic polynomial of the integer scatter matrix is computed modulo many primes, a prime per row of a
Spark job, by reduction to Hessenberg form, and put together by Chinese remaindering. All its roots are real, so signs of its
coefficients after a shift count the roots above a point without error; bisection isolates the largest ones. The components
follow by inverse iteration on the null space of scatter minus root, in decimal arithmetic.

The driver holds sums of the size of the matrix, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction
from math import comb, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bound_batches, written

SCALE, COMPONENTS = 256, 4
# Binary places to which roots are found, and decimal digits of the inverse iteration.
PLACES, DIGITS = 240, 160
# Whole numbers up to here are exact as doubles.
EXACT = 1 << 53
LONGEST = (1 << 63) - 1
# Sums are split in two parts, so that a part has fewer than 38 digits however many tasks add to it.
PART = 1 << 100


def on_grid(vectors: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """key, x: floor(scale * entry) of each vector without null or non-finite entries; null and empty ones are left out."""
    entries = F.transform(F.col(vector), lambda c: c.cast("double"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = vectors.select(F.col(key).alias("key"), entries.alias("x")).where(F.col("x").isNotNull() & (F.size("x") > 0) & finite)
    return usable.select("key", F.transform("x", lambda c: F.floor(F.lit(float(scale)) * c)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy()
    return values.reshape(len(column), -1)


def _products(x: np.ndarray) -> np.ndarray:
    """Transpose of x times x in whole numbers: by doubles as long as they are exact."""
    largest = max(int(x.max()), -int(x.min()), 1)
    rows = EXACT // largest**2
    if rows == 0:
        x = x.astype(object)
        return x.T @ x
    total = np.zeros((x.shape[1],) * 2, object)
    for at in range(0, len(x), rows):
        part = x[at : at + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


_SUMS = "i int, j int, low decimal(38,0), high decimal(38,0)"


def moments(fit: DataFrame, size: int) -> tuple[list[int], list[list[int]]]:
    """Sums of the entries of ``x`` and of their products, exact: each task adds up its own, then a row per entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(size, object), np.zeros((size, size), object)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                sums += x.astype(object).sum(axis=0)
                products += _products(x)
        at = [(i, j) for i in range(size) for j in range(i, size)]
        values = [int(products[i, j]) for i, j in at] + [int(s) for s in sums]
        at += [(i, -1) for i in range(size)]
        parts = [[Decimal(p) for p in column] for column in zip(*((v % PART, v // PART) for v in values), strict=True)]
        columns = [pa.array([i for i, _ in at], pa.int32()), pa.array([j for _, j in at], pa.int32())]
        yield pa.RecordBatch.from_arrays([*columns, *[pa.array(p, pa.decimal128(38, 0)) for p in parts]], ["i", "j", "low", "high"])

    added = fit.select("x").mapInArrow(run, _SUMS).groupBy("i", "j").agg(F.sum("low").alias("low"), F.sum("high").alias("high"))
    sums, products = [0] * size, [[0] * size for _ in range(size)]
    for r in added.collect():
        value = int(r["low"]) + int(r["high"]) * PART
        if r["j"] < 0:
            sums[r["i"]] = value
        else:
            products[r["i"]][r["j"]] = products[r["j"]][r["i"]] = value
    return sums, products


# Characteristic polynomial ----------------------------------------------------------------------------------


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide for all numbers below 3.4e14."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7, 11, 13, 17)):
        return n in (2, 3, 5, 7, 11, 13, 17)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    return all(
        (x := pow(a, odd, n)) in (1, n - 1) or any((x := x * x % n) == n - 1 for _ in range(twos - 1)) for a in (2, 3, 5, 7, 11, 13, 17)
    )


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below 2**31, as many as their product needs to exceed the bound."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(tI - matrix) modulo a prime below 2**31, lowest power first, through Hessenberg form."""
    h, size = matrix.copy(), len(matrix)
    for k in range(size - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot, top = k + 1 + below[0], k + 1
        if pivot != top:
            h[[pivot, top]] = h[[top, pivot]]
            h[:, [pivot, top]] = h[:, [top, pivot]]
        factor = h[top + 1 :, k] * pow(int(h[top, k]), -1, p) % p
        # rows lose their multiple of the pivot row, the pivot column gains the same multiples of the others
        h[top + 1 :] = (h[top + 1 :] - factor[:, None] * h[top]) % p
        h[:, top] = (h[:, top] + (h[:, top + 1 :] * factor % p).sum(axis=1)) % p
    polys = np.zeros((size + 1, size + 1), np.int64)
    polys[0, 0] = 1
    for k in range(size):
        # weights of the earlier polynomials: entries of the column times the subdiagonal between
        weights, run = np.zeros(k + 1, np.int64), 1
        for i in range(k, -1, -1):
            weights[i] = h[i, k] * run % p
            run = run * int(h[i, i - 1]) % p if i else run
        polys[k + 1, 1:] = polys[k, :-1]
        polys[k + 1] = (polys[k + 1] - (weights[:, None] * polys[: k + 1] % p).sum(axis=0)) % p
    return polys[size]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(tI - matrix), lowest power first, of a positive semidefinite matrix of whole numbers.

    Its eigenvalues have a mean of trace / size, which bounds their elementary symmetric functions and so the number
    of primes needed.
    """
    size, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    bound = max(comb(size, k) * (-(-trace // size)) ** k for k in range(size + 1))
    primes = primes_beyond(2 * bound + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                rest = np.array([[v % p for v in row] for row in matrix], np.int64)
                found = polynomial_modulo(rest, p)
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([found.tolist()], pa.list_(pa.int64()))], ["p", "rest"])

    tasks = max(1, min(len(primes) // 4, spark.sparkContext.defaultParallelism))
    rows = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(tasks)
    rests = {r["p"]: r["rest"] for r in rows.mapInArrow(run, "p bigint, rest array<bigint>").collect()}
    product = prod(primes)
    shares = {p: product // p * pow(product // p, -1, p) for p in primes}
    found = [sum(shares[p] * rests[p][k] for p in primes) % product for k in range(size + 1)]
    return [c - product if 2 * c > product else c for c in found]


# Roots ------------------------------------------------------------------------------------------------------


def _variations(coefficients: list[int]) -> int:
    signs = [c > 0 for c in coefficients if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def roots_above(polynomial: list[int], at: int, places: int) -> int:
    """How many roots lie above at / 2**places, each as often as its multiplicity; all roots must be real.

    By Descartes' rule the sign changes of the shifted polynomial are an upper bound, which is reached if all roots
    are real.
    """
    size = len(polynomial) - 1
    shifted = [c << places * (size - k) for k, c in enumerate(polynomial)]
    for low in range(size):
        for k in range(size - 1, low - 1, -1):
            shifted[k] += at * shifted[k + 1]
    return _variations(shifted)


def _sign(polynomial: list[int], at: int, places: int) -> int:
    value, scale = 0, 1
    for c in reversed(polynomial):
        value = value * at + c * scale
        scale <<= places
    return (value > 0) - (value < 0)


def largest_roots(polynomial: list[int], number: int, places: int = PLACES) -> list[tuple[Fraction, int]]:
    """The largest positive roots of a polynomial that has no other roots than real ones from 0 on, falling, each with its multiplicity, until
    these come to ``number``. Roots are rounded to a multiple of 2**-places."""
    found: list[tuple[Fraction, int]] = []
    wanted = min(number, roots_above(polynomial, 0, 0))
    # no root is larger than the sum of all
    top = max(1, -polynomial[-2]) if len(polynomial) > 1 else 1
    done = 0
    while done < wanted:
        low, high, scale = 0, top, 0
        below = roots_above(polynomial, low, scale)
        above = 0
        # the interval (low, high] / 2**scale holds the next root; below and above: roots beyond its ends
        while scale < places or high - low > 1:
            if high - low == 1:
                low, high, scale = 2 * low, 2 * high, scale + 1
            middle = (low + high) // 2
            if below - above == 1 and (side := _sign(polynomial, high, scale)):
                # one simple root: the sign tells its side; at the root itself it belongs to the lower part
                is_above = _sign(polynomial, middle, scale) not in (side, 0)
                n = below if is_above else above
            else:
                n = roots_above(polynomial, middle, scale)
            if n > done:
                low, below = middle, n
            else:
                high, above = middle, n
        found.append((Fraction(low + high, 2 << scale), below - done))
        done = below
    return found


# Components -------------------------------------------------------------------------------------------------


def null_space(matrix: list[list[int]], root: Fraction, multiplicity: int, digits: int = DIGITS) -> list[np.ndarray]:
    """Orthonormal vectors that matrix maps to root times themselves, by inverse iteration in decimals."""
    size = len(matrix)
    with localcontext() as context:
        context.prec = digits
        value = Decimal(root.numerator) / Decimal(root.denominator)
        a = np.array([[Decimal(v) for v in row] for row in matrix], object)
        a[np.diag_indices(size)] -= value
        tiny = max(abs(value), Decimal(1)) * Decimal(10) ** (-digits // 2)
        order = np.arange(size)
        for k in range(size):
            pivot = k + int(np.argmax(np.abs(a[k:, k])))
            a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k], a[k, k + 1 :])
        start = np.random.default_rng(7).integers(1, 1000, (multiplicity, size))
        vectors = [np.array([Decimal(int(v)) for v in row], object) for row in start]
        for _ in range(3):
            solved: list[np.ndarray] = []
            for vector in vectors:
                y = vector[order]
                for k in range(size):
                    y[k + 1 :] -= a[k + 1 :, k] * y[k]
                for k in range(size - 1, -1, -1):
                    y[k] = y[k] / a[k, k]
                    y[:k] -= a[:k, k] * y[k]
                for _ in range(2):
                    y = y / (y @ y).sqrt()
                    for other in solved:
                        y = y - (y @ other) * other
                solved.append(y / (y @ y).sqrt())
            vectors = solved
        return [np.array([float(v) for v in vector]) for vector in vectors]


@dataclass(frozen=True)
class Whitening:
    """n fitted vectors with their sums; per component its unit vector, its variance and its share of all variance."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray


def solve(spark: SparkSession, n: int, sums: list[int], products: list[list[int]], components: int = COMPONENTS) -> Whitening:
    """Components from exact sums; those without variance are left out."""
    size = len(sums)
    scatter = [[n * products[i][j] - sums[i] * sums[j] for j in range(size)] for i in range(size)]
    trace = sum(scatter[i][i] for i in range(size))
    vectors, roots = [], []
    if trace:
        polynomial = characteristic_polynomial(spark, scatter)
        if polynomial[-1] != 1 or polynomial[-2] != -trace:
            raise ArithmeticError("the characteristic polynomial does not fit the trace")
        for root, times in largest_roots(polynomial, components):
            vectors += null_space(scatter, root, times)
            roots += [root] * times
    vectors, roots = vectors[:components], roots[:components]
    vectors = [v * np.sign(v[np.argmax(np.abs(v))]) for v in vectors]
    matrix = np.array(vectors).T if vectors else np.zeros((size, 0))
    return Whitening(n, sums, matrix, np.array([float(r / n**2) for r in roots]), np.array([float(r / trace) for r in roots]))


def _project(x: np.ndarray, fit: Whitening) -> tuple[np.ndarray, list[int | None]]:
    """Whitened coordinates, and the exact sum of squares of n * x - sums (null where it doesn't fit a long)."""
    bound = fit.n * (max(int(x.max()), -int(x.min()), 0) + 1) + max(map(abs, fit.sums))
    if x.shape[1] * bound**2 <= LONGEST:
        centred = fit.n * x - np.array(fit.sums, np.int64)
        deviation = (centred * centred).sum(axis=1).tolist()
    else:
        centred = fit.n * x.astype(object) - np.array(fit.sums, object)
        deviation = [int(v) if v <= LONGEST else None for v in (centred * centred).sum(axis=1)]
    return centred.astype(np.float64) @ fit.components / (fit.n * np.sqrt(fit.variances)), deviation


def fit_list(grid: DataFrame) -> DataFrame:
    """Each distinct vector of the grid once, of those of its most frequent length (the longer one of equals): written."""
    lengths = grid.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    size = lengths.agg(F.max_by("size", F.struct("n", "size"))).first()[0]
    return written(grid.where(F.size("x") == F.lit(size or 0)).select("x").distinct(), "fit-list")


def fit(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening fitted to each distinct vector once; None where no vector can be used."""
    return _fitted(fit_list(on_grid(vectors, key, vector)), components)


def _fitted(rows: DataFrame, components: int) -> Whitening | None:
    first = rows.first()
    if first is None:
        return None
    sums, products = moments(rows, len(first["x"]))
    return solve(rows.sparkSession, rows.count(), sums, products, components)


def whiten(grid: DataFrame, whitening: Whitening) -> DataFrame:
    """key, deviation, whitened (an array with an entry per component) for each row of a grid of the fitted length."""
    bound_batches(grid.sparkSession)
    size, shared = len(whitening.sums), grid.sparkSession.sparkContext.broadcast(whitening)
    schema = T.StructType([grid.schema["key"], *T.StructType.fromDDL("deviation bigint, whitened array<double>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found, deviation = _project(_matrix(batch.column(1)), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(deviation, pa.int64()), pa.array(list(found), pa.list_(pa.float64()))], schema.names
                )

    return grid.where(F.size("x") == size).select("key", "x").mapInArrow(run, schema)


def identity_error(rows: DataFrame, whitening: Whitening) -> float:
    """Largest entry by which the covariance of the whitened fit list differs from the identity."""
    n = len(whitening.variances)
    whitened = whiten(rows.select(F.lit(None).cast("long").alias("key"), "x"), whitening)
    at = [(i, j) for i in range(n) for j in range(i, n)]
    found = whitened.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}") for i, j in at]).first()
    return max(abs(found[k] - (i == j)) for k, (i, j) in enumerate(at))


def report(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error: a row per vector and component.

    Vectors that are null, empty or hold a null or non-finite entry are left out, as are those of another length
    than the most frequent one. Components without variance have no row: none for an empty table, for equal vectors or
    a single one; two distinct vectors have one component. Equal eigenvalues share their space, in which the choice of components
    is the same for all rows. Repeated rows and null keys give their own rows; other columns are not read.
    """
    spark = vectors.sparkSession
    grid = on_grid(vectors, key, vector)
    rows = fit_list(grid)
    found = _fitted(rows, components)
    schema = T.StructType(
        [
            T.StructField(key, vectors.schema[key].dataType),
            *T.StructType.fromDDL(
                "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
            ).fields,
        ]
    )
    if found is None or not len(found.variances):
        return spark.createDataFrame([], schema)
    shares = F.array(*[F.lit(float(e)) for e in found.explained])
    return whiten(grid, found).select(
        F.col("key"), "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        F.col("key").alias(key),
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(found.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(identity_error(rows, found)).alias("identity_error"),
    )
