"""Whitening from an exact characteristic polynomial.

Vectors are rounded to integers, so their scatter is an exact integer matrix,
summed over all tasks. Its characteristic polynomial is found modulo many primes,
one Hessenberg reduction each, and put together by Chinese remaindering. All
its roots are real, so signs of the shifted polynomial count the roots above a
point exactly, and bisection isolates each to as many bits as wanted. The null
space of the scatter less a root, by inverse iteration in long decimals, is a component.
Only sums of the size of the matrix are on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm.scratch import store

SCALE, COMPONENTS = 256, 4
# Bits of a limb and rows multiplied at once: products of two limbs sum exactly in a double.
LIMB, ROWS = 20, 4096
# Relative width, in bits, to which roots are isolated; nearer roots than EQUAL bits share a null space. Digits beyond the scatter's own.
ROOT_BITS, EQUAL_BITS, DIGITS = 96, 60, 60
STEPS = 3
LONGEST = (1 << 63) - 1


def rounded(vector: Column) -> Column:
    """Entries times SCALE, rounded down to longs (the nearest one, where none is near enough)."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def finite(vector: Column) -> Column:
    every = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(every, F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """``x`` as doubles below 2 ** LIMB in size, lowest first; the highest carries the sign."""
    found = []
    while x.size and (int(x.max()) >= 1 << LIMB or int(x.min()) <= -(1 << LIMB)):
        found.append((x & ((1 << LIMB) - 1)).astype(np.float64))
        x = x >> LIMB
    return [*found, x.astype(np.float64)]


def scatter_of(x: np.ndarray) -> np.ndarray:
    """Exact sums of products of all pairs of columns, as Python integers."""
    total = np.zeros((x.shape[1],) * 2, object)
    for at in range(0, len(x), ROWS):
        parts = limbs(x[at : at + ROWS])
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                exact = (a.T @ b).astype(np.int64).astype(object)
                total = total + exact * (1 << LIMB * (i + j))
    return total


def sums(fit: DataFrame, dim: int) -> np.ndarray:
    """Scatter of ``x`` with a column of ones beside it: products, sums, and the number of rows."""
    piece = 1 << 80  # sums of three pieces each fit a decimal, however many tasks there are

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1), object)
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            total = total + scatter_of(np.hstack([x, np.ones((len(x), 1), np.int64)]))
        places = [(i, j) for i in range(dim + 1) for j in range(i, dim + 1)]
        values = [int(total[p]) for p in places]
        pieces = [[v % piece for v in values], [v // piece % piece for v in values], [v // piece // piece for v in values]]
        columns = [pa.array([p[k] for p in places], pa.int32()) for k in (0, 1)]
        columns += [pa.array(map(Decimal, p), pa.decimal128(38, 0)) for p in pieces]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "v0", "v1", "v2"])

    parts = fit.select("x").mapInArrow(run, "i int, j int, v0 decimal(38,0), v1 decimal(38,0), v2 decimal(38,0)")
    found = np.zeros((dim + 1, dim + 1), object)
    for row in parts.groupBy("i", "j").agg(*[F.sum(v).alias(v) for v in ("v0", "v1", "v2")]).collect():  # one per pair of dimensions
        found[row.i, row.j] = found[row.j, row.i] = int(row.v0) + int(row.v1) * piece + int(row.v2) * piece * piece
    return found


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every number below 2 ** 32."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(size: int) -> list[int]:
    """The largest primes below 2 ** 31, as many as make a product above ``size``."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= size:
        if is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of the characteristic polynomial modulo ``p``, lowest first, by way of a Hessenberg form."""
    h = (matrix % p).astype(np.int64)
    d = len(h)
    for m in range(1, d - 1):
        rows = np.flatnonzero(h[m:, m - 1])
        if not len(rows):
            continue
        pivot = m + int(rows[0])
        if pivot != m:
            h[[m, pivot]] = h[[pivot, m]]
            h[:, [m, pivot]] = h[:, [pivot, m]]
        times = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - times[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * times % p).sum(axis=1)) % p
    # The polynomial of each leading block from those of the smaller ones.
    blocks = np.zeros((d + 1, d + 1), np.int64)
    blocks[0, 0] = 1
    for k in range(1, d + 1):
        factors, below = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            factors[i] = int(h[i, k - 1]) * below % p
            below = below * int(h[i, i - 1]) % p if i else 0
        blocks[k, 1:] = blocks[k - 1, :-1]
        blocks[k] = (blocks[k] - (factors[:, None] * blocks[:k] % p).sum(axis=0)) % p
    return blocks[d]


def polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """The exact characteristic polynomial of a symmetric matrix without negative eigenvalues, lowest coefficient first."""
    d, trace = len(matrix), int(np.trace(matrix))
    # Coefficients are sums of products of eigenvalues, which are largest when all are alike.
    primes = primes_beyond(2 * (2 + trace // d) ** d)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [polynomial_mod(matrix, p).tolist() for p in frame["p"].tolist()]
            yield pd.DataFrame({"p": frame["p"], "coefficients": found})

    table = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), spark.sparkContext.defaultParallelism))
    total, product = [0] * (d + 1), math.prod(primes)
    for row in table.mapInPandas(run, "p long, coefficients array<long>").collect():  # one per prime
        others = product // row.p
        weight = others * pow(others, -1, row.p)
        total = [t + c * weight for t, c in zip(total, row.coefficients)]
    total = [t % product for t in total]
    return [t - product if t > product // 2 else t for t in total]


def roots_above(coefficients: list[int], at: int, bits: int) -> int:
    """Roots above ``at / 2 ** bits``, each as often as it counts, of a polynomial with real roots only.

    Descartes' rule is exact then: they are the changes of sign after a shift to that point.
    """
    d = len(coefficients) - 1
    shifted = [c << bits * (d - k) for k, c in enumerate(coefficients)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            shifted[k] += at * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def isolate(coefficients: list[int], k: int, bound: int) -> Fraction:
    """The k-th largest root, which is above 0 and at most ``bound``, to ROOT_BITS bits."""
    low, high, bits = 0, bound, 0
    while True:
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if roots_above(coefficients, middle, bits) >= k else (low, middle)
        if low and low >> ROOT_BITS:
            return Fraction(2 * low + 1, 1 << (bits + 1))
        low, high, bits = 2 * low, 2 * high, bits + 1


def null_space(matrix: np.ndarray, root: Fraction, n: int) -> list[list[float]]:
    """``n`` orthonormal vectors that ``matrix`` takes to ``root`` times themselves, each with its largest entry positive."""
    d = len(matrix)
    with localcontext() as context:
        context.prec = DIGITS + len(str(max(abs(int(v)) for v in matrix.flat)))
        value = Decimal(root.numerator) / Decimal(root.denominator)
        rows = np.array([[Decimal(int(v)) for v in row] for row in matrix], object)
        rows[np.diag_indices(d)] -= value
        tiny, order = abs(value) * Decimal(10) ** -context.prec, list(range(d))
        for k in range(d):
            pivot = max(range(k, d), key=lambda i: abs(rows[i, k]))
            rows[[k, pivot]] = rows[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
            rows[k, k] = rows[k, k] or tiny  # the root itself, or a part that it leaves alone
            rows[k + 1 :, k] = rows[k + 1 :, k] / rows[k, k]
            rows[k + 1 :, k + 1 :] = rows[k + 1 :, k + 1 :] - np.outer(rows[k + 1 :, k], rows[k, k + 1 :])

        def length_one(v: np.ndarray) -> np.ndarray:
            v = v / max(abs(x) for x in v)
            return v / (v * v).sum().sqrt()

        found: list[np.ndarray] = []
        for number in range(n):
            v = np.array([Decimal(1 + (i + 1) * (2 * number + 3) * 7919 % 1009) for i in range(d)], object)
            for _ in range(STEPS):
                v = v[order]
                for k in range(1, d):
                    v[k] -= (rows[k, :k] * v[:k]).sum()
                for k in range(d - 1, -1, -1):
                    v[k] = (v[k] - (rows[k, k + 1 :] * v[k + 1 :]).sum()) / rows[k, k]
                v = length_one(v)
                for other in found * 2:
                    v = v - (v * other).sum() * other
                v = length_one(v)
            found.append(v if v[max(range(d), key=lambda i: abs(v[i]))] > 0 else -v)
    return [[float(x) for x in v] for v in found]


def components(spark: SparkSession, matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[list[Fraction], list[list[float]]]:
    """The largest eigenvalues above 0 of a symmetric integer matrix without negative ones, falling, and a unit eigenvector of each."""
    trace = int(np.trace(matrix)) if len(matrix) else 0
    if trace == 0:
        return [], []
    coefficients = polynomial(spark, matrix)
    zeros = next(k for k, c in enumerate(coefficients) if c)
    coefficients = coefficients[zeros:]
    number = min(wanted, len(coefficients) - 1)

    def roots(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [isolate(coefficients, k, trace + 1) for k in frame["k"].tolist()]
            yield pd.DataFrame({"k": frame["k"], "over": [str(f.numerator) for f in found], "under": [str(f.denominator) for f in found]})

    asked = spark.range(1, number + 1, numPartitions=number).select(F.col("id").alias("k"))
    rows = sorted(asked.mapInPandas(roots, "k long, over string, under string").collect())
    values = [Fraction(int(r.over), int(r.under)) for r in rows]
    # Roots that are as good as equal share a null space.
    first = [k for k in range(number) if not k or (values[k - 1] - values[k]) * (1 << EQUAL_BITS) > values[k]]
    spans = [(k, end - k) for k, end in zip(first, [*first[1:], number])]

    def spaces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k, n in zip(frame["k"].tolist(), frame["n"].tolist()):
                vectors = null_space(matrix, values[k], n)
                yield pd.DataFrame({"k": range(k, k + n), "vector": vectors})

    table = spark.createDataFrame(spans, "k long, n long").repartition(len(spans))
    vectors = sorted(table.mapInPandas(spaces, "k long, vector array<double>").collect())
    return values, [list(r.vector) for r in vectors]


def _moved(x: np.ndarray, n: int, total: np.ndarray) -> tuple[np.ndarray, list]:
    """``n * x - total`` as doubles, and the sums of squares over its rows; None where a sum is no long."""
    most = n * max(abs(int(x.max())), abs(int(x.min()))) + max(abs(int(t)) for t in total) if x.size else 0
    if most * most * x.shape[1] <= LONGEST:
        exact = n * x - total.astype(np.int64)
        return exact.astype(np.float64), (exact * exact).sum(axis=1).tolist()
    exact = n * x.astype(object) - total
    squares = (exact * exact).sum(axis=1)
    return exact.astype(np.float64), [int(s) if s <= LONGEST else None for s in squares]


def identity_error(fit: DataFrame, dim: int, n: int, total: np.ndarray, weights: np.ndarray) -> float:
    """Largest entry of the whitened fit list's covariance less the identity, centred before it is multiplied.

    Each task centres on its own mean; the rest is added from the means.
    """
    k = weights.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if len(batch):
                white = _moved(_matrix(batch.column(0), dim), n, total)[0] @ weights
                own, more = white.mean(axis=0), len(white)
                apart = own - mean
                products += (white - own).T @ (white - own) + np.outer(apart, apart) * (rows * more / (rows + more))
                mean += apart * (more / (rows + more))
                rows += more
        columns = [pa.array([rows], pa.int64()), pa.array([mean.tolist()]), pa.array([products.ravel().tolist()])]
        yield pa.RecordBatch.from_arrays(columns, ["rows", "mean", "products"])

    parts = store(fit.select("x").mapInArrow(run, "rows long, mean array<double>, products array<double>"), "moments")
    means = parts.agg(*[(F.sum(F.col("rows") * F.col("mean")[i]) / F.sum("rows")).alias(f"m{i}") for i in range(k)]).first()
    apart = [F.col("mean")[i] - F.lit(means[i]) for i in range(k)]
    entries = [F.sum(F.col("products")[i * k + j] + F.col("rows") * apart[i] * apart[j]) / F.sum("rows") for i in range(k) for j in range(k)]
    found = np.array(parts.agg(*[e.alias(f"c{i}") for i, e in enumerate(entries)]).first(), np.float64).reshape(k, k)
    return float(np.abs(found - np.eye(k)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is null or holds null or non-finite entries are left out. The components are fitted on the distinct rounded
    vectors of the commonest length (the longest of these); vectors of another length have no place among them and get
    null ``deviation`` and ``whitened``. Rows that repeat, and rows with a null id, each get results. Components belong to eigenvalues
    above 0, so there are fewer than ``wanted`` where vectors vary in fewer directions, and no rows at all for one distinct vector,
    vectors without entries or an empty table. Equal eigenvalues have any orthonormal components of their space. A ``deviation`` beyond a long is null.
    """
    spark = vectors.sparkSession
    good = vectors.where(finite(F.col(vector_col))).select(F.col(id_col).alias("vec_id"), rounded(F.col(vector_col)).alias("x"))
    fit = store(good.select("x").distinct(), "fit-list")
    lengths = fit.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n"))
    top = lengths.orderBy(F.col("n").desc(), F.col("dim").desc()).first()
    dim = top["dim"] if top else 0
    fit = fit.where(F.size("x") == dim)
    found = sums(fit, dim) if dim else np.zeros((1, 1), object)
    n, total = int(found[dim, dim]), found[dim, :dim]
    centred = n * found[:dim, :dim] - np.outer(total, total)  # the covariance times n * n
    values, axes = components(spark, centred, wanted)
    weights = np.array([np.array(a) / math.sqrt(v) for v, a in zip(values, axes)], np.float64).reshape(len(values), dim).T
    error = identity_error(fit, dim, n, total, weights) if values else 0.0
    trace = int(np.trace(centred))
    if not values:
        good = good.where(F.lit(False))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            moved, squares = _moved(x, n, total)
            white = pa.array((moved @ weights).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(squares, pa.int64()), white], ["vec_id", "deviation", "white"])

    kind = good.schema["vec_id"].dataType.simpleString()
    placed = good.where(F.size("x") == dim).mapInArrow(place, f"vec_id {kind}, deviation long, white array<double>")
    nothing = F.array_repeat(F.lit(None).cast("double"), len(values))
    others = good.where(F.size("x") != dim).select("vec_id", F.lit(None).cast("long").alias("deviation"), nothing.alias("white"))
    each = placed.union(others).select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(v / trace)) for v in values]).cast("array<double>")
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
