"""Embedding whitening from an exact characteristic polynomial.

1. Every entry c becomes the whole number floor(``SCALE`` c).  Tasks sum vectors and
   products exactly; the scatter M = n * sum(x x') - S S' is an integer matrix, n * n
   times the covariance (``SHIFT``, which the contract adds to x, cancels).
2. The characteristic polynomial of M: for one 31-bit prime after the other, a
   task reduces M modulo the prime to Hessenberg form and reads the polynomial off
   it; Chinese remaindering joins the images.  Primes are taken until their product passes twice
   the sum of the coefficients, which is at most (1 + trace / d)**d.
3. All roots are real, so the sign changes of p(x + a) count the roots above a
   exactly, multiplicity included.  Bisection by that count isolates the roots, and
   bisection by the sign of p takes each to ``ROOT_BITS`` bits relative to its size.
4. A component spans the null space of M - root: one elimination in integers of
   some hundred digits and ``ROUNDS`` of inverse iteration, one task per root.  Roots
   that agree to ``ROOT_BITS`` bits are one root, whose vectors are made
   orthogonal.
5. A row's whitened values are the exact n x - S over n, projected and divided by
   the root's square root; the identity error is measured on these values.

The driver holds numbers of the dimension squared, never of the rows.

Defined cases: rows whose vector is null, or has null or non-finite entries or one
whose x is no long, are dropped, and so are those not of the commonest length
(the longer one in a tie; empty vectors count as null).  Null and repeated vec_id stay as they are.
Components of eigenvalue 0 have no whitened value and are left out, so one row
alone, or an empty table, gives no rows.  A deviation past 64 bits stops
the query instead of wrapping.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
ROOT_BITS = 160
#: Bits that elimination carries beyond the entries'.
GUARD = 96
ROUNDS = 3
#: Products below this are exact in doubles.
EXACT = 1 << 53
#: Sums travel in parts of so many bits.
LIMB, LIMBS = 40, 5

OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


class Whitening(NamedTuple):
    n: int
    sums: list[int]
    values: list[float]  # eigenvalues of the covariance, falling
    vectors: np.ndarray  # components by dimension
    explained: list[float]


# ---------------------------------------------------------------- sums

def valid(vectors: DataFrame) -> DataFrame:
    """vec_id, y (array of doubles, whole: floor(SCALE c)) of the rows that count."""
    c = F.col("embedding").cast("array<double>")
    fine = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float((1 << 62) // SCALE)))
    rows = vectors.where(F.col("embedding").isNotNull()).select("vec_id", c.alias("embedding")).where(fine & (F.size("embedding") > 0))
    common = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common["d"] if common else 0
    return rows.where(F.size("embedding") == d).select("vec_id", "embedding")


def _matrix(column: pa.Array) -> np.ndarray:
    """Whole doubles floor(SCALE c), one row a vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).reshape(len(column), -1)


def _gram(y: np.ndarray) -> np.ndarray:
    """y' y as Python integers, exact."""
    top = float(np.abs(y).max(initial=0))
    if top * top * len(y) < EXACT:
        return (y.T @ y).astype(np.int64).astype(object)
    step = max(8, (53 - len(y).bit_length()) // 2)
    if len(y) << 2 * step >= EXACT:
        return _gram(y[: len(y) // 2]) + _gram(y[len(y) // 2:])
    parts, rest, sign = [], np.abs(y.astype(np.int64)), np.sign(y)
    while rest.any():
        parts.append((rest & ((1 << step) - 1)) * sign)
        rest = rest >> step
    total = np.zeros((y.shape[1],) * 2, object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            total = total + (a.T @ b).astype(np.int64).astype(object) * (1 << step * (i + j))
    return total


def _limbs(v: int) -> list[int]:
    out = []
    for _ in range(LIMBS - 1):
        out.append(v & ((1 << LIMB) - 1))
        v >>= LIMB
    return [*out, v]


def _batches_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """i, j, limbs: sums of products (i <= j), of entries (j = -1) and of rows (i = j = -1)."""
    n, sums, products = 0, 0, 0
    for b in batches:
        if b.num_rows:
            y = _matrix(b.column("embedding"))
            ones = np.ones((len(y), 1))
            whole = _gram(np.hstack([y, ones]))
            n, sums, products = n + len(y), sums + whole[:-1, -1], products + whole[:-1, :-1]
    if n:
        d = len(sums)
        cells = [(-1, -1, n), *((i, -1, sums[i]) for i in range(d)), *((i, j, products[i, j]) for i in range(d) for j in range(i, d))]
        i, j, v = zip(*cells)
        limbs = zip(*map(_limbs, map(int, v)))
        yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(x, pa.int64()) for x in limbs)],
                              names=["i", "j", *(f"l{k}" for k in range(LIMBS))])


def sums_of(rows: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, scatter): whole numbers of all rows."""
    limbs = [f"l{k}" for k in range(LIMBS)]
    parts = rows.select("embedding").mapInArrow(_batches_sums, "i int, j int, " + ", ".join(f"{c} long" for c in limbs))
    cells = {(r["i"], r["j"]): sum(int(r[c]) << LIMB * k for k, c in enumerate(limbs))
             for r in parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in limbs]).collect()}  # d * d rows
    n = cells.get((-1, -1), 0)
    d = sum(j == -1 for _, j in cells) - (n > 0)
    sums = [cells[i, -1] for i in range(d)]
    return n, sums, [[n * cells[min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(d)] for i in range(d)]


# ---------------------------------------------------------------- polynomial

def _is_prime(p: int) -> bool:
    """Miller-Rabin with bases that decide all numbers below 3 * 10**9."""
    if any(p % q == 0 for q in (2, 3, 5, 7)):
        return False
    twos = ((p - 1) & (1 - p)).bit_length() - 1
    for base in (2, 3, 5, 7):
        x = pow(base, (p - 1) >> twos, p)
        if x not in (1, p - 1) and all((x := x * x % p) != p - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_past(bound: int) -> list[int]:
    """The largest 31-bit primes whose product passes ``bound``."""
    found, product, p = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(p):
            found.append(p)
            product *= p
        p -= 2
    return found


def polynomial_mod(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients modulo p of det(x - matrix), the constant first."""
    h = np.array([[v % p for v in row] for row in matrix], np.int64)
    d = len(h)
    for k in range(d - 2):  # similarity steps that clear column k below its subdiagonal
        below = np.flatnonzero(h[k + 1:, k])
        if len(below) == 0:
            continue
        at = k + 1 + int(below[0])
        if at != k + 1:
            h[[k + 1, at]] = h[[at, k + 1]]
            h[:, [k + 1, at]] = h[:, [at, k + 1]]
        times = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - times[:, None] * h[k + 1]) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * times % p).sum(axis=1)) % p
    poly = np.zeros((d + 1, d + 1), np.int64)  # row k: polynomial of the leading k by k block
    poly[0, 0] = 1
    for k in range(d):
        new = np.zeros(d + 1, np.int64)
        new[1:] = poly[k, :-1]
        chain, factors = 1, np.zeros(k + 1, np.int64)
        for i in range(k, -1, -1):
            factors[i] = h[i, k] * chain % p
            if i:
                chain = chain * int(h[i, i - 1]) % p
        poly[k + 1] = (new - (factors[:, None] * poly[: k + 1] % p).sum(axis=0)) % p
    return poly[d].tolist()


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x - matrix) of a positive semidefinite integer matrix, the constant first."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    primes = primes_past(2 * (((d + trace) ** d) // d ** d + 1))

    def images(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mine = b.column("p").to_pylist()
            yield pa.record_batch([pa.array(mine, pa.int64()), pa.array([polynomial_mod(matrix, p) for p in mine], pa.list_(pa.int64()))], names=["p", "c"])

    asked = spark.createDataFrame([(p,) for p in primes], "p long").repartition(max(1, min(len(primes), spark.sparkContext.defaultParallelism)))
    got = asked.mapInArrow(images, "p long, c array<long>").collect()  # d + 1 numbers a prime
    product = 1
    for p in primes:
        product *= p
    total = [0] * (d + 1)
    for r in got:
        rest = product // r["p"]
        unit = rest * pow(rest, -1, r["p"])
        total = [t + c * unit for t, c in zip(total, r["c"])]
    whole = [t % product for t in total]
    return [c - product if 2 * c > product else c for c in whole]


# ---------------------------------------------------------------- roots

def roots_above(poly: list[int], m: int, s: int) -> int:
    """How many roots of a real-rooted ``poly`` exceed m / 2**s: the sign changes of the shifted polynomial."""
    d = len(poly) - 1
    c = [v << s * (d - i) for i, v in enumerate(poly)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += m * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(poly: list[int], m: int, s: int) -> int:
    total, d = 0, len(poly) - 1
    for i in range(d, -1, -1):
        total = total * m + (poly[i] << s * (d - i))
    return (total > 0) - (total < 0)


def top_roots(poly: list[int], most: int, bits: int = ROOT_BITS) -> list[tuple[int, int, int]]:
    """(m, s, multiplicity) of the ``most`` largest positive roots m / 2**s, falling; poly
    has real roots only, none negative."""
    zero = next(i for i, v in enumerate(poly) if v)
    poly = poly[zero:]
    if len(poly) == 1:
        return []
    found, high = [], 1 << max(1, abs(poly[-2])).bit_length()  # the sum of the roots
    todo = [(0, high, 0, len(poly) - 1, 0)]  # roots in (lo, hi] / 2**s; roots above lo, above hi
    while todo:
        lo, hi, s, above_lo, above_hi = todo.pop()
        inside = above_lo - above_hi
        if inside == 0 or above_hi >= most:
            continue
        while hi - lo > lo >> bits:
            if hi - lo == 1:
                lo, hi, s = 2 * lo, 2 * hi, s + 1
            mid = (lo + hi) // 2
            if inside > 1:
                above = roots_above(poly, mid, s)
                if above_hi < above < above_lo:
                    todo += [(lo, mid, s, above_lo, above), (mid, hi, s, above, above_hi)]
                    break
            else:
                sign = _sign(poly, mid, s)
                if sign == 0:
                    lo = hi = mid
                    break
                above = above_hi if (sign < 0) == (above_hi % 2 == 1) else above_lo
            lo, hi = (lo, mid) if above == above_hi else (mid, hi)
        else:
            found.append((lo + hi, s + 1, inside))
            continue
        if lo == hi:
            found.append((lo, s, inside))
    return sorted(found, key=lambda r: Fraction(r[0], 1 << r[1]), reverse=True)


# ---------------------------------------------------------------- components

def null_vectors(matrix: list[list[int]], m: int, s: int, count: int) -> list[list[float]]:
    """``count`` orthogonal unit vectors of the null space of matrix - m / 2**s."""
    d = len(matrix)
    width = max(v.bit_length() for row in matrix for v in row) + s + GUARD
    a = np.array([[((v << s) - (m if i == j else 0)) << GUARD for j, v in enumerate(row)] for i, row in enumerate(matrix)], object)
    steps = []
    for k in range(d):  # elimination with row exchanges; multipliers have ``width`` bits
        at = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if at != k:
            a[[k, at]] = a[[at, k]]
        if a[k, k] == 0:
            a[k, k] = 1
        times = np.array([(v << width) // a[k, k] for v in a[k + 1:, k]], object)
        if len(times):
            a[k + 1:, k:] -= (times[:, None] * a[k, k:][None, :]) >> width
        steps.append((at, times))
    rng = np.random.default_rng(d)
    got: list[np.ndarray] = []
    for _ in range(count):
        z = np.array([int(v) << width for v in rng.integers(-1000, 1000, d)], object)
        for _ in range(ROUNDS):
            for v in got:
                z = z - ((v * ((z * v).sum() >> width)) >> width)
            norm = isqrt(int((z * z).sum()))
            z = np.array([(int(v) << width) // norm for v in z], object)
            for k, (at, times) in enumerate(steps):
                if at != k:
                    z[k], z[at] = z[at], z[k]
                if len(times):
                    z[k + 1:] -= (times * z[k]) >> width
            for k in range(d - 1, -1, -1):
                z[k] = ((int(z[k] << width)) - int((a[k, k + 1:] * z[k + 1:]).sum() if k + 1 < d else 0)) // a[k, k]
        for v in got:
            norm = isqrt(int((z * z).sum()))
            z = np.array([(int(x) << width) // norm for x in z], object)
            z = z - ((v * ((z * v).sum() >> width)) >> width)
        norm = isqrt(int((z * z).sum()))
        got.append(np.array([(int(v) << width) // norm for v in z], object))
    return [[int(v) / (1 << width) for v in z] for z in got]


def fit(rows: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """The whitening of rows (vec_id, embedding); None without a positive eigenvalue."""
    spark = rows.sparkSession
    n, sums, scatter = sums_of(rows)
    trace = sum(scatter[i][i] for i in range(len(scatter)))
    if trace == 0:
        return None
    roots = top_roots(characteristic(spark, scatter), most)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("id").to_pylist()
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([null_vectors(scatter, *roots[i]) for i in ids], pa.list_(pa.list_(pa.float64())))], names=["id", "v"])

    asked = spark.range(len(roots)).repartition(max(1, min(len(roots), spark.sparkContext.defaultParallelism)))
    spans = {r["id"]: r["v"] for r in asked.mapInArrow(vectors, "id long, v array<array<double>>").collect()}  # at most d vectors
    values, components, explained = [], [], []
    for i, (m, s, _) in enumerate(roots):
        for v in spans[i]:
            v = np.array(v)
            components.append(v if v[np.argmax(np.abs(v))] > 0 else -v)
            values.append(m / ((n * n) << s))
            explained.append(m / (trace << s))
    return Whitening(n, sums, values[:most], np.array(components[:most]), explained[:most])


# ---------------------------------------------------------------- rows

def _centred(y: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """(n x - S, whole and exact; its squares' sum)."""
    largest = max(float(np.abs(y).max(initial=0)) * model.n, *map(abs, model.sums))
    kind = np.int64 if 4 * largest * largest * y.shape[1] < 1 << 62 else object
    gap = y.astype(np.int64).astype(kind) * model.n - np.array(model.sums, kind)
    return gap, (gap * gap).sum(axis=1)


def _whitened(y: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    gap, squares = _centred(y, model)
    return (gap / model.n).astype(float) @ (model.vectors / np.sqrt(model.values)[:, None]).T, squares


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened values' covariance minus the identity."""
    k = len(model.values)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for b in batches:
            if b.num_rows:
                w = np.hstack([_whitened(_matrix(b.column("embedding")), model)[0], np.ones((b.num_rows, 1))])
                total += w.T @ w
        i, j = np.triu_indices(k + 1)
        yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"])

    cells = rows.select("embedding").mapInArrow(products, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    found = {(r["i"], r["j"]): r["v"] / model.n for r in cells}
    return max(abs(found[i, j] - found[i, k] * found[j, k] - (i == j)) for i in range(k) for j in range(i, k))


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = valid(vectors)
    model = fit(rows, most)
    if model is None:
        return vectors.sparkSession.createDataFrame([], OUT)
    error, k = identity_error(rows, model), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                w, squares = _whitened(_matrix(b.column("embedding")), model)
                each = np.repeat(np.arange(len(w)), k)
                yield pa.record_batch([
                    b.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(w))),
                    pa.array(np.full(len(each), model.n, np.int64)), pa.array(squares.tolist(), pa.int64()).take(pa.array(each)),
                    pa.array(w.ravel()), pa.array(np.tile(model.explained, len(w))), pa.array(np.full(len(each), error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(run, OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


QUERIES = {"op12_exact_whitening": query}
ORACLE: dict[str, str] = {}
