"""Embedding whitening by an exact characteristic polynomial (operator 12).

1. Spark sums the integer scatter: entries c become x = floor(64 c) + 1,000,000,
   and tasks add products of x - 1,000,000 exactly (20-bit limbs, so that every
   float sum is an integer below 2^53). With n rows and sums S the integer matrix
   A = n * sum(x x') - S S' is n^2 times the covariance. Only A reaches the driver:
   D^2 numbers, ``MOST_DIMS`` checked.
2. The characteristic polynomial of A modulo many 31-bit primes, each by a
   Hessenberg reduction (a Spark task takes a share of the primes), put together
   by Chinese remaindering; the number of primes follows from the bound
   |coefficient| <= binomial(D, k) * radius^k, so the integers are exact.
3. All roots are real, so the sign changes of the polynomial shifted to a point
   count the roots above it exactly (Descartes). Bisection isolates the largest
   roots, then halves each interval to ``ROOT_BITS`` bits by the sign of the
   integer polynomial; roots that stay together that far are one root repeated.
4. Null-space inverse iteration from the root, corrected with residuals in exact
   integers until they vanish in double precision; repeated roots get an
   orthonormal basis of their space.
5. A last pass projects every row.

Rows without a vector, or with a null or non-finite entry, are dropped. Of
vectors of several lengths the most frequent length is meant (ties: the longer);
other rows have no covariance with them and are dropped too. Components with
eigenvalue 0 have no whitened value and are left out; no rows, or all rows equal:
no result. Repeated rows count each. ``deviation`` beyond a long is null, entries
beyond 2^52 raise. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fulfilq.llm.common import flat

SCALE, SHIFT = 64, 1_000_000
COMPONENTS, ROOT_BITS = 32, 120
MOST_DIMS = 4096
LIMB = 20
#: Rows multiplied at once: 2^(2 * LIMB) * ROWS stays below 2^53.
ROWS = 1 << 12


def integer_rows(col, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows count, their entries floor(64 c) as long) of a list column."""
    col = flat(col)
    width = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
    good = width == dims
    some = col.filter(pa.array(good)).flatten().cast(pa.float64())
    values = pc.fill_null(some, math.nan).to_numpy(zero_copy_only=False).reshape(-1, dims)
    finite = np.isfinite(values).all(axis=1)
    good[np.flatnonzero(good)[~finite]] = False
    x = np.floor(SCALE * values[finite])
    if x.size and np.abs(x).max() >= 2.0**52:
        raise ArithmeticError("an entry is beyond 2^52 / 64: floor(64 * c) is no exact long")
    return good, x.astype(np.int64)


def exact_scatter(x: np.ndarray) -> np.ndarray:
    """x' x as Python integers."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    limbs = []
    rest = x.copy()
    while rest.any() or not limbs:
        low = ((rest + (1 << (LIMB - 1))) & ((1 << LIMB) - 1)) - (1 << (LIMB - 1))
        limbs.append(low.astype(float))
        rest = (rest - low) >> LIMB
    for a in range(0, len(x), ROWS):
        for i, p in enumerate(limbs):
            for j, q in enumerate(limbs):
                part = p[a : a + ROWS].T @ q[a : a + ROWS]
                total += part.astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def dimension(rows: DataFrame, column: str) -> int | None:
    """The most frequent length of vectors without null or non-finite entries (ties: the longer)."""
    v = F.col(column)
    whole = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    sizes = rows.where(v.isNotNull() & (F.size(v) > 0)).where(whole).groupBy(F.size(v).alias("d")).count()
    best = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    if best is None:
        return None
    if best["d"] > MOST_DIMS:
        raise ValueError(f"vectors have {best['d']} entries; at most {MOST_DIMS} are handled")
    return best["d"]


def moments(rows: DataFrame, column: str, dims: int) -> tuple[int, list[int], np.ndarray]:
    """n, sums of x - SHIFT by dimension, and the exact matrix A = n * sum(x x') - S S' (Python integers)."""

    def run(batches):
        total, sums, n = np.zeros((dims, dims), object), np.zeros(dims, object), 0
        for b in batches:
            _, x = integer_rows(b.column(0), dims)
            n += len(x)
            sums = sums + x.sum(axis=0, dtype=object) if len(x) else sums
            total = total + exact_scatter(x) if len(x) else total
        if not n:
            return
        i, j = np.triu_indices(dims)
        ids = np.concatenate([i * dims + j, -1 - np.arange(dims), [-dims - 1]])
        values = [str(v) for v in (*total[i, j], *sums, n)]
        for a in range(0, len(ids), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(ids[a : a + (1 << 16)], pa.int64()), pa.array(values[a : a + (1 << 16)])], ["id", "v"])

    parts = rows.select(column).mapInArrow(run, "id bigint, v string")
    got = parts.groupBy("id").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()  # D (D + 1) / 2 + D + 1 numbers
    by = {r["id"]: int(r["v"]) for r in got}
    n, sums = by.get(-dims - 1, 0), [by.get(-1 - i, 0) for i in range(dims)]
    a = np.zeros((dims, dims), object)
    if n:
        for i in range(dims):
            for j in range(i, dims):
                a[i, j] = a[j, i] = n * by[i * dims + j] - sums[i] * sums[j]
    return n, sums, a


# ---------------------------------------------------------------------------
# Characteristic polynomial
# ---------------------------------------------------------------------------
def primes(count: int) -> list[int]:
    """The largest primes below 2^31."""
    small = [p for p in range(3, 46341, 2) if all(p % q for q in range(3, math.isqrt(p) + 1, 2))]
    out, top = [], 2**31 - 1
    while len(out) < count:
        span = 1 << 13
        odd = np.arange(top, top - span, -2, dtype=np.int64)
        ok = np.ones(len(odd), bool)
        for q in small:
            ok &= odd % q != 0
        out += odd[ok].tolist()
        top -= span
    return out[:count]


def inverse(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """x^(p - 2) modulo p."""
    out, base, e = np.ones_like(x), x % p, p - 2
    while e.any():
        out = np.where(e & 1, out * base % p, out)
        base, e = base * base % p, e >> 1
    return out


def charpoly_mod(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Coefficients (constant first, leading 1 last) of det(t - a) for matrices ``a`` (one per prime, reduced)."""
    k, d, _ = a.shape
    h, each, q = a.copy(), np.arange(k), p[:, None, None]
    for c in range(d - 2):
        # a row with a nonzero entry below the diagonal moves up, its column along
        pivot = (h[:, c + 1 :, c] != 0).argmax(axis=1) + c + 1
        for x in (h, h.transpose(0, 2, 1)):
            rows = x[each, pivot].copy()
            x[each, pivot] = x[:, c + 1]
            x[:, c + 1] = rows
        u = h[:, c + 2 :, c] * inverse(h[:, c + 1, c], p)[:, None] % p[:, None]  # pivot 0: the column is 0, so is u
        h[:, c + 2 :] = (h[:, c + 2 :] - u[:, :, None] * h[:, c + 1 : c + 2] % q) % q
        add = np.zeros((k, d), np.int64)
        for j in range(d - c - 2):  # sums of products stay below 2^63
            add = (add + h[:, :, c + 2 + j] * u[:, j : j + 1]) % p[:, None]
        h[:, :, c + 1] = (h[:, :, c + 1] + add) % p[:, None]
    poly = np.zeros((d + 1, k, d + 1), np.int64)
    poly[0, :, 0] = 1
    m = p[:, None]
    for i in range(1, d + 1):
        new = np.zeros((k, d + 1), np.int64)
        new[:, 1:] = poly[i - 1][:, :-1]
        new = (new - h[:, i - 1, i - 1][:, None] * poly[i - 1]) % m
        t = np.ones(k, np.int64)
        for j in range(1, i):
            t = t * h[:, i - j, i - j - 1] % p
            new = (new - (h[:, i - j - 1, i - 1] * t % p)[:, None] * poly[i - j - 1]) % m
        poly[i] = new
    return poly[d]


def coefficient_bound(a: np.ndarray) -> int:
    """Above twice every |coefficient|: eigenvalues lie in [0, radius], coefficient k sums binomial(D, k) products of k of them."""
    d = len(a)
    radius = max(int(sum(abs(v) for v in row)) for row in a)
    return 2 * max(math.comb(d, k) * radius**k for k in range(d + 1)) + 1


def characteristic_polynomial(spark: SparkSession, a: np.ndarray) -> list[int]:
    """Exact integer coefficients of det(t - a), constant first."""
    d, bound = len(a), coefficient_bound(a)
    moduli = primes(bound.bit_length() // 30 + 1)
    shipped = spark.sparkContext.broadcast([str(v) for v in a.ravel()])  # D^2 numbers

    def run(batches):
        whole = np.array([int(v) for v in shipped.value], object).reshape(d, d)
        for b in batches:
            every = b.column(0).to_numpy()
            step = max(1, (1 << 21) // (d * d))
            for i in range(0, len(every), step):
                p = every[i : i + step]
                mod = np.stack([(whole % int(x)).astype(np.int64) for x in p])
                coded = charpoly_mod(mod, p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p), pa.FixedSizeListArray.from_arrays(pa.array(coded.ravel()), d + 1).cast(pa.list_(pa.int64()))], ["p", "c"]
                )

    tasks = max(1, min(len(moduli), spark.sparkContext.defaultParallelism, len(moduli) * d**3 // 10**8 + 1))
    work = spark.createDataFrame(pa.table({"p": pa.array(moduli, pa.int64())})).repartition(tasks, "p")
    got = work.mapInArrow(run, "p bigint, c array<bigint>").collect()  # D + 1 numbers per prime
    values, modulus = [0] * (d + 1), 1
    for r in got:  # Garner's step, prime by prime
        p = r["p"]
        inv = pow(modulus, -1, p)
        values = [v + modulus * ((c - v) * inv % p) for v, c in zip(values, r["c"], strict=True)]
        modulus *= p
    shipped.unpersist()
    return [v - modulus if 2 * v > modulus else v for v in values]


# ---------------------------------------------------------------------------
# Real roots
# ---------------------------------------------------------------------------
def roots_above(poly: list[int], num: int, bits: int) -> int:
    """How many roots (with multiplicity) are greater than num / 2^bits; all roots of ``poly`` are real."""
    d = len(poly) - 1
    c = [v << (bits * (d - i)) for i, v in enumerate(poly)]  # roots times 2^bits
    for i in range(d):  # Taylor shift by num
        for j in range(d - 1, i - 1, -1):
            c[j] += num * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def sign_at(poly: list[int], num: int, bits: int) -> int:
    total, scale = 0, 0
    for v in reversed(poly):
        total = total * num + (v << scale)
        scale += bits
    return (total > 0) - (total < 0)


def largest_roots(poly: list[int], count: int) -> list[tuple[int, int, int]]:
    """(num, bits, multiplicity) of the largest distinct positive roots, falling, until ``count`` with multiplicity.

    A root lies within 2^-bits of num / 2^bits, ``ROOT_BITS`` bits of it are right.
    """
    zero = next(i for i, v in enumerate(poly) if v)
    poly = poly[zero:]
    d = len(poly) - 1
    if not d:
        return []
    top = 1
    while roots_above(poly, 1 << top, 0):
        top += 1
    out, taken = [], 0
    work = [(0, 1, -top, d, 0)]  # (low, high) * 2^-bits, roots in (low, high] and above high; the highest interval is last
    while work and taken < count:
        low, high, bits, n, above_it = work.pop()
        if n == 1 or low.bit_length() > ROOT_BITS:
            if n == 1:
                # the sign above the root; halve until enough bits stand
                above = sign_at(poly, high, max(bits, 0)) if bits >= 0 else sign_at(poly, high << -bits, 0)
                if above == 0:
                    out.append((high, bits, 1))
                    taken += 1
                    continue
                while low.bit_length() <= ROOT_BITS:
                    low, high, bits = 2 * low, 2 * high, bits + 1
                    mid = low + 1
                    s = sign_at(poly, mid, bits) if bits >= 0 else sign_at(poly, mid << -bits, 0)
                    if s == 0:
                        low, high = mid, mid
                        break
                    low, high = (low, mid) if s == above else (mid, high)
            out.append((high, bits, n))
            taken += n
            continue
        low, high, bits = 2 * low, 2 * high, bits + 1
        mid = low + 1
        over = roots_above(poly, mid << max(-bits, 0), max(bits, 0)) - above_it
        if n - over:
            work.append((low, mid, bits, n - over, above_it + over))
        if over:
            work.append((mid, high, bits, over, above_it))
    return out


# ---------------------------------------------------------------------------
# Components
# ---------------------------------------------------------------------------
def null_space(a: np.ndarray, num: int, bits: int, size: int) -> np.ndarray:
    """Orthonormal rows spanning the null space of a - num / 2^bits (Python integers), by corrected inverse iteration."""
    d = len(a)
    scale = max(int(a[i, i]) for i in range(d))
    up = max(bits, 0)
    shifted = a * (1 << up)
    for i in range(d):
        shifted[i, i] -= num << max(-bits, 0)
    unit = scale << up
    m = np.array([[v / unit for v in row] for row in shifted])
    eps = np.finfo(float).eps
    rng = np.random.default_rng(1)
    v = np.linalg.qr(rng.standard_normal((d, size)))[0]
    for _ in range(4):  # inverse iteration; the shift keeps the factors regular
        v = np.linalg.qr(np.linalg.solve(m + eps * np.eye(d), v))[0]
    # bordered system: regular although m is singular; residuals are exact integers
    border = 60
    for _ in range(6):
        exact = np.array([[int(x) for x in row] for row in np.rint(np.ldexp(v, border))], object)
        r = shifted.dot(exact)
        r = np.array([[x / (unit << border) for x in row] for row in r])
        k = np.block([[m, v], [v.T, np.zeros((size, size))]])
        fix = np.linalg.solve(k, np.vstack([-r, np.zeros((size, size))]))[:d]
        v = np.linalg.qr(v + fix)[0]
        if np.abs(fix).max() < 4 * eps:
            break
    return v.T


def components(spark: SparkSession, a: np.ndarray, count: int = COMPONENTS) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(unit vectors as rows, eigenvalues of ``a`` as (num, bits)) by falling eigenvalue, at most ``count``."""
    vectors, values = [], []
    if not a.any():
        return np.zeros((0, len(a))), []
    for num, bits, size in largest_roots(characteristic_polynomial(spark, a), count):
        for v in null_space(a, num, bits, size):
            vectors.append(v / np.linalg.norm(v))
            values.append((num, bits))
    return np.array(vectors[:count]).reshape(-1, len(a)), values[:count]


def ratio(value: tuple[int, int], by: int) -> float:
    """num / 2^bits / by, correctly rounded."""
    num, bits = value
    return num / (by << bits) if bits >= 0 else (num << -bits) / by


# ---------------------------------------------------------------------------
# Whitening
# ---------------------------------------------------------------------------
class Whitener:
    """What a task needs to whiten rows: n, sums, components and eigenvalues (D * 32 numbers)."""

    def __init__(self, n: int, sums: list[int], a: np.ndarray, vectors: np.ndarray, values: list[tuple[int, int]]):
        self.n, self.dims, self.sums = n, len(sums), sums
        self.middle = [s // n for s in sums]
        self.rest = np.array([(s - n * m) / n for s, m in zip(sums, self.middle, strict=True)])
        trace = int(sum(a[i, i] for i in range(len(a))))
        self.explained = np.array([ratio(v, trace) for v in values])
        self.weights = vectors.T / np.sqrt(np.array([ratio(v, n * n) for v in values]))

    def whiten(self, x: np.ndarray) -> np.ndarray:
        near = (x - np.array(self.middle, np.int64)).astype(float) - self.rest
        return near @ self.weights

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """sum of (n x - S)^2 over the dimensions, exact; beyond a long: null."""
        out, n = [], self.n
        far = int(np.abs(x).max()) + max(abs(s) for s in self.sums) // n + 2 if x.size else 0
        if (2 * n * far) ** 2 * self.dims < 2**62:
            y = n * x - np.array(self.sums, np.int64)
            return (y * y).sum(axis=1).tolist()
        for row in x.tolist():
            total = sum((n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True))
            out.append(total if total < 2**63 else None)
        return out


def fit(rows: DataFrame, column: str = "embedding", count: int = COMPONENTS) -> Whitener | None:
    """None where there is no row, or no row differs from another."""
    if (dims := dimension(rows, column)) is None:
        return None
    n, sums, a = moments(rows, column, dims)
    vectors, values = components(rows.sparkSession, a, count)
    return Whitener(n, sums, a, vectors, values) if len(values) else None


def identity_error(rows: DataFrame, column: str, model) -> float:
    """Largest absolute entry of the whitened rows' covariance (divisor n, centred first) minus the identity."""
    w = model.value
    k = w.weights.shape[1]

    def mean_run(batches):
        total = np.zeros(k)
        for b in batches:
            total += w_of(b).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(total)], ["i", "v"])

    def w_of(b):
        return model.value.whiten(integer_rows(b.column(0), model.value.dims)[1])

    def sums(run):
        got = rows.select(column).mapInArrow(run, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
        return {r["i"]: r["v"] for r in got}  # one number per component, or pair of components

    by = sums(mean_run)
    mean = np.array([by[i] for i in range(k)]) / w.n

    def cov_run(batches):
        total = np.zeros((k, k))
        for b in batches:
            y = w_of(b) - mean
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total.ravel())], ["i", "v"])

    by = sums(cov_run)
    cov = np.array([by[i] for i in range(k * k)]).reshape(k, k) / w.n
    return float(np.abs(cov - np.eye(k)).max())


SCHEMA = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whiten(rows: DataFrame, id_column: str = "vec_id", column: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component."""
    spark = rows.sparkSession
    w = fit(rows, column, count)
    if w is None:
        return spark.createDataFrame([], SCHEMA)
    model = spark.sparkContext.broadcast(w)
    error = identity_error(rows, column, model)

    def run(batches):
        w = model.value
        k = w.weights.shape[1]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                good, x = integer_rows(b.column(1), w.dims)
                ids = flat(b.column(0)).filter(pa.array(good))
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(each), w.n, np.int64)),
                        pa.array(w.deviation(x), pa.int64()).take(pa.array(each)),
                        pa.array(w.whiten(x).ravel()),
                        pa.array(np.tile(w.explained, len(x))),
                        pa.array(np.full(len(each), error)),
                    ],
                    [c.split()[0] for c in SCHEMA.split(", ")],
                )

    return rows.select(F.col(id_column).cast("bigint").alias("vec_id"), column).mapInArrow(run, SCHEMA)
