"""Embedding whitening by the exact characteristic polynomial of the integer scatter.

Entries become integers ``y = floor(64 * c)``; the scatter ``M = n * sum(y y') - S S'``
is then an exact integer matrix (``n**2`` times the covariance, whatever constant is
added to ``y``). Spark sums the products exactly; what reaches the driver is one number
per pair of dimensions, whatever the number of vectors.

1. **Polynomial.** ``M`` modulo one prime after another is brought to Hessenberg form,
   whose characteristic polynomial follows by a recurrence. Primes are dealt to Spark
   tasks; the residues are joined by the Chinese remainder theorem. ``M`` is positive
   semidefinite, so Maclaurin's inequality bounds the coefficients and thereby the primes.
2. **Roots.** All roots are real, so the sign changes among the coefficients of
   ``p(x + a)`` are exactly the number of roots above ``a`` (Descartes), multiplicity
   included. Integer bisection isolates the distinct roots (their number is known from
   the exact gcd of ``p`` and ``p'``) and narrows them as far as their gaps ask.
3. **Components.** Inverse iteration with the isolated root as shift, in decimal
   arithmetic of as many digits as the gap asks, one Spark row per distinct root;
   repeated roots get an orthonormal basis of their space.

Defined results: rows whose vector is null, empty, holds a null or non-finite entry, or
is of another length than most (ties: the longer) are left out; equal rows all count.
Components of eigenvalue 0 (constant dimensions, a single vector) have no whitened
coordinate and are left out. An empty table gives an empty result; columns other than
the id and the vector are not read. An entry or a deviation beyond 64 bits fails the run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm.common import Shared, lean

QUANTUM = 64.0
COMPONENTS = 32
#: Primes of one block in a task; products of two residues stay below 2**62.
BLOCK = 32
#: Roots are narrowed, and other components damped, by this many decimal digits.
DIGITS = 30


def vectors(table: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of the usable rows."""
    v = F.col(column).cast("array<double>")
    rows = table.select(F.col(id_column).cast("bigint").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("v") == (usual[0]["d"] if usual else 0))


def _integers(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """``floor(64 c)`` of a batch's vectors as whole doubles."""
    column = batch.column(batch.schema.get_field_index("v"))
    y = np.floor(QUANTUM * column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d))
    if y.size and np.abs(y).max() >= 2.0**62:
        raise OverflowError("an embedding entry times 64 does not fit in 64 bits")
    return y


def _products(y: np.ndarray) -> np.ndarray:
    """``y' y`` as Python integers; doubles hold each block's sums exactly."""
    most = int(np.abs(y).max()) if y.size else 0
    rows = (1 << 53) // max(1, most * most)
    if rows == 0:
        exact = y.astype(np.int64).astype(object)
        return exact.T.dot(exact)
    out = np.zeros((y.shape[1],) * 2, object)
    for a in range(0, len(y), rows):
        out += (y[a : a + rows].T @ y[a : a + rows]).astype(np.int64).astype(object)
    return out


def _moments(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per pair of dimensions and task; (-1, j) sums dimension j, (-1, -1) counts."""
        n, total, pairs = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            y = _integers(batch, d)
            if len(y):
                n += len(y)
                total += y.astype(np.int64).astype(object).sum(0)
                pairs += _products(y)
        if n:
            i, j = np.triu_indices(d)
            values = [n, *total, *pairs[i, j]]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.r_[np.full(d + 1, -1), i], pa.int32()), pa.array(np.r_[-1, np.arange(d), j], pa.int32()),
                pa.array([Decimal(int(x)) for x in values], pa.decimal128(38, 0))], ["i", "j", "value"])

    return run


def scatter(rows: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, ``n * sum(y y') - S S'``), all exact."""
    parts = rows.select("v").mapInArrow(lean(_moments(d)), "i int, j int, value decimal(38,0)")
    found = {(r["i"], r["j"]): int(r["value"]) for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    n = found.get((-1, -1), 0)
    sums = [found.get((-1, j), 0) for j in range(d)]
    m = np.zeros((d, d), object)
    for i in range(d):
        for j in range(i, d):
            m[i, j] = m[j, i] = n * found.get((i, j), 0) - sums[i] * sums[j]
    return n, sums, m


# ---------------------------------------------------------------------------
# characteristic polynomial


def primes_down(limit: int) -> Iterator[int]:
    """Primes below ``limit`` (2**31 at most), the largest first."""
    root = math.isqrt(limit) + 1
    sieve = np.ones(root + 1, bool)
    sieve[:2] = False
    for k in range(2, math.isqrt(root) + 1):
        if sieve[k]:
            sieve[k * k :: k] = False
    small = np.flatnonzero(sieve)
    for x in range(limit - 1, root, -1):
        if (x % small).all():
            yield x


def polynomials_modulo(m: np.ndarray, primes: list[int]) -> np.ndarray:
    """Coefficients (constant first) of ``det(x - m)`` modulo every prime, a row each."""
    d, count = len(m), len(primes)
    p = np.array(primes, np.int64)
    q, r = p[:, None], p[:, None, None]
    a = np.stack([(m % prime).astype(np.int64) for prime in primes])
    for k in range(1, d - 1):
        below = a[:, k:, k - 1] != 0
        pivot = k + below.argmax(1)
        swap = np.flatnonzero(pivot != k)
        if len(swap):
            to = pivot[swap]
            a[swap, k], a[swap, to] = a[swap, to], a[swap, k]
            a[swap, :, k], a[swap, :, to] = a[swap, :, to], a[swap, :, k]
        inverse = np.array([pow(int(x), -1, int(z)) if x else 0 for x, z in zip(a[:, k, k - 1], p, strict=True)], np.int64)
        f = a[:, k + 1 :, k - 1] * inverse[:, None] % q
        a[:, k + 1 :, :] = (a[:, k + 1 :, :] - f[:, :, None] * a[:, k, None, :]) % r
        a[:, :, k] = (a[:, :, k] + (f[:, None, :] * a[:, :, k + 1 :] % r).sum(2)) % q
    polys = [np.ones((count, 1), np.int64)]
    for k in range(d):  # expand the last column of every leading block
        new = np.zeros((count, k + 2), np.int64)
        new[:, 1:] = polys[k]
        new[:, : k + 1] -= a[:, k, k, None] * polys[k] % q
        below = np.ones(count, np.int64)
        for i in range(k - 1, -1, -1):
            below = below * a[:, i + 1, i] % p
            new[:, : i + 1] -= (a[:, i, k] * below % p)[:, None] * polys[i] % q
        polys.append(new % q)
    return polys[d]


def characteristic_polynomial(spark: SparkSession, m: np.ndarray) -> list[int]:
    """``det(x - m)`` of a positive semidefinite integer matrix, constant coefficient first."""
    d, mean = len(m), sum(m[i, i] for i in range(len(m))) // len(m) + 1
    bound = max(math.comb(d, k) * mean**k for k in range(d + 1))
    primes, product = [], 1
    for prime in primes_down(1 << 31):
        primes.append(prime)
        product *= prime
        if product > bound:
            break
    matrix = Shared(spark, m)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [x for batch in batches for x in batch.column(0).to_pylist()]
        for a in range(0, len(own), BLOCK):
            block = own[a : a + BLOCK]
            rows = polynomials_modulo(matrix.value, block)
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(rows.tolist(), pa.list_(pa.int64()))], ["prime", "c"])

    dealt = spark.createDataFrame([(x,) for x in primes], "prime bigint").repartition(max(1, math.ceil(len(primes) / BLOCK)))
    images = dealt.mapInArrow(lean(residues), "prime bigint, c array<bigint>").collect()  # (d + 1) residues a prime
    modulus, value = 1, [0] * (d + 1)
    for image in images:
        prime = image["prime"]
        inverse = pow(modulus, -1, prime)
        value = [v + modulus * ((c - v) * inverse % prime) for v, c in zip(value, image["c"], strict=True)]
        modulus *= prime
    # signs alternate from the leading 1 down, so absolute values below the bound decide
    return [-(modulus - v) if (d - k) % 2 and v else v for k, v in enumerate(value)]


# ---------------------------------------------------------------------------
# roots


def _divide(a: list[int], b: list[int], p: int | None = None) -> tuple[list[int], list[int]]:
    """Quotient and remainder by a monic (modulo ``p``: any) polynomial."""
    a, out = list(a), [0] * max(0, len(a) - len(b) + 1)
    inverse = pow(b[-1], -1, p) if p else 1
    for k in range(len(a) - len(b), -1, -1):
        f = a[k + len(b) - 1] * inverse
        f = f % p if p else f
        out[k] = f
        if f:
            for j, x in enumerate(b):
                a[k + j] = (a[k + j] - f * x) % p if p else a[k + j] - f * x
    while a and a[-1] == 0:
        a.pop()
    return out, a


def _gcd_modulo(a: list[int], b: list[int], p: int) -> list[int]:
    a, b = [x % p for x in a], [x % p for x in b]
    while b and b[-1] == 0:
        b.pop()
    while b:
        a, b = b, _divide(a, b, p)[1]
    inverse = pow(a[-1], -1, p)
    return [x * inverse % p for x in a]


def without_repeats(poly: list[int]) -> list[int]:
    """The monic polynomial's distinct roots, each once: ``p / gcd(p, p')``, the gcd proved by division."""
    slope = [k * c for k, c in enumerate(poly)][1:]
    if not slope:
        return poly
    modulus, held = 1, None
    for prime in primes_down(1 << 31):
        image = _gcd_modulo(poly, slope, prime)
        if len(image) == 1:
            return poly  # a gcd modulo a prime is never of lower degree than the gcd
        if held is None or len(image) < len(held):
            modulus, held = prime, image
        elif len(image) == len(held):
            inverse = pow(modulus, -1, prime)
            held = [h + modulus * ((c - h) * inverse % prime) for h, c in zip(held, image, strict=True)]
            modulus *= prime
        else:
            continue
        gcd = [h - modulus if h > modulus // 2 else h for h in held]
        rest, left = _divide(poly, gcd)
        if not left and not _divide(slope, gcd)[1]:
            return rest
    raise ArithmeticError("no gcd found")


def roots_above(poly: list[int], at: int, scale: int) -> int:
    """Roots above ``at / 2**scale``, with multiplicity, of a polynomial with only real roots."""
    d = len(poly) - 1
    c = [x << scale * (d - k) for k, x in enumerate(poly)]
    for i in range(d):  # coefficients of p(x + at)
        for k in range(d - 1, i - 1, -1):
            c[k] += at * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _value(poly: list[int], at: int, scale: int) -> int:
    """A positive multiple of the polynomial's value at ``at / 2**scale``."""
    value, d = 0, len(poly) - 1
    for k in range(d, -1, -1):
        value = value * at + (poly[k] << scale * (d - k))
    return value


@dataclass
class Root:
    """A root in ``(low, low + 1] / 2**scale``, with its multiplicity."""

    low: int
    scale: int
    times: int

    def decimal(self) -> Decimal:
        return Decimal(2 * self.low + 1) / (Decimal(2) ** (self.scale + 1))

    def gap(self, other: Root) -> Fraction:
        """Distance of the two intervals, 0 if they touch."""
        low, high = sorted([(Fraction(x.low, 1 << x.scale), Fraction(x.low + 1, 1 << x.scale)) for x in (self, other)])
        return max(Fraction(0), high[0] - low[1])

    def narrow(self, poly: list[int], positive_above: bool, steps: int = 32) -> None:
        """Halve the interval ``steps`` times by the sign that the (simple) polynomial has above the root."""
        for _ in range(steps):
            self.low, self.scale = 2 * self.low, self.scale + 1
            value = _value(poly, self.low + 1, self.scale)
            if value and (value > 0) != positive_above:
                self.low += 1


def largest_roots(poly: list[int], wanted: int) -> list[Root]:
    """The largest distinct positive roots that make up ``wanted`` with multiplicity, and the next one."""
    simple, known = without_repeats(poly), {}

    def above(at: int, scale: int) -> int:
        if (at, scale) not in known:
            known[at, scale] = roots_above(simple, at, scale)
        return known[at, scale]

    top = max(1, (-poly[-2]).bit_length())  # the trace bounds every root
    found, before = [], 0
    for rank in range(1, above(0, 0) + 1):
        if found and before - found[-1].times >= wanted:
            break
        low, high, scale = 0, 1 << top, 0  # root number ``rank`` of the distinct ones lies in (low, high]
        while high - low > 1 or above(low, scale) > rank or above(high, scale) < rank - 1:
            if high - low == 1:
                low, high, scale = 2 * low, 2 * high, scale + 1
            middle = (low + high) // 2
            if above(middle, scale) >= rank:
                low = middle
            else:
                high = middle
        times = roots_above(poly, low, scale) - before
        found.append(Root(low, scale, times))
        before += times
    while True:  # until a step is a small part of the value and of the gaps beside it
        wide = set()
        for k, root in enumerate(found):
            gaps = [root.gap(x) for x in found[max(0, k - 1) : k] + found[k + 1 : k + 2]]
            if root.low <= 10**DIGITS or any(g * (1 << root.scale) <= 10**DIGITS for g in gaps):
                wide |= {k - 1, k, k + 1}
        if not wide:
            return found
        for k in wide & set(range(len(found))):
            found[k].narrow(simple, k % 2 == 0)


# ---------------------------------------------------------------------------
# components


def eigenvectors(m: np.ndarray, value: str, times: int, digits: int) -> list[list[float]]:
    """Orthonormal vectors of the eigenvalue nearest to ``value``, by inverse iteration with ``digits`` digits."""
    d = len(m)
    with localcontext() as context:
        context.prec, context.Emax, context.Emin = digits, 10**9, -(10**9)
        shift = Decimal(value)
        a = np.array([[Decimal(int(x)) for x in row] for row in m], object)
        a[np.arange(d), np.arange(d)] -= shift
        size = max(abs(x) for x in a.ravel())
        tiny = size * Decimal(10) ** (3 - digits)
        order = list(range(d))
        for k in range(d):  # factors with row exchange; a vanishing pivot is the null space itself
            best = max(range(k, d), key=lambda i: abs(a[i, k]))
            if best != k:
                a[[k, best]] = a[[best, k]]
                order[k], order[best] = order[best], order[k]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            if k + 1 < d:
                f = a[k + 1 :, k] / a[k, k]
                a[k + 1 :, k] = f
                a[k + 1 :, k + 1 :] -= f[:, None] * a[k, None, k + 1 :]
        basis: list[np.ndarray] = []
        for t in range(times):
            z = np.array([Decimal(1 + (i * 7919 + t * 104729 + i * i * 31) % 1009) for i in range(d)], object)
            for _ in range(3):
                z = z[order]
                for k in range(1, d):
                    z[k] -= (a[k, :k] * z[:k]).sum()
                for k in range(d - 1, -1, -1):
                    rest = (a[k, k + 1 :] * z[k + 1 :]).sum() if k + 1 < d else Decimal(0)
                    z[k] = (z[k] - rest) / a[k, k]
                z = z / max(abs(x) for x in z)
                for other in basis:
                    z = z - other * (other * z).sum()
                z = z / (z * z).sum().sqrt()
            basis.append(z)
        out = []
        for z in basis:
            lead = max(range(d), key=lambda i: (abs(z[i]), -i))
            out.append([float(x if z[lead] > 0 else -x) for x in z])
        return out


def components(spark: SparkSession, m: np.ndarray, roots: list[Root], wanted: int) -> tuple[np.ndarray, list[Decimal]]:
    """(vectors as rows, eigenvalues of ``m``), by falling eigenvalue."""
    with localcontext() as context:
        context.prec = 200
        values = [root.decimal() for root in roots]
        size = Decimal(max(1, max(abs(int(x)) for x in m.ravel())))
        jobs, have = [], 0
        for k, root in enumerate(roots):
            if have >= wanted:
                break
            digits = 20 + DIGITS + max(0, (size * len(m) / (Decimal(2) ** -root.scale)).adjusted())
            jobs.append((k, str(values[k]), root.times, digits))
            have += root.times
    matrix = Shared(spark, m)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, value, times, digits in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                found = eigenvectors(matrix.value, value, times, digits)
                yield pa.RecordBatch.from_arrays([pa.array([k] * times, pa.int32()), pa.array(found, pa.list_(pa.float64()))], ["k", "vector"])

    if not jobs:
        return np.zeros((0, len(m))), []
    dealt = spark.createDataFrame(jobs, "k int, value string, times int, digits int").repartition(len(jobs))
    rows = sorted(dealt.mapInArrow(lean(solve), "k int, vector array<double>").collect(), key=lambda r: (r["k"], r["vector"]))[:wanted]
    return np.array([r["vector"] for r in rows]).reshape(-1, len(m)), [values[r["k"]] for r in rows]


# ---------------------------------------------------------------------------
# the operator


@dataclass
class Whitening:
    """What ``fit`` learns: exact sums, components as rows, square roots of the scatter's eigenvalues."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    scales: np.ndarray
    explained: np.ndarray

    def apply(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whitened rows, exact squared deviations ``sum((n y - S)**2)``)."""
        most = max(int(np.abs(y).max()) if y.size else 0, 1)
        exact = y.astype(np.int64)
        if 2 * self.n * most * 2 < 1 << 62:
            apart = self.n * exact - np.array(self.sums, np.int64)
        else:
            apart = self.n * exact.astype(object) - np.array(self.sums, object)
        far = int(np.abs(apart).max()) if apart.size else 0
        if far * far * y.shape[1] < 1 << 62:
            deviation = (apart.astype(np.int64) ** 2).sum(1)
        else:
            wide = (apart.astype(object) ** 2).sum(1)
            if wide.max() >= 1 << 63:
                raise OverflowError("a deviation does not fit in 64 bits")
            deviation = wide.astype(np.int64)
        return apart.astype(np.float64) @ self.vectors.T / self.scales, deviation


def fit(table: DataFrame, wanted: int = COMPONENTS, id_column: str = "vec_id", column: str = "embedding") -> Whitening | None:
    """Learn the whitening of all usable rows; None when there are none."""
    rows, spark = vectors(table, id_column, column), table.sparkSession
    first = rows.select(F.size("v").alias("d")).first()
    if first is None:
        return None
    n, sums, m = scatter(rows, first["d"])
    roots = largest_roots(characteristic_polynomial(spark, m), wanted) if any(m[i, i] for i in range(len(m))) else []
    found, values = components(spark, m, roots, wanted)
    trace = sum(int(m[i, i]) for i in range(len(m)))
    return Whitening(n, sums, found, np.array([float(v.sqrt()) for v in values]), np.array([float(v / trace) for v in values]))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, from the rows themselves."""
    shared, d, k = Shared(rows.sparkSession, model), len(model.sums), len(model.scales)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, square = 0, np.zeros(k), np.zeros((k, k))
        learnt = shared.value
        for batch in batches:
            w, _ = learnt.apply(_integers(batch, d))
            if len(w) == 0:
                continue
            own = w.mean(0)
            square += (w - own).T @ (w - own) + np.outer(own - mean, own - mean) * (n * len(w) / (n + len(w)))
            mean = mean + (own - mean) * (len(w) / (n + len(w)))
            n += len(w)
        if n:
            i, j = np.triu_indices(k)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.r_[np.full(k, -1), i], pa.int32()), pa.array(np.r_[np.arange(k), j], pa.int32()),
                pa.array(np.r_[n * mean, square[i, j] + n * mean[i] * mean[j]])], ["i", "j", "value"])

    sums = rows.select("v").mapInArrow(lean(spread), "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    found = {(r["i"], r["j"]): r["value"] for r in sums.collect()}  # a number per pair of components
    mean = [found[-1, j] / model.n for j in range(k)]
    return max((abs(found[i, j] / model.n - mean[i] * mean[j] - (i == j)) for i in range(k) for j in range(i, k)), default=0.0)


_RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(table: DataFrame, wanted: int = COMPONENTS, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Whitened coordinates of every usable row, one row per component (see the module's text)."""
    spark, model = table.sparkSession, fit(table, wanted, id_column, column)
    if model is None or not len(model.scales):
        return spark.createDataFrame([], _RESULT)
    rows = vectors(table, id_column, column)
    error, shared, d, k = identity_error(rows, model), Shared(spark, model), len(model.sums), len(model.scales)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt = shared.value
        for whole in batches:
            for a in range(0, whole.num_rows, 2000):
                batch = whole.slice(a, 2000)
                w, deviation = learnt.apply(_integers(batch, d))
                ids, size = batch.column(batch.schema.get_field_index("vec_id")), len(w)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(np.repeat(np.arange(size), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * k, learnt.n, np.int64)), pa.array(np.repeat(deviation, k)), pa.array(w.ravel()),
                    pa.array(np.tile(learnt.explained, size)), pa.array(np.full(size * k, error))], [c.split()[0] for c in _RESULT.split(", ")])

    return rows.mapInArrow(lean(project), _RESULT)
