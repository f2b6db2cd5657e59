"""Whitening of embeddings from an exactly computed spectrum.

Entries become integers, so the scatter of all vectors is an exact integer matrix. Its
characteristic polynomial is computed modulo many primes (Hessenberg form, one Spark row per
prime) and put together by Chinese remaindering. As all roots are real, the sign changes of a
shifted polynomial count the roots beyond the shift exactly; bisection isolates the largest roots
and their multiplicities, and refines each to 48 digits. Components are null vectors of the scatter
minus a root, by inverse iteration with 100 digits (one Spark row per root).

What passes through the driver depends on the number of dimensions only.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
REACH = 2.0**56  # entries of this size and more have no 64-bit integer form
DIGITS = 100  # of the inverse iteration
CLOSE = 160  # bits to which a root is refined, relative to it
PRIME_TOP = 2**31  # residues below it multiply without overflow
LIMB = 10**18
ROUNDS = 3


class Fit(NamedTuple):
    """Rows and sums of the fit list (in steps above SHIFT), its spectrum and unit components.

    ``roots`` are eigenvalues of the scatter, n^2 times those of the covariance.
    """

    n: int
    sums: list[int]
    trace: int
    roots: list[float]
    components: np.ndarray  # one per row


# ----- the fit list


def grid(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id and y = floor(64 * c) of every vector that can be fitted (x of the contract is y + 1000000).

    Vectors that are null, empty, hold null or non-finite entries or entries of 2^56 and more go. If
    lengths differ, the most frequent one stays (of equally frequent ones the shortest). Null and
    repeated ids and repeated rows stay, row by row.
    """
    v = F.col(vec_col).cast("array<double>")
    usable = F.forall(v, lambda c: F.coalesce(F.abs(c) < REACH, F.lit(False)))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(usable & (F.size("v") > 0))
    lengths = rows.groupBy(F.size("v").alias("d")).count().agg(F.max(F.struct("count", -F.col("d"))).alias("most")).first()["most"]
    d = -lengths[1] if lengths else 0
    return rows.where(F.size("v") == d).select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long")).alias("y"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def exact_products(y: np.ndarray) -> np.ndarray:
    """y^T y in exact integers; limbs of 20 bits keep each floating product sum below 2^53."""
    total = np.zeros((y.shape[1],) * 2, object)
    for at in range(0, len(y), 256):
        part = y[at : at + 256]
        mask = (1 << 20) - 1
        small = np.abs(part).max() < 1 << 22
        limbs = [part] if small else [part & mask, (part >> 20) & mask, part >> 40]
        floats = [limb.astype(np.float64) for limb in limbs]
        for i, a in enumerate(floats):
            for j, b in enumerate(floats):
                total += (a.T @ b).astype(np.int64).astype(object) << (20 * (i + j))
    return total


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Upper half of the products of (1, y) over a task's rows, each as two decimal limbs."""
    total = None
    for batch in batches:
        if batch.num_rows:
            y = _matrix(batch.column(0))
            one = exact_products(np.c_[np.ones(len(y), np.int64), y])
            total = one if total is None else total + one
    if total is None:
        return
    i, j = np.triu_indices(len(total))
    high, low = zip(*(divmod(int(v), LIMB) for v in total[i, j]))
    wide = pa.decimal128(38, 0)
    columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))]
    columns += [pa.array([decimal.Decimal(v) for v in half], wide) for half in (high, low)]
    yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "high", "low"])


def scatter(gridded: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """n, sums of y and the exact scatter n * sum(y y^T) - sum(y) sum(y)^T = n^2 times the covariance.

    This is the sum of centred products: in exact integers the centring loses nothing.
    """
    parts = gridded.select("y").mapInArrow(_products, "i int, j int, high decimal(38,0), low decimal(38,0)")
    sums = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    if not sums:
        return 0, [], np.zeros((0, 0), object)
    size = max(r["j"] for r in sums) + 1
    total = np.zeros((size, size), object)
    for r in sums:
        total[r["i"], r["j"]] = total[r["j"], r["i"]] = int(r["high"]) * LIMB + int(r["low"])
    n, s = total[0, 0], total[0, 1:]
    return n, list(s), n * total[1:, 1:] - np.outer(s, s)


# ----- the characteristic polynomial


def is_prime(n: int) -> bool:
    """Exact for n below 3,215,031,751, beyond all primes used here."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7) if n != p):
        return False
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if base % n and x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """Primes below PRIME_TOP, downwards, whose product exceeds 2 * bound."""
    out, product, n = [], 1, PRIME_TOP
    while product <= 2 * bound:
        n -= 1
        if is_prime(n):
            out.append(n)
            product *= n
    return out


def polynomial_mod(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients (constant first) of det(x - m) modulo a prime, by reduction to Hessenberg form."""
    h = (m % p).astype(np.int64)
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + below[0]
        h[[k + 1, pivot]] = h[[pivot, k + 1]]
        h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        f = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - f[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * f % p).sum(1)) % p
    # Minors of x - h from the upper left corner, each from all earlier ones.
    minors = np.zeros((d + 1, d + 1), np.int64)
    minors[0, 0] = 1
    for k in range(1, d + 1):
        weights, below = np.zeros(k, np.int64), 1
        for i in range(k, 0, -1):
            weights[i - 1] = int(h[i - 1, k - 1]) * below % p
            below = below * int(h[i - 1, i - 2]) % p if i > 1 else 0
        minors[k, 1:] = minors[k - 1, :-1]
        minors[k] = (minors[k] - (weights[:, None] * minors[:k] % p).sum(0)) % p
    return minors[d]


def remaindered(residues: dict[int, list[int]]) -> list[int]:
    """Integers, the smallest in size, that leave the given residues modulo all primes."""
    product = math.prod(residues)
    out = [0] * len(next(iter(residues.values())))
    for p, values in residues.items():
        rest = product // p
        factor = rest * pow(rest, -1, p)
        out = [(a + factor * int(v)) % product for a, v in zip(out, values)]
    return [a - product if 2 * a > product else a for a in out]


def characteristic_polynomial(spark: SparkSession, m: np.ndarray) -> list[int]:
    """Exact coefficients of det(x - m), constant first, for a symmetric matrix without negative roots.

    With such roots no coefficient exceeds (1 + trace / d)^d in size.
    """
    d = len(m)
    primes = primes_for(((int(np.trace(m)) + d) ** d) // d**d + 1)
    shared = spark.sparkContext.broadcast(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ps = batch.column(0).to_pylist()
            found = [polynomial_mod(shared.value, p).tolist() for p in ps]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["p", "c"])

    tasks = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), 32), "p")
    return remaindered({r["p"]: r["c"] for r in tasks.mapInArrow(run, "p long, c array<long>").collect()})


# ----- roots


class Dyadic(NamedTuple):
    """The number ``units / 2**bits``."""

    units: int
    bits: int


def scaled(poly: list[int], bits: int) -> list[int]:
    """Coefficients of the polynomial whose roots are 2**bits times as large."""
    d = len(poly) - 1
    return [c << (bits * (d - i)) for i, c in enumerate(poly)]


def roots_beyond(poly: list[int], at: Dyadic) -> int:
    """Roots larger than ``at``, with multiplicity.

    Descartes' count of sign changes is exact for a polynomial that has only real roots.
    """
    c = scaled(poly, at.bits)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += at.units * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


class Bracket(NamedTuple):
    """Roots in (low, low + 1] / 2**bits: one of multiplicity ``times``, or that many too close to tell."""

    low: int
    bits: int
    times: int


def isolated(poly: list[int], top: int, wanted: int) -> list[Bracket]:
    """Brackets of the ``wanted`` largest positive roots, largest first; ``top`` bounds all roots.

    Halves every interval that holds several roots, until they are apart or agree to CLOSE bits.
    """
    out: list[Bracket] = []
    width = max(top, 1).bit_length()
    # (low units, bits, roots beyond the upper end, roots beyond low), the topmost interval last.
    stack = [(0, -width, 0, roots_beyond(poly, Dyadic(0, 0)))]
    while stack and sum(b.times for b in out) < wanted:
        low, bits, above, beyond = stack.pop()
        count = beyond - above
        if not count:
            continue
        if (count == 1 and low) or low.bit_length() > CLOSE:
            out.append(Bracket(low, bits, count))
            continue
        middle = roots_beyond(poly, Dyadic(2 * low + 1, bits + 1)) if bits >= 0 else roots_beyond(poly, Dyadic((2 * low + 1) << -(bits + 1), 0))
        stack.append((2 * low, bits + 1, middle, beyond))
        stack.append((2 * low + 1, bits + 1, above, middle))
    return out


def refined(poly: list[int], b: Bracket) -> decimal.Decimal:
    """The root of a bracket to CLOSE bits, from the sign of the polynomial at midpoints."""
    low, bits = b.low, b.bits

    def value(units: int, bits: int) -> int:
        c = scaled(poly, bits) if bits > 0 else poly
        x = units if bits > 0 else units << -bits
        total = 0
        for v in reversed(c):
            total = total * x + v
        return total

    if b.times == 1:
        end = value(low + 1, bits)
        while low.bit_length() <= CLOSE and end:
            middle = value(2 * low + 1, bits + 1)
            bits += 1
            if not middle:
                low, end = 2 * low, 0
            elif (middle > 0) == (end > 0):
                low, end = 2 * low, middle
            else:
                low = 2 * low + 1
        if not end:
            low, bits = low + 1, bits
    with decimal.localcontext(prec=DIGITS):
        return decimal.Decimal(low) / decimal.Decimal(2) ** bits


# ----- components


def null_vectors(m: np.ndarray, root: decimal.Decimal, count: int) -> np.ndarray:
    """``count`` orthonormal vectors that m - root takes nearest to zero, one per row.

    Elimination with the largest pivots, then rounds of inverse iteration from fixed starts; the
    vectors of a multiple root are kept apart by orthogonalisation.
    """
    with decimal.localcontext(prec=DIGITS):
        d = len(m)
        a = np.array([[decimal.Decimal(int(v)) for v in row] for row in m], object)
        a[np.arange(d), np.arange(d)] -= root
        tiny = max(abs(v) for v in a.flat) * decimal.Decimal(10) ** -DIGITS or decimal.Decimal(1)
        # Starts without a pattern in common with the data.
        b = np.array([[decimal.Decimal((i + 1) * (k + 3) * 7919 % 1009 + 1) for k in range(count)] for i in range(d)], object)
        order = np.arange(d)
        for k in range(d):
            pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            f = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] -= f[:, None] * a[k, k + 1 :]
            a[k + 1 :, k] = f
        for _ in range(ROUNDS):
            x = b[order]
            for k in range(d):
                x[k + 1 :] -= a[k + 1 :, k][:, None] * x[k]
            for k in range(d - 1, -1, -1):
                x[k] = x[k] / a[k, k]
                x[:k] -= a[:k, k][:, None] * x[k]
            for k in range(count):
                for e in range(k):
                    x[:, k] -= (x[:, e] * x[:, k]).sum() * x[:, e]
                x[:, k] /= (x[:, k] * x[:, k]).sum().sqrt()
            b = x
        out = np.array([[float(v) for v in row] for row in b.T])
    lead = out[np.arange(count), np.abs(out).argmax(1)]
    return out * np.sign(lead)[:, None]


def spectrum(spark: SparkSession, m: np.ndarray, wanted: int) -> tuple[list[float], np.ndarray]:
    """The ``wanted`` largest positive roots of the scatter and their components, largest first.

    Roots that are zero, that is dimensions without variance, have no component.
    """
    poly = characteristic_polynomial(spark, m)
    brackets = isolated(poly, int(np.trace(m)), wanted)
    if not brackets:
        return [], np.zeros((0, len(m)))
    shared = spark.sparkContext.broadcast((m, poly, brackets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, coefficients, all_brackets = shared.value
        for batch in batches:
            for k in batch.column(0).to_pylist():
                root = refined(coefficients, all_brackets[k])
                vectors = null_vectors(matrix, root, all_brackets[k].times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(vectors), pa.int32()), pa.array(range(len(vectors)), pa.int32()),
                     pa.array([float(root)] * len(vectors)), pa.array(vectors.tolist(), pa.list_(pa.float64()))],
                    names=["k", "nth", "root", "v"],
                )

    tasks = spark.createDataFrame([(k,) for k in range(len(brackets))], "k int").repartition(len(brackets), "k")
    rows = sorted(tasks.mapInArrow(run, "k int, nth int, root double, v array<double>").collect(), key=lambda r: (r["k"], r["nth"]))[:wanted]
    return [r["root"] for r in rows], np.array([r["v"] for r in rows])


def fit(gridded: DataFrame, components: int = COMPONENTS) -> Fit:
    n, sums, m = scatter(gridded)
    trace = int(np.trace(m)) if n else 0
    roots, vectors = spectrum(gridded.sparkSession, m, components) if trace else ([], np.zeros((0, len(sums))))
    return Fit(n, sums, trace, roots, vectors)


# ----- projection


def _centred(y: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * y - sums, exactly; 64-bit where that cannot overflow."""
    reach = n * int(np.abs(y).max(initial=0)) + max(abs(s) for s in sums)
    if reach < 2**62:
        return n * y - sums.astype(np.int64)
    return n * y.astype(object) - sums


def whiten(gridded: DataFrame, f: Fit) -> DataFrame:
    """vec_id, deviation, whitened (array, one entry per component) of every vector.

    ``deviation`` is null where it is no 64-bit number.
    """
    shared = gridded.sparkSession.sparkContext.broadcast(f)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        sums = np.array(f.sums, object)
        across = f.components.T / (np.sqrt(np.array(f.roots)) / f.n)
        for batch in batches:
            if not batch.num_rows:
                continue
            centred = _centred(_matrix(batch.column(1)), f.n, sums)
            fits = centred.dtype != object and int(np.abs(centred).max()) ** 2 * centred.shape[1] < 2**63
            squares = ((centred if fits else centred.astype(object)) ** 2).sum(1)
            deviation = [v if v < 2**63 else None for v in squares.tolist()]
            w = (centred / f.n).astype(np.float64) @ across
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), flat], names=["vec_id", "deviation", "whitened"])

    return gridded.select("vec_id", "y").mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, n: int, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity.

    The vectors are centred already; what is left of their mean is taken off the products.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((components + 1,) * 2)
        for batch in batches:
            if batch.num_rows:
                w = np.c_[np.ones(batch.num_rows), _matrix(batch.column(0))]
                total += w.T @ w
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "s"])

    parts = whitened.select("whitened").mapInArrow(run, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    total = np.zeros((components + 1,) * 2)
    for r in parts.collect():
        total[r["i"], r["j"]] = total[r["j"], r["i"]] = r["s"]
    mean = total[0, 1:] / n
    return float(np.abs(total[1:, 1:] / n - np.outer(mean, mean) - np.eye(components)).max())


def whitening(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error; rows x components.

    Vectors that cannot be fitted give no row (see ``grid``). Components are numbered from 1 by falling
    variance; there are as many as dimensions with variance, at most ``components``, so a table
    without variance, of one row or empty gives no row. Other columns are not read.
    """
    gridded = grid(vectors, id_col, vec_col)
    f = fit(gridded, components)
    if not f.roots:
        empty = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], empty)
    rows = whiten(gridded, f)
    error = identity_error(rows, f.n, len(f.roots))

    def constant(values: list[float]) -> Column:
        return F.array(*[F.lit(v) for v in values])

    share = constant([r / f.trace for r in f.roots])
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened")).select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(f.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(share, F.col("k") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
