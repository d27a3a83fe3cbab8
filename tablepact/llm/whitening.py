"""Exact whitening: the integer scatter's characteristic polynomial, its roots, and their null spaces.

Components are scaled to whole numbers, so n² times their covariance, ``n Σxxᵀ - (Σx)(Σx)ᵀ``, is a matrix of whole
numbers. Its characteristic polynomial is computed exactly: modulo primes by reduction to Hessenberg form (the primes are
dealt over tasks), then combined by Chinese remaindering. All roots of it are real and none is negative, so the
number of roots above a point is exactly the number of sign changes of the shifted polynomial (Descartes' rule is
exact there): bisection isolates each root with its multiplicity, and exact signs refine it far beyond doubles.
Each root's vectors come from inverse iteration in fixed-point arithmetic of the same precision.

The driver sees d x d numbers and polynomials only, never rows. Sums are exact at any size: a task adds blocks that
fit 64 bits and hands sums over in limbs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

#: Whole numbers a component's unit is cut into, and what is added to each (the addition leaves the covariance as it is).
UNITS, ADDED = 64, 1_000_000
#: Bits of a limb; sums of limbs over up to 2**32 tasks fit 64 bits.
LIMB = 30
#: Bits to which roots and null spaces are worked out; closer roots share a null space.
BITS, CLOSE = 192, 96
#: Elements of a block of rows in Python.
BLOCK = 1 << 20


def scaled(df: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """``df`` with ``x`` (array<long>): ``floor(64 c) + 1000000`` of each component.

    Left out: rows whose vector is null, empty or holds null or non-finite components, vectors not of the table's most
    frequent length (the shortest of equally frequent ones), and components beyond 2**56, whose multiples no long holds.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = df.withColumn("x", v).filter("x IS NOT NULL AND size(x) > 0 AND forall(x, c -> c IS NOT NULL AND c = c AND abs(c) < 72057594037927936)")
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    rows = rows.filter(F.size("x") == (sizes[0]["d"] if sizes else 0))
    return rows.withColumn("x", F.expr(f"transform(x, c -> cast(floor({UNITS} * c) AS bigint) + {ADDED})"))


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _blocks(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[np.ndarray]:
    for batch in batches:
        x = _vectors(batch.column(column)) if batch.num_rows else np.empty((0, 1), dtype=np.int64)
        step = max(1, BLOCK // max(1, x.shape[1]))
        for at in range(0, len(x), step):
            yield x[at : at + step]


def _limbs(values: Iterator[tuple[int, int]]) -> pa.RecordBatch:
    """``(cell, limb, part)`` rows of whole numbers of any size."""
    cells, limbs, parts = [], [], []
    for cell, value in values:
        sign, value, k = (-1 if value < 0 else 1), abs(value), 0
        while value or not k:
            cells.append(cell)
            limbs.append(k)
            parts.append(sign * (value & ((1 << LIMB) - 1)))
            value >>= LIMB
            k += 1
    return pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(limbs, pa.int32()), pa.array(parts, pa.int64())], ["cell", "limb", "part"])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's count (cell 0), sums and sums of products of its vectors, less :data:`ADDED`."""
    n, sums, gram = 0, None, None
    for x in _blocks(batches):
        y = x - ADDED
        d = y.shape[1]
        if gram is None:
            sums, gram = [0] * d, np.zeros((d, d), dtype=object)
        top = int(np.abs(y).max(initial=0))
        if top * top * len(y) < 1 << 53:  # every partial sum is exact in doubles
            f = y.astype(np.float64)
            part = (f.T @ f).astype(np.int64).astype(object)
        else:
            o = y.astype(object)
            part = o.T @ o
        gram = gram + part
        sums = [s + int(t) for s, t in zip(sums, y.astype(object).sum(axis=0), strict=True)]
        n += len(y)
    if n:
        d = len(sums)
        # Only half of a symmetric matrix is handed over.
        cells = [(0, n), *((1 + i, s) for i, s in enumerate(sums)), *((1 + d + i * d + j, int(gram[i, j])) for i in range(d) for j in range(i, d))]
        yield _limbs(iter(cells))


def _totals(parts: DataFrame) -> dict[int, int]:
    rows = parts.groupBy("cell", "limb").agg(F.sum("part").alias("part")).collect()
    total: dict[int, int] = {}
    for r in rows:
        total[r["cell"]] = total.get(r["cell"], 0) + (r["part"] << (LIMB * r["limb"]))
    return total


@dataclass(frozen=True)
class Scatter:
    """``n`` vectors of whole numbers: their sums and n² times their covariance."""

    n: int
    sums: list[int]
    matrix: list[list[int]]


def scatter(distinct: DataFrame) -> Scatter:
    """Exact moments of ``distinct(x)``; tasks hand over d² numbers each, added up by Spark."""
    total = _totals(distinct.select("x").mapInArrow(_moments, "cell long, limb int, part long"))
    n = total.get(0, 0)
    d = next((k for k in range(1, 1 << 16) if len(total) == 1 + k + k * (k + 1) // 2), 0) if n else 0
    sums = [total[1 + i] for i in range(d)]
    m = [[0] * d for _ in range(d)]
    for i in range(d):
        for j in range(i, d):
            m[i][j] = m[j][i] = n * total[1 + d + i * d + j] - sums[i] * sums[j]
    return Scatter(n, [s + n * ADDED for s in sums], m)


def _primes(count: int) -> list[int]:
    """The ``count`` largest primes below 2**31: products of two residues fit 64 bits."""
    small = [p for p in range(2, 46341) if all(p % q for q in range(2, math.isqrt(p) + 1))]
    found, top, step = [], 1 << 31, 1 << 20
    while len(found) < count:
        low = top - step
        sieve = np.ones(step, dtype=bool)
        for p in small:
            sieve[(-low) % p :: p] = False
        found += (low + np.flatnonzero(sieve)[::-1]).tolist()
        top = low
    return found[:count]


def charpoly_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of ``det(tI - matrix)`` modulo the prime ``p``, the constant first, by Hessenberg form."""
    h = matrix % p
    d = len(h)
    for k in range(1, d - 1):
        pivot = k + int(np.argmax(h[k:, k - 1] != 0))
        if not h[pivot, k - 1]:
            continue
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        u = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        if u.any():
            h[k + 1 :] = (h[k + 1 :] - u[:, None] * h[k] % p) % p
            # Products are reduced before they are added: a row of them could pass 64 bits otherwise.
            h[:, k] = (h[:, k] + (h[:, k + 1 :] * u % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), dtype=np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - h[k - 1, k - 1] * polys[k - 1]) % p
        run = 1
        for i in range(1, k):
            run = run * int(h[k - i, k - i - 1]) % p
            if not run:
                break
            polys[k] = (polys[k] - (run * int(h[k - i - 1, k - 1]) % p) * polys[k - i - 1]) % p
    return polys[d].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients of ``det(tI - matrix)``, constant first, for a matrix without negative eigenvalues."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    # Of d values >= 0 with this sum, the k-th elementary symmetric function is at most C(d, k) (sum / d)^k.
    bound = max(math.comb(d, k) * (-(-trace // d)) ** k for k in range(d + 1))
    primes = _primes((2 * bound).bit_length() // 30 + 2)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array(matrix, dtype=object)
        for batch in batches:
            for p in batch.column(0).to_pylist():
                got = charpoly_mod((exact % p).astype(np.int64), p)
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([got], pa.list_(pa.int64()))], ["p", "c"])

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks).mapInArrow(residues, "p long, c array<long>").collect()
    # Chinese remaindering, two halves at a time.
    parts = [([r["c"][i] for i in range(d + 1)], r["p"]) for r in rows]
    while len(parts) > 1:
        joined = []
        for (a, p), (b, q) in zip(parts[::2], parts[1::2], strict=False):
            inv = pow(p, -1, q)
            joined.append(([x + p * ((y - x) * inv % q) for x, y in zip(a, b, strict=True)], p * q))
        parts = joined + ([parts[-1]] if len(parts) % 2 else [])
    c, modulus = parts[0]
    return [x - modulus if 2 * x > modulus else x for x in c]


def _scaled_poly(c: list[int], s: int) -> list[int]:
    """The polynomial of the roots times 2**s."""
    d = len(c) - 1
    return [x << (s * (d - k)) for k, x in enumerate(c)]


def _above(c: list[int], a: int) -> int:
    """The number of roots above ``a``, with multiplicity, of a polynomial with real roots only."""
    c = list(c)
    for i in range(len(c) - 1):
        for k in range(len(c) - 2, i - 1, -1):
            c[k] += a * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(c: list[int], a: int) -> int:
    value = 0
    for x in reversed(c):
        value = value * a + x
    return (value > 0) - (value < 0)


@dataclass(frozen=True)
class Root:
    """``multiplicity`` roots (equal, or closer than 2**-CLOSE of themselves), each within 2**-shift above ``low`` / 2**shift."""

    low: int
    shift: int
    multiplicity: int


def largest_roots(c: list[int], count: int) -> list[Root]:
    """The ``count`` largest positive roots, falling, of a polynomial whose roots are real and not negative.

    Exact at any distance between roots. Roots that repeat, or agree in CLOSE bits, are one entry; the last entry keeps all of its roots.
    """
    zero = next(k for k, x in enumerate(c) if x)
    c = c[zero:]
    if len(c) == 1:
        return []
    top = 1 << (max(1, -c[-2]).bit_length() + 1)  # the sum of the roots bounds each
    found: list[Root] = []
    # Intervals (low, high] / 2**shift with their numbers of roots above either end; the highest interval is on top.
    todo = [(0, top, 0, len(c) - 1, 0)]
    have = 0
    while todo and have < count:
        low, high, s, above_low, above_high = todo.pop()
        inside = above_low - above_high
        if not inside:
            continue
        settled = (high - low) << CLOSE <= low
        if settled or (inside == 1 and low and high - low <= low):
            q = _scaled_poly(c, s)
            if inside == 1:  # a single root: exact signs instead of shifts
                at_high = _sign(q, high)
                while at_high and (high - low) << BITS > low:
                    if high - low == 1:
                        low, high, s = 2 * low, 2 * high, s + 1
                        q = _scaled_poly(c, s)
                    mid = (low + high) // 2
                    sign = _sign(q, mid)
                    if sign == 0:
                        low, high = mid - 1, mid
                        break
                    low, high = (low, mid) if sign == at_high else (mid, high)
                if at_high == 0 or high - low == 1 and _sign(q, high) == 0:
                    low = high  # the root itself
                found.append(Root(low, s, 1))
            else:
                while (high - low) << BITS > low:  # a repeated root: halve while all of it stays on one side
                    if high - low == 1:
                        low, high, s = 2 * low, 2 * high, s + 1
                    mid = (low + high) // 2
                    n = _above(_scaled_poly(c, s), mid)
                    if n == above_low:
                        low = mid
                    elif n == above_high:
                        high = mid
                    else:
                        break
                found.append(Root(high, s, inside))
            have += inside
            continue
        if high - low == 1:
            low, high, s = 2 * low, 2 * high, s + 1
        mid = (low + high) // 2
        n = _above(_scaled_poly(c, s), mid)
        todo += [(low, mid, s, above_low, n), (mid, high, s, n, above_high)]
    return found


def null_vectors(matrix: list[list[int]], root: Root) -> np.ndarray:
    """Orthonormal vectors, as rows, of the (numerical) null space of ``matrix - root``, by inverse iteration in fixed point."""
    d = len(matrix)
    size = max(1, max(abs(x) for row in matrix for x in row)).bit_length()
    bits = 2 * BITS + size
    one = 1 << bits
    shift = (root.low << bits) >> root.shift if root.shift <= bits else root.low >> (root.shift - bits)
    a = np.array([[x << bits for x in row] for row in matrix], dtype=object)
    for i in range(d):
        a[i, i] -= shift
    order = list(range(d))
    least = 1 << max(0, bits - BITS)  # stands for a pivot that vanishes: its direction is the null space's
    for k in range(d):
        p = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if p != k:
            a[[k, p]] = a[[p, k]]
            order[k], order[p] = order[p], order[k]
        if abs(a[k, k]) < least:
            a[k, k] = least if a[k, k] >= 0 else -least
        if k + 1 < d:
            a[k + 1 :, k] = (a[k + 1 :, k] << bits) // a[k, k]
            a[k + 1 :, k + 1 :] -= (a[k + 1 :, k, None] * a[k, k + 1 :]) >> bits

    def solve(b: np.ndarray) -> np.ndarray:
        x = b[order]
        for k in range(d):
            if k:
                x[k] -= int((a[k, :k] * x[:k]).sum()) >> bits
        for k in reversed(range(d)):
            rest = int((a[k, k + 1 :] * x[k + 1 :]).sum()) >> bits if k + 1 < d else 0
            x[k] = ((x[k] - rest) << bits) // int(a[k, k])
        return x

    def normed(x: np.ndarray) -> np.ndarray:
        return (x << bits) // math.isqrt(int((x * x).sum()))

    rng = np.random.default_rng(1)
    found: list[np.ndarray] = []
    for _ in range(root.multiplicity):
        x = np.array([int(v) << (bits - 31) for v in rng.integers(1 << 30, 1 << 31, d) * rng.choice([-1, 1], d)], dtype=object)
        for _ in range(4):
            x = normed(solve(x))
            for _ in range(2):
                for f in found:
                    x = x - ((f * (int((f * x).sum()) >> bits)) >> bits)
            x = normed(x)
        found.append(x)
    return np.array([[int(v) / one for v in f] for f in found])


@dataclass(frozen=True)
class Whitener:
    """What rows need: ``n``, sums, and per component its vector, eigenvalue (as a double) and share of the variance."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray


def fit(spark: SparkSession, s: Scatter, components: int = 16) -> Whitener:
    """The ``components`` largest components; fewer if fewer eigenvalues are positive. Each null space is a task of its own."""
    d = len(s.matrix)
    empty = Whitener(s.n, s.sums, np.empty((0, d)), np.empty(0), np.empty(0))
    trace = sum(s.matrix[i][i] for i in range(d))
    if not trace:
        return empty
    roots = largest_roots(characteristic_polynomial(spark, s.matrix), components)
    matrix = s.matrix

    def spaces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                v = null_vectors(matrix, roots[k])
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(v)), pa.array(list(range(len(v)))), pa.array(v.tolist(), pa.list_(pa.float64()))], ["k", "i", "v"])

    rows = spark.range(0, len(roots), 1, len(roots)).mapInArrow(spaces, "k long, i long, v array<double>").collect()
    rows = sorted(rows, key=lambda r: (r["k"], r["i"]))[:components]
    of = [roots[r["k"]] for r in rows]
    # n² e is root.low / 2**shift; whole numbers are divided at once, so each double is the nearest.
    values = np.array([r.low / (s.n * s.n << r.shift) for r in of])
    return Whitener(s.n, s.sums, np.array([r["v"] for r in rows]), values, np.array([r.low / (trace << r.shift) for r in of]))


def _projected(w: Whitener, x: np.ndarray) -> np.ndarray:
    """Whitened rows of whole numbers ``x``."""
    whole = [s // w.n for s in w.sums]
    rest = np.array([(s - t * w.n) / w.n for s, t in zip(w.sums, whole, strict=True)])
    # The mean's whole part is taken away exactly, its fraction in doubles.
    return ((x - np.array(whole, dtype=np.int64)).astype(np.float64) - rest) @ (w.vectors / np.sqrt(w.values)[:, None]).T


def identity_error(distinct: DataFrame, w: Whitener) -> float | None:
    """The largest absolute entry of the whitened fit list's covariance minus the identity; null without components."""
    k = len(w.values)
    if not k:
        return None

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, gram = np.zeros(k), np.zeros((k, k))
        for x in _blocks(batches):
            y = _projected(w, x)
            sums += y.sum(axis=0)
            gram += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(k + k * k), pa.int32()), pa.array(np.concatenate([sums, gram.ravel()]))], ["cell", "part"])

    rows = distinct.select("x").mapInArrow(moments, "cell int, part double").groupBy("cell").agg(F.sum("part").alias("part")).collect()
    total = np.zeros(k + k * k)
    for r in rows:
        total[r["cell"]] = r["part"]
    mean = total[:k] / w.n
    return float(np.abs(total[k:].reshape(k, k) / w.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """``Σ (n x - S)²`` of each row, exact; none where no long holds it."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = [s % n for s in sums]
    y = x - whole
    top = int(np.abs(y).max(initial=0)) + 1
    if (top * n) ** 2 * x.shape[1] < 1 << 63:
        t = y * n - np.array(rest, dtype=np.int64)
        return (t * t).sum(axis=1).tolist()
    t = y.astype(object) * n - np.array(rest, dtype=object)
    return [v if v < 1 << 63 else None for v in map(int, (t * t).sum(axis=1))]


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: a row per remaining row and component.

    Components are fitted on each distinct scaled vector once. Rows are kept under any id, null and repeated ones too.
    There is no row where no eigenvalue is positive (one distinct vector, or none). A deviation that no long holds is null.
    """
    spark = df.sparkSession
    rows = scaled(df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")), "v").select("vec_id", "x")
    distinct = written(rows.select("x").distinct(), "distinct")
    s = scatter(distinct)
    w = fit(spark, s, components)
    k, error = len(w.values), identity_error(distinct, w)
    schema = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double".format(rows.schema["vec_id"].dataType.simpleString())
    if not k:
        return spark.createDataFrame([], schema)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, BLOCK // max(1, k * len(w.sums)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = _vectors(part.column(1))
                m = len(x)
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n, dtype=np.int64)),
                    pa.array(_deviations(x, w.n, w.sums), pa.int64()).take(pa.array(each)), pa.array(_projected(w, x).ravel()),
                    pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(out, schema)
