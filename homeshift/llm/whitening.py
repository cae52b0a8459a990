"""Operator 13: embedding whitening from the exact characteristic polynomial of the integer scatter.

Every entry c becomes the integer x = floor(1024 c) + 100000, so the scatter M = n * sum(x x') - S S' = n^2 * covariance is
an integer matrix, the same for any integer shift of x.  It is summed exactly: tasks add small integers in
doubles that hold them exactly, and send their sums as limbs of 40 bits that Spark adds as longs.

The fit then is exact but for roundings that are stated:

1. the characteristic polynomial of M modulo many primes below 2^31, by reduction to Hessenberg form (a Spark task for
   a block of primes), joined by Chinese remaindering; the number of primes follows from a bound on the coefficients;
2. real roots: M has real roots only, so the sign changes of the shifted polynomial count the roots above a point
   exactly; bisection in integers isolates the largest roots and narrows each to 2^-``BITS``;
3. components: inverse iteration on M - root * I with ``DIGITS`` decimal digits, orthogonal within a repeated root.

Whitened values are one pass over the vectors; their covariance, and its distance from the identity, comes from the
written result (``covar_pop``, which centres before multiplying).

Memory: an Arrow batch; the driver holds d x d integers for each vector length d, never rows.  No key is hot: a task sends
d * (d + 1) / 2 sums.  Tables lie in the shared checkpoint folder.

Defined results: a null vector, or one with a null or non-finite entry, is dropped; a null id is kept; repeated rows
count each; vectors of several lengths are fitted each length on its own; an empty vector has no components; fewer
components than asked for are returned when the covariance has a lower rank (none when all vectors are equal); a
deviation beyond 64 bits is null; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeshift.llm.common import shuffle_partitions
from homeshift.session import materialize

SCALE, SHIFT = 1024, 100_000
LIMB = 40
BITS = 96
DIGITS = 90
EXACT_ROWS = 1 << 12  # rows of entries below 2^20 whose products sum below 2^53


@dataclass(frozen=True)
class Model:
    """Fitted whitening of the vectors of one length; ``roots`` are those of the integer scatter (n^2 times the covariance)."""

    dim: int
    n: int
    sums: list[int]  # of x, by dimension
    trace: int  # of the integer scatter
    roots: list[Decimal]
    components: np.ndarray  # one unit row a component

    @property
    def eigenvalues(self) -> list[float]:
        return [float(r / (self.n * self.n)) for r in self.roots]

    @property
    def explained(self) -> list[float]:
        return [float(r / self.trace) for r in self.roots]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(v.isNotNull() & ~bad).select(F.col(id_col).alias("id"), v.alias("v"))


def integers(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of the batch, floor(1024 c) of their entries) for each vector length; whole numbers as doubles."""
    col = batch.column(batch.schema.get_field_index("v"))
    ends = np.asarray(col.offsets, dtype=np.int64)
    sizes = np.diff(ends)
    flat = np.asarray(col.values, dtype=np.float64)
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        at = ends[:-1][rows][:, None] + np.arange(d)
        yield rows, np.floor(SCALE * flat[at])


def _exact(y: np.ndarray) -> np.ndarray:
    """Whole doubles as Python integers."""
    return np.array([[int(v) for v in row] for row in y], dtype=object).reshape(y.shape)


def scatter_sums(batches) -> dict[int, list]:
    """By vector length: [count, sums, sums of products], as Python integers."""
    sums: dict[int, list] = {}
    for b in batches:
        for _, y in integers(b):
            d = y.shape[1]
            s = sums.setdefault(d, [0, np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)])
            s[0] += len(y)
            small = np.abs(y).max(axis=1, initial=0) < 1 << 20
            fast = y[small]
            for at in range(0, len(fast), EXACT_ROWS):
                z = fast[at : at + EXACT_ROWS]
                s[1] = s[1] + _exact(z.sum(axis=0)[None])[0]
                s[2] = s[2] + _exact(z.T @ z)
            if not small.all():
                z = _exact(y[~small])
                s[1] = s[1] + z.sum(axis=0)
                s[2] = s[2] + z.T.dot(z)
    return sums


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(position, limb) with value = sum(limb * 2^(40 * position)); limbs have the sign of the value."""
    sign, value, k = (-1 if value < 0 else 1), abs(value), 0
    while value:
        low = value & ((1 << LIMB) - 1)
        if low:
            yield k, sign * low
        value >>= LIMB
        k += 1


def scatter(vectors: DataFrame) -> dict[int, tuple[int, list[int], list[list[int]]]]:
    """By vector length: (n, sums of y, sums of products of y) with y = floor(1024 c)."""

    def run(batches):
        rows = []
        for d, (n, s, g) in scatter_sums(batches).items():
            rows += [(d, -1, -1, k, v) for k, v in limbs(n)]
            for i in range(d):
                rows += [(d, -1, i, k, v) for k, v in limbs(s[i])]
                rows += [(d, i, j, k, v) for j in range(i, d) for k, v in limbs(g[i, j])]
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in cols[:4]] + [pa.array(cols[4], pa.int64())], ["d", "i", "j", "k", "v"])

    parts = vectors.select("v").mapInArrow(run, "d int, i int, j int, k int, v long")
    got: dict[int, tuple] = {}
    for d, i, j, k, v in parts.groupBy("d", "i", "j", "k").agg(F.sum("v").alias("v")).collect():  # at most d * (d + 3) / 2 sums a length
        count, s, g = got.setdefault(d, ([0], [0] * d, [[0] * d for _ in range(d)]))
        value = v << (LIMB * k)
        if j < 0:
            count[0] += value
        elif i < 0:
            s[j] += value
        else:
            g[i][j] += value
            if i != j:
                g[j][i] += value
    return {d: (count[0], s, g) for d, (count, s, g) in got.items()}


# --------------------------------------------------- characteristic polynomial

def is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide every number below 2^32."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for a in (2, 3, 5, 7):
        x = pow(a, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """Primes below 2^31, from the largest down, whose product is above ``bound``."""
    out, product, n = [], 1, (1 << 31) + 1
    while product <= bound:
        n -= 2
        if is_prime(n):
            out.append(n)
            product *= n
    return out


def coefficient_bound(m: list[list[int]]) -> int:
    """The k-th elementary symmetric function of d numbers that are not negative is at most C(d, k) * (their mean)^k."""
    d = len(m)
    mean = -(-sum(m[i][i] for i in range(d)) // d)
    return max(math.comb(d, k) * mean**k for k in range(d + 1))


def charpoly_mod(m: np.ndarray, p: int) -> list[int]:
    """Coefficients, from the constant on, of det(x I - m) modulo the prime ``p`` < 2^31: Hessenberg form, then its recurrence."""
    a, d = m.copy(), len(m)
    for c in range(d - 2):
        r = c + 1
        below = np.flatnonzero(a[r:, c])
        if not len(below):
            continue
        if below[0]:
            other = r + int(below[0])
            a[[r, other]] = a[[other, r]]
            a[:, [r, other]] = a[:, [other, r]]
        f = a[r + 1 :, c] * pow(int(a[r, c]), -1, p) % p
        a[r + 1 :] = (a[r + 1 :] - f[:, None] * a[r] % p) % p
        a[:, r] = (a[:, r] + (a[:, r + 1 :] * f % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), dtype=np.int64)
    polys[0, 0] = 1
    for k in range(d):
        new = np.zeros(d + 1, dtype=np.int64)
        new[1:] = polys[k, :-1]
        run, weight = 1, np.zeros(k + 1, dtype=np.int64)
        weight[k] = a[k, k]
        for i in range(k - 1, -1, -1):
            run = run * int(a[i + 1, i]) % p
            if not run:
                break
            weight[i] = run * int(a[i, k]) % p
        polys[k + 1] = (new - (weight[:, None] * polys[: k + 1] % p).sum(axis=0)) % p
    return polys[d].tolist()


def characteristic_polynomial(spark, m: list[list[int]]) -> list[int]:
    """Coefficients, from the constant on, of det(x I - m) for a positive semidefinite integer matrix."""
    d = len(m)
    primes = primes_for(2 * coefficient_bound(m))

    def run(batches):
        for b in batches:
            found = b.column(0).to_pylist()
            rows = [charpoly_mod(np.array([[v % p for v in row] for row in m], dtype=np.int64).reshape(d, d), p) for p in found]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(rows, pa.list_(pa.int64()))], ["p", "c"])

    parts = max(1, min(len(primes), shuffle_partitions(spark)))
    work = spark.createDataFrame([(p,) for p in primes], "p long").repartition(parts)
    value, product = [0] * (d + 1), 1
    for p, c in work.mapInArrow(run, "p long, c array<long>").collect():  # d + 1 residues a prime
        inverse = pow(product, -1, p)
        value = [v + product * ((r - v) * inverse % p) for v, r in zip(value, c)]
        product *= p
    return [v - product if 2 * v > product else v for v in value]


# ----------------------------------------------------------------------- roots

def shifted(c: list[int], t: int) -> list[int]:
    """Coefficients of p(x + t)."""
    c = list(c)
    for k in range(len(c) - 1):
        for i in range(len(c) - 2, k - 1, -1):
            c[i] += t * c[i + 1]
    return c


def roots_above(c: list[int], t: int) -> int:
    """Number of roots above ``t``, with multiplicity, of a polynomial with real roots only."""
    signs = [v > 0 for v in shifted(c, t) if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value_at(c: list[int], t: int) -> int:
    out = 0
    for v in reversed(c):
        out = out * t + v
    return out


def largest_roots(c: list[int], k: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(root * 2^bits rounded up, multiplicity) of the largest positive roots, until ``k`` roots are counted."""
    d = len(c) - 1
    q = [v << (bits * (d - i)) for i, v in enumerate(c)]  # roots times 2^bits
    positive = roots_above(q, 0)
    top = 1 << max(1, (abs(c[d - 1]) << bits).bit_length())  # no root is above the sum of all
    todo, found = [(0, top, positive, 0)], []
    while todo and sum(m for _, m in found) < k:
        lo, hi, above_lo, above_hi = todo.pop()
        if above_lo == above_hi:
            continue
        if above_lo - above_hi == 1:  # isolated: the sign alone tells the side
            while hi - lo > 1:
                mid = (lo + hi) // 2
                v = value_at(q, mid)
                if v == 0:
                    lo, hi = mid - 1, mid
                elif (v > 0) == (above_hi % 2 == 0):
                    hi = mid
                else:
                    lo = mid
            found.append((hi, 1))
        elif hi - lo == 1:  # several roots within 2^-bits
            found.append((hi, above_lo - above_hi))
        else:
            mid = (lo + hi) // 2
            n = roots_above(q, mid)
            todo += [(lo, mid, above_lo, n), (mid, hi, n, above_hi)]  # the upper half first
    return found


# ------------------------------------------------------------------ components

def _dot(a, b, ctx):
    out = Decimal(0)
    for x, y in zip(a, b):
        out = ctx.fma(x, y, out)
    return out


def null_vectors(m: list[list[int]], root: Decimal, count: int, ctx: Context) -> list[list[Decimal]]:
    """``count`` orthonormal vectors of the null space of m - root * I: LU with row exchanges, then inverse iteration."""
    d = len(m)
    a = [[ctx.subtract(Decimal(m[i][j]), root) if i == j else Decimal(m[i][j]) for j in range(d)] for i in range(d)]
    largest = max(abs(v) for row in a for v in row) or Decimal(1)
    tiny = ctx.multiply(largest, Decimal(10) ** -(ctx.prec - 5))
    order = list(range(d))
    for c in range(d):
        best = max(range(c, d), key=lambda r: abs(a[r][c]))
        a[c], a[best] = a[best], a[c]
        order[c], order[best] = order[best], order[c]
        if abs(a[c][c]) < tiny:
            a[c][c] = tiny
        for r in range(c + 1, d):
            if a[r][c]:
                f = ctx.divide(a[r][c], a[c][c])
                row, piv = a[r], a[c]
                row[c] = f
                for j in range(c + 1, d):
                    row[j] = ctx.fma(-f, piv[j], row[j])
    rng, out = random.Random(d), []
    for _ in range(count):
        v = [Decimal(rng.randint(-1000, 1000)) for _ in range(d)]
        for _ in range(4):
            x = [v[i] for i in order]
            for r in range(d):
                x[r] = ctx.subtract(x[r], _dot(a[r][:r], x[:r], ctx))
            for r in range(d - 1, -1, -1):
                x[r] = ctx.divide(ctx.subtract(x[r], _dot(a[r][r + 1 :], x[r + 1 :], ctx)), a[r][r])
            for _ in range(2):
                for u in out:
                    f = _dot(u, x, ctx)
                    x = [ctx.fma(-f, p, q) for p, q in zip(u, x)]
            size = ctx.sqrt(_dot(x, x, ctx))
            v = [ctx.divide(p, size) for p in x]
        out.append(v)
    return out


def solve(spark, n: int, sums: list[int], products: list[list[int]], count: int) -> Model:
    """Model of one vector length from the sums of y and of products of y."""
    d = len(sums)
    m = [[n * products[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    trace = sum(m[i][i] for i in range(d))
    whole = [s + n * SHIFT for s in sums]
    if not trace:
        return Model(d, n, whole, 0, [], np.zeros((0, d)))
    poly = characteristic_polynomial(spark, m)
    ctx = Context(prec=DIGITS + len(str(trace)))
    roots, parts = [], []
    for scaled, times in largest_roots(poly, count):
        root = ctx.divide(Decimal(scaled), Decimal(1 << BITS))
        for v in null_vectors(m, root, min(times, count - len(roots)), ctx):
            u = np.array([float(x) for x in v])
            parts.append(u if u[np.argmax(np.abs(u))] > 0 else -u)
            roots.append(root)
    return Model(d, n, whole, trace, roots, np.array(parts).reshape(len(roots), d))


def fit(vectors: DataFrame, count: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> dict[int, Model]:
    """Models by vector length, fitted on all usable vectors."""
    spark = vectors.sparkSession
    sums = scatter(usable(vectors, id_col, vector_col))
    return {d: solve(spark, *s, count) for d, s in sorted(sums.items()) if d}


# ------------------------------------------------------------------- whitening

def _int64_or_none(values) -> pa.Array:
    return pa.array([int(v) if -(1 << 63) <= v < 1 << 63 else None for v in values], pa.int64())


def whiten(vectors: DataFrame, models: dict[int, Model], id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, dim, n, deviation, whitened array) of every usable vector whose length was fitted."""
    kind = vectors.schema[id_col].dataType.simpleString()
    scaled = {d: (m.n, [s - m.n * SHIFT for s in m.sums], m.components / np.sqrt([float(r) for r in m.roots])[:, None] if m.roots else m.components) for d, m in models.items()}

    def run(batches):
        for b in batches:
            for rows, y in integers(b):
                d = y.shape[1]
                if d not in scaled or not len(rows):
                    continue
                n, s, w = scaled[d]
                far = n * float(np.abs(y).max()) + max(map(abs, s))
                if far * far * d < 2.0**62:
                    dev = n * y.astype(np.int64) - np.array(s, dtype=np.int64)
                else:
                    dev = n * _exact(y) - np.array(s, dtype=object)
                out = dev.astype(np.float64) @ w.T
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), d, np.int32)), pa.array(np.full(len(rows), n, np.int64)),
                    _int64_or_none((dev * dev).sum(axis=1)), pa.array(list(out), pa.list_(pa.float64())),
                ], ["id", "dim", "n", "deviation", "w"])

    return usable(vectors, id_col, vector_col).mapInArrow(run, f"id {kind}, dim int, n long, deviation long, w array<double>")


def identity_errors(rows: DataFrame, count: int) -> dict[int, float]:
    """By vector length: the largest entry, without its sign, of the whitened values' covariance minus the identity."""
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    cell = [F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))) - F.lit(float(i == j)) for i, j in pairs]
    worst = F.greatest(*[F.coalesce(F.abs(c), F.lit(0.0)) for c in cell], F.lit(0.0))
    return {r["dim"]: r["e"] for r in rows.groupBy("dim").agg(worst.alias("e")).collect()}  # one row a vector length


def whitened_components(vectors: DataFrame, count: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row a usable vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    models = fit(vectors, count, id_col, vector_col)
    rows = materialize(whiten(vectors, models, id_col, vector_col), "whitened")
    errors = identity_errors(rows, count)
    none = F.lit(None).cast("double")
    explained = F.coalesce(*[F.when(F.col("dim") == d, F.array(*[F.lit(x) for x in m.explained])) for d, m in models.items() if m.roots], F.array(none))
    error = F.coalesce(*[F.when(F.col("dim") == d, F.lit(e)) for d, e in errors.items()], none)
    long = rows.select("id", "n", "deviation", explained.alias("x"), error.alias("identity_error"), F.posexplode("w").alias("i", "whitened"))
    return long.select(F.col("id").alias(id_col), (F.col("i") + 1).alias("component"), "n", "deviation", "whitened", F.get("x", "i").alias("explained"), "identity_error")
