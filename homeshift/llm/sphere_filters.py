"""Operator 2: embedding near-duplicates by spherical-cap filters from random product codes.

A filter direction is the concatenation of one code word from each of two blocks of
coordinates (random rotation first, then random unit code words), so ``words`` code words a block make
``words ** 2`` directions.  A vector passes every filter whose inner product reaches the cap
height; list decoding finds them without trying all: a block's scores are sorted, and a pair
of words is looked at only while the best partner still reaches the height.  A vector that
passes fewer than ``least`` filters takes its best ones.  Vectors that share a filter are compared exactly
(cosine in double precision), so no pair below the threshold is linked.

Size: the height, from the exact distribution of inner products with a direction, puts about ``bucket``
vectors into a filter.  A vector has about ``filters`` filters and at least ``least``; both are raised
on the driver until random pairs at the threshold itself meet with probability ``recall``, so they
grow slowly with the number n of vectors; comparisons are about n * filters * bucket / 2.  Where ``MOST_FILTERS`` filters a
vector do not reach it (very short vectors, thresholds far from 1, negative ones), one filter holds all vectors of that length:
every pair is compared, block by block.

Counting without pairs: a pair is counted in the first filter that both vectors share (each entry carries
its vector's filters), so links are summed per vector and never listed.  Components use one edge per vector
and filter, to the smallest vector it reaches inside the filter.

Skew: equal directions collapse first (their copies count as links).  A filter with more
than ``BLOCK`` vectors is cut into blocks by a hash, and every pair of blocks is a task of
its own; all pairs are still compared.

Recall is measured against brute force in the tests (at least 0.99 there), and at the threshold for up to 100 million vectors.

Defined results: a vector that is null, empty, zero, or holds a null or non-finite component
has no links and is its own component; vectors of different lengths do not link; a repeated
id counts as a further vector of that id; a null id gets a null component; a cosine equal to the threshold links; other columns of the
input, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeshift.llm.common import shuffle_partitions
from homeshift.llm.components import components
from homeshift.session import materialize

BLOCK = 1024
PROBES, MOST_FILTERS = 4000, 512
COLUMNS = 2048
SEED = 20240229


def cap_height(dim: int, share: float, grid: int = 400) -> float:
    """Height that the inner product of a random unit vector and a product code's direction reaches with probability ``share``.

    The vector's parts in the two blocks have lengths cos(phi) and sin(phi); a part's
    cosine with a unit code word has the angle's density sin ** (block - 2).
    """
    if dim < 2:
        return 2.0  # never reached: a vector takes its best filters
    h, k = (dim + 1) // 2, dim - (dim + 1) // 2
    mid = (np.arange(grid) + 0.5) / grid
    phi = mid * math.pi / 2
    w = np.cos(phi) ** (h - 1) * np.sin(phi) ** (k - 1)
    w /= w.sum()
    v, wv = (np.cos(mid * math.pi), np.sin(mid * math.pi) ** (k - 2)) if k > 1 else (np.array([1.0, -1.0]), np.ones(2))
    wv = wv / wv.sum()
    angle = np.linspace(0, math.pi, 10 * grid + 1)
    below = np.r_[0, np.cumsum(np.sin((angle[1:] + angle[:-1]) / 2) ** max(0, h - 2))]

    def tail(t: float) -> float:
        z = (t - np.sin(phi)[:, None] * v) / np.cos(phi)[:, None]
        if h == 1:
            return float(w @ np.where(z <= -1, 1, np.where(z <= 1, 0.5, 0)) @ wv)
        return float(w @ np.interp(np.arccos(np.clip(z, -1, 1)), angle, below / below[-1]) @ wv)

    lo, hi = 0.0, math.sqrt(2)
    for _ in range(40):
        t = (lo + hi) / 2
        lo, hi = (t, hi) if tail(t) > share else (lo, t)
    return lo


class ProductCode:
    """Two blocks of random code words after a random rotation, for vectors of one length."""

    def __init__(self, dim: int, n: int, filters: float, bucket: int, least: int):
        rng = np.random.default_rng(SEED + dim)
        self.least, self.whole = least, False
        self.rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        share = min(0.1, bucket / max(n, 1))  # share of vectors in a filter
        self.words = max(8, math.ceil(math.sqrt(filters / share)))
        self.half = (dim + 1) // 2
        a = rng.normal(size=(self.words, self.half))
        b = rng.normal(size=(self.words, max(1, dim - self.half)))
        self.a = a / np.linalg.norm(a, axis=1, keepdims=True)
        self.b = b / np.linalg.norm(b, axis=1, keepdims=True)
        self.height = cap_height(dim, share)

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        """Sorted filter numbers of each unit vector of ``x``."""
        if self.whole:
            return [np.zeros(1, np.int64)] * len(x)
        y = x @ self.rotation
        s = y[:, : self.half] @ self.a.T
        t = y[:, self.half :] @ self.b.T if y.shape[1] > self.half else np.zeros((len(x), self.words))
        out = []
        for u, v in zip(s, t):
            p, q = np.argsort(-u), np.argsort(-v)
            us, vs = u[p], -v[q]  # descending, ascending negatives
            reach = np.searchsorted(vs, us - self.height, side="right")  # partners of each word that reach the height
            k = int(np.argmax(reach == 0)) if (reach == 0).any() else len(reach)
            n = int(reach[:k].sum())
            if n < self.least:
                m = min(self.words, self.least)
                best = (us[:m, None] - vs[None, :m]).ravel().argsort(kind="stable")[::-1][: self.least]
                got = p[best // m] * self.words + q[best % m]
            else:
                first = np.repeat(np.arange(k), reach[:k])
                second = np.arange(n) - np.repeat(np.cumsum(reach[:k]) - reach[:k], reach[:k])
                got = p[first] * self.words + q[second]
            out.append(np.sort(got))
        return out


def pairs_at(dim: int, cosine: float, m: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``m`` random pairs of unit vectors with the given cosine."""
    rng = np.random.default_rng(seed)
    x, z = rng.normal(size=(2, m, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    return x, cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * z


def recall_at(code: ProductCode, x: np.ndarray, y: np.ndarray) -> float:
    """Share of the pairs that meet in a filter."""
    met = 0
    for at in range(0, len(x), 500):
        both = zip(code.decode(x[at : at + 500]), code.decode(y[at : at + 500]))
        met += sum(bool(len(np.intersect1d(a, b, assume_unique=True))) for a, b in both)
    return met / len(x)


def fitted_code(dim: int, n: int, cosine: float, recall: float, filters: float, bucket: int, least: int) -> ProductCode:
    """The code with the fewest filters a vector that reaches ``recall`` on random pairs at the threshold itself, from the given numbers on.

    If none of at most ``MOST_FILTERS`` does, its only filter holds every vector, so no pair is missed.
    """
    code = ProductCode(dim, n, filters, bucket, least)
    if dim < 2 or n < 2 or not 0 <= cosine <= 1:
        code.whole = True
        return code
    probes = [pairs_at(dim, cosine, PROBES, SEED + i) for i in range(2)]
    while any(recall_at(code, x, y) < recall for x, y in probes):
        if least >= MOST_FILTERS:
            code.whole = True
            break
        least *= 2
        code = ProductCode(dim, n, max(filters, least / 2), bucket, least)
    return code


def usable(vec: str):
    """Whether a vector column has a direction: not null or empty, all components finite, not all zero."""
    v = F.col(vec)
    size = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.exists(v, lambda x: x != 0) & ~size, F.lit(False))


def _directions(col: pa.Array) -> np.ndarray:
    """Unit vectors in double precision, one row each; scaled first, so that squares neither overflow nor vanish."""
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _entries(codes: dict[int, ProductCode]):
    """(node, copies, vec) -> (dim, filter, node, copies, vec, filters), one row for each filter that a vector passes."""

    def run(batches):
        for b in batches:
            dims = b.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                own = b.filter(pa.array(dims == dim))
                for at in range(0, own.num_rows, 500):
                    part = own.slice(at, 500)
                    lists = codes[int(dim)].decode(_directions(part.column(2)))
                    row = pa.array(np.repeat(np.arange(len(lists)), [len(x) for x in lists]))
                    flat = np.concatenate(lists)
                    whole = pa.array(lists, pa.list_(pa.int64())).take(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(flat), dim), pa.int32()), pa.array(flat), part.column(0).take(row), part.column(1).take(row), part.column(2).take(row), whole],
                        ["dim", "filter", "node", "copies", "vec", "filters"],
                    )

    return run


def _filter_numbers(codes: dict[int, ProductCode]):
    def run(batches):
        for b in _entries(codes)(batches):
            yield b.select(["dim", "filter"])

    return run


def _smallest_reached(link: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Smallest node that each row reaches by links inside the matrix."""
    low = node.copy()
    while True:
        new = np.minimum(low, np.where(link, low[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == low).all():
            return low
        low = new


def _links_in_filter(mine: int, side: np.ndarray, node: np.ndarray, copies: np.ndarray, x: np.ndarray, lists: pa.Array, cosine: float):
    """(nodes with links, links counted here, smallest node reached) of the vectors of one filter, or None."""
    link = x @ x.T >= cosine
    np.fill_diagonal(link, False)
    if side.min() != side.max():  # two blocks: pairs inside a block belong to another task
        link &= side[:, None] != side[None, :]
    keep = np.flatnonzero(link.any(axis=1))
    if not len(keep):
        return None
    link, node, copies, lists = link[np.ix_(keep, keep)], node[keep], copies[keep], lists.take(pa.array(keep))
    # a pair counts in its first common filter: here, unless a smaller filter holds both
    row = np.repeat(np.arange(len(keep)), lists.value_lengths().to_numpy())
    flat = lists.flatten().to_numpy()
    row, flat = row[flat < mine], flat[flat < mine]
    _, col, held = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.cumsum(held > 1) - 1  # filters that several rows hold, COLUMNS at a time
    row, col = row[held[col] > 1], number[col[held[col] > 1]]
    met = np.zeros(link.shape, bool)
    for at in range(0, int(col.max()) + 1 if len(col) else 0, COLUMNS):
        here = (col >= at) & (col < at + COLUMNS)
        has = np.zeros((len(keep), COLUMNS), np.float32)
        has[row[here], col[here] - at] = 1
        met |= (has @ has.T) > 0
    first_here = link & ~met
    return node, first_here @ copies, _smallest_reached(link, node)


def _compare(cosine: float):
    """Entries sorted by (dim, filter, i, j) -> (node, links, least): counted links and the smallest node reached."""

    def groups(t: pa.RecordBatch):
        key = np.stack([t.column(i).to_numpy() for i in range(4)], axis=1)
        cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        out = [[], [], []]
        for lo, hi in zip(np.r_[0, cut], np.r_[cut, len(key)]):
            if hi - lo > 1:
                part = t.slice(lo, hi - lo)
                got = _links_in_filter(int(key[lo, 1]), part.column(4).to_numpy(), part.column(5).to_numpy(), part.column(6).to_numpy(), _directions(part.column(7)), part.column(8), cosine)
                if got:
                    for c, v in zip(out, got):
                        c.append(v)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], ["node", "links", "least"])

    def run(batches):
        def key(b: pa.RecordBatch, r: int) -> tuple:
            return tuple(b.column(i)[r].as_py() for i in range(4))

        held: list[pa.RecordBatch] = []
        for b in batches:  # the last group of a batch may go on in the next one
            if not b.num_rows:
                continue
            held.append(b)
            last = key(b, b.num_rows - 1)
            if last == key(held[0], 0):
                continue
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            r = t.num_rows - 1
            while key(t, r) == last:
                r -= 1
            yield from groups(t.slice(0, r + 1))
            held = [t.slice(r + 1)]
        if held:
            yield from groups(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return run


def embedding_components(
    vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding", filters: float = 16, bucket: int = 64, least: int = 8, recall: float = 0.9995
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row; two vectors link at a cosine of ``cosine`` or more."""
    spark = vectors.sparkSession
    parts = shuffle_partitions(spark)
    element = vectors.schema[vec_col].dataType.elementType.simpleString()
    element = element if element == "float" else "double"
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(f"array<{element}>").alias("vec"))
    rows = materialize(own.withColumn("node", F.when(F.col("id").isNotNull() & usable("vec"), F.xxhash64("vec"))), "sphere-rows")
    nodes = rows.where("node is not null").groupBy("node").agg(F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
    nodes = materialize(nodes, "sphere-nodes")
    sizes = nodes.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row for each length of a vector
    codes = {r["d"]: fitted_code(r["d"], r["n"], cosine, recall, filters, bucket, least) for r in sizes}
    source = nodes.select("node", "copies", "vec")
    entries = source.mapInArrow(_entries(codes), f"dim int, filter long, node long, copies long, vec array<{element}>, filters array<long>")
    counts = source.mapInArrow(_filter_numbers(codes), "dim int, filter long").groupBy("dim", "filter").agg(F.count(F.lit(1)).alias("m"))
    large = counts.where(F.col("m") > BLOCK).select("dim", "filter", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    cut = entries.join(large, ["dim", "filter"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    dealt = cut.select("dim", "filter", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.alias("side"), "node", "copies", "vec", "filters")
    dealt = dealt.repartition(parts, "dim", "filter", "i", "j").sortWithinPartitions("dim", "filter", "i", "j")
    found = materialize(dealt.mapInArrow(_compare(cosine), "node long, links long, least long"), "sphere-links")
    comp = components(found.select(F.col("node").alias("a"), F.col("least").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = nodes.drop("vec").join(links, "node", "left").join(comp, "node", "left")
    placed = placed.select("node", "copies", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("root"))
    low = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    final = placed.join(low, "root").select("node", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.select("id", "node").join(final, "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
