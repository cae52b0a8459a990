"""Operator 3: exact Jaccard join of word n-gram sets, with set-relation skipping.

Two documents link when inter * 100 >= 80 * union over their sets of 5-word shingles.
The result has one row per document: set size and smallest id reachable by links.

Stages (each written table lies in the shared checkpoint folder)
1. Reduction.  A shingle that occurs in one document only can't be shared, so a
   document with a link has at least 80 % shingles of frequency two or more.  Mappers send
   sorted, delta-coded shingle keys by key range (about 5 bytes a shingle); a key that several documents
   of a mapper's chunk hold is shared for certain and goes on once, with its count.  Each range counts
   its keys and returns, for each document, how many of the other shingles are shared.  Most documents end
   here, exactly: key truncation can only raise a count.
2. Sets.  Equal sets collapse to one node.  Texts of the remaining nodes are read again
   (a Bloom filter of their ids, at most 2 MB, thins the scan) and stored as sorted 64-bit shingles.
3. Index lists by position.  Shingles are ordered from rare to frequent (the
   ``COMMON`` most frequent shingles last, then by hash); the first n - ceil(0.8 n) + 1 of a
   set are posted with their position and the set's size.
4. Related sets.  Every node's home is the smallest-ranked node of its lists.  Sets travel to their home
   once; there, links are found among highly similar sets, deriving a set's answers from
   those of the pivots it was compared with: Jaccard distance is a metric, so distances to a
   common pivot prove or exclude most links, and sets that are already connected are not compared.
   A home above ``BLOCK_SETS`` sets is cut into blocks; up to ``PIVOTS`` of its sets are compared in every
   block, so the groups of near copies that hold one of them are connected across the blocks.
5. The rest.  Lists with more than one component and home are walked for pairs of different homes that
   are not connected yet; entries are in order of size, those outside the size window are skipped, and the
   positions bound the possible overlap.  The remaining pairs are verified on the whole sets.
   A list above ``LIST_BLOCK`` entries is cut into blocks by a hash, apart for its largest component, and
   every pair of blocks is a task of its own, but for pairs of blocks inside the largest component.
6. Components of the links; the smallest id of a component goes to all its documents.

No pair is lost: stages 1, 3 and 5 only skip pairs that can't reach the threshold, stage 4 only pairs
that are connected anyway.  Sets are compared by 64-bit shingle hashes.

Skew: a key reaches its range at most once a chunk, however many documents of the chunk hold it; equal texts are one node after a map-side aggregate; homes with more than
``BLOCK_SETS`` sets are cut into blocks whose cross pairs, if pivots left them unconnected, fall to
stage 5; long lists are cut into pairs of blocks; key ranges are ranges of hashes.  Unconnected sets that
share a prefix shingle are still compared pair by pair: that part grows with the square of their number.  Memory: a mapper holds ``CHUNK_TEXT`` bytes of text at a time, a counting
task one key range (about ``RANGE_TEXT`` bytes of text).

Defined results: null or empty texts have size 0 and link with nothing; shorter texts
than k words have one shingle; a null id gets a null component; rows
that repeat an id share the smallest component of their own texts' nodes; very long texts are sets like any other; a similarity
equal to the threshold links; other columns of the input, whatever their names, are ignored; empty table, empty result.
``docs`` should be a table scan: rows must come in the same order when a task runs again.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from homeshift.llm.common import shuffle_partitions
from homeshift.llm.components import components
from homeshift.llm.flat_text import U, mix64, shingle_hashes, spans_hash, string_chunks
from homeshift.session import materialize

CHUNK_TEXT = 3_000_000
RANGE_TEXT = 8_000_000
COMMON, COMMON_DF = 65_536, 64
BLOCK_SETS, BLOCK_TOKENS = 4096, 3_000_000
PIVOTS = 16  # sets of a cut home that all its blocks see
LIST_BLOCK, PAIR_ROWS = 4096, 500_000
NODE_SEED = U(0x9E3779B97F4A7C15)


def text_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct shingles of each text one after the other, sizes, nodes): a node identifies a set; 0 without shingles."""
    h, per = shingle_hashes(data, offsets, k)
    doc = np.repeat(np.arange(len(per)), per)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    if len(h):
        first = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]
        h, doc = h[first], doc[first]
    size = np.bincount(doc, minlength=len(per)).astype(np.int64)
    ends = np.cumsum(size)
    has = size > 0
    node = np.zeros(len(per), np.uint64)
    node[has] = spans_hash(mix64(h + NODE_SEED), (ends - size)[has], ends[has])
    return h, size, node.view(np.int64)


def _pack(keys: np.ndarray, idx: np.ndarray) -> bytes:
    """Sorted keys and their document numbers: count, first key, bytes a delta, byte planes of deltas, numbers."""
    d = np.diff(keys, prepend=keys[:1])
    width = max(1, (int(d.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(d.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    head = np.array([len(keys), int(keys[0]) if len(keys) else 0, width], dtype="<u8")
    return head.tobytes() + planes.tobytes() + idx.astype("<u2").tobytes()


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, first, width = (int(x) for x in np.frombuffer(blob, "<u8", 3))
    planes = np.zeros((n, 8), np.uint8)
    planes[:, :width] = np.frombuffer(blob, np.uint8, n * width, 24).reshape(width, n).T
    keys = np.cumsum(planes.view("<u8").ravel(), dtype=np.uint64) + U(first)
    return keys, np.frombuffer(blob, "<u2", n, 24 + n * width)


def _pack_counts(c: np.ndarray) -> bytes:
    """Bytes a count, then the counts: the width follows the largest one, so that none wraps."""
    width = next(w for w in (1, 2, 4, 8) if int(c.max()) < 1 << 8 * w)
    return bytes([width]) + c.astype(f"<u{width}").tobytes()


def _unpack_counts(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1)


def _pack_keys(keys: np.ndarray, idx: np.ndarray, many: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys of one document in the chunk with its number, and keys of several with their count."""
    one = _pack(keys, idx)
    return len(one).to_bytes(8, "little") + one + (_pack(many, np.zeros(len(many))) + _pack_counts(counts) if len(many) else b"")


def _unpack_keys(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    at = 8 + int.from_bytes(blob[:8], "little")
    keys, idx = _unpack(blob[8:at])
    if at == len(blob):
        return keys, idx, keys[:0], np.zeros(0, np.int64)
    many, none = _unpack(blob[at:])
    n, _, width = np.frombuffer(blob, "<u8", 3, at)
    end = at + 24 + int(n) * (int(width) + 2)
    return keys, idx, many, _unpack_counts(blob[end:]).astype(np.int64)


def _map_keys(k: int, key_bits: int, ranges: int):
    """Documents -> rows (range, chunk, payload): range -1 holds the chunk's ids, sizes, nodes and shingles known as shared."""

    def run(batches):
        base, number = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            ids = b.column(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
            for i, j, data, off in string_chunks(b.column(1), CHUNK_TEXT):
                for at in range(i, j, 65_536):  # numbers inside a chunk fit two bytes
                    to = min(j, at + 65_536)
                    lo, hi = off[at - i], off[to - i]
                    h, size, node = text_sets(data[lo:hi], off[at - i : to - i + 1] - lo, k)
                    chunk = base + number
                    number += 1
                    sure = np.zeros(to - at, np.int64)  # shingles that the chunk itself shows to be shared
                    out = []
                    if len(h):
                        key = h >> U(64 - key_bits)
                        order = np.argsort(key, kind="stable")
                        key, idx = key[order], np.repeat(np.arange(to - at), size)[order]
                        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                        count = np.diff(np.append(begin, len(key)))
                        sure += np.bincount(idx[np.repeat(count > 1, count)], minlength=to - at)
                        many, counts = key[begin[count > 1]], count[count > 1]
                        key, idx = key[begin[count == 1]], idx[begin[count == 1]]
                        edge = np.array([(r << key_bits) // ranges for r in range(ranges)], dtype=np.uint64)
                        cut = np.append(np.searchsorted(key, edge), len(key))
                        cut2 = np.append(np.searchsorted(many, edge), len(many))
                        for r in np.flatnonzero(np.diff(cut) + np.diff(cut2)):
                            x, y, u, v = *cut[r : r + 2], *cut2[r : r + 2]
                            out.append((int(r), _pack_keys(key[x:y], idx[x:y], many[u:v], counts[u:v])))
                    out.append((-1, np.concatenate([ids[at:to], size, node, sure]).astype("<i8").tobytes()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r for r, _ in out], pa.int32()), pa.array([chunk] * len(out), pa.int64()), pa.array([p for _, p in out], pa.binary())],
                        ["rng", "chunk", "payload"],
                    )

    return run


def _groups(batches, key: int):
    """Rows of consecutive equal keys, across batches: (key, list of row tuples)."""
    last, rows = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if rows and row[key] != last:
                yield last, rows
                rows = []
            last = row[key]
            rows.append(row)
    if rows:
        yield last, rows


def _rows(kinds, schema_names, types):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(kinds, types)], schema_names)


def _count_range(batches):
    """Ranges -> rows (kind, chunk, payload): 0 documents, 1 shared counts of a chunk, 2 a frequent key and its count."""
    names, types = ["kind", "chunk", "payload"], [pa.int32(), pa.int64(), pa.binary()]
    for rng, rows in _groups(batches, 0):
        if rng == -1:
            yield _rows([[0] * len(rows), [r[1] for r in rows], [r[2] for r in rows]], names, types)
            continue
        parts = [_unpack_keys(r[2]) for r in rows]
        key = np.concatenate([p[0] for p in parts] + [p[2] for p in parts])
        times = np.concatenate([np.ones(sum(len(p[0]) for p in parts), np.int64)] + [p[3] for p in parts])
        order = np.argsort(key, kind="stable")
        key = key[order]
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        count = np.add.reduceat(times[order], begin)
        shared = np.zeros(len(key), bool)
        shared[order] = np.repeat(count > 1, np.diff(np.append(begin, len(key))))
        out = [[], [], []]
        at = 0
        for r, (_, idx, _, _) in zip(rows, parts):
            own = idx[shared[at : at + len(idx)]]
            at += len(idx)
            if len(own):
                out[0].append(1)
                out[1].append(r[1])
                out[2].append(_pack_counts(np.bincount(own)))
        for x in np.flatnonzero(count >= COMMON_DF):
            out[0].append(2)
            out[1].append(int(key[begin[x]]))
            out[2].append(int(count[x]).to_bytes(8, "big"))
        yield _rows(out, names, types)


def _sum_chunks(batches):
    """(chunk, kind, payload) rows of a chunk -> (id, n_shingles, node, shared)."""
    for _, rows in _groups(batches, 0):
        ids, size, node, sure = np.frombuffer(next(r[2] for r in rows if r[1] == 0), "<i8").reshape(4, -1)
        shared = sure.copy()
        for r in rows:
            if r[1] == 1:
                c = _unpack_counts(r[2])
                shared[: len(c)] += c.astype(np.int64)
        yield _rows([ids, size, node, shared], ["id", "n", "node", "shared"], [pa.int64()] * 4)


def _make_sets(k: int, bits, m: int):
    """Documents that may be candidates -> (id, n, node, tokens)."""

    def run(batches):
        words = bits.value
        for b in batches:
            h = b.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            b = b.filter(pa.array((words[h >> 6] >> (h & 63).astype(np.uint64)) & U(1) == 1))
            if not b.num_rows:
                continue
            for i, j, data, off in string_chunks(b.column(1)):
                tok, size, node = text_sets(data, off, k)
                cut = np.cumsum(size)[:-1]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i).cast(pa.int64()), pa.array(size), pa.array(node), pa.array([x.astype("<u8").tobytes() for x in np.split(tok, cut)], pa.binary())],
                    ["id", "n", "node", "tokens"],
                )

    return run


def _prefixes(common, key_bits: int, num: int, den: int):
    """Sets -> index entries (token, pos, n, node) of the first n - ceil(num / den * n) + 1 tokens, rare ones first."""

    def run(batches):
        keys, counts = common.value
        for b in batches:
            out = [[], [], [], []]
            for n, node, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                t = np.frombuffer(blob, "<u8")
                short = t >> U(64 - key_bits)
                at = np.minimum(np.searchsorted(keys, short), max(0, len(keys) - 1))
                df = np.where(keys[at] == short, counts[at], 0) if len(keys) else np.zeros(len(t), np.int64)
                take = n + (-n * num // den) + 1
                first = np.lexsort((t, df))[:take]
                out[0].append(t[first].view(np.int64))
                out[1].append(np.arange(take))
                out[2].append(np.full(take, n))
                out[3].append(np.full(take, node))
            if out[0]:
                yield _rows([np.concatenate(c) for c in out], ["token", "pos", "n", "node"], [pa.int64()] * 4)

    return run


def linked(inter, a, b, num: int, den: int):
    return den * inter >= num * (a + b - inter)


def home_links(sets: list[np.ndarray], num: int, den: int, pivots: int = 4) -> np.ndarray:
    """Connected components (smallest position) of all links among the sets.

    The sets that were compared with all others so far, the pivots, give their answers on: for
    Jaccard distance d, |d(p, x) - d(p, y)| > limit excludes a link of x and y and
    d(p, x) + d(p, y) <= limit proves it; only undecided sets of other components are compared.
    """
    m = len(sets)
    by_size = np.argsort([len(s) for s in sets], kind="stable")
    size = np.array([len(sets[i]) for i in by_size], dtype=np.int64)
    _, flat = np.unique(np.concatenate([sets[i] for i in by_size]), return_inverse=True)
    off = np.r_[0, np.cumsum(size)]
    mark = np.zeros(int(flat.max()) + 1, np.int64)
    label = np.arange(m)
    limit = 1 - num / den
    seen: list[np.ndarray] = []

    def overlaps(x: int, ys: np.ndarray) -> np.ndarray:
        own = flat[off[x] : off[x + 1]]
        mark[own] = 1
        lo, hi = int(ys[0]), int(ys[-1]) + 1
        if size[ys].sum() * 3 > off[hi] - off[lo]:
            got = np.add.reduceat(mark[flat[off[lo] : off[hi]]], off[lo:hi] - off[lo])[ys - lo]
        else:
            n = size[ys]
            first = np.cumsum(n) - n
            at = np.arange(int(n.sum())) - np.repeat(first, n) + np.repeat(off[ys], n)
            got = np.add.reduceat(mark[flat[at]], first)
        mark[own] = 0
        return got

    def join(x: int, ys: np.ndarray) -> None:
        if len(ys):
            old = np.unique(np.append(label[ys], label[x]))
            label[np.isin(label, old)] = old[0]

    for x in range(m - 1):
        hi = int(np.searchsorted(size, size[x] * den / num + 1e-9, side="right"))  # skip blocks of larger sets
        if len(seen) < pivots and (not seen or min(d[x] for d in seen) > limit):
            every = np.arange(m)
            inter = overlaps(x, every)
            seen.append(1 - inter / (size + size[x] - inter))
            join(x, every[linked(inter, size, size[x], num, den)])
            continue
        ys = np.arange(x + 1, hi)
        ys = ys[label[ys] != label[x]]
        for d in seen:
            if len(ys):
                sure = d[ys] + d[x] <= limit - 1e-9
                join(x, ys[sure])
                ys = ys[~sure & (np.abs(d[ys] - d[x]) <= limit + 1e-9)]
        ys = ys[label[ys] != label[x]]
        if len(ys):
            inter = overlaps(x, ys)
            join(x, ys[linked(inter, size[ys], size[x], num, den)])
    out = np.empty(m, np.int64)
    out[by_size] = by_size[label]
    return out


def _home_edges(num: int, den: int):
    """Sets sorted by (home, block) -> edges (a, b) that span the links inside a home's block."""

    def run(batches):
        keyed = (pa.RecordBatch.from_arrays([pa.array(list(zip(b.column(0).to_pylist(), b.column(1).to_pylist())), pa.list_(pa.int64())), b.column(2), b.column(3)], ["k", "node", "tokens"]) for b in batches)
        for _, rows in _groups(keyed, 0):
            if len(rows) > 1:
                nodes = np.array([r[1] for r in rows], dtype=np.int64)
                root = home_links([np.frombuffer(r[2], "<u8") for r in rows], num, den)
                off = np.flatnonzero(root != np.arange(len(nodes)))
                if len(off):
                    yield _rows([nodes[off], nodes[root[off]]], ["a", "b"], [pa.int64()] * 2)

    return run


def _list_pairs(num: int, den: int):
    """Entries sorted by (token, i, j) -> pairs of unconnected nodes of different homes that may still link; of two blocks, pairs across them."""

    def run(batches):
        for _, rows in _groups(batches, slice(0, 3)):
            if len(rows) < 2:
                continue
            side, pos, n, node, home, comp = (np.array(c, dtype=np.int64) for c in list(zip(*rows))[3:])
            if comp.min() == comp.max() or home.min() == home.max():
                continue
            order = np.lexsort((pos, n))
            side, pos, n, node, home, comp = (c[order] for c in (side, pos, n, node, home, comp))
            end = np.searchsorted(n, n * den / num + 1e-9, side="right")  # size blocks beyond are skipped
            across = side.min() != side.max()
            a, b, held = [], [], 0
            for x in range(len(n) - 1):
                y = slice(x + 1, end[x])
                most = np.minimum(n[x] - pos[x], n[y] - pos[y])  # overlap, if this is the first common token
                ok = (comp[y] != comp[x]) & (home[y] != home[x]) & (most * (num + den) >= num * (n[y] + n[x]))
                if across:
                    ok &= side[y] != side[x]
                got = node[y][ok]
                a.append(np.minimum(got, node[x]))
                b.append(np.maximum(got, node[x]))
                held += len(got)
                if held >= PAIR_ROWS:
                    yield _rows([np.concatenate(a), np.concatenate(b)], ["a", "b"], [pa.int64()] * 2)
                    a, b, held = [], [], 0
            if held:
                yield _rows([np.concatenate(a), np.concatenate(b)], ["a", "b"], [pa.int64()] * 2)

    return run


def _list_blocks(walked: DataFrame) -> DataFrame:
    """Index entries -> (token, i, j, side, pos, n, node, home, comp): entries of lists with unconnected homes, once for each pair of blocks."""
    ends = [F.min("home").alias("first"), F.max("home").alias("last")]
    per = walked.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"), *ends)
    ends = [F.min("first").alias("first"), F.max("last").alias("last")]
    per = per.groupBy("token").agg(F.sum("c").alias("m"), F.max(F.struct("c", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"), *ends)
    long = F.col("m") > LIST_BLOCK
    rest = F.when(long, F.ceil((F.col("m") - F.col("top.c")) / LIST_BLOCK)).otherwise(1).cast("int")
    mass = F.when(long, F.ceil(F.col("top.c") / LIST_BLOCK)).otherwise(0).cast("int")
    per = per.where("comps > 1 and first < last").select("token", rest.alias("rest"), mass.alias("mass"), F.col("top.comp").alias("most"))
    inside = (F.col("mass") > 0) & (F.col("comp") == F.col("most"))  # the largest component meets the others only
    spread = F.xxhash64("node", F.lit(3))
    own = F.when(inside, F.col("rest") + F.pmod(spread, F.col("mass"))).otherwise(F.pmod(spread, F.col("rest"))).cast("int")
    others = F.sequence(F.lit(0), F.when(inside, F.col("rest") - 1).otherwise(F.col("rest") + F.col("mass") - 1))
    cut = walked.join(per, "token").withColumn("own", own).withColumn("other", F.explode(others))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    return cut.select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.alias("side"), "pos", "n", "node", "home", "comp")


def _verify(num: int, den: int):
    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                s, t = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                keep.append(bool(linked(len(np.intersect1d(s, t, assume_unique=True)), len(s), len(t), num, den)))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def ngram_components(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row; two texts link at a Jaccard similarity of ``percent`` or more."""
    spark, num, den = docs.sparkSession, percent, 100
    sc, parts = spark.sparkContext, shuffle_partitions(spark)
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    known = own.where("id is not null")

    n_bytes = known.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = max(1, math.ceil(n_bytes / RANGE_TEXT))
    key_bits = min(56, max(40, int(n_bytes // 6 + 1).bit_length() + 7))
    keys = known.mapInArrow(_map_keys(k, key_bits, ranges), "rng int, chunk long, payload binary")
    to = F.when(F.col("rng") < 0, F.pmod("chunk", F.lit(1024)) + (1 << 20)).otherwise(F.col("rng"))
    dealt = keys.withColumn("to", to).repartition(max(parts, min(ranges, 100_000)), "to").sortWithinPartitions("rng", "chunk").drop("to")
    counted = materialize(dealt.mapInArrow(_count_range, "kind int, chunk long, payload binary"), "ngram-counts")
    chunks = counted.where("kind < 2").select("chunk", "kind", "payload").repartition(parts, "chunk").sortWithinPartitions("chunk", "kind")
    rows = materialize(chunks.mapInArrow(_sum_chunks, "id long, n long, node long, shared long"), "ngram-docs")

    nodes = rows.where("n > 0").groupBy("node", "n").agg(F.min("id").alias("least"), F.max("shared").alias("shared"))
    nodes = materialize(nodes, "ngram-nodes")
    candidates = nodes.where(F.col("shared") * den >= F.col("n") * num).select("node", "least")
    # a Bloom filter with one hash: it thins the second scan, the join below makes it exact
    m = 1 << min(24, max(12, (16 * candidates.count()).bit_length()))
    hashed = F.pmod(F.xxhash64("least"), F.lit(m)).cast("int")
    words = candidates.select(hashed.alias("h")).select(F.shiftright("h", 6).alias("w"), F.pmod("h", F.lit(64)).alias("bit")).groupBy("w").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("v"))
    bits = np.zeros(m // 64, np.uint64)
    for w, v in words.collect():  # at most 2^18 words
        bits[w] = np.uint64(v & 0xFFFFFFFFFFFFFFFF)
    texts = known.withColumn("h", F.pmod(F.xxhash64("id"), F.lit(m)).cast("int"))
    made = texts.mapInArrow(_make_sets(k, sc.broadcast(bits), m), "id long, n long, node long, tokens binary")
    sets = made.join(candidates.withColumnRenamed("least", "id"), ["node", "id"]).groupBy("node", "n").agg(F.first("tokens").alias("tokens"))
    sets = materialize(sets, "ngram-sets")

    top = counted.where("kind = 2").select(F.col("chunk").alias("key"), F.col("payload").alias("c")).orderBy(F.desc("c"), "key").limit(COMMON).collect()
    common = sorted((r["key"], int.from_bytes(bytes(r["c"]), "big")) for r in top)  # at most COMMON of the most frequent keys
    common = sc.broadcast((np.array([x for x, _ in common], np.uint64), np.array([c for _, c in common], np.int64)))
    entries = sets.select("n", "node", "tokens").mapInArrow(_prefixes(common, key_bits, num, den), "token long, pos long, n long, node long")
    rank = F.struct(F.xxhash64("node"), F.col("node"))
    entries = materialize(entries, "ngram-entries")
    lists = entries.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min(rank).alias("pivot")).where("size > 1")
    listed = materialize(entries.join(lists.drop("size"), "token"), "ngram-lists")
    homes = listed.groupBy("node").agg(F.min("pivot")["node"].alias("home"))
    sized = homes.join(sets.select("node", "n"), "node")
    cuts = sized.groupBy("home").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("t"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_SETS), F.ceil(F.col("t") / BLOCK_TOKENS))
    seen = F.greatest(F.lit(1), F.least(F.lit(PIVOTS), F.floor(F.col("m") / F.col("blocks") / 8)))  # pivots are at most an eighth of a block, or one
    homes = sized.join(cuts.where("m > 1").withColumn("blocks", blocks).select("home", "blocks", seen.alias("seen")), "home")
    homes = homes.select("node", "home", "blocks", "seen", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).alias("block"))
    homes = materialize(homes, "ngram-homes")
    turn = F.row_number().over(Window.partitionBy("home").orderBy(F.xxhash64("node", F.lit(2)), "node"))  # limited before the exchange
    pivots = homes.where("blocks > 1").withColumn("turn", turn).where(F.col("turn") <= PIVOTS).where("turn <= seen")
    pivots = pivots.withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where("to != block")
    members = homes.select("home", "block", "node").unionAll(pivots.select("home", F.col("to").alias("block"), "node"))
    at_home = members.join(sets, "node").select("home", "block", "node", "tokens").repartition(parts, "home", "block").sortWithinPartitions("home", "block")
    inner = materialize(at_home.mapInArrow(_home_edges(num, den), "a long, b long"), "ngram-inner")
    comp = components(inner)

    place = homes.join(comp, "node", "left").select("node", F.xxhash64("home", "block").alias("home"), F.coalesce("component", "node").alias("comp"))
    walked = listed.select("token", "pos", "n", "node").join(place, "node", "left")
    walked = walked.select("token", "pos", "n", "node", F.coalesce("home", F.xxhash64("node")).alias("home"), F.coalesce("comp", "node").alias("comp"))
    walked = materialize(walked, "ngram-walked")
    dealt = _list_blocks(walked).repartition(parts, "token", "i", "j").sortWithinPartitions("token", "i", "j")
    pairs = dealt.mapInArrow(_list_pairs(num, den), "a long, b long").distinct()
    pairs = materialize(pairs, "ngram-pairs")
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("s"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("t"))
    outer = pairs.join(left, "a").join(right, "b").select("a", "b", "s", "t").mapInArrow(_verify(num, den), "a long, b long")

    comp = components(inner.unionAll(outer))
    placed = nodes.join(comp, "node", "left").select("node", "n", "least", F.coalesce("component", "node").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    final = placed.join(least, "root").select("node", "n", "component_id")
    some = rows.join(final, ["node", "n"], "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
    nameless = own.where("id is null").mapInArrow(_sizes(k), "n_shingles long")
    out = some.unionAll(nameless.select(F.lit(None).cast("long").alias("id"), "n_shingles", F.lit(None).cast("long").alias("component_id")))
    return out.withColumnRenamed("id", id_col)


def _sizes(k: int):
    def run(batches):
        for b in batches:
            for _, _, data, off in string_chunks(b.column(1)):
                yield _rows([text_sets(data, off, k)[1]], ["n_shingles"], [pa.int64()])

    return run
