import random
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from homeshift.llm import ngram_join as nj
from llm_edge import EDGE


def words(text):
    return [w for w in (text or "").encode().lower().replace(b"\x0b", b" ").split()]


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return Counter((d, len(sets[i]), None if d is None else min(least[find(i)])) for i, (d, _) in enumerate(rows))


def check(docs, rows):
    got = nj.ngram_components(docs)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == brute(rows)


def near_copies(seed, groups=6, size=25, length=60):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [r.choice(vocab) for _ in range(30)]
    rows = []
    for g in range(groups):
        base = [r.choice(vocab) for _ in range(length)]
        for _ in range(size):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                t[r.randrange(len(t))] = r.choice(vocab)
            if r.random() < 0.2:
                t = t[r.randint(0, 6) :]
            if r.random() < 0.3:
                t += passage
            rows.append(" ".join(t) if r.random() < 0.9 else "\n".join(t).upper())
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_equal_brute_force(docs_of, seed):
    rows = near_copies(seed)
    check(docs_of(rows, 5), rows)


def test_many_homes_and_small_blocks(docs_of, monkeypatch):
    """With blocks of a few sets, most links cross blocks and fall to the list walk."""
    monkeypatch.setattr(nj, "BLOCK_SETS", 4)
    monkeypatch.setattr(nj, "CHUNK_TEXT", 3000)
    monkeypatch.setattr(nj, "RANGE_TEXT", 9000)
    rows = near_copies(7, groups=3, size=30)
    check(docs_of(rows, 5), rows)


def test_blocks_of_near_copies_meet_through_pivots(docs_of, monkeypatch):
    """A group of near copies in many blocks: its cross pairs are not listed once pivots have connected it."""
    listed = {}

    def record(df, name, *more):
        out = write(df, name, *more)
        if name == "ngram-pairs":
            listed["pairs"] = out.count()
        return out

    write = nj.materialize
    monkeypatch.setattr(nj, "materialize", record)
    monkeypatch.setattr(nj, "BLOCK_SETS", 16)
    r = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(160):
        t = list(base)
        for _ in range(r.choice([1, 1, 2])):
            t[r.randrange(200)] = f"x{r.randrange(40)}"
        rows.append((i, " ".join(t)))
    check(docs_of(rows), rows)
    assert listed["pairs"] < len(rows)


def test_long_lists_are_cut_into_block_pairs(docs_of, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK_SETS", 4)
    monkeypatch.setattr(nj, "LIST_BLOCK", 5)
    rows = near_copies(9, groups=3, size=30)
    check(docs_of(rows, 5), rows)


def test_edge_rows(docs_of):
    check(docs_of(EDGE), EDGE)


def test_empty_table(docs_of):
    assert nj.ngram_components(docs_of([(1, "x")]).where("false")).count() == 0


def test_near_copies_of_a_text_with_many_shingles(docs_of):
    """A count of more than 65,535 shared shingles in one key range."""
    words = [f"w{i}" for i in range(100_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-50] + ["other"])), (3, "a short text of some other words")]
    check(docs_of(rows), rows)


def test_packed_keys_round_trip():
    r = np.random.default_rng(0)
    for n, top in ((1, 5), (1000, 2**40), (50, 2**56)):
        keys = np.sort(r.integers(0, top, n, dtype=np.uint64))
        idx = r.integers(0, 65_536, n)
        k, i = nj._unpack(nj._pack(keys, idx))
        assert (k == keys).all() and (i == idx).all()


def test_hot_keys_reach_a_range_once_a_chunk(monkeypatch):
    """Copies of one text, and a passage of all texts, are one entry a key; the counts stay those of all documents."""
    monkeypatch.setattr(nj.TaskContext, "get", staticmethod(lambda: SimpleNamespace(partitionId=lambda: 0)))
    hot, passage = " ".join(f"h{i}" for i in range(50)), " ".join(f"p{i}" for i in range(20))
    texts = [hot] * 300 + [f"{passage} " + " ".join(f"u{d}x{i}" for i in range(10)) for d in range(300)] + [""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["id", "text"])
    sent = [r for b in nj._map_keys(5, 56, 3)([batch]) for r in zip(*(c.to_pylist() for c in b.columns))]
    got = [nj._unpack_keys(p) for r, _, p in sent if r >= 0]
    distinct = set().union(*(shingles(t) for t in texts))
    assert sum(len(keys) + len(many) for keys, _, many, _ in got) == len(distinct)
    assert sum(len(keys) + int(counts.sum()) for keys, _, _, counts in got) == sum(len(shingles(t)) for t in texts)
    rows = sorted(sent)
    counted = nj._count_range([pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary()))], ["rng", "chunk", "payload"])])
    flat = sorted((c, k, p) for b in counted for k, c, p in zip(*(x.to_pylist() for x in b.columns)) if k < 2)
    (out,) = nj._sum_chunks([pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*flat), (pa.int64(), pa.int32(), pa.binary()))], ["chunk", "kind", "payload"])])
    assert out.column("shared").to_pylist() == [46] * 300 + [16] * 300 + [0]


@pytest.mark.parametrize("most", [1, 255, 256, 65_535, 65_536, 2**33])
def test_packed_counts_round_trip(most):
    assert nj._unpack_counts(nj._pack_counts(np.array([0, most]))).tolist() == [0, most]


@pytest.mark.parametrize("seed", range(5))
def test_derived_answers_equal_all_comparisons(seed):
    r = np.random.default_rng(seed)
    base = r.integers(0, 10_000, 60)
    sets = []
    for _ in range(120):
        s = base.copy()
        at = r.random(60) < r.choice([0, 0.03, 0.06, 0.1, 0.2, 0.5])
        s[at] = r.integers(0, 10_000, at.sum())
        sets.append(np.unique(s.astype(np.uint64)))
    got = nj.home_links(sets, 80, 100)
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if nj.linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]), 80, 100):
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
    same = lambda x: [[y == z for z in x] for y in x]
    assert same(got.tolist()) == same(label)
