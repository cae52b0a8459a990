import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from homeshift.llm import packing
from llm_edge import EDGE

PATH = public_tokenizers.path("byte_bpe_50k.json")


def optimum(items, capacity):
    best = [len(items)]
    items = sorted(items, reverse=True)

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        tried = set()
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in tried:
                tried.add(bins[k])
                bins[k] += items[i]
                go(i + 1, bins)
                bins[k] -= items[i]
        go(i + 1, bins + [items[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(4))
def test_reduction_keeps_the_optimum(seed):
    r = random.Random(seed)
    for _ in range(300):
        capacity = r.choice([10, 13, 17])
        items = [r.randint(1, capacity) for _ in range(r.randint(1, 9))]
        fixed, left = packing.reduce_profile(Counter(items), capacity)
        rest = [w for w, n in left.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + (optimum(rest, capacity) if rest else 0) == optimum(items, capacity)
        placed = Counter(rest)
        for ws, n in fixed:
            assert sum(ws) <= capacity
            for w in ws:
                placed[w] += n
        assert +placed == Counter(items)


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 64, 1024])
    counts = Counter(r.choice([capacity, r.randint(1, capacity), 1]) for _ in range(r.choice([0, 1, 50, 2000])))
    bins, spans = defaultdict(list), defaultdict(list)
    for w, lo, hi, base, at in packing.plan(dict(counts), capacity):
        spans[w].append((lo, hi))
        for k in range(lo, hi):
            bins[base + k - lo].append((at, w))
    for w, n in counts.items():
        s = sorted(spans[w])
        assert s[0][0] == 0 and s[-1][1] == n and all(a[1] == b[0] for a, b in zip(s, s[1:]))
    for b in bins.values():
        at = 0
        for o, w in sorted(b):
            assert o == at
            at += w
        assert at <= capacity
    total = sum(w * n for w, n in counts.items())
    assert len(bins) <= -(-total // capacity) * 1.1 + 1


def check(docs, rows, capacity):
    tok = Tokenizer.from_file(PATH)
    got = packing.pack_documents(docs, PATH, capacity, 2).collect()
    want = Counter()
    for i, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        for k, (start, length) in enumerate(packing.cut(len(ids), capacity)):
            assert length == capacity or k == 0
            want[(i, k, start, length, zlib.crc32(ids[start : start + length].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for o, w in sorted(b):
            assert o == at
            at += w
        assert at <= capacity
    return bins


def test_edge_rows(docs_of):
    check(docs_of(EDGE), EDGE, 1024)
    check(docs_of(EDGE), EDGE, 7)


def test_equal_short_texts(docs_of):
    rows = [(i, "a b c") for i in range(100)]  # four tokens each
    assert len(check(docs_of(rows), rows, 8)) == 50


def test_empty_table(docs_of):
    assert packing.pack_documents(docs_of([(1, "x")]).where("false"), PATH).count() == 0


def test_long_white_space_runs():
    tok, enc = Tokenizer.from_file(PATH), packing.byte_encoding(PATH)
    for text in ("a" + " " * 2_000_000 + "b", "a" + "\n" * 1_500_000 + "b c", "\t" * 1_200_000):
        assert packing.encode(enc, text) == tok.encode(text, add_special_tokens=False).ids


def test_split_runs_equal_the_library(monkeypatch):
    monkeypatch.setattr(packing, "LONG_RUN", 3)
    tok, enc = Tokenizer.from_file(PATH), packing.byte_encoding(PATH)
    r = random.Random(4)
    parts = ["a", "B", "7", "'s", ".", "\n", " ", "   ", "\t", "\u00a0", "\u3000", "\x1c", "\x85", "\u2003", "    \n", *sorted(enc.special_tokens_set)[:3]]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(1, 14)))
        assert packing.encode(enc, text) == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_place_by_rank_with_a_hot_key(spark):
    from pyspark.sql import functions as F

    from homeshift.llm.common import place_by_rank

    spans = [(5, 0, 3, 10, 7), (9, 0, 100_000, 20, 8), (5, 3, 4, 11, 6), (2, 0, 1, 30, 5), (9, 100_000, 100_500, 21, 4)]
    rows = [(k, r, f"x{k}") for k, n in ((5, 4), (9, 100_500), (2, 1)) for r in range(n)]
    df = spark.createDataFrame(rows, "length long, rank long, lo string").repartition(5)
    got = place_by_rank(df, "length", "rank", spans, ["base", "at"])
    want = sorted((k, r, f"x{k}", *next(s[3:] for s in spans if s[0] == k and s[1] <= r < s[2])) for k, r, _ in rows)
    assert sorted(map(tuple, got.collect())) == want
    assert "Exchange" not in got.select(F.col("base"))._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    assert place_by_rank(df.where("false"), "length", "rank", [], ["base"]).count() == 0
