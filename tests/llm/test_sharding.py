import heapq
import random
import zlib
from collections import defaultdict

import pytest

from homeshift.llm.sharding import schedule, shard_by_bytes
from llm_edge import EDGE


def plain_lpt(sizes, shards):
    loads = [0] * shards
    heapq.heapify(loads)
    for s in sorted(sizes, reverse=True):
        heapq.heapreplace(loads, loads[0] + s)
    return sorted(loads)


@pytest.mark.parametrize("seed", range(8))
def test_bulk_schedule_equals_plain_lpt(seed):
    r = random.Random(seed)
    sizes = [r.choice([1, 5, 5, 40, 300, r.randint(1, 2000)]) for _ in range(r.choice([0, 3, 100, 5000]))]
    count = defaultdict(int)
    for s in sizes:
        count[s] += 1
    singles = [(f"k{i}", s) for i, s in enumerate(sorted(sizes)[-5:])]
    for _, s in singles:
        count[s] -= 1
    own, spans, loads = schedule(singles, [(s, n, n * s) for s, n in count.items() if n], 16)
    assert sorted(loads) == plain_lpt(sizes, 16)
    done = defaultdict(list)
    for cls, lo, hi, shard in spans:
        done[cls].append((lo, hi))
    for s, n in count.items():
        at = 0
        for lo, hi in sorted(done.get(s, [])):
            assert lo == at
            at = hi
        assert at == n
    assert set(own) == {k for k, _ in singles}


def check(docs, rows, shards=16):
    got = shard_by_bytes(docs, shards).collect()
    size = {t: len((t or "").encode()) + 1 for _, t in rows}
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted((str(i), size[t], zlib.crc32((t or "").encode())) for i, t in rows)
    slots, of, loads = defaultdict(list), defaultdict(set), defaultdict(int)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        of[(r["text_crc32"], r["size"])].add(r["shard"])
        loads[r["shard"]] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in of.values())
    groups = defaultdict(int)
    for _, t in rows:
        groups[t or ""] += size[t]
    assert sorted(loads.get(s, 0) for s in range(shards)) == plain_lpt(groups.values(), shards)


def test_edge_rows(docs_of):
    check(docs_of(EDGE), EDGE)


def test_hot_group_and_ties(docs_of):
    r = random.Random(3)
    rows = [(i, "hot text") for i in range(500)] + [(1000 + i, "x" * r.choice([3, 10, 10, 50])  + str(i)) for i in range(1000)]
    check(docs_of(rows, 6), rows)


def test_empty_table(docs_of):
    assert shard_by_bytes(docs_of([(1, "x")]).where("false")).count() == 0
