import hashlib
from collections import Counter, defaultdict

from homeshift.llm.exact_dedup import exact_dedup

from llm_edge import EDGE


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return Counter((i, keep[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)


def check(docs, rows, **kw):
    got = exact_dedup(docs, **kw).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == expected(rows)
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) <= {1} and len(kept) == len({t or "" for _, t in rows})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_edge_rows(docs_of):
    check(docs_of(EDGE), EDGE)


def test_hot_group_over_many_leaves_and_rounds(docs_of):
    rows = [(i, "the same text") for i in range(700)] + [(1000 + i, f"own {i % 90}") for i in range(300)]
    check(docs_of(rows, 7), rows, leaves=70, fan_bits=1)
    check(docs_of(rows, 7), rows, leaves=1)


def test_one_row_that_is_repeated(docs_of):
    """A third of all rows are one row: spread over the leaves, one of them stays."""
    rows = [(7, "again and again")] * 400 + [(None, "no id")] * 300 + [(1000 + i, f"own {i}") for i in range(300)]
    check(docs_of(rows, 9), rows, leaves=16)


def test_empty_table(docs_of):
    assert exact_dedup(docs_of([(1, "x")]).where("false")).count() == 0
