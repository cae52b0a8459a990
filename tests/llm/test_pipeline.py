"""run() and each stage against a brute-force version; the registered queries and their SQL."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from homeshift.llm import packing, quality_rules, queries
from llm_edge import EDGE
from test_ngram_join import near_copies
from test_ngram_join import shingles


@pytest.fixture
def corpus(spark, docs_of, tmp_path):
    r = random.Random(4)
    rows = [(i, t) for i, t in near_copies(5, groups=4, size=12)]
    rows += [(500 + i, rows[r.randrange(len(rows))][1]) for i in range(20)]  # exact copies
    rows += [(600 + i, " ".join(f"{w}!!" for w in rows[i][1].upper().split())) for i in range(40)]  # bad quality
    rows += [(900 + k, t) for k, (_, t) in enumerate(EDGE)] + [(500, rows[500 - 452][1])]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(i, int(not (t or "").endswith("!!")), 0) for i, t in rows if i < 700], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), rows


def near_kept(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if j < i:
                both = len(sets[i] & sets[j])
                if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return [i for i in ids if find(i) == i]


def test_every_stage_and_the_run(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality_rules.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good = [(r["doc_id"], r["text"]) for r in quality_rules.score_documents(docs, model).collect() if r["predicted"] == 1]
    assert 0 < len(good) < len(rows) and not any(600 <= i < 640 for i, _ in good)

    one = cp.keep_quality(spark, docs, folder)
    assert one.columns == docs.columns and Counter((r["doc_id"], r["text"]) for r in one.collect()) == Counter(good)

    best = {}
    for i, t in good:
        best[t or ""] = max(i, best.get(t or "", i))
    two = cp.drop_copies(spark, one, folder)
    kept = [(r["doc_id"], r["text"]) for r in two.collect()]
    assert two.columns == docs.columns and Counter((i, t or "") for i, t in kept) == Counter((i, t) for t, i in best.items())

    three = cp.drop_near_copies(spark, two, folder)
    left = {r["doc_id"]: r["text"] for r in three.collect()}
    assert three.columns == docs.columns and sorted(left) == near_kept(kept)

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in left.items():
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        for k, (start, n) in enumerate(packing.cut(len(ids), 1024)):
            want[(i, k, start, n, zlib.crc32(ids[start : start + n].tobytes()))] += 1
    got = cp.run(spark, folder).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        assert all(o == sum(n for p, n in b if p < o) for o, _ in b) and sum(n for _, n in b) <= 1024


def test_stages_on_edge_rows_and_no_rows(spark, docs_of, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (docs_of(EDGE), docs_of(EDGE).where("false")):
        for _, stage in cp.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            docs.collect()
    texts = cp.drop_copies(spark, docs_of(EDGE), "").collect()
    assert len({r["text"] or "" for r in texts}) == len(texts) == len({t or "" for _, t in EDGE})


def test_columns_of_any_name_are_carried(spark, tmp_path):
    """Columns named like the stages' own keep their values; a third of all rows are one row, repeated, a third have no id."""
    names = ["_id", "_sha", "_own", "_again", "_doc", "_key", "_kept", "kept", "keep_id", "component_id", "node", "score"]
    rows = [(7, "the same text of a row that is repeated again and again", *names)] * 60
    rows += [(None, f"no id but a text of its own {i} " * 4, *[f"n{i}"] * 12) for i in range(60)]
    rows += [(100 + i, " ".join(f"w{i}x{j}" for j in range(30)), *[str(i)] * 12) for i in range(60)]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)).repartition(7)
    want = sorted(map(str, set(rows)))
    for stage in (cp.keep_quality, cp.drop_copies, cp.drop_near_copies):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", *names]
    assert sorted(str(tuple(r)) for r in docs.collect()) == want


def test_one_query_for_each_operator():
    names = list(queries.build())
    assert [int(n[2:].split("_")[0]) for n in names if n.startswith("op")] == list(range(1, 14)) and "pipeline" in names
    assert set(queries.oracle()) <= set(names) and 4 <= len(cp.STAGES) <= 5


@pytest.mark.parametrize("name", ["op1_url_filter", "op6_exact_dedup", "op9_license_scan", "op11_fill_middle", "op12_warc"])
def test_sql(spark, name):
    import os
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from oracle_compare import compare

    assert all(compare(spark, "/root/testdata/sf0.001", [name], verbose=False)[name])
