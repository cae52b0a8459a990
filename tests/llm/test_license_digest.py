import os
import re
import textwrap
from collections import Counter
from hashlib import sha256

import duckdb
import pytest

from homeshift.llm import license_digest as ld
from homeshift.llm import license_digests as lt
from llm_edge import EDGE


def canon(t):
    t = t.lower()
    for a, b in ld.SPELLINGS:
        t = t.replace(a, b)
    t = re.sub(r"(?m)^[ \t]*(copyright|\(c\))[^\n]*$", "", t)
    return re.sub(r"[\W_]+", "", t)


def brute(rows, known=ld.LICENSES, digests=()):
    names, sizes = {}, {}
    for name, t in known:
        if c := canon(t):
            digests = [*digests, (name, len(c), c[: ld.START], sha256(c.encode()).hexdigest())]
    for name, size, start, d in digests:
        names.setdefault(d, set()).add(name)
        sizes.setdefault((size, start), set()).add(d)

    def get(t):
        return names.get(sha256(canon(t).encode()).hexdigest(), set())

    out = Counter()
    for i, t in rows:
        lines = [get(x) for x in (t or "").split("\n")]
        found = sorted({",".join(sorted(x)) for x in lines if x})
        runs, parts = [], [c for c in map(canon, (t or "").split("\n")) if c]
        for a in range(len(parts)):
            text = parts[a]
            for b in range(a + 1, len(parts)):
                text += parts[b]
                d = sha256(text.encode()).hexdigest()
                if d in sizes.get((len(text), parts[a][: ld.START]), ()):
                    runs.append(",".join(sorted(names[d])))
        out[(i, ",".join(sorted(get(t or ""))) or None, ",".join(found) or None, sum(map(bool, lines)), ",".join(sorted(set(runs))) or None, len(runs))] += 1
    return out


ROWS = EDGE + [
    (20, ld.LICENSES[0][1]),
    (21, ld.LICENSES[0][1].upper().replace("\n\n", "\n ** \n").replace("<YEAR> <HOLDER>", "2019-2021 Some One & Sons")),
    (22, "Some prose here.\nReleased under the MIT Licence!\nMore prose.\n  licensed under cc by-nc 4.0\nReleased under the MIT License."),
    (23, "Released under the MIT License. And more on the same line."),
    (24, "Copyright (c) 2020 X\n" + ld.ISC_BODY.replace("\n\n", "\n")),
    (25, "(c) only a notice\nCopyright by us"),
    (26, "---\n...\n"),
    (27, "# " + "\n# ".join(textwrap.wrap("MIT License", 40) + ["Copyright (c) 2019 A B"] + textwrap.wrap(ld.MIT_BODY, 70)) + "\nimport os\nprint(1)\n"),
    (28, "Some code.\n\n" + "\n".join(textwrap.wrap(ld.ISC_BODY, 52)) + "\n\nMore of it.\n" + "\n".join(textwrap.wrap(ld.ISC_BODY, 80))),
    (29, "\n".join(textwrap.wrap(ld.ISC_BODY, 60)) + " and more on the last line"),
    (30, "\n".join(["permission is hereby granted"] * 60)),
]


def test_equal_to_brute_force(spark, docs_of):
    got = ld.scan_licenses(docs_of(ROWS), ld.license_table(spark)).collect()
    assert Counter(tuple(r) for r in got) == brute(ROWS)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[21]["license"] == "MIT" and by_id[27]["passage_licenses"] == "MIT" and by_id[28]["n_passages"] == 2 and by_id[29]["n_passages"] == 0


def test_large_license_table_is_joined_by_shuffle(spark, docs_of, monkeypatch):
    monkeypatch.setattr(ld, "BROADCAST_ROWS", 0)
    known = ld.LICENSES + [("OTHER", "Released under the MIT License")]
    got = ld.scan_licenses(docs_of(ROWS), ld.license_table(spark, known)).collect()
    assert Counter(tuple(r) for r in got) == brute(ROWS, known)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "license string, text string")
    assert all(r["license"] is None and r["n_license_lines"] == 0 for r in ld.scan_licenses(docs_of(ROWS), none).collect())
    assert ld.scan_licenses(docs_of(ROWS).where("false"), ld.license_table(spark)).count() == 0


FOLDER = "/usr/share/common-licenses"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no folder of licence texts")
def test_whole_licences_from_the_parameter_file(spark, docs_of):
    """Every whole text, reflowed and inside a longer text, is found by its digest; the file holds what the texts give."""
    assert set(lt.rows(FOLDER)) == set(ld.known_digests())
    rows, names = [], {}
    for k, (name, t) in enumerate(lt.texts(FOLDER)):
        rows += [(2 * k, t), (2 * k + 1, "My program.\n\n" + t.replace("    ", " ") + "\nThe end.")]
        names[2 * k] = names[2 * k + 1] = name
    got = {r["doc_id"]: r for r in ld.scan_licenses(docs_of(rows), ld.license_table(spark, digests=ld.known_digests())).collect()}
    assert [i for i in names if i % 2 == 0 and got[i]["license"] != names[i]] == []
    assert [i for i in names if i % 2 == 1 and names[i] not in (got[i]["passage_licenses"] or "").split(",")] == []


def test_the_python_normal_form_is_the_same(spark):
    texts = [t for _, t in ld.LICENSES] + [t or "" for _, t in ROWS] + ["Straße №5 x² ٣ ÀÉ", "  copyright x\n(c) y\nz"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", ld.canonical(ld.F.col("text")).alias("c"))
    assert [r["c"] for r in df.orderBy("i").collect()] == [lt.canonical(t) for t in texts]


def test_sql_on_the_same_rows(spark, docs_of):
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [(i, t) for i, t in dict(ROWS).items() if i is not None])
    rows = con.execute(ld.oracle_sql()).fetchall()
    assert Counter(rows) == brute([(i, t) for i, t in dict(ROWS).items() if i is not None], digests=ld.known_digests())


def test_no_python_in_the_plan(spark, docs_of):
    plan = ld.scan_licenses(docs_of(EDGE), ld.license_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "InArrow" not in plan
