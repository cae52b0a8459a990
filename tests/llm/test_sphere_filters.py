import numpy as np
import pytest

from homeshift.llm import sphere_filters as sf


def planted(n=3000, dim=64, seed=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, 600, 2):
        c, d = r.uniform(0.95, 0.97), r.normal(size=dim)
        d -= x[i] * (d @ x[i])
        x[i + 1] = c * x[i] + np.sqrt(1 - c * c) * d / np.linalg.norm(d)
    x[1000:1300] = x[1000] + r.normal(size=(300, dim)) * 0.002
    x[1400:1450] = x[1400]
    return (x * r.uniform(0.1, 9, (n, 1))).astype(np.float32)


def degrees(x, cosine=0.95):
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    link = y @ y.T >= cosine
    return link.sum(1) - 1, link


def component(link):
    low = np.arange(len(link))
    while True:
        new = np.where(link, low[None, :], len(link)).min(axis=1)
        if (new == low).all():
            return low
        low = new


@pytest.mark.parametrize("block", [1024, 64])
def test_recall_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(sf, "BLOCK", block)
    x = planted()
    deg, link = degrees(x)
    df = spark.createDataFrame([(i, v, 1, 5) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>, label int, node int")
    out = {r["vec_id"]: r for r in sf.embedding_components(df).collect()}
    got = np.array([out[i]["n_links"] for i in range(len(x))])
    assert len(out) == len(x) and (got <= deg).all()  # nothing below the threshold, no pair counted twice
    assert got.sum() >= 0.99 * deg.sum() and got[:600].sum() >= 0.99 * deg[:600].sum()
    comp = np.array([out[i]["component_id"] for i in range(len(x))])
    assert (comp == component(link)).mean() > 0.99
    assert all(out[i]["kept"] == (out[i]["component_id"] == i) for i in out)


def test_edge_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [nan, 1.0, 0.0]), (7, [inf, 1.0, 0.0]),
        (8, [None, 1.0, 0.0]), (9, [1.0, 0.0]), (10, [1e-30, 0.0, 0.0]), (11, [-1.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0]), (12, [5.0]), (13, [7.0]), (2, [2.0, 0.0, 0.0]), (14, [1e300, 0.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in sf.embedding_components(df).collect())
    linked = [(i, 4, 1) for i in (1, 2, 2, 10, 14)]
    alone = [(i, 0, i) for i in (3, 4, 5, 6, 7, 8, 9, 11)]
    assert got == sorted([(0, 0, None), (12, 1, 12), (13, 1, 12), *linked, *alone], key=lambda t: (t[0], t[1]))


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert sf.embedding_components(df).count() == 0


@pytest.mark.parametrize("n", [2_000, 20_000, 1_000_000, 100_000_000])
def test_recall_at_the_threshold_does_not_fall_with_the_number_of_vectors(n):
    code = sf.fitted_code(64, n, 0.95, 0.9995, 16, 64, 8)
    m = 2000 if n < 10**7 else 500
    recall = sf.recall_at(code, *sf.pairs_at(64, 0.95, m, 7))
    print(n, code.least, code.words, recall)
    assert recall >= 0.998


@pytest.mark.parametrize("dim", [2, 3, 16, 64])
def test_cap_height_has_its_share(dim):
    r = np.random.default_rng(dim)
    x = r.normal(size=(400_000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    product = x[:, 0] + x[:, (dim + 1) // 2]  # the direction of two unit code words
    for share in (0.1, 0.003):
        assert abs((product >= sf.cap_height(dim, share)).mean() / share - 1) < 0.12


@pytest.mark.parametrize("cosine, dim", [(-0.2, 5), (0.3, 3), (0.95, 1)])
def test_where_no_number_of_filters_is_enough_every_pair_is_compared(spark, monkeypatch, cosine, dim):
    monkeypatch.setattr(sf, "MOST_FILTERS", 16)
    monkeypatch.setattr(sf, "BLOCK", 50)
    x = np.random.default_rng(dim).normal(size=(300, dim)).astype(np.float32)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    deg, link = degrees(x, cosine)
    out = {r["vec_id"]: r for r in sf.embedding_components(df, cosine).collect()}
    assert [out[i]["n_links"] for i in range(300)] == deg.tolist()
    assert [out[i]["component_id"] for i in range(300)] == component(link).tolist()


def test_shared_filters_are_counted_in_parts(monkeypatch):
    import pyarrow as pa

    r = np.random.default_rng(1)
    x = np.repeat(r.normal(size=(6, 8)), 5, axis=0)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = [np.unique(np.append(r.integers(0, 60, 12), 30)) for _ in range(30)]
    want = None
    for columns in (2048, 3, 1):
        monkeypatch.setattr(sf, "COLUMNS", columns)
        got = sf._links_in_filter(30, np.zeros(30, int), np.arange(30), np.ones(30, int), x, pa.array(lists, pa.list_(pa.int64())), 0.95)
        first = [sum(x[i] @ x[j] >= 0.95 and min(set(lists[i]) & set(lists[j])) == 30 for j in range(30) if j != i) for i in range(30)]
        assert got[1].tolist() == first
        want = want or [g.tolist() for g in got]
        assert want == [g.tolist() for g in got]
