import time

import numpy as np
import pytest

from homeshift.llm import html_blocks as hb
from homeshift.llm import train_block_labeller as tb

MODEL = hb.Labeller.load()


def only(page):
    return MODEL.texts([page])[0]


def test_blocks_of_broken_markup():
    got = [t for t, _, _ in hb.blocks("<p>a <b>b\n c<p>d&amp;e &lt;x&gt; &copy;<!-- <p>no --><br>f<div title='x > y'>g</div><script>var t='</p><p>no';</script>h<ul><li>1<li>2</ul><style>p{}</style>end<p tail")]
    assert got == ["a b c", "d&e <x> © f", "g", "h", "1", "2", "end"]
    assert hb.blocks("") == [] and hb.blocks("<p></p> \n <!-- x") == [] and hb.blocks("a < b and c > d")[0][0] == "a < b and c > d"


def test_paths_survive_wrong_nesting():
    got = {t: [n[0] for n in p] for t, p, _ in hb.blocks("<div><p>x<table><tr><td>1<td>2</table></div></section><article>y</article>z")}
    assert got["1"][-1] == got["2"][-1] == "td" and got["y"] == ["article"] and got["z"] == []


def test_held_out_accuracy():
    blocks, pages = tb.held_out_accuracy(MODEL.w, seed=123, pages=400)
    assert blocks > 0.995 and pages > 0.97


PAGE = """<!DOCTYPE html><html><head><title>T</title></head><body><nav><ul><li><a href=/a>Home</a></li></ul></nav>
<div class="ad">Buy our goods now.</div><article><h1>The title</h1><p><b>First words of it.<br><p>Second  block &amp; more.</p></article>
<div class="comments"><p>I liked it very much.</p></div><form><p>Your mail</p></form><aside class="sidebar"><p>Popular posts</p></aside>
<div class="cookie-notice">We use cookies.</div><footer>&copy; x</footer></body></html>"""


def test_plain_layout():
    assert only(PAGE) == "The title\nFirst words of it.\nSecond block & more."


def test_one_page_alone_equals_pages_together():
    pages = [tb.Page(i).html() for i in range(40)]
    assert MODEL.texts(pages) == [only(p) for p in pages]


def test_gradients():
    rng = np.random.default_rng(0)
    dim, h = 3 + 2 + hb.NUMBERS, 4
    w = {"path": rng.normal(size=(hb.PATH_ROWS, 3)), "word": rng.normal(size=(hb.WORD_ROWS, 2)), "ow": rng.normal(size=(2 * h + dim, 1)), "ob": np.zeros(1)}
    for d in "fb":
        w |= {d + "w": rng.normal(size=(dim, 4 * h)) / 3, d + "u": rng.normal(size=(h, 4 * h)) / 3, d + "b": np.zeros(4 * h)}
    b = tb.batch_of([tb.labelled(3), tb.labelled(5)], hb.Features())
    _, g, _ = tb.loss_and_grad(w, b)
    for k, at in (("fw", (1, 2)), ("bu", (0, 5)), ("ow", (3, 0)), ("fb", (6,)), ("path", (int(b["rows"][0]), 1)), ("word", (int(b["words"][0]), 0))):
        eps = 1e-2
        up, down = (({**w, k: w[k].copy()}) for _ in range(2))
        up[k][at] += eps
        down[k][at] -= eps
        slope = (tb.loss_and_grad(up, b)[0] - tb.loss_and_grad(down, b)[0]) / (2 * eps)
        assert slope == pytest.approx(g[k][at], rel=0.05, abs=2e-4), k


def test_rows_and_edge_cases(spark):
    long = "<article>" + "<p>word and word.</p>" * 20_000 + "</article>"
    rows = [(1, "u1", PAGE), (1, "u1", PAGE), (2, None, None), (3, "u3", ""), (None, "u4", "<p"), (5, "u5", long), (6, "u6", "<" * 5000), (7, "u7", "<a b='" * 5000)]
    df = spark.createDataFrame([(*r, "t", 9) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    t = time.time()
    got = [tuple(r) for r in hb.extract_text(df).collect()]
    assert time.time() - t < 120
    want = [(i, u, only(h) if h else "", len(only(h)) if h else 0) for i, u, h in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert [g[3] for g in got if g[0] in (2, 3)] == [0, 0]
    assert hb.extract_text(df.where("false")).count() == 0


def test_visible_elements_are_not_dropped():
    assert only("<article><h1>A title of some words</h1><p>The formula <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds for every case.</p></article>") == "A title of some words\nThe formula x=2 holds for every case."
    kept = [t for t, _, _ in hb.blocks("<p>a<object>b</object><canvas>c</canvas><iframe>d</iframe><audio>e</audio></p><noscript>f</noscript><noframes>g</noframes>")]
    assert kept == ["abcde", "f", "g"]
    assert hb.blocks("<select><option>a</option></select><textarea>b</textarea><template><p>c</p></template><svg><text>d</text></svg><title>e</title>") == []


def plain_probabilities(w, items):
    """The network of one page by loops over blocks, gates and names."""
    x = []
    for k, (text, path, link) in enumerate(items):
        names = {n for level in path.levels() for n in level} | {"leaf:" + n for n in (path.levels()[-1] if len(path) else ("none",))}
        names |= {"near:" + n for level in path.levels()[-3:-1] for n in level}
        v = sum((w["path"][hb._row(n)].astype(float) for n in names), np.zeros(w["path"].shape[1]))
        words, _ = hb.Features.words([text])
        mean = w["word"][words].astype(float).mean(0) if len(words) else np.zeros(w["word"].shape[1])
        x.append(np.concatenate([v, mean, hb.Features.numbers(items)[k]]))
    size, states = w["fu"].shape[0], {}
    s = lambda v: 1 / (1 + np.exp(-v))
    for d, order in (("f", range(len(x))), ("b", range(len(x) - 1, -1, -1))):
        h = c = np.zeros(size)
        for t in order:
            z = x[t] @ w[d + "w"].astype(float) + h @ w[d + "u"].astype(float) + w[d + "b"]
            i, f, o, g = s(z[:size]), s(z[size : 2 * size] + 1), s(z[2 * size : 3 * size]), np.tanh(z[3 * size :])
            c = f * c + i * g
            h = o * np.tanh(c)
            states[d, t] = h
    return [s(float((np.concatenate([states["f", t], states["b", t], x[t]]) @ w["ow"].astype(float) + w["ob"])[0])) for t in range(len(x))]


def test_network_equals_plain_loops():
    pages = [hb.blocks(p, MODEL.root) for p in [PAGE] + [tb.Page(i).html() for i in range(12)]]
    got = MODEL.probabilities(pages)
    for items, p in zip(pages, got):
        assert np.allclose(p, plain_probabilities(MODEL.w, items), atol=2e-4)


def test_states_equal_the_training_pass():
    rng = np.random.default_rng(2)
    x, live = rng.normal(size=(70, 3, 5)).astype(np.float32), (rng.random((70, 3)) < 0.8).astype(np.float32)
    w, u, b = (rng.normal(size=s).astype(np.float32) for s in ((5, 16), (4, 16), (16,)))
    for back in (False, True):
        assert np.allclose(hb.lstm_states(x, live, w, u, b, back, part=16), hb.lstm(x, live, w, u, b, back)[0], atol=1e-5)


@pytest.mark.parametrize("page", [
    "".join(f"<div class=c{i}>w" for i in range(20_000)) + "</section>" * 20_000 + "</div>" * 20_000,
    "".join(f"<x{i % 7}>" for i in range(20_000)) + "<p>word" * 50_000,
    "<select><p>word" * 50_000,
])
def test_hard_pages_take_seconds(page):
    start = time.time()
    MODEL.texts([page])
    assert time.time() - start < 60


def test_many_blocks_in_little_memory():
    import tracemalloc

    tracemalloc.start()
    start = time.time()
    text = MODEL.texts(["<article>" + "<p>word and word.</p>" * 60_000 + "</article>"])[0]
    assert text.count("\n") > 45_000 and time.time() - start < 120
    assert tracemalloc.get_traced_memory()[1] < 80 << 20
    tracemalloc.stop()
