"""Training of the block labeller on generated pages: ``python -m homeshift.llm.train_block_labeller``.

Pages are drawn at random: an article (with or without a telling wrapper) and
menus, site headers, breadcrumbs, sidebars, adverts, notices, forms, related links, reader
comments and footers around it and inside it.  Each block's label is known from the drawing.
"""

from __future__ import annotations

import random
import sys

import numpy as np

from homeshift.llm.html_blocks import NUMBERS, PATH_ROWS, WEIGHTS, WORD_ROWS, Features, Labeller, bag, blocks, lstm, sigmoid

SYLLABLES = "an ar be ca che ci da de di en er es fa ge he hi in is ja ka la le li lo ma me mi na ne ni no o on or ou pa que ra re ri sa sch se si st ta te ti tion to tra u un ver vi wa wh ye zu ño ção für élé".split()
BOILER = {
    "menu": ("nav menu navbar navigation topnav mainmenu links tabs", "Home About Contact News Sport Products Services Sitemap Archive Login Help".split()),
    "header": ("header masthead top site brand logo topbar branding", "Welcome to the official site | Daily news for everyone".split()),
    "crumbs": ("breadcrumb breadcrumbs crumbs trail", "Home > News > Local".split()),
    "side": ("sidebar aside widget rail secondary sidenav right left column", "Popular Trending Latest Recent posts Tags Categories Most read".split()),
    "advert": ("ad ads advert advertisement banner sponsor sponsored promo promoted adbox adsense commercial", "Advertisement Sponsored Buy now Sale Best offer Click here Limited time discount".split()),
    "notice": ("cookie cookies consent notice gdpr alert popup modal privacy disclaimer message warning overlay", "We use cookies to improve your experience. Accept all By using this site you agree to our terms".split()),
    "form": ("form signup newsletter subscribe search login register contact", "Subscribe Sign up Enter your email Search Send Submit Password Your name".split()),
    "related": ("related recommended more suggestions share social pagination pager tags readmore", "Read more You may also like Related articles Share on Next Previous".split()),
    "comments": ("comments comment reply replies discussion respond thread disqus feedback reader", "says: Reply Great post! I agree Thanks for sharing Leave a comment Posted by".split()),
    "footer": ("footer foot bottom copyright colophon legal credits", "© Copyright All rights reserved. Imprint Privacy Terms of use Contact".split()),
}
GOOD = "article content main post entry story text body maincontent articlebody postbody entrycontent storybody page prose news blog".split()
NEUTRAL = "container wrapper row col md inner outer box block clearfix group grid layout wrap section area slot holder zone unit panel list item page main".split()


def draw_words(r: random.Random, n: int) -> str:
    out = []
    for _ in range(n):
        w = "".join(r.choice(SYLLABLES) for _ in range(r.choice((1, 1, 2, 2, 3, 4))))
        if r.random() < 0.12:
            w = w.capitalize()
        if r.random() < 0.1:
            w += r.choice(".,.!;")
        if r.random() < 0.02:
            w = r.choice(("&amp;", "&quot;", "12", "2024", "$5", "|", "***"))
        out.append(w)
    s = " ".join(out)
    s = s[:1].upper() + s[1:]
    s += r.choice(("", ".", ".", "."))
    return s.upper() + "!!" if r.random() < 0.03 else s


class Page:
    def __init__(self, seed: int):
        self.r, self.out, self.marks = random.Random(seed), [], 0

    def text(self, s: str, good: bool) -> str:
        """Text with a mark that carries the label; the mark is taken out again after parsing."""
        return ("\ue001" if good else "\ue000") + s

    def attrs(self, names: list[str]) -> str:
        r = self.r
        if r.random() < 0.45:
            names = names + [r.choice(NEUTRAL)]
        if r.random() < 0.1:
            names = names + ["x%d" % r.randrange(1000)]
        key = "id" if r.random() < 0.25 else "class"
        value = r.choice((" ", "-", "_", " ")).join(names)
        quote = r.choice(('"', '"', "'")) if " " in value or r.random() < 0.8 else ""
        return f" {key}={quote}{value}{quote}" if names else ""

    def boiler(self, kind: str, depth: int = 0) -> str:
        r = self.r
        names, words = BOILER[kind]
        tags = {"menu": ("nav", "div", "ul"), "header": ("header", "div"), "crumbs": ("div", "nav", "ul"), "side": ("aside", "div"), "form": ("form", "form", "div"), "footer": ("footer", "div"), "comments": ("div", "section")}
        tag = r.choice(tags.get(kind, ("div", "div", "section", "aside") if kind != "advert" else ("div", "div", "div", "aside", "p")))
        told = tag in ("nav", "header", "aside", "form", "footer")
        own = [r.choice(names.split())] if not told or r.random() < 0.5 else []

        def line() -> str:
            if kind == "comments":
                return draw_words(r, r.randint(2, 60))
            own_words = r.sample(words, min(len(words), r.randint(1, 6)))
            kind_of = r.random()
            return " ".join(own_words) if kind_of < 0.35 else draw_words(r, r.randint(1, 25) if kind not in ("menu", "crumbs") else r.randint(1, 3))

        parts = []
        for _ in range(r.randint(1, 7) if kind in ("menu", "related", "side", "comments", "crumbs") else r.randint(1, 3)):
            s = self.text(line(), False)
            style = r.random()
            if kind in ("menu", "crumbs", "related") and style < 0.8 or style < 0.15:
                s = f'<a href="/{r.randrange(99)}">{s}</a>'
                s = f"<li>{s}</li>" if r.random() < 0.8 else f"{s} "
            elif kind == "comments" and style < 0.6:
                s = f'<div class="{r.choice(("comment", "reply", "comment-body", "media"))}"><p>{s}</p></div>'
            elif kind == "form":
                s = r.choice(("<label>%s</label><input>", "<p>%s</p><input type=text>", "<button>%s</button>", "<div>%s</div>")) % s
            elif style < 0.5:
                s = f"<p>{s}</p>"
            elif style < 0.6:
                level = r.choice("123" if kind == "header" else "2344")
                s = f"<h{level}>{s}</h{level}>"
            elif style < 0.75:
                s = f"<div>{s}</div>"
            parts.append(s)
        body = "".join(parts)
        if "<li>" in body and tag != "ul":
            body = f"<ul>{body}</ul>"
        if tag == "p" and "<" in body:
            tag = "div"
        extra = "<!-- %s -->" % r.choice(("ad", "x", "menu > y")) if r.random() < 0.2 else ""
        return f"{extra}<{tag}{self.attrs(own)}>{body}</{tag}>"

    def article(self) -> str:
        r = self.r
        parts = []
        if r.random() < 0.75:
            title = f"<h1>{self.text(draw_words(r, r.randint(1, 12)), True)}</h1>"
            parts.append(f"<header>{title}</header>" if r.random() < 0.1 else title)
        for _ in range(r.choice((0, 1, 1, 2, 3, 4, 5, 6, 8, 10, 15, 25))):
            style = r.random()
            s = self.text(draw_words(r, r.choice((1, 1, 2, 4, 8, 15, 30, 50, 80))), True)
            if style < 0.55:
                s = f"<p>{s}" + ("</p>" if r.random() < 0.9 else "")
            elif style < 0.65:
                s = f"<p><b>{s}<br>"
            elif style < 0.7:
                s = f"<h{r.choice('2234')}>{s}</h2>" if r.random() < 0.05 else f"<h2>{s}</h2>"
            elif style < 0.75:
                s = f"<p>{s} <a href='/x'>{draw_words(r, 2)}</a> {draw_words(r, 4)}</p>"
            elif style < 0.8:
                s = "<ul>" + "".join(f"<li>{self.text(draw_words(r, r.randint(1, 20)), True)}</li>" for _ in range(r.randint(1, 5))) + "</ul>"
            elif style < 0.84:
                s = f"<blockquote>{s}</blockquote>"
            elif style < 0.88:
                s = f"<figure><img src=a.jpg><figcaption>{s}</figcaption></figure>"
            elif style < 0.92:
                s = "<table>" + "".join(f"<tr><td>{self.text(draw_words(r, 3), True)}</td><td>{self.text(draw_words(r, 2), True)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>"
            elif style < 0.95:
                s = f"<pre>{s}</pre>"
            else:
                s = f"<div>{s}</div>"
            parts.append(s)
            if r.random() < 0.12:
                parts.append(self.boiler(r.choice(("advert", "advert", "related", "notice", "form", "side"))))
        if r.random() < 0.15:
            parts.append(self.boiler(r.choice(("comments", "comments", "related", "form", "footer", "notice"))))
        body = "".join(parts)
        kind = r.random()
        if kind < 0.5:
            body = f"<article{self.attrs([r.choice(GOOD)] if r.random() < 0.4 else [])}>{body}</article>"
        elif kind < 0.7:
            body = f"<main{self.attrs([r.choice(GOOD)] if r.random() < 0.3 else [])}>{body}</main>"
        elif kind < 0.93:
            body = f"<div{self.attrs([r.choice(GOOD)])}>{body}</div>"
        return body

    def html(self) -> str:
        r = self.r
        if r.random() < 0.05:  # nothing but text, with little or no markup
            return "".join(r.choice(("%s", "<p>%s</p>", "<div>%s</div>", "<h2>%s</h2>")) % self.text(draw_words(r, r.randint(3, 40)), True) for _ in range(r.choice((1, 1, 2, 4))))
        above = [k for k in ("notice", "header", "menu", "crumbs", "advert", "side", "form") if r.random() < (0.75 if k == "menu" else 0.35)]
        below = [k for k in ("related", "side", "advert", "comments", "form", "notice", "footer") if r.random() < (0.75 if k == "footer" else 0.35)]
        parts = [self.boiler(k) for k in above] + [self.article()] + [self.boiler(k) for k in below]
        body = "".join(parts)
        if r.random() < 0.35:
            body = f'<div{self.attrs([r.choice(NEUTRAL)])}>{body}</div>'
        head = '<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>x</title><style>p{}</style><script>var t="</p>";</script></head><body>'
        return head + body + ("</body></html>" if r.random() < 0.8 else "")


def labelled(seed: int):
    """Blocks and labels of one drawn page."""
    items, y = [], []
    for t, p, link in blocks(Page(seed).html()):
        good = t.count("\ue001") > 0
        t = t.replace("\ue001", "").replace("\ue000", "").strip()
        if t:
            items.append((t, p, link))
            y.append(good)
    return items, np.array(y, np.float32)


def batch_of(pages, features: Features):
    sizes = np.array([len(p) for p, _ in pages])
    items = [x for p, _ in pages for x in p]
    rows = [features.path_rows(p) for _, p, _ in items]
    words, per_word = Features.words([t for t, _, _ in items])
    return {
        "sizes": sizes,
        "rows": np.concatenate(rows),
        "per_row": np.array([len(r) for r in rows]),
        "words": words,
        "per_word": per_word,
        "numbers": np.concatenate([Features.numbers(p) for p, _ in pages]),
        "y": np.concatenate([y for _, y in pages]),
    }


def lstm_grad(x, live, w, u, kept, dout):
    """Gradients of one direction: (dx, dw, du, db)."""
    size = u.shape[0]
    n = x.shape[1]
    dh, dc = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
    dz_all = np.zeros((*x.shape[:2], 4 * size), np.float32)
    du = np.zeros_like(u)
    for t, i, f, o, g, c, h, tc, m in reversed(kept):
        dh = dh + dout[t]
        dnew = dh * m
        do = dnew * tc
        dnew_c = dc * m + dnew * o * (1 - tc * tc)
        dz = np.concatenate([dnew_c * g * i * (1 - i), dnew_c * c * f * (1 - f), do * o * (1 - o), dnew_c * i * (1 - g * g)], axis=1)
        dz_all[t] = dz
        du += h.T @ dz
        dh = dh * (1 - m) + dz @ u.T
        dc = dc * (1 - m) + dnew_c * f
    flat = dz_all.reshape(-1, 4 * size)
    return dz_all @ w.T, x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(axis=0)


def loss_and_grad(w, b):
    sizes, n = b["sizes"], len(b["sizes"])
    steps = int(sizes.max())
    dp, dw_ = w["path"].shape[1], w["word"].shape[1]
    x = np.concatenate([bag(w["path"], b["rows"], b["per_row"], False), bag(w["word"], b["words"], b["per_word"], True), b["numbers"]], axis=1)
    live = (np.arange(steps)[:, None] < sizes).astype(np.float32)
    col = np.repeat(np.arange(n), sizes)
    row = np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    pad = np.zeros((steps, n, x.shape[1]), np.float32)
    pad[row, col] = x
    fwd, kf = lstm(pad, live, w["fw"], w["fu"], w["fb"], False)
    bwd, kb = lstm(pad, live, w["bw"], w["bu"], w["bb"], True)
    both = np.concatenate([fwd, bwd, pad], axis=2)
    top = both[row, col]
    p = sigmoid((top @ w["ow"] + w["ob"])[:, 0])
    dz = ((p - b["y"]) / len(p))[:, None].astype(np.float32)
    g = {"ow": top.T @ dz, "ob": dz.sum(axis=0)}
    dtop = np.zeros_like(both)
    dtop[row, col] = dz @ w["ow"].T
    size = w["fu"].shape[0]
    dx1, g["fw"], g["fu"], g["fb"] = lstm_grad(pad, live, w["fw"], w["fu"], kf, dtop[:, :, :size])
    dx2, g["bw"], g["bu"], g["bb"] = lstm_grad(pad, live, w["bw"], w["bu"], kb, dtop[:, :, size : 2 * size])
    dx = (dx1 + dx2 + dtop[:, :, 2 * size :])[row, col]
    g["path"], g["word"] = np.zeros_like(w["path"]), np.zeros_like(w["word"])
    np.add.at(g["path"], b["rows"], np.repeat(dx[:, :dp], b["per_row"], axis=0))
    np.add.at(g["word"], b["words"], np.repeat(dx[:, dp : dp + dw_] / np.maximum(b["per_word"], 1)[:, None], b["per_word"], axis=0))
    return -np.mean(np.log(np.where(b["y"] > 0.5, p, 1 - p) + 1e-7)), g, p


def train(pages: int = 15000, epochs: int = 8, hidden: int = 20, path_dim: int = 16, word_dim: int = 4, seed: int = 1, rate: float = 0.006):
    rng = np.random.default_rng(seed)
    dim = path_dim + word_dim + NUMBERS

    def init(a, b):
        return (rng.normal(size=(a, b)) / np.sqrt(a)).astype(np.float32)

    w = {"path": np.zeros((PATH_ROWS, path_dim), np.float32), "word": np.zeros((WORD_ROWS, word_dim), np.float32), "ow": init(2 * hidden + dim, 1), "ob": np.zeros(1, np.float32)}
    for d in "fb":
        w |= {d + "w": init(dim, 4 * hidden), d + "u": init(hidden, 4 * hidden), d + "b": np.zeros(4 * hidden, np.float32)}
    features = Features()
    data = [x for x in (labelled(seed * 1_000_000 + i) for i in range(pages)) if x[0]]
    data.sort(key=lambda x: len(x[0]))
    batches = [batch_of(data[i : i + 48], features) for i in range(0, len(data), 48)]
    m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        total = 0.0
        for i in rng.permutation(len(batches)):
            b = batches[i]
            told = rng.random(len(b["rows"])) > 0.07  # names are left out at random, so that no single one decides
            owner = np.repeat(np.arange(len(b["per_row"])), b["per_row"])
            loss, g, _ = loss_and_grad(w, b | {"rows": b["rows"][told], "per_row": np.bincount(owner[told], minlength=len(b["per_row"]))})
            total += loss
            step += 1
            lr = rate * min(1, step / 100) * (0.15 ** (epoch / max(1, epochs - 1)))
            for k in w:
                np.clip(g[k], -1, 1, out=g[k])
                if k in ("path", "word"):
                    g[k] += 1e-5 * w[k]
                m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                m2[k] = 0.99 * m2[k] + 0.01 * g[k] ** 2
                w[k] -= lr * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-7)
        print(f"epoch {epoch}: loss {total / len(batches):.4f}", file=sys.stderr, flush=True)
    return w


def held_out_accuracy(w, seed: int = 77, pages: int = 500) -> tuple[float, float]:
    """Share of right blocks and of pages without a wrong block, on pages that were not trained on."""
    model = Labeller(w)
    data = [x for x in (labelled(seed * 1_000_000 + i) for i in range(pages)) if x[0]]
    right = [(p >= 0.5) == (y > 0.5) for p, (_, y) in zip(model.probabilities([x for x, _ in data]), data)]
    return float(np.mean(np.concatenate(right))), float(np.mean([r.all() for r in right]))


if __name__ == "__main__":
    weights = train()
    print("held out: blocks %.4f, whole pages %.4f" % held_out_accuracy(weights))
    np.savez_compressed(sys.argv[1] if len(sys.argv) > 1 else WEIGHTS, **{k: v.astype(np.float16 if k in ("path", "word") else np.float32) for k, v in weights.items()})
