"""Operator 10: main-text extraction with a recurrent block labeller.

1. A page is cut into leaf blocks: maximal runs of text between block-level tags. Comments, scripts,
   styles, form fields, templates, drawings and the head's title are skipped; everything else, formulas and the content of
   ``noscript``, ``object`` or ``iframe`` too, is left to the labeller; character references are
   decoded; white space inside a block becomes one space.
2. Each block becomes a vector: summed embeddings of its tag path (tags, class and id
   words of all open elements, hashed), mean embedding of its hashed words, and a few numbers (length,
   share of link text, end mark).
3. A bidirectional LSTM in numpy reads the whole sequence of blocks of a page and gives each one
   the probability of being article text, so a decision uses the context of the whole document.
4. Blocks at 0.5 or more are joined in page order by one newline.

The weights in ``block_labeller.npz`` were trained by ``train_block_labeller.py`` on generated
pages with known labels; the path is a parameter.  Pages are independent: no shuffle, no state between
batches; pages of similar length run through the network together, at most ``BATCH_STEPS`` blocks
at a time (or one longer page).  A path shares what its parent has: names are summed once an element, however deep it
lies; prediction keeps hidden states only.

Defined results: null or empty html gives an empty text; a page without article
blocks too; unclosed and wrongly nested tags are repaired as browsers do in the common cases; a tag that is cut off
at the end is dropped; very long pages and very deep ones are read whole; repeated rows stay, as do null ids and urls; other columns
of the input, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from homeshift.llm.flat_text import _BYTE, ascii_words, lower_ascii, spans_hash

WEIGHTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "block_labeller.npz")
PATH_ROWS, WORD_ROWS = 4096, 2048
NUMBERS = 6
BATCH_STEPS = 20_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var br img wbr nobr "
    "object iframe canvas audio video map math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup "
    "msubsup munder mover munderover mmultiscripts mtable mtr mtd semantics".split()
)
HIDDEN = frozenset("script style template title textarea select datalist svg annotation annotation-xml".split())
#: An opening tag of the key closes an open element of the value.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
#: Elements beyond which an implied end does not reach.
FENCE = frozenset("ul ol dl table article section div nav aside main header footer form blockquote body".split())
ENDS_P = FENCE | frozenset("h1 h2 h3 h4 h5 h6 pre hr address fieldset figure details".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)[^>]*>|</?[a-zA-Z][^>]*\Z", re.S)
NAME = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORDS = re.compile(r"[a-z0-9]+")


def _names(tag: str, attrs: str) -> tuple[str, ...]:
    out = [tag]
    if attrs and "=" in attrs:
        for m in NAME.finditer(attrs):
            out += WORDS.findall((m.group(1) or m.group(2) or m.group(3) or "").lower())
    return tuple(out)


class Path:
    """The open elements of a block, outermost first: names of the innermost one, and its parent.

    ``fresh``: the names that no outer element has.  Children are shared, so a path that was seen is the same object.
    """

    __slots__ = ("parent", "names", "depth", "fresh", "children", "base", "vector")

    def __init__(self, parent: "Path | None" = None, names: tuple[str, ...] = (), fresh: tuple[str, ...] = ()):
        self.parent, self.names, self.fresh = parent, names, fresh
        self.depth = 0 if parent is None else parent.depth + 1
        self.children: dict[tuple, Path] = {}
        self.base = self.vector = None

    def levels(self) -> list[tuple[str, ...]]:
        out, p = [], self
        while p.parent is not None:
            out.append(p.names)
            p = p.parent
        return out[::-1]

    def __iter__(self):
        return iter(self.levels())

    def __len__(self) -> int:
        return self.depth

    def own_names(self) -> set[str]:
        """Names that only the innermost elements add: the leaf's, and those of the two around it."""
        out = {"leaf:" + x for x in (self.names if self.depth else ("none",))}
        p = self.parent
        for _ in range(2):
            if p is not None and p.parent is not None:
                out |= {"near:" + x for x in p.names}
                p = p.parent
        return out


class Stack:
    """Open elements while a page is read; counts keep every step independent of the depth."""

    def __init__(self, root: Path):
        self.path, self.tags = root, []
        self.open, self.names = Counter(), Counter()  # open tags; names on the path
        self.scopes = [Counter()]  # open tags since each fence

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        child = self.path.children.get(names)
        if child is None:
            child = self.path.children[names] = Path(self.path, names, tuple(dict.fromkeys(x for x in names if not self.names[x])))
        self.path = child
        self.tags.append(tag)
        self.open[tag] += 1
        self.names.update(names)
        if tag in FENCE:
            self.scopes.append(Counter())
        else:
            self.scopes[-1][tag] += 1

    def pop(self) -> str:
        tag = self.tags.pop()
        self.open[tag] -= 1
        for x in self.path.names:
            self.names[x] -= 1
        if tag in FENCE:
            self.scopes.pop()
        else:
            self.scopes[-1][tag] -= 1
        self.path = self.path.parent
        return tag

    def close(self, tag: str) -> None:
        if self.open[tag]:
            while self.pop() != tag:
                pass

    def end(self, tags) -> None:
        """Implied ends: every open element of ``tags`` since the last fence is closed, with all inside it."""
        while any(self.scopes[-1][t] for t in tags):
            self.pop()


def blocks(page: str, root: Path | None = None) -> list[tuple[str, Path, float]]:
    """(text, path, share of link text) of each leaf block; paths grow from ``root``."""
    out: list[tuple[str, Path, float]] = []
    stack = Stack(Path() if root is None else root)
    parts: list[str] = []
    unclosed: set[str] = set()
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((text, stack.path, min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    def text(s: str) -> None:
        nonlocal linked
        if s:
            parts.append(s)
            if links:
                linked += len(s)

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        tag = (m.group(2) or m.group(5) or "").lower()
        if not tag:
            continue
        closing = bool(m.group(1) or m.group(4))
        if tag in HIDDEN:
            if not closing and not (m.group(3) or "").endswith("/"):
                end = None if tag in unclosed else _end_of(tag).search(page, at)
                if end is None:
                    unclosed.add(tag)  # no later end either
                at = end.end() if end else (n if tag in ("script", "style") else at)
            if tag not in ("svg", "annotation", "annotation-xml"):
                text(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            if tag in ("br", "img", "wbr"):
                text(" ")
            continue
        flush()
        if closing:
            stack.close(tag)
            links = 0
            continue
        ends = CLOSES.get(tag, {"p"} if tag in ENDS_P else ())
        if ends:
            stack.end(ends)
        if tag not in VOID and not (m.group(3) or "").endswith("/"):
            stack.push(tag, _names(tag, m.group(3) or ""))
    flush()
    return out


@lru_cache
def _end_of(tag: str) -> re.Pattern:
    return re.compile(f"</{tag}\\b[^>]*>", re.I)


@lru_cache(1 << 17)
def _row(name: str) -> int:
    raw = np.frombuffer(name.encode(), np.uint8)
    return int(spans_hash(_BYTE[raw], np.array([0]), np.array([len(raw)]))[0] % np.uint64(PATH_ROWS))


class Features:
    """Rows of the embedding tables and numbers of blocks."""

    @staticmethod
    def path_rows(path: Path) -> np.ndarray:
        """Rows of all names of a path (training; ``path_vector`` is their sum)."""
        names = {x for level in path.levels() for x in level} | path.own_names()
        return np.array(sorted(_row(x) for x in names), dtype=np.int64)

    @staticmethod
    def path_vector(path: Path, table: np.ndarray) -> np.ndarray:
        """Sum of the table's rows of a path's names; outer elements are summed once and shared."""
        if path.vector is None:
            todo, p = [], path
            while p.base is None:
                todo.append(p)
                if p.parent is None:
                    break
                p = p.parent
            for p in reversed(todo):
                own = table[[_row(x) for x in p.fresh]].sum(axis=0)
                p.base = own if p.parent is None else p.parent.base + own
            path.vector = path.base + table[[_row(x) for x in path.own_names()]].sum(axis=0)
        return path.vector

    @staticmethod
    def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashed words of all texts and the number of words of each."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        off = np.r_[0, np.cumsum([len(b) for b in raw])]
        data = lower_ascii(np.frombuffer(b"".join(raw), np.uint8))
        starts, ends, per = ascii_words(data, off)
        return (spans_hash(_BYTE[data], starts, ends) % np.uint64(WORD_ROWS)).astype(np.int64), per

    @staticmethod
    def numbers(items: list[tuple[str, Path, float]]) -> np.ndarray:
        n = len(items)
        out = np.zeros((n, NUMBERS), np.float32)
        for i, (t, p, link) in enumerate(items):
            out[i] = (np.log1p(len(t)) / 6, link, t[-1] in ".!?\"”»:;", min(len(p), 12) / 12, i / max(1, n - 1), t[0] in "©")
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def bag(table: np.ndarray, rows: np.ndarray, per: np.ndarray, mean: bool) -> np.ndarray:
    """Sum (or mean) of the table's rows for each of ``per`` runs of ``rows``."""
    out = np.zeros((len(per), table.shape[1]), np.float32)
    has = per > 0
    if len(rows):
        out[has] = np.add.reduceat(table[rows], (np.cumsum(per) - per)[has], axis=0)
    return out / np.maximum(per, 1)[:, None] if mean else out


def lstm(x: np.ndarray, live: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, back: bool):
    """Hidden states (T, N, H) of one direction; padded steps keep the state.  Also what training needs."""
    steps, n, _ = x.shape
    size = u.shape[0]
    h, c = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
    out = np.zeros((steps, n, size), np.float32)
    kept = []
    pre = x @ w + b
    for t in range(steps - 1, -1, -1) if back else range(steps):
        z = pre[t] + h @ u
        i, f, o = sigmoid(z[:, :size]), sigmoid(z[:, size : 2 * size] + 1), sigmoid(z[:, 2 * size : 3 * size])
        g = np.tanh(z[:, 3 * size :])
        m = live[t][:, None]
        new_c = f * c + i * g
        tc = np.tanh(new_c)
        kept.append((t, i, f, o, g, c, h, tc, m))
        c = m * new_c + (1 - m) * c
        h = m * (o * tc) + (1 - m) * h
        out[t] = h
    return out, kept


def lstm_states(x: np.ndarray, live: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, back: bool, part: int = 2048) -> np.ndarray:
    """The hidden states of ``lstm`` alone; inputs meet their weights ``part`` steps at a time, nothing else is kept."""
    steps, n, _ = x.shape
    size = u.shape[0]
    # all gates by one tanh: sigmoid(v) = tanh(v / 2) / 2 + 1 / 2
    half = np.where(np.arange(4 * size) < 3 * size, 0.5, 1.0).astype(np.float32)
    plus = (1 - half) * (half < 1)
    w, u, b = w * half, np.ascontiguousarray(u * half), (b + np.where((np.arange(4 * size) // size) == 1, 1.0, 0.0)).astype(np.float32) * half
    h, c = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
    out = np.zeros((steps, n, size), np.float32)
    masked = not live.all()
    for at in range(0, steps, part):
        span = range(at, min(at + part, steps))
        if back:
            span = range(steps - 1 - span.start, steps - 1 - span.stop, -1)
        first = min(span[0], span[-1])
        pre = x[first : first + len(span)] @ w + b
        for t in span:
            z = np.tanh(pre[t - first] + h @ u)
            z *= half
            z += plus
            new_c = z[:, size : 2 * size] * c + z[:, :size] * z[:, 3 * size :]
            new_h = z[:, 2 * size : 3 * size] * np.tanh(new_c)
            if masked:
                m = live[t][:, None]
                new_c, new_h = m * new_c + (1 - m) * c, m * new_h + (1 - m) * h
            c = new_c
            out[t] = h = new_h
    return out


class Labeller:
    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights
        self.root, self.seen = Path(), 0

    @classmethod
    def load(cls, path: str = WEIGHTS) -> "Labeller":
        with np.load(path) as f:
            return cls({k: f[k].astype(np.float32) for k in f.files})

    def vectors(self, pages: list[list[tuple[str, Path, float]]]) -> np.ndarray:
        """Input vectors of all blocks of all pages, one after the other."""
        items = [x for p in pages for x in p]
        words, per = Features.words([t for t, _, _ in items])
        path = np.zeros((len(items), self.w["path"].shape[1]), np.float32)
        for i, (_, p, _) in enumerate(items):
            path[i] = Features.path_vector(p, self.w["path"])
        return np.concatenate([path, bag(self.w["word"], words, per, True), np.concatenate([Features.numbers(p) for p in pages if p])], axis=1)

    def probabilities(self, pages: list[list[tuple[str, Path, float]]]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end - at + 1) * len(pages[order[end]]) <= BATCH_STEPS:
                end += 1
            group = order[at:end]
            at = end
            sizes = np.array([len(pages[i]) for i in group])
            x = self.vectors([pages[i] for i in group])
            steps, n = int(sizes.max()), len(group)
            live = (np.arange(steps)[:, None] < sizes).astype(np.float32)
            col = np.repeat(np.arange(n), sizes)
            row = np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            if n == 1:
                pad = x[:, None]
            else:
                pad = np.zeros((steps, n, x.shape[1]), np.float32)
                pad[row, col] = x
            size = self.w["fu"].shape[0]
            z = x @ self.w["ow"][2 * size :] + self.w["ob"]
            for k, d in enumerate("fb"):  # one direction's states at a time
                z += lstm_states(pad, live, self.w[d + "w"], self.w[d + "u"], self.w[d + "b"], d == "b")[row, col] @ self.w["ow"][k * size : (k + 1) * size]
            for i, p in zip(group, np.split(sigmoid(z[:, 0]), np.cumsum(sizes)[:-1])):
                out[i] = p
        return out

    def texts(self, pages: list[str]) -> list[str]:
        cut = []
        for p in pages:
            if self.seen > 50_000:  # known paths are dropped, those of this call live on in its blocks
                self.root, self.seen = Path(), 0
            cut.append(blocks(p, self.root))
            self.seen += len(cut[-1])
        return ["\n".join([t for (t, _, _), p in zip(c, probs) if p >= 0.5]) for c, probs in zip(cut, self.probabilities(cut))]


_LOADED: dict[str, Labeller] = {}


def extract_text(pages, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", weights: dict | None = None, chunk: int = 64):
    """(id, url, text, n_chars) of every row; ``weights`` replaces the trained ones."""
    model = Labeller(weights) if weights else Labeller.load()
    shared = pages.sparkSession.sparkContext.broadcast(model.w)  # fixed size
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Labeller(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, chunk):
                part = b.slice(at, chunk)
                texts = own.texts([x or "" for x in part.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"]
                )

    cols = pages.selectExpr(f"`{id_col}` as id", f"`{url_col}` as url", f"`{html_col}` as html")
    out = cols.mapInArrow(run, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
