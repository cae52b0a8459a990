"""Operator 4: quality classifier as a sparse rule ensemble.

1. Statistics of a whole text are Spark column expressions (shares of upper case, digits,
   symbols, distinct words and lines, mean word length, ...).  Id, language, source and labels are not among them.
2. On a bounded sample of labelled rows (``max_rows``, smallest hashes first; rows
   with crc32(id) mod 5 = 0 are held out) small boosted trees are grown; every path from
   a root to a node is a rule, a conjunction of thresholds on statistics.
3. Lasso logistic regression over the rules keeps few of them with a weight.
4. The kept rules are compiled into one Spark column expression; scoring is one pass
   over the documents without Python, shuffle or state.

Only the fit is bounded; scoring reads every whole text.  The sample's ids (at most
``max_rows``) are the only rows that are broadcast.

Defined results: null and empty texts get the statistics of an empty text and thus a
score; a null id counts as the empty string for the hold-out; without labels, or with a
single class, the score is the smoothed share of label 1; repeated label rows count once (an id labelled both ways
counts with each label), of documents that repeat a labelled id the one with the smallest text hash; very long texts are
scored whole; equal scores stay equal; other columns are carried along, except that input columns named ``score``, ``held_out`` or
``predicted`` are replaced by the results; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOLD_OUT = 5
THRESHOLD = 0.3
MAX_ROWS = 20_000

def _count(t: Column, pattern: str) -> Column:
    return F.regexp_count(t, F.lit(pattern)).cast("double")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, wherever the optimizer moves the expression.

    A plain alias is copied into each use when a filter on the result is pushed below the projection; a lambda
    variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


NAMES = [
    "log_length", "words", "lines", "bytes_a_char", "upper", "digit", "symbol", "symbol_word", "bang", "stop", "bar",
    "word_length", "distinct_words", "distinct_root", "distinct_lines", "words_a_line",
]


def statistics(text: Column) -> Column:
    """Struct of the statistics ``NAMES`` of a whole text; null counts as empty."""

    def counts(t: Column) -> Column:
        return F.struct(
            F.length(t).cast("double").alias("n"),
            F.octet_length(t).cast("double").alias("bytes"),
            F.array_remove(F.split(t, r"\s+"), "").alias("words"),
            F.array_remove(F.split(t, "\n"), "").alias("lines"),
            _count(t, "[A-Z]").alias("upper"),
            _count(t, "[0-9]").alias("digit"),
            _count(t, r"[!-/:-@\[-`{-~&&[^.,]]").alias("symbol"),
            _count(t, "[!?]").alias("bang"),
            _count(t, "[.,]").alias("stop"),
            _count(t, r"\|").alias("bar"),
        )

    def sizes(c: Column) -> Column:
        names = ["n", "bytes", "upper", "digit", "symbol", "bang", "stop", "bar"]
        lists = {"w": F.size(c["words"]), "l": F.size(c["lines"]), "dw": F.size(F.array_distinct(c["words"])), "dl": F.size(F.array_distinct(c["lines"]))}
        return F.struct(*[c[x].alias(x) for x in names], *[e.cast("double").alias(k) for k, e in lists.items()])

    def shares(c: Column) -> Column:
        def share(a: str, b: str) -> Column:
            return F.when(c[b] > 0, c[a] / c[b]).otherwise(F.lit(0.0))

        values = [
            F.log1p(c["n"]), F.log1p(c["w"]), F.log1p(c["l"]), share("bytes", "n"), share("upper", "n"), share("digit", "n"), share("symbol", "n"), share("symbol", "w"),
            share("bang", "w"), share("stop", "w"), share("bar", "w"), share("n", "w"), share("dw", "w"),
            F.when(c["w"] > 0, c["dw"] / F.sqrt(c["w"])).otherwise(F.lit(0.0)), share("dl", "l"), share("w", "l"),
        ]
        return F.struct(*[v.alias(k) for k, v in zip(NAMES, values)])

    return let(F.coalesce(text, F.lit("")), lambda t: let(counts(t), lambda c: let(sizes(c), shares)))


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % HOLD_OUT == 0


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, True for <=, threshold)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def thresholds(c: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds halfway between values that follow each other, behind the quantiles of ``c``, and the width of each gap (in deviations of ``c``)."""
    values = np.unique(c)
    if len(values) < 2:
        return np.zeros(0), np.zeros(0)
    at = np.unique(np.searchsorted(values, np.quantile(c, np.linspace(0, 1, bins + 1)[:-1], method="lower")))
    at = at[at < len(values) - 1]
    return (values[at] + values[at + 1]) / 2, (values[at + 1] - values[at]) / (c.std() or 1.0)


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int = 16, depth: int = 3, rate: float = 0.4, bins: int = 48, least: int = 8, near: float = 0.01) -> list[Rule]:
    """Paths of boosted regression trees as rules (without copies, in the order found).

    Among splits whose gain is within a share of ``near`` of the best one, the one with the widest gap around its
    threshold is taken: a statistic that just happens to separate the sample does so by a hair.
    """
    found = [thresholds(c, bins) for c in x.T]
    edges, gaps = [e for e, _ in found], [w for _, w in found]
    cut = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    rules: dict[Rule, None] = {}
    z = np.full(len(y), math.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    for _ in range(trees):
        p = _sigmoid(z)
        grad, hess = y - p, p * (1 - p) + 1e-6
        todo = [(np.arange(len(y)), ())]
        while todo:
            rows, path = todo.pop()
            splits = []
            g, h = grad[rows].sum(), hess[rows].sum()
            if len(path) < depth and len(rows) >= 2 * least:
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    c = cut[rows, f]
                    n = np.cumsum(np.bincount(c, minlength=len(e) + 1))[:-1]
                    gl = np.cumsum(np.bincount(c, grad[rows], len(e) + 1))[:-1]
                    hl = np.cumsum(np.bincount(c, hess[rows], len(e) + 1))[:-1]
                    gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                    gain[(n < least) | (len(rows) - n < least)] = 0
                    splits += [(float(gain[k]), float(gaps[f][k]), f, int(k)) for k in np.flatnonzero(gain >= (1 - near) * gain.max()) if gain[k] > 1e-6]
            if path:
                rules[tuple(sorted(path))] = None
            if not splits:
                z[rows] += rate * g / (h + 1)
                continue
            most = max(v for v, *_ in splits)
            _, f, k = max((w, -f, -k) for v, w, f, k in splits if v >= (1 - near) * most)
            f, k = -f, -k
            under = cut[rows, f] <= k
            at = float(edges[f][k])
            todo += [(rows[~under], (*path, (f, False, at))), (rows[under], (*path, (f, True, at)))]
    return list(rules)


def rule_matrix(x: np.ndarray, rules: list[Rule]) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for j, rule in enumerate(rules):
        for f, under, at in rule:
            out[:, j] *= (x[:, f] <= at) == under
    return out


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float = 0.002, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated proximal gradient steps; the intercept is not penalised."""
    n = len(y)
    step = 4 * n / (np.linalg.norm(a, 2) ** 2 + n)
    w = v = np.zeros(a.shape[1])
    b = c = math.log((y.sum() + 1) / (n - y.sum() + 1))
    t = 1.0
    for _ in range(rounds):
        r = _sigmoid(a @ v + c) - y
        new = v - step * (a.T @ r) / n
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = c - step * r.mean()
        s = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / s * (new - w), new_b + (t - 1) / s * (new_b - b)
        w, b, t = new, new_b, s
    return w, b


class RuleModel:
    """Statistics' names, kept rules with weights, and an intercept."""

    def __init__(self, names: list[str], rules: list[tuple[Rule, float]], intercept: float):
        self.names, self.rules, self.intercept = names, rules, intercept

    def score(self, stats) -> Column:
        """The rules as one column expression; ``stats`` gives the column of a statistic by its name."""
        terms = [F.lit(float(self.intercept))]
        for rule, weight in self.rules:
            held = F.lit(True)
            for f, under, at in rule:
                c = stats(self.names[f])
                held = held & ((c <= at) if under else (c > at))
            terms.append(F.when(held, F.lit(float(weight))).otherwise(F.lit(0.0)))
        while len(terms) > 1:  # a balanced sum keeps the expression shallow
            terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
        return 1 / (1 + F.exp(-terms[0]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_ROWS, penalty: float = 0.002) -> RuleModel:
    """Fit on at most ``max_rows`` labelled rows that are not held out."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
    known = known.select(F.col(id_col).alias("_label_id"), F.col(label_col).cast("int").alias("_label")).distinct()
    sample = known.orderBy(F.xxhash64("_label_id"), "_label_id", "_label").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    chosen = texts.join(F.broadcast(sample), F.col("_id") == F.col("_label_id"))
    # of documents that repeat an id one counts, so no more than max_rows rows reach the driver
    one = chosen.select("_label_id", "_label", F.struct(F.xxhash64("_text"), statistics(F.col("_text")).alias("_stats")).alias("_row"))
    rows = one.groupBy("_label_id", "_label").agg(F.min("_row").alias("_row")).select("_label", "_row._stats.*").toPandas()
    x, y = rows[NAMES].to_numpy(float), rows["_label"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # the fit does not depend on the order of the rows
    x, y = x[order], y[order]
    if not len(y) or y.min() == y.max():
        return RuleModel(NAMES, [], math.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    rules = grow_rules(x, y)
    weights, b = lasso_logistic(rule_matrix(x, rules), y, penalty)
    return RuleModel(NAMES, [(r, w) for r, w in zip(rules, weights) if abs(w) > 1e-6], b)


def score_documents(docs: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` plus held_out, score and predicted."""
    score = let(statistics(F.col(text_col)), lambda s: model.score(lambda name: s[name]))
    out = docs.withColumns({"held_out": held_out(id_col), "score": score})
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
