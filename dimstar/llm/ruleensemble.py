"""Quality classifier: a sparse ensemble of rules, compiled into Spark columns.

Statistics of a text are built-in column expressions.  Shallow trees are
boosted on them (numpy, a bounded sample of labelled documents); every path
from a root to a node is a conjunctive rule.  A logistic regression with an
L1 penalty over all rules keeps a few.  The kept rules become one column
expression, so scoring is a projection inside the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimstar.llm.common import WORD, crc_mod, sample_per_class

Rule = tuple[tuple[str, bool, float], ...]  # conditions (statistic, above, threshold)


@dataclass(frozen=True)
class Params:
    per_class: int = 6000  # documents of the training sample
    trees: int = 24
    depth: int = 3
    bins: int = 32
    rate: float = 0.3
    least: int = 10  # documents at a node
    penalty: float = 0.0005
    steps: int = 400


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text; NULL counts as the empty text."""
    t = F.coalesce(text, F.lit(""))
    chars, words = F.char_length(t).cast("double"), F.regexp_count(t, F.lit(WORD)).cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(t, F.lit(pattern)) / F.greatest(chars, F.lit(1.0))

    return {
        "n_words": words,
        "word_length": chars / F.greatest(words, F.lit(1.0)),
        "distinct": F.size(F.array_distinct(F.split(t, " "))) / F.greatest(words, F.lit(1.0)),
        "upper": share(r"\p{Lu}"),
        "symbol": share(r"[#*$%&|<>=+~^{}\[\]\\]"),
        "exclaim": share(r"[!?]"),
        "digit": share(r"[0-9]"),
        "stop": share(r"[.,;:]"),
        "line": share(r"\n"),
        # A word that the next word repeats.
        "twice": F.regexp_count(t, F.lit(r"(?<![^ ])([^ ]++)(?= \1(?![^ ]))")) / F.greatest(words, F.lit(1.0)),
    }


def _tree(x: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, names: list[str], params: Params):
    """One regression tree on binned statistics: its rules, and its predictions."""
    out, rules = np.zeros(len(x)), []

    def grow(rows: np.ndarray, path: Rule, depth: int) -> None:
        g, h = grad[rows].sum(), hess[rows].sum()
        best = (1e-6, None)
        if depth < params.depth:
            for j, cut in enumerate(cuts):
                gs = np.bincount(x[rows, j], grad[rows], len(cut) + 1).cumsum()[:-1]
                hs = np.bincount(x[rows, j], hess[rows], len(cut) + 1).cumsum()[:-1]
                ns = np.bincount(x[rows, j], minlength=len(cut) + 1).cumsum()[:-1]
                ok = (ns >= params.least) & (len(rows) - ns >= params.least)
                gain = np.where(ok, gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1), 0)
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), (j, int(gain.argmax())))
        if path:
            rules.append(path)
        if best[1] is None:
            out[rows] = g / (h + 1)
            return
        j, k = best[1]
        for above in (False, True):
            side = rows[(x[rows, j] > k) == above]
            grow(side, (*path, (names[j], above, float(cuts[j][k]))), depth + 1)

    grow(np.arange(len(x)), (), 0)
    return rules, out


def _holds(rule: Rule, values: np.ndarray, names: list[str]) -> np.ndarray:
    ok = np.ones(len(values), bool)
    for name, above, cut in rule:
        ok &= (values[:, names.index(name)] > cut) == above
    return ok


def _tidy(rule: Rule) -> Rule:
    """Each bound of a statistic once: the tightest."""
    tight: dict[tuple[str, bool], float] = {}
    for name, above, cut in rule:
        k = (name, above)
        tight[k] = cut if k not in tight else (max if above else min)(tight[k], cut)
    return tuple((n, a, c) for (n, a), c in sorted(tight.items()))


@dataclass(frozen=True)
class Ensemble:
    """Rules with weights; the score is the logistic function of their sum."""

    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self, stats: dict[str, Column]) -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            held = F.lit(True)
            for name, above, cut in rule:
                held = held & ((stats[name] > F.lit(cut)) if above else (stats[name] <= F.lit(cut)))
            total = total + F.when(held, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def scores(self, values: np.ndarray, names: list[str]) -> np.ndarray:
        z = self.bias + sum((_holds(r, values, names) * w for r, w in self.rules), np.zeros(len(values)))
        return 1 / (1 + np.exp(-z))


def train(values: np.ndarray, labels: np.ndarray, names: list[str], params: Params = Params()) -> Ensemble:
    """Boosted trees, their paths as rules, and lasso logistic weights.

    Without rows the score is 0.5; with one class it is that class's share,
    smoothed by one row of either.  Where no tree can split (equal
    statistics, or fewer than ``2 * least`` rows) there are no rules, and
    every score is the smoothed share of the rows with label 1.
    """
    prior = (labels.sum() + 1) / (len(labels) + 2)
    start = float(np.log(prior / (1 - prior)))
    if len(set(labels.tolist())) < 2:
        return Ensemble(start, ())
    cuts = [np.unique(np.quantile(values[:, j], np.linspace(0, 1, params.bins + 1)[1:-1])) for j in range(len(names))]
    binned = np.stack([np.searchsorted(c, values[:, j]) for j, c in enumerate(cuts)], axis=1)
    z, rules = np.full(len(labels), start), {}
    for _ in range(params.trees):
        p = 1 / (1 + np.exp(-z))
        found, step = _tree(binned, cuts, labels - p, p * (1 - p), names, params)
        z += params.rate * step
        rules.update((_tidy(r), None) for r in found)
    names_of = list(rules)
    if not names_of:  # no statistic splits the rows, or they are too few for a split
        return Ensemble(start, ())
    held = np.stack([_holds(r, values, names) for r in names_of], axis=1).astype(float)
    weights, bias = _lasso(held, labels, start, params)
    return Ensemble(float(bias), tuple((r, float(w)) for r, w in zip(names_of, weights) if w != 0))


def _lasso(x: np.ndarray, y: np.ndarray, bias: float, params: Params) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient; the bias has no penalty."""
    n, k = x.shape
    v = np.ones(k) / np.sqrt(k)
    for _ in range(20):
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v)
    size = 4 / (np.linalg.norm(x @ v) ** 2 / n + 1)
    w, b, pw, pb, t = np.zeros(k), bias, np.zeros(k), bias, 1.0
    for _ in range(params.steps):
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ew, eb = w + (t - 1) / nt * (w - pw), b + (t - 1) / nt * (b - pb)
        d = 1 / (1 + np.exp(-(x @ ew + eb))) - y
        pw, pb, t = w, b, nt
        w = ew - size * (x.T @ d) / n
        w = np.sign(w) * np.maximum(np.abs(w) - size * params.penalty, 0)
        b = eb - size * d.mean()
    return w, b


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        params: Params = Params()) -> Ensemble:
    """Learn from a sample of about ``per_class`` labelled documents of each class.

    ``labels`` holds only rows that may be learnt from.  The sample has at
    most ``4 * per_class`` rows, which bounds what is broadcast.
    """
    known = labels.select(F.col(key).alias("label_key"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("label_key").isNotNull())
    sample = F.broadcast(sample_per_class(known, "label_key", "label", params.per_class))
    stats = statistics(F.col("text"))
    names = list(stats)
    rows = (
        docs.select(F.col(f"`{key}`").alias("label_key"), F.col(f"`{text}`").alias("text"))
        .join(sample, "label_key")
        .select("label_key", "label", *(c.alias(n) for n, c in stats.items()))
        .toPandas()
        .sort_values(["label_key", "label"], kind="stable")
    )
    return train(rows[names].to_numpy(float), rows["label"].to_numpy(float), names, params)


def score(docs: DataFrame, model: Ensemble, key: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per row: key, score, predicted.

    NULL and empty texts score like texts without words; repeated rows are
    scored each, very long texts whole; an empty table gives an empty result.
    """
    stats = statistics(F.col(f"`{text}`"))
    made = docs.select(F.col(f"`{key}`").alias(key), F.struct(*(c.alias(n) for n, c in stats.items())).alias("s"))
    by_name = {n: F.col(f"s.{n}") for n in stats}
    out = made.select(key, model.column(by_name).alias("score"))
    return out.select(key, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def training_rows(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Labels that may be learnt from: crc32 of the id as text, modulo 5, is not 0."""
    return labels.where(crc_mod(F.col(key), 5) != 0)
