"""Toxicity: class-conditional Kneser-Ney models of the letters of words.

Two interpolated Kneser-Ney models, one of toxic and one of ordinary
documents, predict each letter of a word from the letters before it.  Only
their highest order is their own; all lower orders are shared: continuation
counts over the words of all documents, which Spark gathers.  So a rare
expression that neither class knows gets the same probability from both.

The log-likelihood ratio of a letter therefore depends only on the n-gram
seen in a class, or on its context alone; a word's ratio is a sum of table
entries.  A document is compared by its length-normalised ratio, over the
whole and over its most toxic window, and a logistic regression on sample
documents that took no part in the models makes that a score.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimstar.llm.common import crc_mod, map_texts, materialize, sample_per_class, word_blocks

START, END = "\x02", "\x03"
EDGES = ".,;:!?\"'()[]{}<>*#&%$|-_"
MEMO = 200_000


@dataclass(frozen=True)
class Params:
    order: int = 5
    discount: float = 0.75
    per_class: int = 4000  # documents of the training sample
    windows: tuple[int, ...] = (8, 32, 128)  # words
    threshold: float = 0.3


def grams(word: bytes, order: int) -> list[str]:
    """The n-grams of ``order`` letters of a word, one for each letter and its end."""
    w = word.decode().strip(EDGES)
    if not w:
        return []
    w = START * (order - 1) + w + END
    return [w[i : i + order] for i in range(len(w) - order + 1)]


def _gram_rows(docs: DataFrame, keep: list[str], text: str, order: int, distinct: bool) -> DataFrame:
    """n-grams of the texts, summed within each batch (distinct: each word of a batch once)."""

    def make():
        def work(column: pa.Array) -> dict:
            out = [[] for _ in range(len(column))]
            words: Counter[bytes] = Counter()
            for _, block in word_blocks(column):
                for x in block:
                    words.update(x)
            found: Counter[str] = Counter()
            for w, n in words.items():
                for g in grams(w, order):
                    found[g] += 1 if distinct else n
            if out:
                out[0] = [{"gram": g, "n": n} for g, n in found.items()]
            return {"found": pa.array(out, pa.list_(pa.struct([("gram", pa.string()), ("n", pa.int64())])))}

        return work

    rows = map_texts(docs, keep, text, "found array<struct<gram: string, n: long>>", make)
    return rows.select(*keep, F.inline("found"))


def class_counts(sample: DataFrame, order: int) -> dict[int, dict[str, int]]:
    """Counts of n-grams in each class of a bounded sample (label, text)."""
    out: dict[int, dict[str, int]] = {}
    for k in (0, 1):
        rows = _gram_rows(sample.where(F.col("label") == k), [], "text", order, distinct=False)
        out[k] = {r[0]: int(r[1]) for r in rows.groupBy("gram").agg(F.sum("n")).collect()}
    return out


def shared_counts(docs: DataFrame, text: str, contexts: set[str], order: int) -> list[dict]:
    """Continuation counts of all documents for the orders below ``order``.

    By order, for contexts of the class models (whose number the sample
    bounds): {context: {letter: number of different letters before}}.
    """
    spark = docs.sparkSession
    seen = _gram_rows(docs, [], text, order, distinct=True).groupBy("gram").agg(F.sum("n").alias("n"))
    seen = materialize(seen.select("gram"), "grams")
    out: list[dict] = []
    for k in range(order - 1, 0, -1):
        known = sorted({c[len(c) - k + 1 :] for c in contexts})
        kept = spark.createDataFrame([(c,) for c in known], "context string")
        found = (
            seen.groupBy(F.substring("gram", -k, k).alias("gram"))
            .agg(F.countDistinct(F.substring("gram", -k - 1, 1)).alias("n"))
            .select(F.substring("gram", 1, k - 1).alias("context"), F.substring("gram", k, 1).alias("letter"), "n")
            .join(kept, "context", "left_semi")
        )
        table: dict[str, dict[str, int]] = defaultdict(dict)
        for c, x, n in found.collect():
            table[c][x] = n
        out.append(dict(table))
    return out


def ratios(counts: dict[int, dict[str, int]], shared: list[dict], params: Params) -> tuple[dict[str, float], dict[str, float]]:
    """log P(letter | context, toxic) / P(letter | context, ordinary): by n-gram seen in a class, and by context else."""
    d = params.discount
    letters = max(2, len(shared[-1].get("", {}))) if shared else 2
    memo: dict[str, float] = {}

    def lower(gram: str) -> float:
        """Shared probability of the last letter after the letters before."""
        if not gram:
            return 1 / letters
        if gram not in memo:
            table = shared[len(shared) - len(gram)].get(gram[:-1], {})
            total, rest = sum(table.values()), lower(gram[1:])
            memo[gram] = (max(table.get(gram[-1], 0) - d, 0) + d * len(table) * rest) / total if total else rest
        return memo[gram]

    sums = {k: Counter() for k in counts}
    kinds = {k: Counter() for k in counts}
    for k, table in counts.items():
        for g, n in table.items():
            sums[k][g[:-1]] += n
            kinds[k][g[:-1]] += 1

    def backoff(k: int, context: str) -> float:
        n = sums[k][context]
        return d * kinds[k][context] / n if n else 1.0

    by_context = {c: log(backoff(1, c) / backoff(0, c)) for c in {*sums[0], *sums[1]}}
    by_gram = {}
    for g in {*counts[0], *counts[1]}:
        c, rest = g[:-1], max(lower(g[1:]), 1e-9)
        p = [(max(counts[k].get(g, 0) - d, 0) / sums[k][c] if sums[k][c] else 0) + backoff(k, c) * rest for k in (0, 1)]
        by_gram[g] = log(p[1] / p[0])
    return by_gram, by_context


@dataclass
class ToxicModel:
    by_gram: dict[str, float]
    by_context: dict[str, float]
    params: Params
    weights: tuple[float, ...] = ()  # the bias first, then one for each feature
    memo: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"memo": {}}

    def word(self, w: bytes) -> float:
        total = 0.0
        for g in grams(w, self.params.order):
            r = self.by_gram.get(g)
            total += self.by_context.get(g[:-1], 0.0) if r is None else r
        return total

    def features(self, column: pa.Array) -> np.ndarray:
        """Per text: the mean ratio of a word over the text, and over its most toxic window of each size."""
        out = np.zeros((len(column), 1 + len(self.params.windows)))
        for first, block in word_blocks(column):
            sizes = np.array([len(x) for x in block])
            words = [w for x in block for w in x]
            if not words:
                continue
            if len(self.memo) > MEMO:
                self.memo.clear()
            for w in words:
                if w not in self.memo:
                    self.memo[w] = self.word(w)
            value = np.fromiter(map(self.memo.__getitem__, words), float, len(words))
            total = np.r_[0.0, np.cumsum(value)]
            end = np.repeat(np.cumsum(sizes), sizes)
            start = end - np.repeat(sizes, sizes)
            full = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[full]
            out[first + full, 0] = (total[starts + sizes[full]] - total[starts]) / sizes[full]
            for k, window in enumerate(self.params.windows, 1):
                begin = np.maximum(np.minimum(np.arange(len(words)), end - window), start)
                last = np.minimum(begin + window, end)
                # A text shorter than a window is compared as if neutral words filled it.
                out[first + full, k] = np.maximum.reduceat((total[last] - total[begin]) / window, starts)
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        bias, *weights = self.weights
        z = bias + (features @ np.array(weights) if weights else np.zeros(len(features)))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Newton steps with a small ridge."""
    a = np.c_[np.ones(len(x)), x]
    w = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        grad = a.T @ (p - y) + 0.01 * w
        hess = (a * (p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
    return tuple(map(float, w))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        params: Params = Params()) -> ToxicModel:
    """Models from a sample of about ``per_class`` labelled documents of each class, shared counts from all documents.

    ``labels`` holds only rows that may be learnt from.  Three quarters of
    the sample train the class models, the rest the logistic regression,
    with the classes in the proportions of the labels.  Without both
    classes the score is the smoothed share of toxic labels.
    """
    known = labels.select(F.col(key).alias("label_key"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("label_key").isNotNull())
    number = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    share = (number.get(1, 0) + 1) / (sum(number.values()) + 2)
    if len(number) < 2:
        return ToxicModel({}, {}, params, (log(share / (1 - share)),))
    picked = F.broadcast(sample_per_class(known, "label_key", "label", params.per_class))  # 4 * per_class rows at most
    sample = docs.select(F.col(f"`{key}`").alias("label_key"), F.col(f"`{text}`").alias("text")).join(picked, "label_key")
    sample = materialize(sample, "toxic-sample")
    held = F.crc32(F.concat(F.lit("held "), F.col("label_key").cast("string")).cast("binary")) % 4 == 0
    counts = class_counts(sample.where(~held), params.order)
    contexts = {g[:-1] for table in counts.values() for g in table}
    model = ToxicModel(*ratios(counts, shared_counts(docs, text, contexts, params.order), params), params)
    rows = sorted(features(sample.where(held), model, ["label_key", "label"], "text").collect())
    if {r["label"] for r in rows} == {0, 1}:
        y = np.array([r["label"] for r in rows], float)
        model.weights = _logistic(np.array([r["ratios"] for r in rows]), y)
        # The sample has the classes in other proportions than the labels.
        bias = model.weights[0] + log(share / (1 - share)) - log(y.mean() / (1 - y.mean()))
        model.weights = (bias, *model.weights[1:])
    else:
        model.weights = (log(share / (1 - share)),)
    return model


def features(docs: DataFrame, model: ToxicModel, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns and ratios: the length-normalised ratios of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample

    def make():
        return lambda column: {"ratios": pa.array(shared.value.features(column).tolist(), pa.list_(pa.float64()))}

    return map_texts(docs, keep, text, "ratios array<double>", make)


def score(docs: DataFrame, model: ToxicModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: key, score, predicted.

    NULL and empty texts score as texts of neutral words; repeated rows are
    scored each, very long texts whole; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(column: pa.Array) -> dict:
            found = shared.value.scores(shared.value.features(column))
            return {"score": found, "predicted": (found >= model_threshold).astype(np.int32)}

        return work

    model_threshold = model.params.threshold
    return map_texts(docs, [key], text, "score double, predicted int", make)


def training_rows(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Labels that may be learnt from: crc32 of the id as text, modulo 4, is not 2."""
    return labels.where(crc_mod(F.col(key), 4) != 2)
