import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimstar.llm.ruleensemble import Ensemble, Params, fit, score, statistics, train, training_rows


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(12)
    rows, labels = [], []
    for i in range(900):
        words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(rnd.randint(8, 150))]
        bad = i % 4 == 0
        if bad:
            kind = i // 4 % 3
            words = [w + "###" for w in words] if kind == 0 else [w.upper() + "!!" for w in words] if kind == 1 else [w for w in words[:9] for _ in range(12)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad), 0))
    rows += [(2000, None), (2001, ""), (2002, "\n" * 5000), (None, "a b c"), (1, rows[1][1]), (2003, "word " * 40000)]
    labels += [(None, 0, 0), (5000, None, 0), (1, 1, 0), (2001, 0, 0)]
    docs = spark.createDataFrame([(*r, "x", 0.2) for r in rows], "doc_id long, text string, s string, score double")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def model(tables):
    return fit(tables[0], training_rows(tables[1]))


def test_held_out_documents(tables, model):
    docs, labels = tables
    learnt = {r["doc_id"] for r in training_rows(labels).collect()}
    got = {r["doc_id"]: r for r in score(docs, model).collect()}
    held = [i for i in range(900) if i not in learnt]
    assert len(held) > 120
    assert np.mean([got[i]["predicted"] == (i % 4 != 0) for i in held]) > 0.95
    assert got[2000]["score"] == got[2001]["score"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    assert score(docs, model).count() == docs.count() and score(docs.limit(0), model).count() == 0


def test_few_rules(model):
    assert 0 < len(model.rules) < 60
    assert all(1 <= len(r) <= 3 for r, _ in model.rules)


def test_columns_say_what_numpy_says(tables, model):
    docs, _ = tables
    names = list(statistics(F.col("text")))
    rows = docs.select("doc_id", *(c.alias(f"v_{n}") for n, c in statistics(F.col("text")).items()),
                       model.column(statistics(F.col("text"))).alias("p")).collect()
    values = np.array([[r[f"v_{n}"] for n in names] for r in rows], float)
    assert np.allclose(model.scores(values, names), [r["p"] for r in rows])


def test_statistics(spark):
    s = {n: c for n, c in statistics(F.col("t")).items()}
    r = spark.createDataFrame([("Aa aa aa b!\n1#",)], "t string").select(*(c.alias(n) for n, c in s.items())).first()
    assert (r["n_words"], r["twice"], r["symbol"]) == (5, 1 / 5, 1 / 14)


def test_degenerate_labels(tables):
    docs, labels = tables
    assert fit(docs, labels.limit(0)) == Ensemble(0.0, ())
    assert fit(docs, labels.where("quality = 1")).rules == ()
    same = train(np.ones((50, 2)), np.r_[np.ones(25), np.zeros(25)], ["a", "b"], Params(steps=50))
    assert same.rules == () and abs(same.bias) < 1e-9


@pytest.mark.parametrize("n", [2, 10, 19])
def test_too_few_labels_to_split(n):
    values = np.random.default_rng(n).normal(size=(n, 3))
    labels = np.arange(n) % 2
    got = train(values, labels.astype(float), ["a", "b", "c"])
    assert got.rules == ()
    assert np.allclose(got.scores(values, ["a", "b", "c"]), (labels.sum() + 1) / (n + 2))


def test_lasso_weights_are_optimal():
    """The conditions of the least penalised loss: gradients of -penalty times the sign, or within the penalty at weight 0."""
    from dimstar.llm.ruleensemble import _lasso

    rng = np.random.default_rng(3)
    x = (rng.random((400, 12)) < 0.4).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(-(2 * x[:, 0] - 3 * x[:, 1] + 0.3)))).astype(float)
    p = Params(penalty=0.02, steps=5000)
    w, b = _lasso(x, y, 0.0, p)
    d = 1 / (1 + np.exp(-(x @ w + b))) - y
    grad = x.T @ d / len(y)
    assert w[0] > 0 > w[1] and (w == 0).any()
    assert abs(d.mean()) < 1e-5
    assert np.allclose(grad[w != 0], -p.penalty * np.sign(w[w != 0]), atol=1e-5)
    assert (np.abs(grad[w == 0]) <= p.penalty + 1e-5).all()


def test_rules_are_tree_paths():
    """The two leaves of one split are a rule and its complement, with the split's own bound."""
    values = np.r_[np.zeros(40), np.ones(40)][:, None]
    got = train(values, values[:, 0].copy(), ["a"], Params(trees=1, depth=1))
    assert got.rules and all(len(r) == 1 and r[0][0] == "a" and 0 <= r[0][2] < 1 for r, _ in got.rules)
    assert got.scores(np.array([[1.0]]), ["a"])[0] > 0.9 > 0.1 > got.scores(np.array([[0.0]]), ["a"])[0]
