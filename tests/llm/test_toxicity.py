import random
from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
import pytest

from dimstar.llm.toxicity import Params, ToxicModel, class_counts, fit, grams, ratios, score, shared_counts, training_rows

BAD = ["grumbo", "grumbix", "zorkle", "zorkling"]


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(8)
    words = ["".join(rnd.choice(["an", "the", "or", "en", "st", "ing", "ed"]) for _ in range(rnd.randint(1, 4))) for _ in range(400)]
    rows, labels = [], []
    for i in range(700):
        toxic = i % 5 == 0
        t = [rnd.choice(words) for _ in range(rnd.randint(5, 120))]
        if toxic:
            for _ in range(max(2, len(t) // 25)):
                t.insert(rnd.randrange(len(t)), rnd.choice(BAD) + rnd.choice(["", ".", ","]))
        rows.append((i, " ".join(t)))
        labels.append((i, 1, int(toxic)))
    rows += [(2000, None), (2001, ""), (2002, "-- ... !!"), (None, "grumbo zorkle grumbo"), (3, rows[3][1]), (2003, "anthe " * 30000 + "zorkle grumbo zorkle")]
    labels += [(3, 1, 0), (None, 1, 1), (5000, 1, None), (2001, 1, 0)]
    docs = spark.createDataFrame([(*r, 0.1, "x") for r in rows], "doc_id long, text string, score double, label string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def model(tables):
    return fit(tables[0], training_rows(tables[1]))


def test_held_out_documents(tables, model):
    docs, labels = tables
    held = {r["doc_id"] for r in labels.collect()} - {r["doc_id"] for r in training_rows(labels).collect()} - {None, 2001, 5000}
    got = {r["doc_id"]: r for r in score(docs, model).collect()}
    assert np.mean([got[k]["predicted"] == (k % 5 == 0) for k in held]) > 0.95
    assert got[None]["predicted"] == 1 and got[2003]["predicted"] == 1
    assert [got[k]["predicted"] for k in (2000, 2001, 2002)] == [0, 0, 0]
    assert got[2000]["score"] == got[2001]["score"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    assert score(docs, model).count() == docs.count()
    assert score(docs.limit(0), model).count() == 0


def test_ratio_is_that_of_two_interpolated_models(spark, tables):
    """by_gram and by_context against Kneser-Ney probabilities spelt out."""
    docs, labels = tables
    order, params = 3, Params(order=3)
    known = labels.selectExpr("doc_id", "toxic AS label").where("label IS NOT NULL")
    sample = docs.drop("label").join(known, "doc_id").select("label", "text")
    counts = class_counts(sample, order)
    contexts = {g[:-1] for t in counts.values() for g in t}
    by_gram, by_context = ratios(counts, shared_counts(docs, "text", contexts, order), params)

    want = {0: Counter(), 1: Counter()}
    for r in sample.collect():
        for w in (r["text"] or "").lower().encode().split():
            want[r["label"]].update(grams(w, order))
    assert {k: dict(v) for k, v in want.items()} == counts
    kinds = {g for r in docs.collect() for w in (r["text"] or "").lower().encode().split() for g in grams(w, order)}
    d = params.discount

    def shared(gram):
        if not gram:
            return 1 / len({g[-1] for g in kinds})
        before = lambda g: len({k[-len(g) - 1] for k in kinds if k.endswith(g)})
        follow = {k[-1] for k in kinds if k[-len(gram):-1] == gram[:-1] or len(gram) == 1}
        total = sum(before(gram[:-1] + x) for x in follow)
        return (max(before(gram) - d, 0) + d * len(follow) * shared(gram[1:])) / total

    def p(k, gram):
        c = gram[:-1]
        n = sum(v for g, v in want[k].items() if g[:-1] == c)
        if not n:
            return shared(gram[1:])
        different = sum(1 for g in want[k] if g[:-1] == c)
        return (max(want[k][gram] - d, 0) + d * different * shared(gram[1:])) / n

    for g in random.Random(1).sample(sorted(by_gram), 60):
        assert by_gram[g] == pytest.approx(log(p(1, g) / p(0, g)), abs=1e-9)
    for c in random.Random(2).sample(sorted(by_context), 30):
        unseen = c + "一"
        lam = [(lambda n: d * sum(1 for g in want[k] if g[:-1] == c) / n if n else 1.0)(sum(v for g, v in want[k].items() if g[:-1] == c)) for k in (0, 1)]
        assert unseen not in by_gram and by_context[c] == pytest.approx(log(lam[1] / lam[0]))


def test_windows():
    model = ToxicModel({}, {}, Params(windows=(2, 4)))
    model.memo = {b"a": 1.0, b"b": -1.0, b"c": 4.0}
    got = model.features(pa.array(["b c a b b", None, "c", ""]))
    assert got.tolist() == [[0.4, 2.5, 0.75], [0, 0, 0], [4, 2, 1], [0, 0, 0]]


def test_one_class_or_none(tables):
    docs, labels = tables
    for some, share in ((labels.where("toxic = 0 AND doc_id < 99"), None), (labels.limit(0), 0.5)):
        got = {r["score"] for r in score(docs, fit(docs, some)).collect()}
        assert len(got) == 1 and (share is None or got == {share})
