import random

import numpy as np
import pytest

from dimstar.llm import langid
from dimstar.llm.langid import Params, fit, keep, predict, training_rows

SYLLABLES = {"aa": ["ka", "ra", "ta", "mo"], "bb": ["sch", "ung", "ein", "lich"], "cc": ["eux", "ou", "ai", "ré"]}


def text(rnd, lang, n):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(600):
        lang = rnd.choice("aabbcc"[::2]) * 2
        rows.append((i, text(rnd, lang, rnd.randint(1, 60)), lang))
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 !?", "cc"), (None, "kara tamo", None), (5, rows[5][1], rows[5][2]),
             (1003, "x" * 300000, None), (1004, text(rnd, "bb", 30000), None)]
    return spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")


@pytest.fixture(scope="module")
def model(docs):
    return fit(training_rows(docs), params=Params(per_language=100, buckets=1 << 10))


def test_held_out_accuracy(docs, model):
    held = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in training_rows(docs).collect()}
    assert len(held) > 100
    want = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = {r["doc_id"]: r for r in predict(docs, model).collect()}
    judged = [k for k in held if k is not None and k < 600]
    assert np.mean([got[k]["lang_pred"] == want[k] for k in judged]) > 0.97
    assert got[1004]["lang_pred"] == "bb" and got[None]["lang_pred"] == "aa"
    for k in (1000, 1001, 1002):
        assert (got[k]["lang_pred"], got[k]["score"], got[k]["accepted"]) == ("und", 0.0, False)
    assert got[1003]["lang_pred"] in model.languages
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert predict(docs, model).count() == docs.count()


def test_rejected_documents_go(docs, model):
    kept = keep(docs, model)
    assert kept.schema == docs.schema
    ids = {r["doc_id"] for r in kept.collect()}
    assert not ids & {1000, 1001, 1002} and len(ids & set(range(600))) > 590


def test_foreign_text_and_noise_are_rejected(spark, docs, model):
    rnd = random.Random(8)
    noise = " ".join("".join(rnd.choice("bcdfghjklmnpqrstvwxz") for _ in range(rnd.randint(3, 9))) for _ in range(40))
    rows = [(1, "это совсем другой язык и другое письмо " * 5), (2, "これは別の言語です"), (3, noise), (4, "Привет"),
            (5, text(rnd, "aa", 40)), (6, text(rnd, "bb", 3)), (7, text(rnd, "aa", 60) + " это")]
    planted = spark.createDataFrame([(*r, None, None) for r in rows], docs.schema)
    assert {r["doc_id"]: r["accepted"] for r in predict(planted, model).collect()} == {1: False, 2: False, 3: False, 4: False, 5: True, 6: True, 7: True}
    assert {r["doc_id"] for r in keep(planted, model).collect()} == {5, 6, 7}


def test_prediction_does_not_depend_on_neighbours(docs, model):
    a = {(r["doc_id"], r["score"]) for r in predict(docs, model).collect()}
    b = {(r["doc_id"], r["score"]) for r in predict(docs.repartition(5), model).collect()}
    assert a == b


def test_training_repeats_itself(docs, model):
    again = fit(training_rows(docs.repartition(3)), params=Params(per_language=100, buckets=1 << 10))
    assert np.array_equal(model.logits, again.logits) and model.threshold == again.threshold


def test_without_labels(spark, docs):
    model = fit(docs.where("lang = 'zz'"))
    assert {r["lang_pred"] for r in predict(docs, model).collect()} == {"und"}
    assert predict(docs.limit(0), model).count() == 0 and keep(docs, model).count() == 0


def test_one_language(docs):
    model = fit(docs.where("lang = 'aa'"), params=Params(per_language=50, buckets=256))
    assert {r["lang_pred"] for r in predict(docs.where("doc_id < 50"), model).collect()} == {"aa"}


def test_memo_is_bounded(model, monkeypatch):
    import pyarrow as pa

    column = pa.array(["kara schung", "tamo tamo euxou", "ein"])
    want = model.predict(column)
    monkeypatch.setattr(langid, "MEMO", 1)
    got = model.predict(column)
    assert want[0] == got[0] and np.array_equal(want[1], got[1])


def test_scores_spelt_out_from_the_subwords_of_a_text():
    """Every byte n-gram by itself: the mean of its buckets' logits, bias, temperature, softmax, share of unseen ones."""
    from binascii import crc32
    from math import exp

    rng = np.random.default_rng(5)
    texts = ["Kara tamo, kara!", "é", "x " * 300 + "ein schung", "a\tb\nc  d"]
    hashes = []
    for t in texts:
        edged = [b"<" + w + b">" for w in t.lower().encode().split()]
        hashes.append([crc32(w[i : i + n]) for w in edged for n in (2, 3, 4) for i in range(len(w)) if i + n <= len(w)])
    seen = sorted(set(hashes[0]) | set(hashes[3][::2]))
    model = langid.LanguageModel(["aa", "bb", "cc"], rng.normal(size=(64, 3)), rng.normal(size=3), temperature=1.7, seen=np.array(seen, np.int64))
    got, unseen = model.scores([t.lower().encode().split() for t in texts])
    for i, hs in enumerate(hashes):
        z = [(sum(model.logits[h % 64][k] for h in hs) / len(hs) + model.bias[k]) / 1.7 for k in range(3)]
        total = sum(exp(x) for x in z)
        assert np.allclose(got[i], [exp(x) / total for x in z])
        assert np.isclose(unseen[i], sum(h not in seen for h in hs) / len(hs))
