import hashlib
import random
import re

import numpy as np
import pytest

from dimstar.llm import pii
from dimstar.llm.common import read
from dimstar.llm.queries import op13_personal_data

# The patterns as the contract spells them.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def check_digit(number):
    twice = [sum(divmod(2 * int(c), 10)) for c in number[-2::-2]]
    return (sum(map(int, number[::-2])) + sum(twice)) % 10 == 0


def brute(text):
    n = lambda m: re.sub("[^0-9]", "", m.group())
    return {
        "email": [m.span() for m in re.finditer(EMAIL, text)],
        "ip": [m.span() for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in re.finditer(CARD, text) if 12 <= len(n(m)) <= 19 and check_digit(n(m))],
        "phone": [m.span() for m in re.finditer(PHONE, text) if 9 <= len(n(m)) <= 15],
    }


def text_of(rnd):
    card = "4556737586899855"
    parts = ["a.b@c.de", "x@y", "@", "q@r.s@t.uv", "1.2.3.4", "300.1.2.3", "0255.1.1.1", "1.2.3.4.5.6.7.8", card, card[:15], "4556 7375-8689 9855",
             "+1 (443) 555-5793", "+12", "+4930.1234567", " ", " ", "-", ".", "é", "z", "7", "\n", "%+", "(12)", "00000000000000"]
    return "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))


def test_base_against_the_patterns():
    rnd = random.Random(3)
    for _ in range(6000):
        t = text_of(rnd)
        assert pii.base(t) == brute(t), t
    found = [pii.base(text_of(rnd)) for _ in range(300)]
    assert all(any(f[k] for f in found) for k in pii.KINDS)


@pytest.mark.parametrize("unit", ["a", "1", "1.", "+1 ", "a@", "@a.", "1 ", "é", "12-"])
def test_long_runs_take_linear_time(unit):
    text = unit * 100_000
    assert set(pii.base(text)) == set(pii.KINDS)
    assert sum(1 for _ in pii.candidates(text)) < 4_000_000


def test_luhn():
    rnd = random.Random(1)
    for _ in range(500):
        number = "".join(rnd.choice("0123456789") for _ in range(rnd.randint(12, 19)))
        assert pii.luhn(number) == check_digit(number)


def test_trees_learn_and_calibrate():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(4000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    params = pii.Params(trees=60, least=10)
    model = pii.calibrate(pii.boost(x[:2500], y[:2500], params), x[2500:3200], y[2500:3200], params)
    p = model.scores(x[3200:])
    assert np.mean((p > 0.5) == y[3200:]) > 0.93
    picked = p >= model.threshold
    assert picked.mean() > 0.1 and y[3200:][picked].mean() > 0.97
    assert (np.diff([p[(p >= q) & (p < q + 0.25)].mean() for q in (0, 0.25, 0.5, 0.75)]) > 0).all()


def test_trees_without_both_labels():
    x = np.ones((10, 2))
    one = pii.calibrate(pii.boost(x, np.ones(10)), x, np.ones(10), pii.Params())
    assert np.allclose(one.scores(x), 11 / 12) and one.threshold > 1
    same = pii.boost(np.ones((20, 2)), np.r_[np.ones(10), np.zeros(10)])
    assert np.allclose(same.scores(np.ones((3, 2))), 0.5)


def document(rnd, i):
    words = ["".join(rnd.choice("abcdefghé") for _ in range(rnd.randint(2, 9))) for _ in range(rnd.randint(20, 60))]
    phone = f"+{rnd.randint(1, 9)} ({rnd.randint(100, 999)}) 555-{rnd.randint(1000, 9999)}"
    digits = [rnd.randint(0, 9) for _ in range(15)]
    card = next(c for d in "0123456789" if pii.luhn(c := "".join(map(str, digits)) + d))
    ip = ".".join(str(rnd.randint(0, 255)) for _ in range(4))
    mail = f"{rnd.choice(words[:5]).replace('é', 'e')}.{rnd.randint(10, 99)}@mail{rnd.randint(0, 9)}.example.com"
    kind = i % 6
    planted = [[phone], [card], [ip], [mail], [f'token = "{rnd.getrandbits(160):040x}"', "version 2.0.1"], [phone, card]][kind]
    at = rnd.randint(1, len(words) - 1)
    text = " ".join([*words[:at], *planted, *words[at:]])
    want = [("phone", phone)] if kind == 0 else [("phone", phone), ("card", card)] if kind == 5 else []
    return text, [(k, text.index(s), text.index(s) + len(s)) for k, s in want]


@pytest.fixture(scope="module")
def documents():
    rnd = random.Random(8)
    return [document(rnd, i) for i in range(1500)]


SCHEMA = "doc_id long, text string, spans string, n_card int"


@pytest.fixture(scope="module")
def model(spark, documents):
    # Runs are seen by the detector alone: none is in the documents learnt from.
    rows = [(i, t, "x", 1) for i, (t, _) in enumerate(documents) if i % 6 != 5]
    return pii.fit(spark.createDataFrame(rows + [(None, None, "x", 1), (7, "", "x", 1)], SCHEMA).repartition(4))


def test_runs_of_spans_are_added(documents, model):
    assert set(model.kinds) == set(pii.KINDS)
    runs = [documents[i] for i in range(len(documents)) if i % 6 == 5]
    caught = clean = 0
    for text, want in runs:
        fine, added = pii.find(text, model)
        spans = {(k, *s) for k in pii.KINDS for s in fine[k]} | {a[:3] for a in added}
        caught += set(want) <= spans
        assert not fine["phone"] and not fine["card"]
    assert caught >= 0.95 * len(runs)
    others = [t for i, (t, _) in enumerate(documents) if i % 6 in (1, 2, 3, 4)]
    clean = sum(not pii.find(t, model)[1] for t in others)
    assert clean >= 0.99 * len(others)


def test_candidates_overlap_and_extend_beyond_the_base(model):
    text = "Write to jane.doe [at] mail.example (dot) com or josé.26@mail3.example.com now"
    spans = {text[a:b] for k, a, b in pii.candidates(text) if k == "email"}
    assert {"jane.doe [at] mail.example (dot) com", "josé.26@mail3.example.com"} <= spans
    card = list(pii.candidates("1234 5678 9012 3456 7890"))
    assert len({(a, b) for k, a, b in card if k == "card"}) >= 4


def test_detect_is_the_same_as_one_text_at_a_time(spark, documents, model):
    texts = [t for t, _ in documents[:120]] + [None, "", documents[5][0], "1 " * 30_000, "a@b.cd " * 5000]
    rows = [(i if i != 3 else None, t, "x", 9) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in pii.detect(spark.createDataFrame(rows, SCHEMA).repartition(3), model).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        fine, added = pii.find(t or "", model)
        r = got[i]
        own = sorted(((a, pii.KINDS.index(k), b) for k, v in brute(t or "").items() for a, b in v))
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in own)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [len(fine[k]) for k in pii.KINDS]
        assert r["n_added"] == len(added)
        spans = [s for s in r["spans"].split(",") if s]
        assert set(listed.split(",")) - {""} <= set(spans) and len(spans) == len(own) + len(added)
    assert got[121]["spans"] == "" and got[121]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.detect(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_no_base_spans_no_model(spark):
    docs = spark.createDataFrame([(1, "no data 12", "x", 1), (2, None, "x", 1)], SCHEMA)
    assert pii.fit(docs).kinds == {} and pii.fit(docs.limit(0)).kinds == {}
    got = {r["doc_id"]: r["spans"] for r in pii.detect(docs, pii.fit(docs)).collect()}
    assert got == {1: "", 2: ""}


def test_redact(documents, model):
    text = documents[5][0]
    made = pii.redact(text, model)
    assert "[phone]" in made and "[card]" in made and not re.search("[0-9]{5}", made)


def test_query(spark):
    got = op13_personal_data(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in read(spark, "/root/testdata/sf0.001", "documents").collect()}
    assert len(got) == len(texts)
    for r in got:
        want = brute(texts[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in pii.KINDS] == [len(want[k]) for k in pii.KINDS]
