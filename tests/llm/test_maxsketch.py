import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from dimstar.llm import maxsketch as ms

PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(PATTERN, (text or "").translate(ASCII))


def brute(docs, items, k=50):
    counted = [(i, Counter(words(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    total, lengths = len(counted), sum(n for *_, n in counted)
    df = Counter(w for _, c, _ in counted for w in c)
    out = []
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(words(t))
    for item, own in wanted.items():
        scored = []
        for i, c, n in counted:
            m = 100 - 50 + (50 * n * total) // lengths
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 20 * m)) for w in own if w in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, *_, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


DOCS, ITEMS = "doc_id long, text string, score double, item_id string", "item_id long, text string, doc_id string"


def table(spark, docs, items):
    return (spark.createDataFrame([(*d, 0.5, "x") for d in docs], DOCS).repartition(6), spark.createDataFrame([(*i, "y") for i in items], ITEMS))


def test_terms():
    rnd = random.Random(1)
    for _ in range(500):
        t = "".join(rnd.choice("aZé9 _-.@[`{ÀÉ\x00\x7f\n漢🙂É") for _ in range(rnd.randint(0, 30)))
        assert ms.terms(t.encode()) == [w.encode() for w in words(t)]
    assert ms.terms(None) == []


def test_bounds_never_understate_a_score():
    rnd = random.Random(2)
    vocabulary = [f"w{i}".encode() for i in range(400)]
    queries = [{w: rnd.randint(1, 9000) for w in rnd.sample(vocabulary, rnd.randint(0, 12))} for _ in range(20)]
    for coordinates in (1, 8, 64, 1 << 14):
        lookup = ms.Lookup(queries, coordinates)
        ats, tops, exact = [], [], []
        for _ in range(30):
            counts, m = Counter(rnd.choices(vocabulary, k=rnd.randint(1, 300))), rnd.randint(50, 400)
            at, top = ms.fold(counts, m, coordinates)
            ats.append(at.astype("<i4").tobytes()), tops.append(top.astype("<i4").tobytes())
            exact.append([sum(x * ms.impact(counts[w], m) for w, x in q.items() if w in counts) for q in queries])
        bounds, exact = lookup.bounds(ats, tops), np.array(exact)
        assert (bounds >= exact).all()
        if coordinates == 1 << 14:
            assert (bounds == exact).mean() > 0.5


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 4))) for _ in range(300)]
    docs = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([3, 20, 60, 200])))) for i in range(500)]
    docs += [(1000 + i, docs[3][1]) for i in range(250)]  # a third of the documents are copies
    docs += [(2000 + i, "rare " + docs[i][1]) for i in range(5)]
    docs += [(7, docs[7][1]), (8, "another text of document eight"), (None, docs[4][1]), (None, None), (3000, ""), (3001, "... --"), (3002, "long " * 30_000)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(2, 25)))) for i in range(25)]
    items += [(100, docs[3][1][:40]), (101, "rare"), (102, "nowhere to be found xyz"), (103, None), (104, ""), (2, "rare A B"), (None, "abc a"), (105, "LONG")]
    return docs, items


@pytest.mark.parametrize("params", [ms.Params(), ms.Params(coordinates=64, chunk=4, growth=2, rows=32), ms.Params(items=7, broadcast_rows=0)])
def test_against_brute_force(spark, corpus, params):
    docs, items = corpus
    assert rows(ms.search(*table(spark, docs, items), params=params)) == brute(docs, items)


def test_few_places(spark, corpus):
    docs, items = corpus
    assert rows(ms.search(*table(spark, docs, items[:8]), params=ms.Params(k=3, coordinates=256))) == brute(docs, items[:8], 3)


def test_rounds_take_the_highest_levels_first():
    held = [[(10, 5), (640, 3), (700, 2)], [(5, 100)], []]
    floor = np.array([1.0, 1.0, 1.0])
    assert ms._next(held, floor, 4) == ([640, 5, 1], [700, 5, 0])
    assert held == [[(10, 5)], [], []]
    assert ms._next(held, np.array([5.0, 1.0, 1.0]), 4) == ([1, 1, 1], [0, 0, 0])  # all bounds of level 10 are below 5


def test_empty_tables(spark, corpus):
    docs, items = table(spark, *corpus)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("text is null"), items)):
        got = ms.search(d, i)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0
