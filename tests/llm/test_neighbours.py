import numpy as np
import pytest

from dimstar.llm.neighbours import Params, nearest, usable

EVERY = "vec_id % 50 = 0"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 3) for i, v in rows],
                                 "vec_id long, embedding array<float>, rank int")


def brute(rows, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for q in sorted({i for i in ids.tolist() if i % 50 == 0}):
        a = x[ids == q][0]
        s = {}
        for i, b in zip(ids.tolist(), x):
            if i != q:
                s[i] = float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))
        out[q] = sorted(s.items(), key=lambda t: (-round(t[1], 12), t[0]))[:k]
    return out


def recall(rows, got):
    want, hit, n = brute(rows), 0, 0
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q, w in want.items():
        found = sorted(by.get(q, []))
        assert [r for r, _, _ in found] == list(range(1, len(found) + 1))
        assert all(a[2] >= b[2] for a, b in zip(found, found[1:]))
        floor = w[-1][1] - 1e-9
        hit += sum(s >= floor for _, _, s in found)
        n += len(w)
    return hit / n


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + rng.normal(size=24) * 0.7)) for i in range(3000)]
    assert recall(rows, nearest(frame(spark, rows), EVERY).collect()) >= 0.9


def test_recall_where_the_start_knows_little(spark):
    """Small start blocks: the graph must come from the rounds, the answers from the walk."""
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(6000, 10)))]
    params = Params(neighbours=8, orders=3, block=32, bits=4, offers=3, beam=24)
    assert recall(rows, nearest(frame(spark, rows), EVERY, params=params).collect()) >= 0.8


def test_small_sets_are_exact_with_ties_and_copies(spark):
    rows = [(i, [1, 2, 3]) for i in range(0, 120)] + [(200, [3, 2, 1]), (250, [-1, 0, 0]), (251, [1, 1, 1]), (252, [2, 2, 2])]
    odd = [(300, None), (350, [0, 0, 0]), (400, [1, None, 1]), (450, [float("nan"), 1, 1]), (500, [float("inf"), 1, 1]), (550, []), (600, [1, 2])]
    got = nearest(frame(spark, rows + odd + rows[:3]), EVERY).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(rows)
    assert set(by) == set(want) == {0, 50, 100, 200, 250}
    for q, w in want.items():
        assert [v for _, v, _ in sorted(by[q])] == [v for v, _ in w]
        assert [s for _, _, s in sorted(by[q])] == pytest.approx([s for _, s in w], abs=1e-12)


def test_few_or_no_rows(spark):
    assert nearest(frame(spark, []), EVERY).count() == 0
    assert nearest(frame(spark, [(0, [1, 1])]), EVERY).count() == 0
    got = nearest(frame(spark, [(0, [1, 1]), (1, [1, 0]), (2, [0, -1])]), EVERY).collect()
    assert [(r["vec_id"], r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1), (2, 2)]
    assert usable(frame(spark, [(None, [1, 1]), (1, [0, 0])])).count() == 0
    assert nearest(frame(spark, [(1, [1, 0]), (2, [0, 1])]), EVERY, params=Params(rounds=1)).count() == 0
