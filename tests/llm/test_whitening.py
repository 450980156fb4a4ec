import math

import numpy as np
import pytest

from dimstar.llm.common import read
from dimstar.llm.queries import op12_whitening
from dimstar.llm.whitening import Params, whiten

SCHEMA = "vec_id long, embedding array<double>, whitened string, x int"


def brute(rows, components=16):
    """All columns but the components' signs, in numpy and Python integers."""
    xs = [(i, tuple(math.floor(64 * float(c)) + 1_000_000 for c in v)) for i, v in rows]
    fit = sorted({x for _, x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    apart = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], float) / n
    cov = apart.T @ apart / n
    e, axes = np.linalg.eigh(cov)
    order = np.argsort(-e)[:components]
    w = apart @ axes[:, order] / np.sqrt(e[order])
    at = {x: k for k, x in enumerate(fit)}
    out = {}
    for i, x in xs:
        dev = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for k, j in enumerate(order):
            out.setdefault((i, k + 1), []).append((n, dev, w[at[x], k], e[j] / np.trace(cov)))
    return out


def compare(got, want):
    assert {(r["vec_id"], r["component"]) for r in got} == set(want) and len(got) == sum(map(len, want.values()))
    signs = {}
    for r in got:
        n, dev, w, share = want[r["vec_id"], r["component"]][0]
        assert (r["n"], r["deviation"]) == (n, dev) and math.isclose(r["explained"], share, rel_tol=1e-9)
        assert abs(abs(r["whitened"]) - abs(w)) < 1e-7
        if abs(w) > 1e-5:
            signs.setdefault(r["component"], set()).add(bool((r["whitened"] > 0) == (w > 0)))
        assert 0 <= r["identity_error"] < 1e-9
    assert all(len(s) == 1 for s in signs.values()) and len({r["identity_error"] for r in got}) == 1


def test_query_against_numpy(spark):
    rows = [(r[0], r[1]) for r in read(spark, "/root/testdata/sf0.001", "embeddings").select("vec_id", "embedding").collect()]
    compare(op12_whitening(spark, "/root/testdata/sf0.001").collect(), brute(rows))


@pytest.fixture(scope="module")
def rows():
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(300, 6)) @ np.diag([9, 6, 4, 2.5, 1.5, 0.7])
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, base[0].tolist()) for i in range(150)]  # a third of the rows share a vector
    return rows + [(5, base[5].tolist()), (2000, [0.0] * 6)]


def test_small_blocks_hot_vector_repeated_rows(spark, rows):
    odd = [(3000, None), (3001, []), (3002, [1.0] * 5), (3003, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (3004, [math.nan] * 6), (3005, [math.inf] * 6)]
    df = spark.createDataFrame([(i, v, "a", 1) for i, v in rows + odd], SCHEMA).repartition(5)
    for params in (Params(), Params(rows=64, dims=4, components=4)):
        compare(whiten(df, params=params).collect(), brute(rows, params.components))


def test_null_keys_stay(spark, rows):
    df = spark.createDataFrame([(None if i == 7 else i, v, "a", 1) for i, v in rows], SCHEMA)
    got = whiten(df).where("vec_id is null").collect()
    assert sorted(r["component"] for r in got) == [1, 2, 3, 4, 5, 6]


def test_no_variance(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0, 3.0], "a", 1) for i in range(9)], SCHEMA)
    got = whiten(df).collect()
    assert len(got) == 27 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(1, 0, 0.0, 0.0, 0.0)}
    df = spark.createDataFrame([(1, [0.0, 0.0, 0.0], "a", 1), (2, [1.0, 0.0, 0.0], "a", 1)], SCHEMA)
    got = {(r["vec_id"], r["component"]): r for r in whiten(df).collect()}
    assert [got[2, k]["explained"] for k in (1, 2, 3)] == pytest.approx([1, 0, 0])
    assert abs(got[1, 1]["whitened"]) == pytest.approx(1) and got[1, 2]["whitened"] == 0


def test_very_large_entries(spark):
    df = spark.createDataFrame([(1, [1e300, 0.0], "a", 1), (2, [-1e300, 1.0], "a", 1), (3, [1e12, 2.0], "a", 1)], SCHEMA)
    got = {(r["vec_id"], r["component"]): r for r in whiten(df).collect()}
    x = [((1 << 48), 0), (-(1 << 48), 64), (64 * 10**12, 128)]
    sums = [sum(c) for c in zip(*x)]
    want = [sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    assert [got[i, 1]["deviation"] for i in (1, 2, 3)] == [w if w < 2**63 else None for w in want]


def test_empty_table(spark):
    got = whiten(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and got.count() == 0
    assert whiten(spark.createDataFrame([(1, None, "a", 1)], SCHEMA)).count() == 0
