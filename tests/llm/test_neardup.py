import random

import pytest

from dimstar.llm.neardup import Params, cells, components, keep, label


def shingles(text, w=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + w]) for i in range(max(1, len(words) - w + 1))} if words else set()


def brute(rows):
    """key -> (n_shingles, component) by comparing all pairs."""
    sets = {k: shingles(t) for k, t in rows}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {k: (len(sets[k]), find(k)) for k in keys}


def texts(rnd):
    """A hub with many near copies that are not near one another, chains, copies, a shared passage and noise."""
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    hub = [word() for _ in range(120)]
    out = []
    for _ in range(60):
        t = list(hub)
        for _ in range(3):
            t[rnd.randrange(len(t))] = word()
        out.append(" ".join(t))
    out += [" ".join(hub)] * 20 + [" ".join(hub).upper()] * 3
    chain = [word() for _ in range(100)]
    for _ in range(25):
        out.append("\n".join(chain))
        at = rnd.randrange(90)
        chain[at : at + 8] = [word() for _ in range(8)]
    passage = " ".join(word() for _ in range(60))
    out += [passage + " " + " ".join(word() for _ in range(rnd.randint(10, 60))) for _ in range(60)]
    out += [" ".join(word() for _ in range(rnd.randint(1, 80))) for _ in range(40)]
    out += ["a b c", "A  b\tc", "a b c d", "a b", None, "", " \n", "x " * 3000, "x " * 5, "x x x x", "é\x1cb c d e f", "é b c d e f"]
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rnd = random.Random(seed)
    rows = list(zip(rnd.sample(range(100000), 260), texts(rnd)))
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, n_shingles int").repartition(9)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in label(docs).collect()}
    assert got == {k: (n, c, k == c) for k, (n, c) in brute(rows).items()}


def test_repeated_rows_and_rows_without_key(spark):
    t = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(5, t), (5, t), (9, t), (None, t), (None, None), (6, None)], "doc_id long, text string")
    rows = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in label(docs).collect()), key=repr)
    assert rows == sorted([(5, 5, True), (5, 5, True), (9, 5, False), (None, None, True), (None, None, True), (6, 6, True)], key=repr)
    left = sorted(((r["doc_id"], r["text"]) for r in keep(docs).collect()), key=repr)
    assert left == sorted([(5, t), (None, t), (None, None), (6, None)], key=repr)
    assert keep(docs).schema == docs.schema


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert label(docs).count() == 0 and keep(docs).count() == 0


def test_sets_below_the_threshold_stay_apart(spark):
    words = [f"w{i}" for i in range(104)]  # 100 shingles
    near = words[:-4] + ["z"] * 4
    for changed, linked in ((14, True), (15, False)):  # 86 of 114, 85 of 115
        # The first words differ: 100 - changed shingles are shared.
        other = [f"v{i}" for i in range(changed)] + words[changed:]
        docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(near[:9]))], "doc_id long, text string")
        roots = {r["doc_id"]: r["component_id"] for r in label(docs).collect()}
        assert (roots[2] == 1) == linked, changed


def test_components_of_long_chains(spark):
    rnd = random.Random(3)
    ids = rnd.sample(range(1000), 200)
    links = list(zip(ids, ids[1:100])) + list(zip(ids[100:], ids[101:])) + [(ids[3], ids[3])]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: min(ids[:100]) for i in ids[:100]} | {i: min(ids[100:]) for i in ids[100:]}
    assert got == want


def test_tables_grow_with_the_square_of_the_sketches():
    p = Params()
    miss = 1 - (1 - (1 - 0.75**p.width) ** p.sketches) ** 2
    assert miss < 5e-5  # of a pair exactly at the threshold


def test_large_bucket_of_unlinked_texts(spark):
    """300 texts share boilerplate without being links, a few of them are; buckets are cut into cells of 16 nodes a side."""
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    passage = [word() for _ in range(80)]
    rows = [(i, " ".join(passage + [word() for _ in range(24)])) for i in range(300)]
    rows += [(300 + i, t + " " + word()) for i, (_, t) in enumerate(rows[:40:4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = {k: c for k, (_, c) in brute(rows).items()}
    assert 250 < len(set(want.values())) <= 300
    assert {r["doc_id"]: r["component_id"] for r in label(docs, params=Params(side=16)).collect()} == want


def test_each_pair_of_a_bucket_meets_once(spark):
    sizes = {7: 1, 8: 5, 9: 23}
    rows = [(i, v, n) for v, n in sizes.items() for i in range(n)]
    x, y = cells(spark.createDataFrame(rows, "node long, value long, n long"), 4)
    met = x.alias("x").join(y.alias("y"), ["value", "row", "col"]).where("x.row < x.col or x.node < y.node")
    got = sorted((r["value"], *sorted((r["a"], r["b"]))) for r in met.selectExpr("value", "x.node a", "y.node b").collect())
    assert got == [(v, a, b) for v, n in sorted(sizes.items()) for a in range(n) for b in range(a + 1, n)]
    assert max(r["count"] for r in x.groupBy("value", "row", "col").count().collect()) < 23
