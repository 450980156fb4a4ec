from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dimstar.llm import repetition
from dimstar.llm.repetition import Rules, judge, keep, measure, repeated_spans

import pyarrow as pa


def brute(words, window):
    """Covered words and longest repeat, by comparing all pairs of positions."""
    n, covered, longest = len(words), set(), 0
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and words[i + k] == words[j + k]:
                k += 1
            longest = max(longest, k)
            if k >= window:
                covered |= set(range(i, i + k))
    return covered, longest


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=25), min_size=1, max_size=5), st.integers(1, 6))
def test_against_all_pairs(texts, window):
    made = measure(pa.array([" ".join(t) for t in texts]), window)
    for i, t in enumerate(texts):
        covered, longest = brute(t, window)
        assert (made["n_words"][i], made["n_repeat_words"][i], made["longest_repeat"][i]) == (len(t), len(covered), longest)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=30))
def test_spans_are_the_union(words):
    covered, _ = brute(words, 5)
    assert {p for a, b in repeated_spans(" ".join(words), 5) for p in range(a, b)} == covered


def test_blocks_do_not_matter(monkeypatch):
    texts = pa.array(["a b a b a b"] * 3 + [None, "", "x " * 50, "c d e f g h c d e f g"])
    whole = measure(texts, 5)
    monkeypatch.setattr(repetition, "BLOCK_WORDS", 7)
    apart = measure(texts, 5)
    assert all((whole[k] == apart[k]).all() for k in whole)
    sliced = measure(texts.slice(5), 5)
    assert sliced["longest_repeat"].tolist() == [49, 5]


@pytest.fixture(scope="module")
def rows(spark):
    plain = " ".join(f"w{i}" for i in range(40))
    data = [
        (1, plain), (2, None), (3, ""), (4, " \n\t "), (5, "one two three"), (6, plain + "\n" + plain), (1, plain),
        (None, plain), (7, "a#b é$\n\nx y\nx y\n \n z"), (8, "w " * 20000), (9, "a\x1cb a b c d e f g h i j\x0bk"),
    ]
    return spark.createDataFrame([(*r, "kept", 1) for r in data], "doc_id long, text string, kept string, n_words int")


def test_rows(rows):
    got = {(r["doc_id"], r["n_words"]): r for r in judge(rows).collect()}
    assert judge(rows).count() == 11
    assert got[(1, 40)]["kept"] and not got[(1, 40)]["base_failed"]
    assert got[(None, 40)]["kept"]
    for k in ((2, 0), (3, 0), (4, 0), (5, 3), (6, 80), (8, 20000)):
        assert got[k]["base_failed"] and not got[k]["kept"]
    assert got[(6, 80)]["n_dup_lines"] == 1 and got[(6, 80)]["longest_repeat"] == 40
    r = got[(7, 7)]
    assert (r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == (10, 2, 1)
    assert got[(9, 12)]["word_chars"] == 14  # U+001C is no white space, U+000B is


def test_long_repeat_is_dropped():
    text = " ".join([f"a{i}" for i in range(201)] + [f"b{i}" for i in range(3000)] + [f"a{i}" for i in range(201)])
    made = measure(pa.array([text]), 5)
    assert repetition._verdict(made, Rules())[1].tolist() == [False]
    assert repetition._verdict(made, Rules(max_longest=201))[1].tolist() == [True]


def test_keep_has_all_columns(rows, spark):
    kept = keep(rows)
    assert kept.schema == rows.schema
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 1, None, 9])
    assert keep(rows.limit(0)).count() == 0 and judge(rows.limit(0)).count() == 0
