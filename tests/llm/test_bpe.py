import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from dimstar.llm import bpe

PIECES = ["  ", "\n", " ", "\t", "a", "the", " the", "'s", "é", "日本", "²", "Ⅷ", "\u00a0", "\u0085", "\x1c", "\u200b", "😀", "\u0301",
          "<|endoftext|>", "<|endof", "1", "23", "!!", "    ", "A" * 5, "_", "\u3000", "\r\n"]


@pytest.fixture(scope="module")
def tokenizer_file():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def model(tokenizer_file):
    return bpe.load(tokenizer_file)


@pytest.fixture(scope="module")
def library(tokenizer_file):
    return Tokenizer.from_file(tokenizer_file)


def ids_of(model, text):
    return [i for part in model.encode(text) for i in part]


def test_random_texts_as_the_library(model, library):
    rnd = random.Random(5)
    for _ in range(3000):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 25)))
        ids = ids_of(model, text)
        assert ids == library.encode(text, add_special_tokens=False).ids
        decoder = bpe.Decoder(model)
        assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == library.decode(ids, skip_special_tokens=False)


def test_broken_bytes_as_the_library(model, library):
    rnd = random.Random(6)
    for _ in range(500):
        ids = [rnd.choice(model.byte_ids) for _ in range(12)]
        decoder = bpe.Decoder(model)
        assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("alphabet, size", [("a", 5000), ("ab", 9000), ("thein", 20000), ("étheß", 9000), ("-", 9999), (" ", 5000), ("x y", 150000)])
def test_long_pretokens(model, library, alphabet, size):
    rnd = random.Random(size)
    text = "".join(rnd.choice(alphabet) for _ in range(size)) + "z"
    assert ids_of(model, text) == library.encode(text, add_special_tokens=False).ids


def test_lookahead_is_sufficient_for_random_merges():
    """Tokens that end before the lookahead never change when bytes are added."""
    rnd = random.Random(9)
    for _ in range(200):
        known, merges, size = list(range(3)), [], {0: 1, 1: 1, 2: 1}
        spelt = {0: (0,), 1: (1,), 2: (2,)}
        for _ in range(rnd.randint(1, 8)):
            a, b = rnd.choice(known), rnd.choice(known)
            if spelt[a] + spelt[b] in spelt.values():
                continue
            made = len(spelt)
            spelt[made], size[made] = spelt[a] + spelt[b], size[a] + size[b]
            merges.append((a, b, made))
            known.append(made)
        need = bpe.lookahead(merges, size)

        def merge(ids):
            for a, b, made in merges:
                out, i = [], 0
                while i < len(ids):
                    if i + 1 < len(ids) and (ids[i], ids[i + 1]) == (a, b):
                        out.append(made)
                        i += 2
                    else:
                        out.append(ids[i])
                        i += 1
                ids = out
            return ids

        for _ in range(20):
            text = [rnd.randint(0, 2) for _ in range(need + rnd.randint(1, 12))]
            more = text + [rnd.randint(0, 2) for _ in range(rnd.randint(1, 8))]

            def stable(ids):
                out, at = [], 0
                for t in ids:
                    at += size[t]
                    if at > len(text) - need:
                        break
                    out.append(t)
                return out

            assert stable(merge(text)) == stable(merge(more))


def test_memo_of_two_generations(tokenizer_file, monkeypatch, library):
    monkeypatch.setattr(bpe, "MEMO", 3)
    model = bpe.Model(open(tokenizer_file, encoding="utf-8").read())
    text = " ".join(f"w{i % 11}xyz, q{i}" for i in range(300))
    assert ids_of(model, text) == library.encode(text, add_special_tokens=False).ids
    assert len(model.spaced) <= 3 and len(model.spaced.old) <= 3


def test_rows(spark, tokenizer_file, library):
    texts = ["a b", None, "", "é" * 70000, "a b", "<|endoftext|> x"]
    docs = spark.createDataFrame([(i if i != 2 else None, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    rows = bpe.round_trip(docs, tokenizer_file).collect()
    assert len(rows) == 6
    for r in rows:
        text = texts[r["doc_id"] if r["doc_id"] is not None else 2] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.round_trip(docs.limit(0), tokenizer_file).count() == 0


def test_ids_there_and_back(spark, tokenizer_file):
    docs = spark.createDataFrame([(1, "Hello  wörld\n"), (2, None), (3, "")], "doc_id long, text string")
    back = bpe.decode_ids(bpe.encode_ids(docs, tokenizer_file, ["doc_id"]), tokenizer_file, ["doc_id"])
    assert sorted(tuple(r) for r in back.collect()) == [(1, "Hello  wörld\n"), (2, ""), (3, "")]


def many(model, texts):
    ids = [[] for _ in texts]
    for row, some in model.encode_many(texts):
        ids[row] += some.tolist()
    return ids


def odd_texts(n):
    rnd = random.Random(n)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 25))) for _ in range(n)]
    words = ["".join(rnd.choice("etaoinßéя日'1!\n") for _ in range(rnd.randint(1, 40))) for _ in range(300)]
    texts += [" ".join(rnd.choices(words, k=rnd.randint(0, 60))) + rnd.choice(["", " ", "\n", " \n", "\x1c"]) for _ in range(n)]
    return [*texts, None, "", " ", "<|endoftext|>", "a" * 5000, "x y " * 400, *["b c\n"] * 3]


@pytest.mark.parametrize("block, wide, rows", [(1 << 22, 64, 1 << 13), (1, 64, 7), (500, 3, 50), (500, 0, 1)])
def test_blocks_of_texts_as_the_library(model, library, monkeypatch, block, wide, rows):
    monkeypatch.setattr(bpe, "BLOCK", block)
    monkeypatch.setattr(bpe, "WIDE", wide)
    monkeypatch.setattr(bpe, "ROWS", rows)
    texts = odd_texts(300)
    assert many(model, texts) == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert many(model, []) == [] and many(model, [None, ""]) == [[], []]


def test_long_texts_come_in_slices(model, library, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 100)
    monkeypatch.setattr(bpe, "BLOCK", 250)
    texts = ["no " * 400, "", "ab\n cd  ef " * 300, "x" * 1000]
    assert many(model, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(list(model.encode_many(texts))) > 10


def test_special_tokens_of_any_number(tokenizer_file, model):
    import json

    spec = json.load(open(tokenizer_file, encoding="utf-8"))
    spec["added_tokens"] = []
    plain = bpe.Model(json.dumps(spec))
    assert many(plain, ["a <|endoftext|>"]) == [[i for part in plain.encode("a <|endoftext|>") for i in part]]
    assert len(many(plain, ["<|endoftext|>"])[0]) > 1 and many(model, ["<|endoftext|>"]) == [[model.special["<|endoftext|>"]]]


def test_new_words_are_merged_together(tokenizer_file, library, monkeypatch):
    """Ordinary words that no memo holds: none is merged by itself, and their CPU time was too much at 30 GB."""
    model = bpe.Model(open(tokenizer_file, encoding="utf-8").read())
    rnd = random.Random(4)
    texts = [" ".join("".join(rnd.choices("etaoinshrdlu", k=rnd.randint(3, 14))) + rnd.choice(["", ".", ".\n"]) for _ in range(200)).strip() for _ in range(60)]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    calls, rounds = [], []
    merge, merge_rows = model.merge, model.merge_rows
    monkeypatch.setattr(model, "merge", lambda data: calls.append(data) or merge(data))
    monkeypatch.setattr(model, "merge_rows", lambda octets: rounds.append(len(octets)) or merge_rows(octets))
    assert many(model, texts) == expected
    distinct = {p for t in texts for p in model.find(t)}
    assert not calls and sum(rounds) == len(distinct) and len(rounds) <= 1 + len(distinct) // bpe.ROWS


def test_round_trip_of_odd_texts(spark, tokenizer_file, library):
    texts = odd_texts(100)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r["doc_id"]: r for r in bpe.round_trip(docs, tokenizer_file).collect()}
    back = {r["doc_id"]: r["ids"] for r in bpe.encode_ids(docs, tokenizer_file, ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert back[i] == ids and rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_ragged_arrays():
    assert bpe.spread(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
    assert bpe.sums(np.array([1, 2, 3]), np.array([0, 2, 0, 1])).tolist() == [0, 3, 0, 3]
