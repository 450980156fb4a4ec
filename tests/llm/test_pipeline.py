"""The corpus pipeline against its stages spelt out on a small fixture."""

import random

import pyarrow as pa

import corpus_pipeline
from dimstar.llm import langid, repetition


def test_stages_and_their_decisions(spark, tmp_path):
    rnd = random.Random(2)
    syllables = {"aa": ["ka", "ra", "ta", "mo"], "bb": ["sch", "ung", "ein", "lich"]}
    word = lambda lang: "".join(rnd.choice(syllables[lang]) for _ in range(rnd.randint(2, 5)))
    rows = []
    for i in range(300):
        lang = rnd.choice(["aa", "bb"])
        rows.append((i, " ".join(word(lang) for _ in range(rnd.randint(12, 90))), lang))
    base = rows[10][1].split() + [word("aa") for _ in range(100)]
    rows += [(400, " ".join(base), "aa"), (401, " ".join(base), "aa"), (402, " ".join([*base[:-2], "x", "y"]), "aa"),
             (403, "12 " * 30, None), (404, None, "aa"), (405, "kara", "aa"), (406, "kara tamo raka ta mora " * 20, "aa"), (407, "", None)]
    docs = spark.createDataFrame([(*r, f"src{r[0] % 3}", len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")

    now = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, now, str(tmp_path))
        assert after.columns == docs.columns, name
        now = spark.createDataFrame(after.collect(), docs.schema)
    kept = {r["doc_id"] for r in now.collect()}

    model = langid.fit(langid.training_rows(docs))
    language, score = model.predict(pa.array([t for _, t, _ in rows]))
    stay = [r for r, g, s in zip(rows, language, score) if g != "und" and s >= model.threshold]
    made = repetition.measure(pa.array([t for _, t, _ in stay]), 5)
    stay = [r for r, ok in zip(stay, repetition._verdict(made, repetition.Rules())[1]) if ok]
    want = set()
    seen = []
    for i, t, _ in sorted(stay):
        w = t.lower().split()
        s = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
        if not any(100 * len(s & x) >= 75 * len(s | x) for x in seen):
            want.add(i)
        seen.append(s)
    assert kept == want
    assert 400 in kept and not kept & {401, 402, 403, 404, 405, 406, 407}

    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == kept
    size = {i: len(t.split()) for i, t, _ in rows if t}
    total = {}
    for r in packed:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_tokens"]
    assert total == {i: size[i] for i in kept}


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality_rules", "near_dedup", "packing"]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
