"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its subwords: the byte n-grams of
its lower-cased words, hashed into a fixed number of buckets.  Embeddings
and softmax are trained by stochastic gradient descent in numpy, on a
bounded sample of labelled documents whose subword counts Spark makes.  A
temperature fitted on sample documents that took no part in the training
calibrates the probabilities; documents whose best score is near chance and
below a low quantile of the calibrated scores are rejected.

A softmax knows only its own languages, so foreign text is told by another
mark: the share of a text's subwords that no training document has.  Its
limit lies between the shares of held documents of the known languages and
those that each language has against the other languages alone.

The softmax of an average is linear in the subwords, so a word has a fixed
vector of logits: scoring looks words up in a memo of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimstar.llm.common import crc_mod, hash_share, keep_rows, map_texts, materialize, reachable, segment_sums, word_blocks

UNKNOWN = "und"
MEMO = 200_000


@dataclass(frozen=True)
class Params:
    buckets: int = 1 << 14
    size: int = 8  # of an embedding
    per_language: int = 600  # documents of the training sample
    epochs: int = 6
    rate: float = 0.5
    batch: int = 32
    pieces: int = 4  # short passages of each training document that train too
    piece_words: int = 8
    reject: float = 0.0005  # share of calibration documents that may be rejected,
    margin: float = 1.2  # but only where the best score is within this factor of chance
    seed: int = 7


def subwords(word: bytes) -> list[int]:
    """Hashes of the 2- to 4-byte n-grams of a word between its edges."""
    w = b"<" + word + b">"
    return [crc32(w[i : i + n]) for n in (2, 3, 4) for i in range(len(w) - n + 1)]


def _unseen(hashes: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Whether each hash is missing among the sorted ``seen``."""
    if not len(seen):
        return np.ones(len(hashes), bool)
    return seen[np.minimum(np.searchsorted(seen, hashes), len(seen) - 1)] != hashes


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray  # buckets x languages: embedding times softmax weights
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    seen: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64), repr=False)  # subwords of the training documents
    limit: float = 1.0  # largest accepted share of other subwords
    memo: dict = field(default_factory=dict, repr=False)
    rows: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"memo": {}, "rows": []}

    def _sums(self, words: list[bytes]) -> np.ndarray:
        """Per word: the sum of its subwords' logits, their number, and how many of them are unseen."""
        memo, rows, buckets = self.memo, self.rows, len(self.logits)
        if len(memo) > MEMO:
            memo.clear()
            rows.clear()
        new = [w for w in dict.fromkeys(words) if w not in memo]
        if new:
            subs = [subwords(w) for w in new]
            sizes = np.array([len(x) for x in subs])
            flat = np.fromiter((b for x in subs for b in x), np.int64, sizes.sum())
            memo.update(zip(new, range(len(memo), len(memo) + len(new))))
            unseen = segment_sums(_unseen(flat, self.seen).astype(float), sizes)
            rows.append(np.c_[segment_sums(self.logits[flat % buckets], sizes), sizes, unseen])
            if len(rows) > 1:
                rows[:] = [np.concatenate(rows)]
        at = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        return rows[0][at]

    def scores(self, block: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated probabilities, a row for each word list; and the share of unseen subwords."""
        sizes = np.array([len(x) for x in block])
        words = [w for x in block for w in x]
        if not words:
            sums = np.zeros((len(block), len(self.languages) + 2))
        else:
            sums = segment_sums(self._sums(words), sizes)
        sums, number, unseen = sums[:, :-2], np.maximum(sums[:, -2:-1], 1), sums[:, -1:]
        return _softmax((sums / number + self.bias) / self.temperature), (unseen / number)[:, 0]

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; no letter: ``und`` with score 0."""
        return self.judge(column)[:2]

    def judge(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language and score of each text, and whether it is accepted."""
        best, score, foreign = [UNKNOWN] * len(column), np.zeros(len(column)), np.zeros(len(column), bool)
        letters = np.array([t is not None and any(map(str.isalpha, t)) for t in column.to_pylist()], bool)
        if not self.languages:
            return best, score, foreign
        for first, block in word_blocks(column):
            p, unseen = self.scores(block)
            foreign[first : first + len(block)] = unseen > self.limit
            top = p.argmax(axis=1)
            for i, k in enumerate(top):
                if letters[first + i]:
                    best[first + i], score[first + i] = self.languages[k], p[i, k]
        known = np.array([g != UNKNOWN for g in best], bool)
        return best, score, known & (score >= self.threshold) & ~foreign


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _passages(words: list[bytes], params: Params) -> Iterator[list[bytes]]:
    """A document's words, and some short passages of it."""
    yield words
    step = max(1, len(words) // (params.pieces + 1))
    for k in range(params.pieces if len(words) > 2 * params.piece_words else 0):
        yield words[k * step : k * step + params.piece_words]


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.array([h for w in words for h in subwords(w)], np.int64)


def _sample(known: DataFrame, params: Params) -> DataFrame:
    """key, lang, text, held of about ``per_language`` documents of each language, as a table.

    Rows of one key count once.  Languages are classes: their counts come to
    the driver.  A sixth of the sample is held back for calibration.
    """
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    share = F.lit(0.0)
    for value, n in sorted(counts.items()):
        share = F.when(F.col("lang") == F.lit(value), F.lit(min(1.0, params.per_language / n))).otherwise(share)
    picked = known.where(hash_share(F.col("key")) < share).groupBy("key").agg(F.min(F.struct("lang", "text")).alias("row"))
    held = F.pmod(F.xxhash64("key", F.lit(params.seed)), F.lit(6)) == 0
    return materialize(picked.select("key", "row.*", held.alias("held")), "language-sample")


def _examples(sample: DataFrame, params: Params) -> DataFrame:
    """Bucket counts of each document and of some short passages of it: two or four bytes a bucket, four a count."""
    kind = _bucket_type(params)

    def make():
        def work(column: pa.Array) -> dict:
            out = []
            for _, block in word_blocks(column):
                for words in block:
                    made = []
                    for passage in _passages(words, params):
                        bucket, n = np.unique(_hashes(passage) % params.buckets, return_counts=True)
                        made.append(bucket.astype(kind).tobytes() + n.astype("<u4").tobytes())
                    out.append(made)
            return {"examples": pa.array(out, pa.list_(pa.binary()))}

        return work

    return map_texts(sample, ["key", "lang", "held"], "text", "examples array<binary>", make)


def _bucket_type(params: Params) -> str:
    return "<u2" if params.buckets <= 1 << 16 else "<u4"


def _example(x: bytes, params: Params) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts, as views of the bytes."""
    kind = np.dtype(_bucket_type(params))
    n = len(x) // (kind.itemsize + 4)
    return np.frombuffer(x, kind, n), np.frombuffer(x, "<u4", n, n * kind.itemsize)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        params: Params = Params()) -> LanguageModel:
    """Train on the labelled rows of ``docs``: a sample of about ``per_language`` documents of each language.

    Rows without text or language are left out; without any labelled row
    the model knows no language and answers ``und``.
    """
    known = docs.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    sample = _sample(known.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")), params)
    model = train(sorted((str(r["key"]), r["lang"], r["held"], [bytes(x) for x in r["examples"]]) for r in _examples(sample, params).collect()), params)
    if model.languages:
        hashes, only = _seen(sample, model.languages)
        model.seen = hashes
        _set_limit(model, _held_shares(sample, model.languages, hashes, only, params))
    return model


def train(rows: list[tuple[str, str, bool, list[bytes]]], params: Params = Params()) -> LanguageModel:
    """The model of examples in the form that ``_examples`` makes: (key, language, held, counts)."""
    languages = sorted({lang for _, lang, _, _ in rows})
    if not languages:
        return LanguageModel([], np.zeros((params.buckets, 0)), np.zeros(0))
    rng = np.random.default_rng(params.seed)
    data = [(x, languages.index(lang)) for _, lang, held, xs in rows if not held for x in xs if x]
    embed = rng.normal(0, 0.1, (params.buckets, params.size))
    weights, bias = rng.normal(0, 0.1, (params.size, len(languages))), np.zeros(len(languages))
    steps, done = params.epochs * -(-len(data) // params.batch), 0
    for _ in range(params.epochs):
        order = rng.permutation(len(data))
        for start in range(0, len(order), params.batch):
            chosen = [data[i] for i in order[start : start + params.batch]]
            parts = [_example(x, params) for x, _ in chosen]
            sizes = np.array([len(at) for at, _ in parts])
            at, share = np.concatenate([at for at, _ in parts]), np.concatenate([n / n.sum() for _, n in parts])[:, None]
            hidden = segment_sums(embed[at] * share, sizes)
            error = _softmax(hidden @ weights + bias)
            error[np.arange(len(chosen)), [y for _, y in chosen]] -= 1
            rate = params.rate * (1 - done / steps)
            back = np.repeat(error @ weights.T, sizes, axis=0) * share
            weights -= rate * hidden.T @ error / len(chosen)
            bias -= rate * error.mean(axis=0)
            # Subwords of an average get small gradients: their rate is larger.
            np.add.at(embed, at, -10 * rate * back / len(chosen) * params.size)
            done += 1
    model = LanguageModel(languages, embed @ weights, bias)
    first = [(_example(xs[0], params), languages.index(lang)) for _, lang, held, xs in rows if held and xs[0]]
    return _calibrate(model, [(at, n / n.sum(), k) for (at, n), k in first], params)


def _seen(sample: DataFrame, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The subwords of the training documents, sorted; and of each the one language that has it, -1 for several.

    United in Spark: a task gives each of its subwords once.
    """
    index = {g: i for i, g in enumerate(languages)}
    reachable(sample.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for b in batches:
            for _, block in word_blocks(b.column(0)):
                for i, words in enumerate(block, _):
                    own = index[b.column(1)[i].as_py()]
                    for w in set(words):
                        for h in subwords(w):
                            if found.setdefault(h, own) != own:
                                found[h] = -1
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int32())], ["h", "g"])

    parts = sample.where(~F.col("held")).select("text", "lang").mapInArrow(run, "h long, g int")
    one = F.when(F.min("g") == F.max("g"), F.max("g")).otherwise(-1)
    table = parts.groupBy("h").agg(one.cast("int").alias("g")).toArrow()
    hashes, only = table.column("h").to_numpy(), table.column("g").to_numpy()
    order = np.argsort(hashes)
    return hashes[order], only[order]


def _held_shares(sample: DataFrame, languages: list[str], hashes: np.ndarray, only: np.ndarray, params: Params) -> list[tuple[list[float], float]]:
    """Of each held document: the shares of unseen subwords in it and its passages; and in it, had only the other languages been learnt."""
    shared = sample.sparkSession.sparkContext.broadcast((hashes, only))  # of the bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, owner = shared.value
        own, foreign = [], []
        for b in batches:
            for at, block in word_blocks(b.column(0)):
                for i, words in enumerate(block, at):
                    lang = languages.index(b.column(1)[i].as_py())
                    found = [x for x in (_hashes(p) for p in _passages(words, params)) if len(x)]
                    if found:
                        own.append([float(_unseen(x, seen).mean()) for x in found])
                        place = np.minimum(np.searchsorted(seen, found[0]), max(0, len(seen) - 1))
                        foreign.append(float((_unseen(found[0], seen) | (owner[place] == lang)).mean()) if len(seen) else 1.0)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.float64())), pa.array(foreign, pa.float64())], ["own", "other"])

    rows = sample.where("held").select("text", "lang").mapInArrow(run, "own array<double>, other double").collect()
    shared.unpersist()
    return [(list(r["own"]), r["other"]) for r in rows]


def _set_limit(model: LanguageModel, held: list[tuple[list[float], float]]) -> None:
    """The limit of the share of unseen subwords.

    The limit is never below the share of a held document or passage.  It
    goes half way up to the low shares of foreign text, for which each
    language stands in with the other languages' subwords alone.
    """
    if len(held) < 10:
        return
    own = max(x for shares, _ in held for x in shares)
    foreign = [x for _, x in held] if len(model.languages) > 1 else [1.0]
    model.limit = max(own, (own + float(np.quantile(foreign, 0.05))) / 2)


def _calibrate(model: LanguageModel, held: list[tuple[np.ndarray, np.ndarray, int]], params: Params) -> LanguageModel:
    """The temperature of least log loss on held documents, and the rejection threshold."""
    if len(held) < 10 or len(model.languages) < 2:
        return model
    z = np.array([share @ model.logits[at] for at, share, _ in held]) + model.bias
    y = np.array([k for *_, k in held])
    grid = np.geomspace(0.25, 20, 40)
    loss = [-np.log(np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    scores = _softmax(z / model.temperature).max(axis=1)
    model.threshold = float(min(params.margin / len(model.languages), np.quantile(scores, params.reject)))
    return model


def predict(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: key, lang_pred, score, accepted.

    NULL texts and texts without a letter: ``und``, score 0, not accepted.
    Foreign texts get the best of the known languages, but aren't accepted.
    Repeated rows are judged each; very long texts whole; an empty table
    gives an empty result.  Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: buckets x languages

    def make():
        def work(column: pa.Array) -> dict:
            langs, score, accepted = shared.value.judge(column)
            return {"lang_pred": pa.array(langs, pa.string()), "score": score, "accepted": pa.array(accepted)}

        return work

    return map_texts(docs, [key], text, "lang_pred string, score double, accepted boolean", make)


def keep(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The documents whose language the model accepts, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(column: pa.Array) -> pa.Array:
            return pa.array(shared.value.judge(column)[2])

        return work

    return keep_rows(docs, text, make)


def training_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents that may be learnt from: crc32 of the id as text, modulo 4, is not 2."""
    return docs.where(crc_mod(F.col(key), 4) != 2)
