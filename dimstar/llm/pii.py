"""Personal data: candidate spans judged by gradient-boosted trees.

Base patterns find e-mail addresses, IP addresses, payment cards and phone
numbers.  They miss what runs into something else (a phone number followed
by a card number is one run of digits, which no check passes).  So high-
recall generators propose overlapping spans of each kind: every run of a few
neighbouring groups of digits, every word around an @ or a spelt-out one.

Boosted trees, one model per kind, judge the candidates by their format
(lengths, groups, separators, check digits) and their context (what stands
before and after, known words nearby).  They learn from what the base
patterns accept: a base span is a positive, any other candidate a negative,
but for those inside a match that is too long for its kind, which aren't
learnt from.  What such a run of several spans looks like is learnt from made
ones: a base span with another base span behind it.  Scores are calibrated
on candidates of other documents, and a kind's threshold is the smallest one
that keeps the wanted precision there.  Candidates above it that overlap no
span of their own kind are added, the best first; base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimstar.llm.common import hash_share, map_texts, sample_per_class

Span = tuple[int, int]

# The kinds in their order.
KINDS = ("email", "ip", "card", "phone")

# Words that tell personal data nearby.
HINTS = {
    "email": ("mail", "email", "contact", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "credit", "payment", "karte", "tarjeta", "carte"),
    "phone": ("tel", "phone", "call", "fax", "mobile", "telefon"),
}
# Words that tell secrets, keys and versions nearby.
OTHERS = ("token", "key", "secret", "version", "id", "hash", "sha", "isbn", "serial")


@dataclass(frozen=True)
class Params:
    documents: int = 12_000  # about so many documents with digits or @ are learnt from
    per_class: int = 4000  # candidates of each kind and label in the sample
    trees: int = 40
    depth: int = 4
    bins: int = 32
    rate: float = 0.3
    least: int = 5  # candidates at a leaf
    precision: float = 0.995  # wanted of calibration candidates above the threshold
    floor: float = 0.5  # no threshold is lower
    per_document: int = 400  # candidates of a document that are learnt from, evenly spread
    runs: int = 4  # base spans of a document from which runs of two spans are made
    near: int = 24  # characters of context on either side
    block: int = 20_000  # candidates that are scored together


# --- base patterns -----------------------------------------------------------------

# Possessive where no shorter repeat could match, so that every scan is linear.
_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def digits(s: str) -> str:
    return _NOT_DIGIT.sub("", s)


def luhn(number: str) -> bool:
    """Whether the check digit of a string of digits is right."""
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-12:]) <= 255 for p in s.split("."))


def emails(text: str) -> list[Span]:
    """The leftmost matches of the e-mail pattern.

    Every @ has one run of local characters before it, so the matches are
    found from the @ to both sides, without trying every start of a long run.
    """
    out, end = [], 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            end = m.end()
    return out


def matches(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """The base spans of each kind, and the matches that have too many digits for theirs."""
    fine: dict[str, list[Span]] = {k: [] for k in KINDS}
    long: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        fine["email"] = emails(text)
    fine["ip"] = [m.span() for m in _IP.finditer(text) if octets(m.group())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            number = digits(m.group())
            if len(number) > 19:
                long["card"].append(m.span())
            elif len(number) >= 12 and luhn(number):
                fine["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            size = len(digits(m.group()))
            if size >= 9:
                (fine if size <= 15 else long)["phone"].append(m.span())
    return fine, long


def base(text: str) -> dict[str, list[Span]]:
    return matches(text)[0]


# --- generators ----------------------------------------------------------------------

_GROUP = re.compile(r"[0-9]++")
_SEPARATOR = re.compile(r"[\x20().\-/]{1,3}\Z")
_WORD_AT = re.compile(r"(?:@|[\x20]?[\[(]at[\])][\x20]?)", re.I)
_NAME = re.compile(r"[\w.%+-]{1,64}\Z")
_HOST = re.compile(r"\w[\w-]*+(?:(?:\.|[\x20]?[\[(]dot[\])][\x20]?)\w[\w-]*+)+", re.I)
_MOST = {"ip": 12, "card": 19, "phone": 15}  # digits of a candidate
_LEAST = {"card": 12, "phone": 7}


def candidates(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of all proposals; their number grows with the length of the text."""
    for m in _WORD_AT.finditer(text):
        name = _NAME.search(text[max(0, m.start() - 64) : m.start()])
        host = _HOST.match(text, m.end())
        if name and host:
            start, end = m.start() - len(name.group()), host.end()
            yield "email", start, end
            inner, shorter = name.group().rfind(".") + 1, text.rfind(".", m.end(), end)
            if inner:
                yield "email", start + inner, end
            if text.find(".", m.end(), end) < shorter:
                yield "email", start, shorter
    groups = [m.span() for m in _GROUP.finditer(text)]
    for i, (a, _) in enumerate(groups):
        size = 0
        start = a
        while start > 0 and a - start < 2 and text[start - 1] in "+(":
            start -= 1
        for j in range(i, len(groups)):
            c, b = groups[j]
            if j > i and not _SEPARATOR.fullmatch(text, groups[j - 1][1], c):
                break
            size += b - c
            if size > 19:
                break
            if 2 <= j - i <= 3 and size <= _MOST["ip"] and text[a:b].count(".") == j - i:
                yield "ip", a, b
            if _LEAST["card"] <= size <= _MOST["card"]:
                yield "card", a, b
            if _LEAST["phone"] <= size <= _MOST["phone"]:
                yield "phone", a, b
                if start < a:
                    yield "phone", start, b


# --- features ------------------------------------------------------------------------

FEATURES = (
    "length", "digits", "groups", "longest group", "shortest group", "spaces", "dots", "dashes", "brackets", "plus first", "bracket first",
    "balanced", "check digit", "octets", "leading zero", "letters", "host labels", "last label", "name length", "digit share",
    "letter before", "digit before", "sign before", "space before", "quote before", "letter after", "digit after", "sign after", "space after",
    "quote after", "plus near before", "digits near before", "digits near after", "hint", "other hint", "equals near",
)


def _side(c: str) -> tuple[float, float, float, float, float]:
    if not c:
        return 0, 0, 0, 1, 0
    return c.isalpha(), c.isdigit(), c in "+-./()@_:=", c.isspace(), c in "\"'"


def features(text: str, kind: str, start: int, end: int, near: int = 24) -> list[float]:
    """Format and context of a candidate, in the order of FEATURES."""
    s, before, after = text[start:end], text[max(0, start - near) : start], text[end : end + near]
    groups = _GROUP.findall(s)
    number = "".join(groups)
    labels, name = [], ""
    if kind == "email":
        plain = re.sub(r"[\x20]?[\[(]at[\])][\x20]?", "@", s, flags=re.I)
        plain = re.sub(r"[\x20]?[\[(]dot[\])][\x20]?", ".", plain, flags=re.I)
        name, _, host = plain.partition("@")
        labels = host.split(".")
    words = set(re.findall(r"[^\W\d_]+", (before + " " + after).lower()))
    parts = [len(g) for g in groups] or [0]
    return [
        end - start, len(number), len(groups), max(parts), min(parts), s.count(" "), s.count("."), s.count("-"), s.count("(") + s.count(")"),
        s[:1] == "+", s[:1] == "(", s.count("(") == s.count(")"), bool(number) and luhn(number), kind == "ip" and octets(s),
        kind == "ip" and any(len(g) > 1 and g[0] == "0" for g in groups), sum(map(str.isalpha, s)), len(labels),
        len(labels[-1]) if labels and labels[-1].isalpha() else 0, len(name), len(number) / max(1, end - start),
        *_side(before[-1:]), *_side(after[:1]), "+" in before[-4:], sum(map(str.isdigit, before[-6:])), sum(map(str.isdigit, after[:6])),
        any(h in words for h in HINTS[kind]), any(h in words for h in OTHERS), "=" in before[-4:],
    ]


# --- boosted trees -------------------------------------------------------------------


@dataclass
class Trees:
    """Boosted trees as arrays: feature, cut, children (a leaf points to itself), value."""

    bias: float = 0.0
    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.int32))
    cut: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))
    child: np.ndarray = field(default_factory=lambda: np.zeros((0, 1, 2), np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))
    depth: int = 0
    scale: tuple[float, float] = (1.0, 0.0)  # calibration: slope and shift of the margin
    threshold: float = 1.1  # above 1: nothing is added

    def margins(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        every = np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int32)
            for _ in range(self.depth):
                at = self.child[t, at, (x[every, self.feature[t, at]] > self.cut[t, at]).astype(np.int8)]
            z += self.value[t, at]
        return z

    def scores(self, x: np.ndarray) -> np.ndarray:
        slope, shift = self.scale
        return 1 / (1 + np.exp(-np.clip(slope * self.margins(x) + shift, -50, 50)))


def _grow(binned: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, params: Params):
    """One tree by histograms of gradients: nodes as [feature, cut, low child, high child, value]; and its predictions."""
    nodes: list[list[float]] = []
    step = np.zeros(len(binned))
    width = params.bins + 1

    def node(rows: np.ndarray, depth: int) -> int:
        at = len(nodes)
        g, h = grad[rows].sum(), hess[rows].sum()
        nodes.append([0, np.inf, at, at, params.rate * g / (h + 1)])
        best, split = 1e-6, None
        if depth < params.depth and len(rows) >= 2 * params.least:
            for j, cut in enumerate(cuts):
                if len(cut):
                    b = binned[rows, j]
                    gs, hs = np.bincount(b, grad[rows], width).cumsum(), np.bincount(b, hess[rows], width).cumsum()
                    ns = np.bincount(b, minlength=width).cumsum()
                    gs, hs, ns = gs[: len(cut)], hs[: len(cut)], ns[: len(cut)]
                    ok = (ns >= params.least) & (len(rows) - ns >= params.least)
                    gain = np.where(ok, gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1), 0)
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, split = gain[k], (j, k)
        if split is None:
            step[rows] = nodes[at][4]
            return at
        j, k = split
        high = binned[rows, j] > k
        low_child, high_child = node(rows[~high], depth + 1), node(rows[high], depth + 1)
        nodes[at][:4] = [j, cuts[j][k], low_child, high_child]
        return at

    node(np.arange(len(binned)), 0)
    return nodes, step


def boost(x: np.ndarray, y: np.ndarray, params: Params = Params()) -> Trees:
    """Logistic boosting.  Without both labels: the smoothed share of positives, without trees."""
    prior = (y.sum() + 1) / (len(y) + 2)
    model = Trees(bias=float(np.log(prior / (1 - prior))), depth=params.depth)
    if len(set(y.tolist())) < 2:
        return model
    cuts = [_cuts(x[:, j], params.bins) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], axis=1)
    z, trees = np.full(len(y), model.bias), []
    for _ in range(params.trees):
        p = 1 / (1 + np.exp(-z))
        nodes, step = _grow(binned, cuts, y - p, p * (1 - p), params)
        z += step
        trees.append(nodes)
    size = max(map(len, trees))
    flat = np.zeros((len(trees), size, 5))
    for t, nodes in enumerate(trees):
        flat[t, : len(nodes)] = nodes
    model.feature, model.cut, model.value = flat[:, :, 0].astype(np.int32), flat[:, :, 1], flat[:, :, 4]
    model.child = flat[:, :, 2:4].astype(np.int32)
    return model


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins`` cuts, half way between neighbouring values."""
    seen = np.unique(values)
    middle = (seen[1:] + seen[:-1]) / 2
    return middle if len(middle) <= bins else np.unique(np.quantile(values, np.linspace(0, 1, bins + 2)[1:-1]))


def calibrate(model: Trees, x: np.ndarray, y: np.ndarray, params: Params) -> Trees:
    """Slope and shift of least log loss on held candidates, and the threshold of the wanted precision.

    Targets are smoothed by one candidate of either label.  Without held
    candidates of both labels nothing is added.
    """
    if len(set(y.tolist())) < 2:
        return model
    z = model.margins(x)
    soft = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton's steps
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -50, 50)))
        w = np.maximum(p * (1 - p), 1e-9)
        d = soft - p
        hessian = np.array([[(w * z * z).sum() + 1e-6, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        da, db = np.linalg.solve(hessian, [(d * z).sum(), d.sum()])
        a, b = a + da, b + db
        if abs(da) + abs(db) < 1e-9:
            break
    model.scale = (float(a), float(b)) if 0 < a < 10 else (1.0, 0.0)  # else the labels are told apart without fail
    p = model.scores(x)
    order = np.argsort(-p, kind="stable")
    right, ranked = np.cumsum(y[order]), p[order]
    good = right >= params.precision * np.arange(1, len(p) + 1)
    last = np.r_[ranked[1:] < ranked[:-1], True]  # a threshold takes all candidates of a score
    fine = np.flatnonzero(good & last)
    if len(fine):
        below = ranked[fine[-1] + 1] if fine[-1] + 1 < len(p) else 0.0
        model.threshold = max(params.floor, float((ranked[fine[-1]] + below) / 2))
    return model


# --- spans of a text -----------------------------------------------------------------


def touches(spans: list[Span], a: int, b: int) -> bool:
    """Whether [a, b) overlaps one of some sorted disjoint spans."""
    at = bisect(spans, (a, b))
    return (at > 0 and spans[at - 1][1] > a) or (at < len(spans) and spans[at][0] < b)


def _inside(spans: list[Span], a: int, b: int) -> bool:
    at = bisect(spans, (a, 1 << 62))
    return at > 0 and spans[at - 1][1] >= b


def examples(text: str, params: Params) -> list[tuple[str, int, int, list[float]]]:
    """(kind, label, start, features) of the base spans and other candidates of a text."""
    fine, long = matches(text)
    own = {k: set(v) for k, v in fine.items()}
    others = [(k, a, b) for k, a, b in candidates(text) if (a, b) not in own[k] and not _inside(long[k], a, b)]
    found = [(k, 1, a, b) for k in KINDS for a, b in fine[k]] + [(k, 0, a, b) for k, a, b in others]
    step = max(1, -(-len(found) // params.per_document))
    return [(k, y, a, features(text, k, a, b, params.near)) for k, y, a, b in found[::step]]


def run_examples(text: str, pool: list[tuple[str, str]], turn: int, params: Params) -> list[tuple[str, int, int, list[float]]]:
    """Like ``examples`` for made runs: base spans of the text, each with one of the ``pool`` (kind, span text) behind it."""
    out = []
    fine = base(text)
    spans = sorted((a, b, k) for k in KINDS for a, b in fine[k])[: params.runs]
    for at, (a, b, kind) in enumerate(spans if pool else []):
        other, words = pool[(turn + 7 * at) % len(pool)]
        left = max(0, a - 2 * params.near)
        made = f"{text[left:b]} {words}{text[b : b + 2 * params.near]}"
        first, second = (a - left, b - left), (b - left + 1, b - left + 1 + len(words))
        right = {(kind, *first), (other, *second)}
        for k, x, y in {*candidates(made)} | right:
            if touches([first, second], x, y):
                out.append((k, int((k, x, y) in right), left + x, features(made, k, x, y, params.near)))
    return sorted(out)


@dataclass
class Model:
    kinds: dict[str, Trees] = field(default_factory=dict)
    params: Params = Params()


def find(text: str, model: Model) -> tuple[dict[str, list[Span]], list[tuple[str, int, int, float]]]:
    """The base spans, and the spans (kind, start, end, score) that the model adds."""
    return find_all([text], model)[0]


def find_all(texts: list[str], model: Model) -> list[tuple[dict[str, list[Span]], list[tuple[str, int, int, float]]]]:
    """Base and added spans of each text; candidates of many texts are scored together, a bounded block at a time."""
    bases, kept = [], {k: [] for k in KINDS}
    rows, vectors = {k: [] for k in KINDS}, {k: [] for k in KINDS}

    def score(kind: str) -> None:
        if rows[kind]:
            p = model.kinds[kind].scores(np.array(vectors[kind], float))
            over = np.flatnonzero(p >= model.kinds[kind].threshold)
            kept[kind] += [(-float(p[k]), *rows[kind][k]) for k in over]
        rows[kind], vectors[kind] = [], []

    for i, text in enumerate(texts):
        fine = base(text)
        bases.append(fine)
        for kind, a, b in candidates(text):
            if kind in model.kinds and not touches(fine[kind], a, b):
                rows[kind].append((i, a, b))
                vectors[kind].append(features(text, kind, a, b, model.params.near))
                if len(rows[kind]) >= model.params.block:
                    score(kind)
    added: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
    for kind in KINDS:
        score(kind)
        taken: dict[int, list[Span]] = {}
        for p, i, a, b in sorted(kept[kind]):
            mine = taken.setdefault(i, [])
            if not touches(mine, a, b):
                mine.insert(bisect(mine, (a, b)), (a, b))
                added[i].append((kind, a, b, -p))
    return list(zip(bases, added))


def joined(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by start, then the kinds' order, then end; comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


# --- Spark ---------------------------------------------------------------------------


def _interesting(text: str) -> Column:
    return F.col(text).rlike("[0-9@]") | F.col(text).rlike(r"(?i)[\[(]at[\])]")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", params: Params = Params()) -> Model:
    """Trees of each kind, from the candidates of a bounded sample of documents.

    About ``documents`` documents with a digit or an @, picked by the hash
    of text and key, give at most ``2 * per_class`` candidates of each kind
    and label; a quarter of the documents serves for calibration alone.
    A kind without base spans in the sample adds nothing.
    """
    picked = docs.select(F.struct(F.col(f"`{key}`").cast("string"), F.xxhash64(F.col(f"`{text}`"))).cast("string").alias("key"), F.col(f"`{text}`").alias("text"))
    picked = picked.where(_interesting("text"))
    share = min(1.0, params.documents / max(1, picked.count()))
    def make():
        def work(column: pa.Array) -> dict:
            texts = column.to_pylist()
            pool = [(k, t[a:b]) for t in texts for k, v in base(t).items() for a, b in v[: params.runs]]
            out = []
            for i, t in enumerate(texts):
                rows = examples(t, params) + run_examples(t, pool, i, params)
                out.append([{"kind": k, "label": y, "start": a, "x": x} for k, y, a, x in rows])
            return {"found": pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("label", pa.int32()), ("start", pa.int64()), ("x", pa.list_(pa.float64()))])))}

        return work

    made = map_texts(picked.where(hash_share(F.col("key")) < share), ["key"], "text", "found array<struct<kind:string,label:int,start:long,x:array<double>>>", make)
    rows = made.select("key", F.explode("found").alias("f")).select("key", "f.*")
    rows = rows.withColumn("class", F.concat_ws(":", "kind", "label")).withColumn("id", F.concat_ws(":", "key", "start", F.hash("x")))
    sample = sample_per_class(rows, "id", "class", params.per_class).select("key", "kind", "label", "start", "x").collect()
    return train([(r["key"], r["kind"], r["label"], r["x"]) for r in sorted(sample)], params)


def train(rows: list[tuple[str, str, int, list[float]]], params: Params = Params()) -> Model:
    """The model of (document, kind, label, features)."""
    model = Model(params=params)
    for kind in KINDS:
        own = [r for r in rows if r[1] == kind]
        if not any(r[2] for r in own):
            continue
        x, y = np.array([r[3] for r in own], float), np.array([r[2] for r in own], float)
        held = np.array([hashlib.blake2b(str(r[0]).encode(), digest_size=2).digest()[0] % 4 == 0 for r in own])
        model.kinds[kind] = calibrate(boost(x[~held], y[~held], params), x[held], y[held], params)
    return model


def detect(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: key, n_<kind> of base spans, base_sha256, spans (base and added), n_added.

    NULL and empty texts have no spans; repeated rows are judged each; very
    long texts whole.  Offsets are code points, the end exclusive.  An empty
    table gives an empty result.  Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: trees of bounded depth

    def make():
        def work(column: pa.Array) -> dict:
            found = find_all([t or "" for t in column.to_pylist()], shared.value)
            fine = [[(k, *s) for k in KINDS for s in b[k]] for b, _ in found]
            out: dict = {f"n_{k}": np.array([len(b[k]) for b, _ in found], np.int64) for k in KINDS}
            out["base_sha256"] = pa.array([hashlib.sha256(joined(f).encode()).hexdigest() for f in fine], pa.string())
            out["spans"] = pa.array([joined(f + [a[:3] for a in more]) for f, (_, more) in zip(fine, found)], pa.string())
            out["n_added"] = np.array([len(more) for _, more in found], np.int64)
            return out

        return work

    kinds = ", ".join(f"n_{k} long" for k in KINDS)
    return map_texts(docs, [key], text, f"{kinds}, base_sha256 string, spans string, n_added long", make)


def redact(text: str, model: Model) -> str:
    """The text with every found span replaced by its kind in brackets; overlapping spans become one."""
    fine, added = find(text, model)
    spans = sorted([(a, b, k) for k in KINDS for a, b in fine[k]] + [(a, b, k) for k, a, b, _ in added])
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"[{k}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])
