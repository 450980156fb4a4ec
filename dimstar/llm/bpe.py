"""Byte-level BPE as a streaming transducer, and its decoder.

The merge list alone says how far ahead an encoder must look: `lookahead`
bounds how far to the left bytes that are yet to come can move a token
boundary.  `Stream` takes the bytes of one pre-token in pieces, emits a token
once it ends further left than that, and keeps the rest: constant memory,
however long the pre-token.  `encode` cuts a text where the pre-tokenizer
must cut too and remembers the ids of recent pieces in a memo of bounded
size.  `encode_many` takes blocks of texts: each distinct piece of a block is
merged once, all of them together as arrays.  `Decoder` turns ids back into
text, holding at most one unfinished code point.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from dimstar.llm.common import map_texts

# Fixed value: the pattern that splits a text before the merges.
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SLICE = 1 << 16  # characters of a text that are cut up at once
MEMO = 150_000  # pieces in each generation of a memo
LONG = 256  # longer pieces are not remembered
BLOCK = 1 << 22  # characters of texts that are encoded together
WIDE = 64  # bytes of the longest pre-tokens that are merged as rows of an array
ROWS = 1 << 13  # rows of such an array


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file.

    Printable Latin-1 characters stand for themselves; the other bytes take
    the code points from 256 on, in order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def lookahead(merges: list[tuple[int, int, int]], size: dict[int, int]) -> int:
    """Bytes of lookahead after which a token boundary is final.

    merges: (left, right, result) in rank order; size: bytes of each token.

    Compare the run over a text with the run over a longer text that begins
    with it, rule by rule.  Their boundaries agree left of some place, at
    first the end of the text.  Rule b can move that place only to the start
    of its right operand, and only if that operand either ends there, where
    an earlier rule a took the token that ended there as its own left
    operand, or covers it, with the split of an earlier rule a inside.  So
    the reach of b is at most the reach of such an a, plus the bytes from
    the start of b's right operand to that place; without any a, the bytes
    of the operand.
    """
    made: dict[int, tuple[int, int]] = {}
    reach: dict[int, int] = {}  # by the rule's result
    taken: dict[int, int] = {}  # by left operand: the largest reach of a rule that takes it
    # By token: the largest (reach of a rule inside + offset of its split), over its whole merge tree.
    inside: dict[int, int] = {}
    most = 0
    for left, right, result in merges:
        ends, token = taken.get(right, 0), right
        while token in made:
            token = made[token][1]
            ends = max(ends, taken.get(token, 0))
        here = max(size[right] + ends, inside.get(right, 0))
        reach[result] = max(reach.get(result, 0), here)
        taken[left] = max(taken.get(left, 0), here)
        within = max(here + size[left], inside.get(left, 0), size[left] + inside.get(right, 0))
        inside[result] = max(inside.get(result, 0), within)
        made.setdefault(result, (left, right))
        most = max(most, here)
    return most + 1


class Memo(dict):
    """Ids by piece: two generations of at most ``MEMO`` pieces, the older one dropped when the younger is full."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.make(piece)
        if len(piece) <= LONG:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Stream:
    """Tokens of one pre-token whose bytes come in pieces."""

    def __init__(self, model: Model):
        self.model, self.rest = model, b""

    def feed(self, piece: bytes) -> list[int]:
        """The tokens that no further byte can change."""
        self.rest += piece
        need = self.model.lookahead
        if len(self.rest) < 2 * need:
            return []
        out, at = [], 0
        for token in self.model.merge(self.rest):
            end = at + len(self.model.bytes_of[token])
            if end > len(self.rest) - need:
                break
            out.append(token)
            at = end
        self.rest = self.rest[at:]
        return out

    def finish(self) -> list[int]:
        out, self.rest = self.model.merge(self.rest), b""
        return out


class Model:
    """Merges and vocabulary of a byte-level BPE file (JSON of the tokenizers library)."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        letters, model = byte_letters(), spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if all(c in letters for c in t)}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.byte_ids = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.ranks = {(a, b): rank for rank, (a, b, _) in enumerate(merges)}
        self.made = [made for _, _, made in merges]
        self.pairs = PairRanks(self.ranks, self.made, self.byte_ids)
        self.lookahead = lookahead(merges, {i: len(b) for i, b in self.bytes_of.items()})
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.find = regex.compile(PRETOKENS).findall
        self.pretoken = Memo(self._pretoken)
        self.spaced = Memo(lambda piece: self._piece(" " + piece))

    def merge(self, data: bytes) -> list[int]:
        """The tokens of ``data`` taken as one pre-token."""
        ids, rank_of, never = [self.byte_ids[b] for b in data], self.ranks.get, len(self.made)
        if len(ids) > 60:
            return self._merge_long(ids)
        ranks = [rank_of(p, never) for p in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < never:
            i = ranks.index(best)
            ids[i] = self.made[best]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of((ids[i], ids[i + 1]), never)
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], ids[i]), never)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs over a linked list."""
        n, ranks = len(ids), self.ranks
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := ranks.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = self.made[rank], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (r := ranks.get((ids[k], ids[after[k]]))) is not None:
                    heapq.heappush(heap, (r, k, ids[k], ids[after[k]]))
        return [x for x in ids if x >= 0]

    def merge_rows(self, octets: np.ndarray) -> np.ndarray:
        """`merge` of a pre-token in each row of bytes: its tokens, and ``pairs.none`` elsewhere.

        256 is no byte; the last column holds no other.  All rows do one
        merge at a time.  A token stands at the place of its first byte;
        ``after`` and ``before`` link the places that have one.
        """
        pairs, (n, width) = self.pairs, octets.shape
        octets = octets.ravel()
        ids, ranks = pairs.octet_ids[octets], pairs.octet_ranks[octets, np.roll(octets, -1)]
        after, before = np.arange(1, len(ids) + 1), np.arange(-1, len(ids) - 1)
        first, table = np.arange(n) * width, ranks.reshape(n, width)
        while len(first):
            at = first + table[first // width].argmin(1)
            best = ranks[at]
            live = best < pairs.never
            first, at, best = first[live], at[live], best[live]
            gone, left = after[at], before[at]
            right = after[gone]
            ids[at] = made = pairs.made[best]
            ids[gone], ranks[gone] = pairs.none, pairs.never
            after[at], before[right] = right, at
            ranks[at] = pairs.rank(made, ids[right])
            ranks[left] = pairs.rank(ids[left], made)
        return ids.reshape(n, width)

    def merge_many(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of distinct pre-tokens and special tokens, one after the other, and the number of each one's."""
        data, offsets = spelt(pieces)
        size = np.diff(offsets)
        order = size.argsort(kind="stable")
        alone = (size > WIDE) | pc.is_in(pieces, pa.array([*self.special], pieces.type)).to_numpy(zero_copy_only=False)
        order = np.concatenate([order[~alone[order]], np.flatnonzero(alone)])
        short = order[: len(order) - alone.sum()]
        counts, parts = np.zeros(len(size), np.int64), []
        for i in range(0, len(short), ROWS):
            rows = short[i : i + ROWS]
            column = np.arange(size[rows].max() + 1)
            there = column < size[rows][:, None]
            octets = np.full(there.shape, 256)
            octets[there] = data[(offsets[rows][:, None] + column)[there]]
            ids = self.merge_rows(octets)
            there = ids != self.pairs.none
            counts[rows] = there.sum(1)
            parts.append(ids[there])
        for i in order[len(short) :].tolist():
            text = pieces[i].as_py()
            ids = [self.special[text]] if text in self.special else self.pretoken[text]
            counts[i] = len(ids)
            parts.append(np.array(ids, np.int64))
        # Back into the order of the pieces.
        starts = np.zeros(len(size), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate([np.empty(0, np.int64), *parts])[spread(starts, counts)], counts

    def _pretoken(self, text: str) -> tuple[int, ...]:
        if len(text) <= LONG:
            return tuple(self.merge(text.encode()))
        stream = Stream(self)
        out: list[int] = []
        for i in range(0, len(text), LONG):
            out += stream.feed(text[i : i + LONG].encode())
        return tuple(out + stream.finish())

    def _piece(self, text: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.pretoken.__getitem__, self.find(text))))

    def encode(self, text: str) -> Iterator[list[int]]:
        """The ids of a text, some at a time."""
        parts = self.split_special.split(text) if self.split_special else [text]
        for part in parts:
            if part in self.special:
                yield [self.special[part]]
                continue
            for piece in slices(part):
                if UNSAFE.search(piece):
                    yield list(self._piece(piece))
                    continue
                first, *rest = piece.split(" ")
                yield [*self._piece(first), *chain.from_iterable(map(self.spaced.__getitem__, rest))]


    def encode_many(self, texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """The ids of each text, some at a time, with the text's number; NULL: as the empty text."""
        rows, block, size = [], [], 0
        for row, text in enumerate(texts):
            for part in self.split_special.split(text or "") if self.split_special else [text or ""]:
                for piece in [part] if part in self.special else slices(part):
                    rows.append(row)
                    block.append(piece)
                    size += len(piece)
                    if size >= BLOCK:
                        yield from self._rows(rows, block)
                        rows, block, size = [], [], 0
        if block:
            yield from self._rows(rows, block)

    def _rows(self, rows: list[int], block: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        ids, counts = self.encode_block(block)
        starts = np.flatnonzero(np.diff(rows, prepend=-1))
        ends = np.cumsum(counts)
        bounds = [0, *ends[starts[1:] - 1].tolist(), len(ids)]
        for i, start in enumerate(starts.tolist()):
            yield rows[start], ids[bounds[i] : bounds[i + 1]]

    def encode_block(self, block: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of slices of texts and special tokens, one after the other, and the number of each one's ids.

        A slice is made of pre-tokens (up to its first sure cut, or to its
        end) and words, which follow a space each.
        """
        pretokens: list[str] = []  # of all slices, and the number of each
        n_pretokens, safe, n_words = [], [], np.zeros(len(block), np.int64)
        for i, piece in enumerate(block):
            before = len(pretokens)
            if piece in self.special:
                pretokens.append(piece)
            elif UNSAFE.search(piece):
                pretokens += self.find(piece)
            else:
                pretokens += self.find(piece[: piece.find(" ")] if " " in piece else piece)
                safe.append(i)
            n_pretokens.append(len(pretokens) - before)

        split = pc.split_pattern(pa.array([block[i] for i in safe], pa.large_string()), " ")
        n_words[safe] = np.diff(split.offsets) - 1
        later = np.ones(len(split.values), bool)
        later[split.offsets[:-1]] = False  # not the first, which is among the pre-tokens
        words = split.values.filter(pa.array(later)).dictionary_encode()
        found, found_starts, n_found = self._split_words(words.dictionary.to_pylist())

        known = pa.array(found + pretokens, pa.large_string()).dictionary_encode()
        codes = known.indices.to_numpy()
        ids, counts = self.merge_many(known.dictionary)
        # The units: distinct words, then distinct pre-tokens.
        n, m = len(n_found), len(counts)
        inner = np.concatenate([codes[spread(found_starts, n_found)], np.arange(m)])
        ids = ids[spread((np.cumsum(counts) - counts)[inner], counts[inner])]
        counts = sums(counts[inner], np.concatenate([n_found, np.ones(m, np.int64)]))

        n_first = np.array(n_pretokens, np.int64)
        n_units = n_first + n_words
        starts = np.cumsum(n_units) - n_units
        units = np.empty(n_units.sum(), np.int64)
        units[spread(starts, n_first)] = n + codes[len(found) :]
        units[spread(starts + n_first, n_words)] = words.indices
        ids = ids[spread((np.cumsum(counts) - counts)[units], counts[units])]
        return ids, sums(counts[units], n_units)

    def _split_words(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The pre-tokens of words that follow a space, the place of each word's first, and the number of each word's."""
        # White space at the end of a word is cut by what follows: such words apart.
        alone = np.array([not w or w[-1].isspace() for w in words], bool)
        together = [w for w, a in zip(words, alone) if not a]
        found = self.find(" " + " ".join(together)) if together else []
        firsts = [i for i, p in enumerate(found) if p[0] == " "]
        for i in np.flatnonzero(alone).tolist():
            firsts.append(len(found))
            found += self.find(" " + words[i])
        order = np.argsort(alone, kind="stable")
        starts, counts = np.empty((2, len(words)), np.int64)
        starts[order], counts[order] = firsts, np.diff([*firsts, len(found)])
        return found, starts, counts


class PairRanks:
    """The merges as arrays: ranks of pairs of tokens, and of pairs of bytes (256: no byte)."""

    def __init__(self, ranks: dict[tuple[int, int], int], made: list[int], byte_ids: list[int]):
        self.never, self.made = len(made), np.array(made, np.int64)
        self.none = 1 + max([*made, *byte_ids, *chain.from_iterable(ranks)])  # the id of no token
        keys = np.array([a * (self.none + 1) + b for a, b in ranks], np.int64)
        order = keys.argsort()
        # A last key that no pair has, so that every search ends inside.
        self.keys = np.append(keys[order], (self.none + 1) ** 2)
        self.ranks = np.append(np.array([*ranks.values()], np.int64)[order], self.never)
        self.octet_ids = np.array([*byte_ids, self.none], np.int64)
        self.octet_ranks = self.rank(self.octet_ids[:, None], self.octet_ids[None, :])

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * (self.none + 1) + right
        at = self.keys.searchsorted(key)
        return np.where(self.keys[at] == key, self.ranks[at], self.never)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ..., counts[0] of them; then those of the next start, and so on."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of the first counts[0] values, that of the next counts[1], and so on."""
    return np.diff(np.append(0, np.cumsum(values))[np.append(0, np.cumsum(counts))])


def spelt(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of large strings or binaries without nulls, one after the other, and where each begins; last: the end."""
    _, offsets, data = pieces.buffers()
    offsets = np.frombuffer(offsets, np.int64)[pieces.offset : pieces.offset + len(pieces) + 1] if len(pieces) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), offsets


class Spelling:
    """What each token stands for, written one after the other."""

    def __init__(self, of: dict[int, bytes]):
        self.of = pa.array([of.get(i) for i in range(max(of) + 1)], pa.large_binary())

    def write(self, ids: np.ndarray) -> bytes:
        data, offsets = spelt(self.of.take(pa.array(ids)))
        return data[offsets[0] : offsets[-1]].tobytes()


# A space after white space: there the pre-tokenizer need not cut.
UNSAFE = re.compile(r"\s ")
SAFE = re.compile(r"(?<!\s) ")


def slices(text: str) -> Iterator[str]:
    """A text in slices that end before a space that follows no white space: a sure cut of the pre-tokenizer."""
    start, n = 0, len(text)
    while n - start > SLICE:
        cut = text.rfind(" ", start + 1, start + SLICE)
        while cut > 0 and text[cut - 1].isspace():
            cut = text.rfind(" ", start + 1, cut)
        if cut < 0:
            found = SAFE.search(text, start + SLICE)
            cut = found.start() if found else n
        yield text[start:cut]
        start = cut
    if start < n:
        yield text[start:]


class Decoder:
    """Ids to text, piece by piece; bytes that are not UTF-8 become U+FFFD."""

    def __init__(self, model: Model):
        self.bytes_of = model.bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.feed_bytes(b"".join(map(self.bytes_of.__getitem__, ids)))

    def feed_bytes(self, data: bytes) -> str:
        """The same for tokens that are spelt out already."""
        return self.state.decode(data)

    def finish(self) -> str:
        return self.state.decode(b"", True)


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


_MODELS: dict[str, Model] = {}


def load(path: str) -> Model:
    """The model of a vocabulary file, made once per process.

    The file is part of the Python environment of every executor, like the
    libraries; it is not one of the input tables.
    """
    if path not in _MODELS:
        _MODELS[path] = Model(_read(path))
    return _MODELS[path]


def encode_ids(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns and ``ids`` (array of int) of each text; NULL: no ids."""

    def make():
        model = load(path)

        def work(column: pa.Array) -> dict:
            parts: list[list[np.ndarray]] = [[np.empty(0, np.int32)] for _ in range(len(column))]
            for row, ids in model.encode_many(t.as_py() for t in column):
                parts[row].append(ids.astype(np.int32))
            return {"ids": pa.array(map(np.concatenate, parts), pa.list_(pa.int32()))}

        return work

    return map_texts(docs, keep, text, "ids array<int>", make)


def decode_ids(rows: DataFrame, path: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """The ``keep`` columns and ``text`` of each id list; NULL: empty."""

    def make():
        model = load(path)

        def work(column: pa.Array) -> dict:
            texts = []
            for row in column.to_pylist():
                decoder = Decoder(model)
                texts.append(decoder.feed(row or []) + decoder.finish())
            return {"text": pa.array(texts, pa.string())}

        return work

    return map_texts(rows, keep, ids, "text string", make)


class Digest:
    """Number and hash of the ids of a text, and hash of the text they decode to."""

    def __init__(self, model: Model):
        self.n, self.decoder = 0, Decoder(model)
        self.ids, self.text = hashlib.sha256(), hashlib.sha256()

    def feed(self, n: int, decimal: bytes, spelling: bytes) -> None:
        """The next ``n`` ids: as decimals with a comma after each, and as bytes of text."""
        if n:
            self.ids.update(b"," if self.n else b"")
            self.ids.update(memoryview(decimal)[:-1])
            self.text.update(self.decoder.feed_bytes(spelling).encode())
            self.n += n

    def finish(self) -> tuple[int, str, str]:
        self.text.update(self.decoder.finish().encode())
        return self.n, self.ids.hexdigest(), self.text.hexdigest()


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode each whole text, holding the ids of one block of texts at a time.

    One row per row: key, n_tokens, ids_sha256 (of the decimal ids joined by
    commas), decoded_sha256 (of the decoded text in UTF-8).  NULL counts as
    the empty text.
    """

    def make():
        model = load(path)
        decimal = Spelling({i: b"%d," % i for i in model.bytes_of})
        token = Spelling(model.bytes_of)

        def work(column: pa.Array) -> dict:
            digests = [Digest(model) for _ in range(len(column))]
            for row, ids in model.encode_many(t.as_py() for t in column):
                digests[row].feed(len(ids), decimal.write(ids), token.write(ids))
            n, ids, decoded = zip(*(d.finish() for d in digests))
            return {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids), "decoded_sha256": pa.array(decoded)}

        return work

    return map_texts(docs, [key], text, "n_tokens long, ids_sha256 string, decoded_sha256 string", make)
