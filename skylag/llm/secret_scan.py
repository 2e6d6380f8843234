"""Secrets in texts: fixed patterns, and a linear-chain conditional random field over tokens."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import LOWER, blocks, mixed, span_hashes, text_of, utf8
from skylag.llm.registry import documents, query
from skylag.session import written

# base kinds in the order in which they are listed, then the model's own
KINDS = ("assign", "access", "hex", "tagged")
TAGGED = 3
# capitals of the data are made small first: the pattern takes letters in either case
_ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
# a run that is long enough begins where its characters begin, so shorter runs may be left out at once
_LONG_HEX = re.compile(rb"[0-9a-f]{24,}")

OUTSIDE, BEGIN, INSIDE = range(3)
# weights of a tag; features are hashed into them
FEATURES = 1 << 15
# documents with a secret, and as many without, on which the model is fitted; tokens of a window
MAX_DOCUMENTS, WINDOW = 1500, 64
# forms in which a sampled secret is seen besides its own, and bytes of text around it
FORMS, AROUND = 4, 160
# tokens of a piece of a chain; results do not depend on it
PIECE = 128
NEVER = -1e9

_KIND = np.full(256, 4, np.uint8)  # 0 blank, 1 digit, 2 small, 3 capital, 4 sign, 5 beyond ASCII
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[0x30:0x3A], _KIND[0x61:0x7B], _KIND[0x41:0x5B], _KIND[0x80:] = 1, 2, 3, 5
_HEXDIGIT = np.zeros(256, bool)
_HEXDIGIT[[*b"0123456789abcdefABCDEF"]] = True
_VOWEL = np.zeros(256, bool)
_VOWEL[[*b"aeiouyAEIOUY"]] = True
_LENGTHS = np.array([2, 3, 4, 6, 8, 10, 12, 16, 20, 24, 32, 40, 64])

# words before a secret, what stands between, and quotes around it, in forms made for training
_NAMES = ("password", "passwd", "secret", "token", "api_key", "passphrase", "credential", "auth", "bearer",
          "private_key", "client_secret", "access_key", "pwd", "key", "signature")
_BETWEEN = (" = ", "=", ": ", ":", " => ", " ")
_HEX_LETTERS = "0123456789abcdef"
_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def base_spans(data: bytes) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the secret itself) in bytes, by start and then kind."""
    out = [
        (m.start(), 0, m.end(), m.start(1)) for m in _ASSIGN.finditer(data.lower()) if m.end(1) - m.start(1) >= 6
    ]
    if b"AKIA" in data:
        out += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(data) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), m.start()) for m in _LONG_HEX.finditer(data)]
    return sorted(out)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of tokens: runs of letters and digits, and each other sign by itself."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[data]
    sign, word = kind == 4, (kind != 4) & (kind != 0)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    starts = sign | (word & (np.concatenate(([True], ~word[:-1])) | cut[:n]))
    ends = sign | (word & (np.concatenate((~word[1:], [True])) | cut[1:]))
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def file_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A code for each text: its size, and its shares of signs, digits and capitals."""
    kind = _KIND[data]

    def share(mask):
        total = np.concatenate(([0], np.cumsum(mask)))
        return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)

    steps = np.array([0.01, 0.03, 0.08, 0.2])
    size = np.minimum(np.log2(np.maximum(np.diff(offsets), 1)).astype(np.int64) // 4, 4)
    codes = [np.searchsorted(steps, share(kind == k), "right") for k in (4, 1, 3)]
    return size + 5 * (codes[0] + 5 * (codes[1] + 5 * codes[2]))


def features(
    data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, files: np.ndarray
) -> np.ndarray:
    """Indices into the weights, one line for each kind of feature and one column for each token."""
    n = len(starts)
    if not n:
        return np.zeros((0, 0), np.int32)
    kind = _KIND[data]
    length = ends - starts
    size = np.searchsorted(_LENGTHS, length, "right")

    def count(mask):
        return np.add.reduceat(mask.astype(np.int32), starts)

    digits, capitals, beyond = count(kind == 1), count(kind == 3), count(kind == 5)
    vowels, hexes = count(_VOWEL[data]), count(_HEXDIGIT[data])
    change = np.zeros(len(data), bool)
    change[1:] = (kind[1:] != kind[:-1]) & (kind[1:] != 0) & (kind[:-1] != 0)
    change[starts] = False
    # a capital at the beginning of a word is no change of kind worth counting
    capital_first = (kind[starts] == 3) & change[np.minimum(starts + 1, len(data) - 1)]
    changes = np.minimum(count(change) - capital_first, 9)

    def part(number):
        return np.where(number == 0, 0, np.where(number == length, 4, 1 + np.minimum(number * 3 // length, 2)))

    letters = length - digits - beyond
    shape = size + 16 * (part(digits) + 5 * (part(capitals) + 5 * (beyond > 0)))
    doc = np.searchsorted(offsets, starts, "right") - 1
    sign = kind[starts] == 4
    signs = np.where(sign, data[starts].astype(np.int64), 256)
    # words with digits are known by their shape only, so no secret is learnt by heart
    words = np.where(digits > 0, shape.astype(np.uint64), span_hashes(LOWER[data], starts, ends))

    def before(values, k, none):
        out = np.full(n, none, values.dtype)
        if n > k:
            out[k:] = np.where(doc[k:] == doc[:-k], values[:-k], none)
        return out

    def after(values, none):
        out = np.full(n, none, values.dtype)
        out[:-1] = np.where(doc[1:] == doc[:-1], values[1:], none)
        return out

    # the nearest word before, of the same text
    place = np.maximum.accumulate(np.where(sign, -1, np.arange(n)))
    place = np.concatenate(([-1], place[:-1]))
    there = (place >= 0) & (doc[np.maximum(place, 0)] == doc) & (np.arange(n) - place <= 6)
    name = np.where(there, words[np.maximum(place, 0)], np.uint64(0))
    blank = np.concatenate(([1], (starts[1:] > ends[:-1]).astype(np.int64)))
    glued = blank + 2 * np.append(blank[1:], 1)
    sign1, sign2, next1 = before(signs, 1, 257), before(signs, 2, 257), after(signs, 257)
    shape1 = before(shape, 1, -1)
    rough = size + 16 * (np.minimum(changes, 4) + 5 * np.where(letters > 0, np.minimum(vowels * 8 // np.maximum(letters, 1), 4), 5))
    kinds = [
        shape, signs, words, name, rough,
        size + 16 * changes, size + 16 * (hexes == length),
        shape + 4096 * glued, sign1 + 258 * (sign2 + 258 * next1),
        before(words, 1, 0), before(words, 2, 0), after(words, 0),
        mixed(name) + rough.astype(np.uint64), shape1 + 4096 * sign1.astype(np.int64) + (1 << 22) * (size > 6),
        files[doc], files[doc] + 8192 * size,
    ]
    out = np.empty((len(kinds), n), np.int32)
    for i, values in enumerate(kinds):
        hashed = mixed(values.astype(np.uint64) * np.uint64(2 * len(kinds) + 1) + np.uint64(i + 1))
        out[i] = (hashed >> np.uint64(40)).astype(np.int64) & (FEATURES - 1)
    return out


@dataclass
class Tagger:
    """Weights of features by tag, of one tag after another, and of the first tag."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros((FEATURES, 3)))
    after: np.ndarray = field(default_factory=lambda: np.zeros((3, 3)))
    first: np.ndarray = field(default_factory=lambda: np.zeros(3))

    def rounded(self) -> Tagger:
        """Weights in steps of 2**-12, so that sums are exact in any order."""
        steps = [np.round(w * 4096) / 4096 for w in (self.weights, self.after, self.first)]
        steps[1][OUTSIDE, INSIDE] = steps[2][INSIDE] = NEVER
        return Tagger(*steps)

    def emissions(self, index: np.ndarray) -> np.ndarray:
        out = np.zeros((index.shape[1] if index.size else 0, 3))
        for line in index:
            out += self.weights[line]
        return out


def viterbi(emission: np.ndarray, begins: np.ndarray, tagger: Tagger, piece: int = PIECE) -> np.ndarray:
    """The best tags of chains that stand one after another; `begins` marks where one begins.

    All chains are cut into pieces of equal length that are worked on together. For each piece,
    the best score from any tag before it to any last tag is found; the best tags between
    pieces follow from these, and then the tags inside. A chain's first tag does not look back.
    """
    n = len(emission)
    if not n:
        return np.zeros(0, np.uint8)
    pieces = -(-n // piece)
    padded = np.zeros((pieces * piece, 3))
    padded[:n] = emission
    start = np.zeros(pieces * piece, bool)
    start[:n] = begins
    # what is beyond the end is a chain by itself, of any tag
    start[n:] = True
    padded, start = padded.reshape(pieces, piece, 3), start.reshape(pieces, piece)
    start[0, 0] = True

    def moves(t):
        return np.where(start[:, t, None, None], tagger.first, tagger.after)

    score = moves(0) + padded[:, 0, None, :]  # piece, tag before, last tag
    for t in range(1, piece):
        score = (score[:, :, :, None] + moves(t)[:, None]).max(2) + padded[:, t, None, :]
    total, came = np.zeros(3), np.zeros((pieces, 3), np.uint8)
    for p in range(pieces):
        ways = total[:, None] + score[p]
        came[p] = ways.argmax(0)
        total = ways.max(0)
        total = total - total.max()  # keeps sums small; differences are exact
    last, entry = np.zeros(pieces, np.int64), np.zeros(pieces, np.int64)
    tag = int(total.argmax())
    for p in range(pieces - 1, -1, -1):
        last[p], entry[p] = tag, came[p, tag]
        tag = entry[p]
    back = np.zeros((piece, pieces, 3), np.uint8)
    every = np.arange(pieces)
    best = moves(0)[every, entry] + padded[:, 0]
    for t in range(1, piece):
        ways = best[:, :, None] + moves(t)
        back[t] = ways.argmax(1)
        best = ways.max(1) + padded[:, t]
    tags = np.zeros((pieces, piece), np.uint8)
    tag = last
    for t in range(piece - 1, -1, -1):
        tags[:, t] = tag
        tag = back[t, every, tag]
    return tags.ravel()[:n]


def fit(index: np.ndarray, tags: np.ndarray, used: np.ndarray, epochs: int = 12, batch: int = 256,
        rate: float = 0.02, ridge: float = 1e-4) -> Tagger:
    """Weights that make the given tags most likely; penalty on their squares.

    index: window, token, kind of feature; tags: window, token; used: tokens of each window.
    Gradients are expectations from forward and backward sums, steps are Adam's over small batches.
    """
    tagger = Tagger()
    n, length = tags.shape
    sizes = (FEATURES * 3, 9, 3)
    theta = np.zeros(sum(sizes))
    cuts = np.cumsum(sizes)[:-1]
    mean, square, step = np.zeros_like(theta), np.zeros_like(theta), 0
    order = np.random.default_rng(7)
    barred = np.zeros((3, 3))
    barred[OUTSIDE, INSIDE] = -1e3
    first_barred = np.array([0, 0, -1e3])
    for _ in range(epochs):
        for rows in np.array_split(order.permutation(n), max(1, n // batch)):
            weights, after, first = (part.reshape(shape) for part, shape in zip(np.split(theta, cuts), ((FEATURES, 3), (3, 3), (3,))))
            x, y, m = index[rows].astype(np.int32), tags[rows], used[rows]
            live = np.arange(length)[None, :] < m[:, None]
            emission = weights[x].sum(2)
            move = np.exp(after + barred)
            peak = emission.max(2, keepdims=True)
            own = np.exp(emission - peak)
            forward, backward = np.empty_like(own), np.ones_like(own)
            scale = np.ones((len(rows), length))
            now = np.exp(first + first_barred) * own[:, 0]
            for t in range(length):
                if t:
                    now = np.where(live[:, t, None], (forward[:, t - 1] @ move) * own[:, t], forward[:, t - 1])
                scale[:, t] = np.where(live[:, t], now.sum(1), 1.0) if t else now.sum(1)
                now = now / scale[:, t, None] if not t else np.where(live[:, t, None], now / scale[:, t, None], now)
                forward[:, t] = now
            for t in range(length - 2, -1, -1):
                here = (own[:, t + 1] * backward[:, t + 1]) @ move.T / scale[:, t + 1, None]
                backward[:, t] = np.where(live[:, t + 1, None], here, 1.0)
            expected = forward * backward
            expected /= expected.sum(2, keepdims=True)
            known = np.eye(3)[y]
            gap = np.where(live[:, :, None], expected - known, 0.0)
            both = live[:, 1:]
            pair = (
                forward[:, :-1, :, None] * move * (own[:, 1:] * backward[:, 1:] / scale[:, 1:, None])[:, :, None, :]
            )
            pair = np.where(both[:, :, None, None], pair, 0.0).sum((0, 1))
            seen = np.zeros((3, 3))
            np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), 1.0)
            flat = x.reshape(-1)
            spread = np.repeat(gap.reshape(-1, 3), x.shape[2], axis=0)
            gradient = np.concatenate([
                np.stack([np.bincount(flat, spread[:, k], FEATURES) for k in range(3)], 1).ravel(),
                (pair - seen).ravel(), gap[:, 0].sum(0),
            ]) / len(rows) + ridge * theta
            step += 1
            mean = 0.9 * mean + 0.1 * gradient
            square = 0.99 * square + 0.01 * gradient * gradient
            theta = theta - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    parts = np.split(theta, cuts)
    tagger.weights, tagger.after, tagger.first = parts[0].reshape(FEATURES, 3), parts[1].reshape(3, 3), parts[2]
    return tagger.rounded()


def _invented(rng: random.Random) -> str:
    """A value that looks like a secret, of a random kind and length."""
    kind = rng.randrange(6)
    if kind == 0:
        text = "".join(rng.choices(_HEX_LETTERS, k=rng.randrange(16, 65)))
        return text.upper() if rng.random() < 0.3 else text
    if kind == 1:
        return "".join(rng.choices(_LETTERS + "+/", k=rng.randrange(20, 61))) + rng.choice(("", "=", "=="))
    if kind == 2:
        return "".join(rng.choices(_LETTERS + "-_", k=rng.randrange(20, 51)))
    if kind == 3:
        short = "".join(rng.choices(_LETTERS[:26], k=rng.randrange(2, 5)))
        return f"{short}{rng.choice('_-')}" + "".join(rng.choices(_LETTERS, k=rng.randrange(20, 41)))
    if kind == 4:
        return "".join(rng.choices(_LETTERS, k=rng.randrange(12, 45)))
    return "".join(rng.choices(_LETTERS + "._-", k=rng.randrange(10, 18)))


def _harmless(rng: random.Random, words: list[str]) -> str:
    """Something with digits, signs or a name before it that is no secret."""
    word = rng.choice(words) if words else "value"
    number = rng.randrange(10 ** rng.randrange(1, 9))
    return rng.choice((
        f"{word} = {number}", f"{word}: {rng.choice(words) if words else word}", f"{number}", f"{word}_{word}",
        f"https://{word.lower()}.org/{word.lower()}/{number}", f"{word.lower()}@{word.lower()}.com", f"v{number % 10}.{number % 7}.{number % 31}",
        f"2024-{number % 12 + 1:02d}-{number % 28 + 1:02d}", f"{word}{word.title()}{number % 10}", f"/usr/{word.lower()}/{word.lower()}{number % 10}.txt",
        f"the {rng.choice(_NAMES)} of {word}", f"+{number:09d}", "-" * rng.randrange(3, 20), f"({number}, {number % 17}, {word})",
    ))


def examples(data: bytes, seed: int) -> list[tuple[bytes, int, int]]:
    """Pieces of a document with the secret's start and end in it; start -1 where there is none.

    A base span is shown as it is, and with other names before it, other signs between and
    invented values; a value without a digit may be an ordinary word and teaches nothing. A
    document without any shows plain passages, with harmless assignments and numbers put in.
    """
    rng = random.Random(seed)
    found = base_spans(data)
    out = []
    for start, kind, end, secret in found[:4]:
        if not any(0x30 <= c < 0x3A for c in data[secret:end]):
            continue
        left = data[max(0, start - AROUND) : start]
        right = data[end : end + AROUND]
        # whatever else is a secret beside it would be taken for none
        left = left[max((e for _, _, e, _ in base_spans(left)), default=0) :]
        right = right[: min((s for s, _, _, _ in base_spans(right)), default=len(right))]
        middle = data[start:secret]
        out.append((left + data[start:end] + right, len(left) + len(middle), len(left) + end - start))
        for _ in range(FORMS):
            value = _invented(rng).encode()
            quote = rng.choice(('"', "'", ""))
            name = f"{rng.choice(_NAMES)}{rng.choice(_BETWEEN)}"
            if rng.random() < 0.3:
                name = name.upper()
            if len(value) >= 24 and rng.random() < 0.3:
                name = ""
            before = left + (name + quote).encode()
            out.append((before + value + (quote + rng.choice((" ", "\n", "", ";"))).encode() + right, len(before), len(before) + len(value)))
    if not found:
        for _ in range(FORMS):
            at = rng.randrange(len(data) + 1)
            piece = data[at : at + 2 * AROUND]
            words = [w for w in piece.decode("utf-8", "ignore").split() if w.isalpha()]
            if rng.random() < 0.5:
                cut = piece.find(b" ") + 1
                piece = piece[:cut] + _harmless(rng, words).encode() + b" " + piece[cut:]
            out.append((piece, -1, -1))
    return out


def _windows(data: bytes, seed: int, size: int):
    """(indices, tags) of at most `size` tokens around each example's secret."""
    whole = np.frombuffer(data, np.uint8)
    files = file_features(whole, np.array([0, len(whole)]))
    for piece, start, end in examples(data, seed):
        piece_data = np.frombuffer(piece, np.uint8)
        ends_at = np.array([0, len(piece_data)])
        starts, ends = tokens(piece_data, ends_at)
        if not len(starts):
            continue
        index = features(piece_data, ends_at, starts, ends, files)
        inside = (ends > start) & (starts < end)
        tags = np.where(inside, INSIDE, OUTSIDE)
        first = 0
        if inside.any():
            tags[np.flatnonzero(inside)[0]] = BEGIN
            first = max(0, int(np.flatnonzero(inside)[0]) - size // 2)
        yield index[:, first : first + size], tags[first : first + size]


def train(docs: DataFrame, text: Column, most: int = MAX_DOCUMENTS, window: int = WINDOW) -> Tagger | None:
    """A tagger fitted on at most `most` documents with base spans and as many without any.

    All documents are searched for base spans; those whose text has the smallest hashes are the sample.
    None where no document has a base span to learn from.
    """
    order = F.xxhash64(F.lit(5), "text")
    marked = docs.select(text.alias("text")).select(F.md5("text").alias("key"), order.alias("order"), "text")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            raw = data.tobytes()
            found = [bool(base_spans(raw[a:b])) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("order"), pa.array(found, pa.bool_())], ["key", "order", "found"]
            )

    known = written(marked.mapInArrow(keys, "key string, order long, found boolean").distinct(), "secret-keys")
    parts = [known.filter(f).orderBy("order", "key").limit(most).select("key") for f in ("found", "not found")]
    sample = parts[0].unionByName(parts[1])

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, value in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                for index, tags in _windows(value.encode(), int(key[:12], 16), window):
                    rows.append((key, index.ravel(), tags))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1].astype(np.int16) for r in rows], pa.list_(pa.int16())),
                 pa.array([r[2].astype(np.int8) for r in rows], pa.list_(pa.int8()))],
                ["key", "index", "tags"],
            )

    # copies of a text are one example
    chosen = marked.join(F.broadcast(sample), "key").groupBy("key").agg(F.first("text").alias("text"))
    got = chosen.mapInArrow(shown, "key string, index array<smallint>, tags array<tinyint>").toArrow()
    keys_of, flat_tags, flat_index = (got.column(c).combine_chunks() for c in ("key", "tags", "index"))
    size = flat_tags.value_lengths().to_numpy()
    if not len(size) or not (flat_tags.flatten().to_numpy() == BEGIN).any():
        return None
    kinds = len(flat_index.flatten()) // int(size.sum())
    # an order that does not depend on how rows were dealt to tasks
    order = sorted(range(len(size)), key=lambda i: (keys_of[i].as_py(), flat_index[i].values.to_numpy().tobytes()))
    index = np.zeros((len(size), window, kinds), np.int16)
    tags, used = np.zeros((len(size), window), np.int8), np.zeros(len(size), np.int64)
    for i, row in enumerate(order):
        k = used[i] = size[row]
        tags[i, :k] = flat_tags[row].values.to_numpy()
        index[i, :k] = flat_index[row].values.to_numpy().reshape(kinds, k).T
    return fit(index, tags, used)


def tagged_spans(data: np.ndarray, offsets: np.ndarray, tagger: Tagger) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends in bytes of what the tagger takes for secrets."""
    starts, ends = tokens(data, offsets)
    if not len(starts):
        return starts, ends
    emission = tagger.emissions(features(data, offsets, starts, ends, file_features(data, offsets)))
    doc = np.searchsorted(offsets, starts, "right")
    begins = np.concatenate(([True], doc[1:] != doc[:-1]))
    tags = viterbi(emission, begins, tagger)
    first = np.flatnonzero(tags == BEGIN)
    follows = np.append((tags[1:] == INSIDE) & ~begins[1:], False)
    stop = np.flatnonzero((tags != OUTSIDE) & ~follows)
    return starts[first], ends[stop[np.searchsorted(stop, first)]]


def secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MAX_DOCUMENTS,
    tagger: Tagger | None = None,
) -> DataFrame:
    """doc_id and `spans` of each document: kind, start, end in characters, by start and then kind.

    Kinds `assign`, `access` and `hex` are the fixed patterns. `tagged` are spans that a conditional
    random field adds, where no fixed pattern has one. It is `tagger`, or else fitted on a bounded
    sample of the documents (`train`), and decodes every whole text as one chain.

    A null text is an empty one; without words a text has no spans. A very long text is one chain,
    too. Rows that repeat an id or a text are scanned each, equal texts have equal spans. Without a
    document that has a base span nothing is learnt and nothing added. No rows give no rows.
    Further columns are ignored.
    """
    if tagger is None:
        tagger = train(docs, text_of(text_col), most)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            out = []
            for first, last, part, cuts in blocks(data, offsets):
                raw = part.tobytes()
                extra: dict[int, list[tuple[int, int]]] = {}
                if tagger is not None:
                    starts, ends = tagged_spans(part, cuts, tagger)
                    texts = np.searchsorted(cuts, starts, "right") - 1
                    for text, a, b in zip(texts.tolist(), starts.tolist(), ends.tolist()):
                        extra.setdefault(text, []).append((a, b))
                for text in range(last - first):
                    begin, end = int(cuts[text]), int(cuts[text + 1])
                    body = raw[begin:end]
                    found = [(s, k, e) for s, k, e, _ in base_spans(body)]
                    found += [
                        (a - begin, TAGGED, b - begin) for a, b in extra.get(text, ())
                        if not any(s < b - begin and a - begin < e for s, _, e in found)
                    ]
                    if not found:
                        out.append([])
                        continue
                    # bytes to characters: those that continue a character are not counted
                    place = np.concatenate(([0], np.cumsum((np.frombuffer(body, np.uint8) & 0xC0) != 0x80)))
                    out.append([
                        {"kind": KINDS[k], "start": int(place[s]), "end": int(place[e])} for s, k, e in sorted(found)
                    ])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(kind))], ["doc_id", "spans"])

    id_type = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        scan, f"doc_id {id_type}, spans array<struct<kind:string,start:long,end:long>>"
    )


def listed(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op12_secrets")
def op12(spark, sf_dir):
    base = F.filter("spans", lambda s: s["kind"] != KINDS[TAGGED])

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return secrets(documents(spark, sf_dir)).select(
        "doc_id", *(number(k).alias(f"n_{k}") for k in KINDS[:TAGGED]),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )
