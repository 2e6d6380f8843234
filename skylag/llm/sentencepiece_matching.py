"""SentencePiece encoding by suffix-array matching, and decoding.

All texts of a batch are cut into units that no piece crosses. The distinct new units are joined
to one string with a suffix array; every piece of the vocabulary is looked up in it by binary
search, which gives all its occurrences at once. Each occurrence is an edge from its start to its
end. Edges are sorted by position and relaxed from left to right: a place's last piece is the one
edge that may follow the last piece of the place it starts from. Whether two pieces may stand side
by side is a fact of the merge order, so the result equals the library's own.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag.llm.common import list_column, portions, text_of
from skylag.llm.registry import documents, query

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_NEVER = 1 << 30
_BYTES = 3  # the 256 byte pieces follow the three special ones
# tokens of remembered units, after which a task forgets them and starts anew; characters of new
# units that share a suffix array
REMEMBERED, ARRAY_CHARS = 2_000_000, 400_000
# bytes of text whose units are held at once
PORTION = 6 << 20


def load_pieces(model_file: str = MODEL) -> list[tuple[str, float, bool]]:
    """(piece, score, whether it matches text) of a model file with byte fallback, by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = model.get_piece_size()
    first = model.piece_to_id("<0x00>")
    if first != _BYTES or not all(model.is_byte(first + i) for i in range(256)):
        raise ValueError("a model with byte fallback is needed")
    return [
        (model.id_to_piece(i), model.get_score(i),
         not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)))
        for i in range(n)
    ]


def merge(symbols: list[str], rank: dict[str, int]) -> tuple[list[str], list[tuple[str, str]]]:
    """Merges neighbours in the order of their rank, leftmost first: what is left, and the merges."""
    after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
    symbols, done = list(symbols), []
    heap: list[tuple[int, int, str, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < len(symbols):
            order = rank.get(symbols[i] + symbols[after[i]])
            if order is not None:
                heapq.heappush(heap, (order, i, symbols[i], symbols[after[i]]))

    for i in range(len(symbols) - 1):
        offer(i)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= len(symbols) or symbols[j] != right:
            continue
        done.append((left, right))
        symbols[i], symbols[j] = left + right, ""
        after[i] = after[j]
        if after[i] < len(symbols):
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [s for s in symbols if s], done


@dataclass
class Vocabulary:
    """A model's pieces as arrays, made once in each Python worker."""

    pieces: list[tuple[str, float, bool]]

    def __post_init__(self) -> None:
        n = len(self.pieces)
        self.ids = {p: i for i, (p, _, text) in enumerate(self.pieces) if text}
        # equal scores have equal rank, so the leftmost of them goes first
        scores = sorted({s for _, s, _ in self.pieces}, reverse=True)
        order = {s: i for i, s in enumerate(scores)}
        self.order = {p: order[self.pieces[i][1]] for p, i in self.ids.items()}
        rank = np.full(n, -1, np.int64)
        left_of, right_of = np.full(n, -1), np.full(n, -1)
        usable = []
        for piece, i in self.ids.items():
            if len(piece) > 1:
                rest, merges = merge(list(piece), self.order)
                if rest != [piece]:
                    continue  # merging never makes this piece
                left_of[i], right_of[i] = (self.ids[x] for x in merges[-1])
                rank[i] = self.order[piece]
            usable.append((piece, i))
        usable.sort()
        self.piece_ids = np.array([i for _, i in usable])
        self.width = max(len(p) for p, _ in usable)
        self.chars = np.zeros((len(usable), self.width), np.int32)
        for row, (piece, _) in enumerate(usable):
            self.chars[row, : len(piece)] = [ord(c) for c in piece]
        self.lengths = np.array([len(p) for p, _ in usable])
        self.length_of = np.ones(n + 1, np.int64)
        self.length_of[self.piece_ids] = self.lengths
        self.unknown = n  # stands for a character outside the vocabulary
        self.right_spine, self.right_depth = self._spines(right_of)
        self.left_spine, self.left_depth = self._spines(left_of)
        self.rank = np.append(rank, -1)
        pairs = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a * (n + 1) + b] = self.order[piece]
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.may_merge = np.zeros(1 << 22, bool)
        self.may_merge[self._slot(self.pair_keys)] = True
        one = [ord(p) for p in self.ids if len(p) == 1]
        self.known_chars = np.zeros(0x110000, bool)
        self.known_chars[one] = True
        in_pieces = {c for p in self.ids for c in p}
        if not in_pieces <= set(map(chr, one)):
            raise ValueError("every character of a piece must be a piece")
        # a line end or tab that no piece has is a unit by itself
        self.breaks = "".join(c for c in "\n\r\t" if c not in in_pieces)
        b = re.escape(self.breaks)
        self.units = re.compile(f"[{b}]|{SPACE}+[^{SPACE}{b}]*|[^{SPACE}{b}]+") if b else (
            re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        )
        self.surface = [
            bytes([i - _BYTES]) if _BYTES <= i < _BYTES + 256
            else (p.encode() if text else b"") for i, (p, _, text) in enumerate(self.pieces)
        ]

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)

    def _spines(self, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From a piece down its last (or first) parts to a character; and how many steps that is."""
        rows = [np.arange(len(child) + 1)]
        child = np.append(child, -1)
        while (child[rows[-1]] >= 0).any():
            rows.append(np.where(child[rows[-1]] >= 0, child[rows[-1]], rows[-1]))
        spine = np.stack(rows, axis=1)
        depth = (np.diff(spine, axis=1) != 0).sum(axis=1) if spine.shape[1] > 1 else np.zeros(len(spine), int)
        return spine, depth

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * (len(self.pieces) + 1) + b
        out = np.full(len(keys), _NEVER, np.int64)
        maybe = np.flatnonzero(self.may_merge[self._slot(keys)])
        if len(maybe) and len(self.pair_keys):
            at = np.minimum(np.searchsorted(self.pair_keys, keys[maybe]), len(self.pair_keys) - 1)
            hit = self.pair_keys[at] == keys[maybe]
            out[maybe[hit]] = self.pair_ranks[at[hit]]
        return out

    def may_follow(self, u: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Whether merging leaves `u` and `t` side by side.

        The two parts that touch at their border grow as merges happen in order; if the two ever
        form a piece before either grows further, the border does not stay.
        """
        ok = np.ones(len(u), bool)
        i, j = self.right_depth[u], self.left_depth[t]
        live = np.arange(len(u))
        while len(live):
            x, y = self.right_spine[u[live], i[live]], self.left_spine[t[live], j[live]]
            up_x = np.where(i[live] > 0, self.rank[self.right_spine[u[live], i[live] - 1]], _NEVER)
            up_y = np.where(j[live] > 0, self.rank[self.left_spine[t[live], j[live] - 1]], _NEVER)
            joined = self._merge_rank(x, y)
            # of equal ranks the leftmost merge comes first
            broken = (joined < up_x) & (joined <= up_y) & (joined < _NEVER)
            ok[live[broken]] = False
            left = up_x <= up_y
            more = ~broken & ((up_x < _NEVER) | (up_y < _NEVER))
            i[live] -= left & more
            j[live] -= ~left & more
            live = live[more]
        return ok

    def suffix_array(self, codes: np.ndarray) -> np.ndarray:
        """Starts of all suffixes, sorted by as many characters as the longest piece has."""
        rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
        step = 1
        while step < self.width:
            later = np.zeros(len(rank), np.int64)
            later[:-step] = rank[step:] + 1
            rank = np.unique(rank * (len(rank) + 2) + later, return_inverse=True)[1].astype(np.int64)
            step *= 2
        return np.argsort(rank, kind="stable")

    def occurrences(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece id) of every occurrence of every piece."""
        suffixes = self.suffix_array(codes)
        padded = np.concatenate((codes, np.full(self.width, -1, codes.dtype)))
        low = np.zeros(len(self.chars), np.int64)
        high = np.full(len(self.chars), len(codes), np.int64)
        for depth in range(self.width):
            live = np.flatnonzero((self.lengths > depth) & (low < high))
            if not len(live):
                break
            wanted = self.chars[live, depth]

            def border(upper: bool) -> np.ndarray:
                a, b = low[live].copy(), high[live].copy()
                while (a < b).any():
                    mid = (a + b) // 2
                    char = padded[suffixes[np.minimum(mid, len(codes) - 1)] + depth]
                    right = (char <= wanted if upper else char < wanted) & (a < b)
                    a, b = np.where(right, mid + 1, a), np.where(right, b, np.minimum(mid, b))
                return a

            low[live], high[live] = border(False), border(True)
        counts = np.maximum(high - low, 0)
        ends = np.cumsum(counts)
        at = np.arange(int(counts.sum())) + np.repeat(low - (ends - counts), counts)
        return suffixes[at], np.repeat(self.piece_ids, counts)

    def encode_units(self, units: list[str], plain: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, one after another, and where each unit's end.

        The first `plain` units begin with one mark of a blank at most.
        """
        ids, sizes = [], []
        chars = np.cumsum([len(u) for u in units[:plain]])
        first = 0
        while first < plain:
            done = chars[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(chars, done + ARRAY_CHARS, "right")))
            some, counts = self._relaxed(units[first:last])
            ids.append(some)
            sizes.append(counts)
            first = last
        # pieces of blanks alone all have one score, so their order depends on the place
        for unit in units[plain:]:
            some = [
                t for s in merge(list(unit), self.order)[0]
                for t in ([self.ids[s]] if s in self.ids else [b + _BYTES for b in s.encode()])
            ]
            ids.append(np.array(some, np.int32))
            sizes.append(np.array([len(some)]))
        if not ids:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate(ids).astype(np.int32), np.cumsum(np.concatenate(sizes))

    def _relaxed(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units, and how many each has."""
        codes = np.frombuffer(("\0".join(units) + "\0").encode("utf-32-le", "surrogatepass"), np.int32)
        lengths = np.array([len(u) for u in units])
        first = np.cumsum(lengths + 1) - lengths - 1
        n = len(codes)
        offset = np.arange(n) - np.repeat(first, lengths + 1)  # place inside the unit
        start, piece = self.occurrences(codes)
        # what no piece covers is an edge of its own; separators are none
        separator = np.zeros(n, bool)
        separator[first + lengths] = True
        strange = np.flatnonzero(~self.known_chars[np.minimum(codes, 0x10FFFF)] & ~separator)
        keep = ~separator[start]
        start = np.concatenate((start[keep], strange))
        piece = np.concatenate((piece[keep], np.full(len(strange), self.unknown)))
        length = self.length_of[piece]
        end = start + length
        # edges by the place of their end, in layers of equal distance from their unit's start
        layer = offset[start] + length
        order = np.argsort((layer * (n + 1) + end) * (self.width + 1) + (self.width - length))
        start, piece, end, layer = start[order], piece[order], end[order], layer[order]
        group = np.flatnonzero(np.diff(end, prepend=-1))
        group_end = np.append(group[1:], len(end))
        last = np.full(n + 1, -1, np.int64)
        cuts = np.searchsorted(layer[group], np.arange(1, int(lengths.max(initial=0)) + 2))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            edge, stop = group[a:b].copy(), group_end[a:b]
            while len(edge):
                s, t = start[edge], piece[edge]
                before = last[s]
                free = (offset[s] == 0) | (t == self.unknown) | (before == self.unknown)
                ok = free.copy()
                ask = np.flatnonzero(~free & (before >= 0))
                if len(ask):
                    ok[ask] = self.may_follow(before[ask], t[ask])
                last[end[edge[ok]]] = t[ok]
                edge, stop = edge[~ok] + 1, stop[~ok]
                edge, stop = edge[edge < stop], stop[edge < stop]
        # from each unit's end back to its start
        place, unit = first + lengths, np.arange(len(units))
        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(unit):
            going = place > first[unit]
            place, unit = place[going], unit[going]
            token = last[place]
            if (token < 0).any():
                raise ValueError("a place cannot be reached; the model is not one of merges")
            steps.append((unit, token, place))
            place = place - self.length_of[token]
        if not steps:
            return np.zeros(0, np.int32), np.zeros(len(units), np.int64)
        unit, token, place = (np.concatenate(c) for c in zip(*steps))
        order = np.argsort(place, kind="stable")
        unit, token, place = unit[order], token[order], place[order]
        strange = np.flatnonzero(token == self.unknown)
        if not len(strange):
            return token, np.bincount(unit, minlength=len(units))
        sizes = np.ones(len(token), np.int64)
        spelled: list[list[int]] = [[t] for t in token.tolist()]
        for i in strange.tolist():
            spelled[i] = [b + _BYTES for b in chr(codes[place[i] - 1]).encode("utf-8", "surrogatepass")]
            sizes[i] = len(spelled[i])
        return np.array([t for s in spelled for t in s]), np.bincount(unit, sizes, len(units)).astype(np.int64)

    def split(self, text: str) -> list[str]:
        return self.units.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def decode(self, ids: list[int]) -> str:
        surface = self.surface
        text = b"".join([surface[i] for i in ids]).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


class Encoder:
    """Encodes batches of texts; ids of units seen before are remembered."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.ends = np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's end."""
        if len(self.flat) > REMEMBERED:
            self.forget()
        split = [self.vocabulary.split(t) for t in texts]
        new = set().union(*split) - self.place.keys() if split else ()
        if new:
            blank = [u for u in new if u.startswith(SPACE * 2)]
            new = [*(new.difference(blank) if blank else new), *blank]
            ids, ends = self.vocabulary.encode_units(new, len(new) - len(blank))
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.ends = np.concatenate((self.ends, ends + len(self.flat)))
            self.flat = np.concatenate((self.flat, ids))
        counts = np.array([len(s) for s in split], np.int64)
        found = map(self.place.__getitem__, chain.from_iterable(split))
        unit = np.fromiter(found, np.int64, int(counts.sum()))
        starts = np.concatenate(([0], self.ends[:-1])) if len(self.ends) else self.ends
        sizes = self.ends[unit] - starts[unit]
        ends = np.cumsum(sizes)
        at = np.arange(int(sizes.sum())) + np.repeat(starts[unit] - (ends - sizes), sizes)
        unit_ends = np.cumsum(counts)
        return self.flat[at], np.concatenate(([0], ends))[unit_ends]


_WORKER: dict[int, Vocabulary] = {}


def _vocabulary(pieces) -> Vocabulary:
    key = hash(tuple(p for p, _, _ in pieces))
    if key not in _WORKER:
        _WORKER[key] = Vocabulary(pieces)
    return _WORKER[key]


def encode(docs: DataFrame, text_col: str = "text", model_file: str = MODEL,
           output: str = "token_ids", check: str | None = None) -> DataFrame:
    """The documents with all their columns and the ids of each whole text.

    Ids are those that the library gives for the model, without begin and end. A null or empty
    text has no ids. A column named as `output` is replaced. With `check`, a column of that name
    tells whether decoding the ids gives the text again; only a text that has the mark of a blank,
    U+2581, itself does not come back, for the model cannot tell it from a blank. The vocabulary,
    a fixed table, goes to every task; each row is independent of all others.
    """
    pieces = load_pieces(model_file)
    extra = [output] + ([check] if check else [])
    kept = [f for f in docs.schema.fields if f.name not in extra]
    schema = T.StructType(list(kept)).add(output, T.ArrayType(T.IntegerType()))
    schema = schema.add(check, "boolean") if check else schema
    names = [f.name for f in kept]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_vocabulary(pieces))
        for batch in (part for whole in batches for part in portions(whole, text_col, PORTION)):
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            ids, ends = encoder.encode(texts)
            columns = [*(batch.column(n) for n in names), list_column(ids, ends, pa.int32())]
            if check:
                all_ids, starts = ids.tolist(), [0, *ends.tolist()]
                columns.append(pa.array([
                    encoder.vocabulary.decode(all_ids[a:b]) == t
                    for a, b, t in zip(starts, starts[1:], texts)
                ], pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, [*names, *extra])

    return docs.mapInArrow(scan, schema)


def decode(tokens: DataFrame, ids_col: str = "token_ids", model_file: str = MODEL,
           output: str = "text") -> DataFrame:
    """The rows with all their columns and the text of their ids; null ids give null.

    Bytes that are not UTF-8 become the replacement character; special ids have no text.
    """
    pieces = load_pieces(model_file)
    kept = [f for f in tokens.schema.fields if f.name != output]
    names = [f.name for f in kept]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(pieces)
        for batch in batches:
            texts = [None if x is None else vocabulary.decode(x) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(texts, pa.string())], [*names, output]
            )

    return tokens.mapInArrow(scan, T.StructType(list(kept)).add(output, "string"))


@query("op1_sentencepiece")
def op1(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", text_of().alias("text"))
    return encode(docs, check="round_trip").select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "round_trip"
    )
