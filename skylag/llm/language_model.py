"""Log-bilinear language model: counted with Spark, trained in numpy by noise-contrastive estimation."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import blocks, portions, text_of
from skylag.llm.registry import documents, query
from skylag.session import written

# outcomes of the model's tree: the end of a text, the buckets of words that are not in the tree, of
# which a small vocabulary needs one, for rare words, then the most frequent words by their counts;
# a model has SIZE outcomes at least, and its size itself stands for what precedes a text
END, OTHER, SIZE = 0, 1, 128
# words of fewer training occurrences are rare, and so are words of under one in SELDOM tokens
RARE, SELDOM = 3, 1 << 25
WIDTH, NOISE, BATCH, STEPS = 24, 64, 2048, 1000
# all training tokens are drawn once, and in a small corpus again up to LEAST_DRAWS; a shard has
# SHARD_TOKENS for each outcome, so that its copy of the model is small beside it
LEAST_DRAWS, MOST_ROUNDS, SHARDS, SHARD_TOKENS = 2_000_000, 16, 4, 200
# outcomes scored at a time, whose guesses stay in the processor's cache
SCORED = 1 << 15
# outcomes whose parameters are merged as one row
CHUNK = 1 << 10
# the most frequent words, whose counts every task has; all others meet their counts in a join
HEAD_WORDS = 1 << 16
# the most words in the tree, and the most buckets, of about BUCKET_WORDS words that are not rare or more
TREE_WORDS, BUCKETS, BUCKET_WORDS = 1 << 16, 1 << 14, 64
# words outside the head, in texts and in the vocabulary, that are worked on as one group
SHELF = 1 << 17


def tokens_of(text: str) -> list[bytes]:
    """Words with A-Z lower-cased; only ASCII blanks part them."""
    return text.encode("utf-8").lower().split()


def _texts(batch: pa.RecordBatch) -> list[list[bytes]]:
    return [tokens_of(text or "") for text in batch.column("text").to_pylist()]


def count_words(texts: DataFrame) -> DataFrame:
    """word, n over all texts; each batch adds its words up before they are exchanged."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for part in portions(batch):
                for words in _texts(part):
                    counts.update(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()).cast(pa.string()),
                 pa.array(list(counts.values()), pa.int64())], ["word", "n"],
            )

    return (
        texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    )


def outcomes(codes: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Outcomes of all texts, ends included, and the two outcomes before each.

    `codes` are the outcomes of all words, `lengths` the words of each text.
    """
    ends = np.cumsum(lengths + 1) - 1
    out = np.full(len(codes) + len(lengths), END)
    at = np.ones(len(out), bool)
    at[ends] = False
    out[at] = codes
    starts = ends - lengths
    one, two = np.concatenate(([size], out[:-1])), np.concatenate(([size, size], out[:-2]))[: len(out)]
    one[starts] = size
    two[starts] = size
    second = starts + 1
    two[second[lengths > 0]] = size
    return out, one, two


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows by about half a million words, with the outcomes of their words and the words of each text."""
    for batch in batches:
        column = batch.column("codes").cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        for first, end, codes, at in blocks(data, offsets, 2 << 20) if len(column) else ():
            yield batch.slice(first, end - first), np.frombuffer(codes.tobytes(), np.int32).astype(np.int64), np.diff(at) // 4


def _head_ids(texts: list[list[bytes]], head: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(words) for words in texts], np.int64)
    get = head.get
    ids = np.fromiter((get(w, -1) for words in texts for w in words), np.int64, int(lengths.sum()))
    return ids, lengths


def _chance(x: np.ndarray) -> np.ndarray:
    """The logistic function of -x, in place."""
    with np.errstate(over="ignore"):  # beyond all numbers is a chance of zero
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _sums_by_row(at: np.ndarray, g: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of `n` that `at` names, in order, and for each the sum of its lines of `g`, of an even width."""
    # places of two bytes are sorted by digits
    order = np.argsort(at.astype(np.uint16) if n <= 1 << 16 else at, kind="stable")
    at = at.take(order)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    many = np.diff(first, append=len(at))
    sums, again = g.take(order.take(first), axis=0), many > 1
    if again.any():
        # two columns at a time, as one complex number
        lines = g.view(np.complex64).take(order[np.repeat(again, many)], axis=0)
        many = many[again]
        sums[again] = np.add.reduceat(lines, np.cumsum(many) - many).view(np.float32)
    return at.take(first), sums


def _with_bias(q: np.ndarray, bias: np.ndarray) -> np.ndarray:
    return np.hstack((q.astype(float), bias.astype(float)[:, None]))


def among_siblings(guess: np.ndarray, node: np.ndarray, above: np.ndarray, layer: np.ndarray, children) -> np.ndarray:
    """Natural logs of the nodes' probabilities among their siblings, for rows in the order of `above`.

    The last columns of `guess` and `layer` are one and the bias; `children` gives the first child
    of a node above and the end of its children.
    """
    total = np.empty(len(node))
    cuts = np.append(np.flatnonzero(np.diff(above, prepend=-1)), len(above)).tolist()
    for a, b in zip(cuts, cuts[1:]):
        first, end = children(int(above[a]))
        siblings = layer[first:end].T
        for c in range(a, b, 2048):
            d = min(b, c + 2048)
            s = guess[c:d] @ siblings
            mine = s[np.arange(d - c), node[c:d] - first]
            top = s.max()
            if top > 300 or s.min() < -300:  # no sum of the others could be told from zero or infinity
                top = s.max(axis=1)
                s -= top[:, None]
            else:
                top = 0.0
            np.exp(s, out=s)
            total[c:d] = mine - top - np.log(s.sum(axis=1))
    return total


class LogBilinear:
    """score(w | a, b) = q[w] . (C1 r[b] + C2 r[a]) + bias[w]; a, b are the outcomes before w.

    Outcomes are leaves of a tree of three layers, each of whose nodes has up to `fan` children; the
    nodes have q and bias of their own. The probability of an outcome is the product of those of
    its nodes among their siblings, so it is normalised in three sums over `fan` nodes.
    """

    def __init__(self, unigram: np.ndarray, seed: int = 5, p: dict[str, np.ndarray] | None = None, layers: int = 3):
        size, rng = len(unigram), np.random.default_rng(seed)
        self.size, self.fan = size, int(np.ceil(size ** (1 / 3) - 1e-9))
        self.noise, counts = [], unigram + 1.0
        for _ in range(layers):
            self.noise.append(counts / counts.sum())
            counts = np.add.reduceat(counts, np.arange(0, len(counts), self.fan))
        if p is None:
            p = {"r": 0.1 * rng.standard_normal((size + 1, WIDTH), np.float32), "c1": np.eye(WIDTH), "c2": np.eye(WIDTH) * 0.5}
            for i, noise in enumerate(self.noise):
                p |= {f"q{i}": 0.1 * rng.standard_normal((len(noise), WIDTH), np.float32), f"bias{i}": np.log(noise)}
        self.p = {k: v.astype(np.float32) for k, v in p.items()}
        # what each row of parameters, or each weight of the contexts, has been moved by
        self.square = {k: np.ones(v.shape if k in ("c1", "c2") else len(v), np.float32) for k, v in self.p.items()}
        self.sums = [np.cumsum(noise) for noise in self.noise]
        self.log_noise = [np.log(NOISE * noise).astype(np.float32) for noise in self.noise]
        self.rng = rng

    def _move(self, q: str, bias: str | None, at: np.ndarray, g: np.ndarray, rate: float) -> None:
        """Move rows of parameters by the sums of their gradients, less the more they have moved.

        If there is a bias, its column of `g` follows, and one of zeros.
        """
        rows, g = _sums_by_row(at, g, len(self.p[q]))
        for key, g in ((q, g[:, :WIDTH]), (bias, g[:, WIDTH])) if bias else ((q, g),):
            square = self.square[key].take(rows)
            square += np.einsum("ij,ij->i", g, g) / WIDTH if g.ndim > 1 else g * g
            self.square[key][rows] = square
            step = rate / np.sqrt(square)
            self.p[key][rows] -= step[:, None] * g if g.ndim > 1 else step * g

    def contrast(self, out: np.ndarray, guess: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """What noise-contrastive estimation adds to the guesses, and the moves of each layer's nodes.

        The outcomes of a batch are told from NOISE nodes, drawn once for all of them.
        """
        p, n = self.p, len(out)
        guess = np.hstack((guess, np.ones((n, 1), np.float32), np.zeros((n, 1), np.float32)))
        to_guess, moves, node = np.zeros((n, WIDTH), np.float32), [], out
        for i, (sums, log_noise) in enumerate(zip(self.sums, self.log_noise)):
            q, bias = p[f"q{i}"], p[f"bias{i}"]
            drawn = np.searchsorted(sums, self.rng.random(NOISE)).clip(0, len(sums) - 1)
            mine, others = q.take(node, axis=0), np.zeros((NOISE, WIDTH + 2), np.float32)
            others[:, :WIDTH], others[:, WIDTH] = q[drawn], bias[drawn] - log_noise[drawn]
            hit = _chance(log_noise.take(node) - bias.take(node) - np.einsum("ij,ij->i", mine, guess[:, :WIDTH]))
            hit -= 1
            miss = _chance(guess @ -others.T)
            mine *= hit[:, None]
            to_guess += mine
            to_guess += miss @ others[:, :WIDTH]
            g = np.empty((n + NOISE, WIDTH + 2), np.float32)
            np.multiply(guess, hit[:, None], out=g[:n])
            np.matmul(miss.T, guess, out=g[n:])
            moves.append((f"q{i}", f"bias{i}", np.concatenate((node, drawn)), g))
            node = node // self.fan
        return to_guess, moves

    def step(self, out: np.ndarray, one: np.ndarray, two: np.ndarray, rate: float) -> None:
        """One step of noise-contrastive estimation, on each layer of nodes."""
        p = self.p
        r1, r2 = p["r"].take(one, axis=0), p["r"].take(two, axis=0)
        to_guess, moves = self.contrast(out, r1 @ p["c1"] + r2 @ p["c2"])
        moves.append((
            "r", None, np.concatenate((one, two)), np.concatenate((to_guess @ p["c1"].T, to_guess @ p["c2"].T))
        ))
        for c, r in (("c1", r1), ("c2", r2)):
            g = r.T @ to_guess
            self.square[c] += g * g
            p[c] = p[c] - 0.1 * rate * g / np.sqrt(self.square[c])
        for move in moves:
            self._move(*move, rate)

    def train(self, codes: np.ndarray, n: np.ndarray, steps: int = STEPS) -> LogBilinear:
        """Steps over counted outcomes, each drawn as often as it was counted."""
        sums = np.cumsum(n.astype(float))
        for i in range(steps):
            drawn = codes[np.searchsorted(sums, self.rng.random(BATCH) * sums[-1], "right")]
            out, rest = drawn % self.size, drawn // self.size
            self.step(out, rest % (self.size + 1), rest // (self.size + 1), 0.3 * (1 - i / steps) + 0.01)
        return self

    def fixed(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """In double precision, what either outcome before adds to a guess, and each layer's q with its bias behind."""
        p, one = self.p, np.ones((self.size + 1, 1))
        r = p["r"].astype(float)
        before = [np.hstack((r @ p["c1"].astype(float), one)), np.hstack((r @ p["c2"].astype(float), 0 * one))]
        return before, [_with_bias(p[f"q{i}"], p[f"bias{i}"]) for i in range(3)]

    def log10_of(self, out: np.ndarray, one: np.ndarray, two: np.ndarray, fixed: tuple | None = None) -> np.ndarray:
        """Normalised log10 probabilities of outcomes after two others, in double precision."""
        before, layers = fixed or self.fixed()
        total, by_outcome = np.empty(len(out)), np.argsort(out, kind="stable")
        for a in range(0, len(out), SCORED):
            rows = by_outcome[a : a + SCORED]
            guess = before[0][one[rows]]
            guess += before[1][two[rows]]
            node, some = out[rows], np.zeros(len(rows))
            for i, layer in enumerate(layers):
                above = node // self.fan if i < 2 else np.zeros_like(node)
                width = self.fan if i < 2 else len(layer)
                some += among_siblings(guess, node, above, layer, lambda x: (x * width, (x + 1) * width))
                node = above
            total[rows] = some
        return total / np.log(10)

    def log10_table(self) -> np.ndarray:
        """Normalised log10 probabilities of a small model: a row for each two outcomes before."""
        n = self.size
        code = np.arange((n + 1) ** 2 * n)
        rest = code // n
        return self.log10_of(code % n, rest % (n + 1), rest // (n + 1)).reshape(-1, n).astype(np.float32)


def _trained(coded: DataFrame, unigram: np.ndarray, tokens: int) -> LogBilinear:
    """A model trained on all coded texts, by as many draws as they have tokens at least.

    In each round every shard of the texts trains a copy of the model, and the copies' moves are
    averaged, row by row, by how often each copy has met the row. A large corpus is gone through
    once, one half of its texts in each of two rounds, a small one wholly in each of several. Shards
    follow the texts alone, so the model does not depend on how the table is partitioned.
    """
    spark = coded.sparkSession
    size, model = len(unigram), LogBilinear(unigram)
    rounds = min(MOST_ROUNDS, -(-LEAST_DRAWS // tokens))
    parts = [None] * rounds if rounds > 1 else [0, 1]
    shards = max(SHARDS, tokens // (SHARD_TOKENS * size))
    for turn, part in enumerate(parts):
        known = spark.sparkContext.broadcast((unigram, model.p))
        rates = [0.1 * (1 - x / len(parts)) + 0.01 for x in (turn, turn + 1)]

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            unigram, start = known.value
            mine = LogBilinear(unigram, seed=7 + turn, p=start)
            met = {k: np.zeros(len(v), np.int64) for k, v in mine.p.items()}
            steps = 0
            for _, codes, lengths in _coded(batches):
                out, one, two = outcomes(codes, lengths, size)
                mixed_up = mine.rng.permutation(len(out))
                for a in range(0, len(out), BATCH):
                    at = mixed_up[a : a + BATCH]
                    mine.step(out[at], one[at], two[at], sum(rates) / 2)
                    steps += 1
                node = out
                for i in range(3):
                    n = np.bincount(node, minlength=len(met[f"q{i}"]))
                    met[f"q{i}"] += n
                    met[f"bias{i}"] += n
                    node = node // mine.fan
                met["r"] += np.bincount(one, minlength=size + 1) + np.bincount(two, minlength=size + 1)
                met["c1"] += len(out)
                met["c2"] += len(out)
            for key, value in mine.p.items() if steps else ():
                for a in range(0, len(value), CHUNK):
                    at = np.flatnonzero(met[key][a : a + CHUNK]).astype(np.int32)
                    if len(at):
                        # half precision is enough for moves and halves what is exchanged
                        moved = (value[a + at] - start[key][a + at]).astype(np.float16)
                        n = met[key][a + at].astype(np.int32)
                        row = [key, a, at.tobytes(), n.tobytes(), moved.tobytes()]
                        yield pa.RecordBatch.from_pylist([dict(zip(("key", "first", "at", "met", "moved"), row))], schema=fields)

        def merge(key, table):
            rows = sorted(table.to_pylist(), key=lambda r: (r["at"], r["met"], r["moved"]))
            count, total = np.zeros(CHUNK, np.int64), None
            for r in rows:
                at, n = np.frombuffer(r["at"], np.int32), np.frombuffer(r["met"], np.int32).astype(np.int64)
                moved = np.frombuffer(r["moved"], np.float16).reshape(len(at), -1).astype(float)
                total = np.zeros((CHUNK, moved.shape[1])) if total is None else total
                total[at] += moved * n[:, None]
                count[at] += n
            at = np.flatnonzero(count).astype(np.int32)
            mean = (total[at] / count[at][:, None]).astype(np.float32)
            row = {"key": rows[0]["key"], "first": rows[0]["first"], "at": at.tobytes(), "met": b"", "moved": mean.tobytes()}
            return pa.Table.from_pylist([row], schema=fields)

        fields = pa.schema([
            ("key", pa.string()), ("first", pa.int64()), ("at", pa.binary()), ("met", pa.binary()), ("moved", pa.binary())
        ])
        schema = "key string, first long, at binary, met binary, moved binary"
        chosen = coded if part is None else coded.filter(F.pmod("place", F.lit(2)) == part)
        copies = (
            chosen.repartition(shards, "place").sortWithinPartitions("place", "codes").select("codes")
            .mapInArrow(learn, schema)
        )
        # one row for each chunk of the model
        merged = written(copies.groupBy("key", "first").applyInArrow(merge, schema), "lm-model")
        p = model.p  # in place: tasks have read what was sent to them
        for r in merged.toLocalIterator():
            at = np.frombuffer(r.at, np.int32) + r["first"]
            p[r.key][at] += np.frombuffer(r.moved, np.float32).reshape(p[r.key][at].shape)
        known.destroy()  # the moves are written, so no task asks for this copy again
    return model


def _leaves(unigram: np.ndarray, out: np.ndarray, guess: np.ndarray, tokens: np.ndarray) -> LogBilinear:
    """One layer of outcomes below guesses that stay as they are, trained by one pass over `tokens`, places in `out`."""
    noise = (unigram + 1) / (unigram + 1).sum()
    leaves = LogBilinear(unigram, 7, {"q0": np.zeros((len(unigram), WIDTH)), "bias0": np.log(noise)}, layers=1)
    mixed_up = leaves.rng.permutation(tokens)
    for a in range(0, len(mixed_up), BATCH):
        at = mixed_up[a : a + BATCH]
        for move in leaves.contrast(out[at], guess[at])[1]:
            leaves._move(*move, 0.1 * (1 - a / len(mixed_up)) + 0.01)
    return leaves


def _in_buckets(
    p: dict[str, np.ndarray], words: dict[str, np.ndarray], tokens: dict[str, np.ndarray], shelves: int, buckets: int, least: int
) -> np.ndarray:
    """log10 probabilities of tokens in their buckets, of which this shelf has every `shelves`-th one.

    `words` has bucket and n of the shelf's vocabulary, by bucket, then falling n; `tokens` word
    (its place there, -1 if unknown), bucket, one, two, held. In a bucket one outcome is for all
    rare words, each of which has its add-one share of it, as has one unknown word.
    """
    places = buckets // shelves
    place, n = words["bucket"] // shelves, words["n"]
    own = np.flatnonzero(n >= least)
    starts = np.concatenate(([0], np.cumsum(1 + np.bincount(place[own], minlength=places))))
    outcome = starts[place]
    outcome[own] = np.arange(len(own)) + place[own] + 1
    unigram = np.bincount(outcome, n, minlength=starts[-1])
    rare = np.bincount(place[n < least], minlength=places)
    share = np.log10(unigram[starts[:-1]] + rare + 1)

    at, word = tokens["bucket"] // shelves, tokens["word"]
    out = starts[at]
    out[word >= 0] = outcome[word[word >= 0]]
    # in an order that does not depend on where the texts were
    order = np.lexsort((tokens["held"], tokens["two"], tokens["one"], word, out))
    out, at = out[order], at[order]
    guess = p["r"].take(tokens["one"][order], axis=0) @ p["c1"] + p["r"].take(tokens["two"][order], axis=0) @ p["c2"]
    leaves = _leaves(unigram, out, guess, np.flatnonzero(tokens["held"][order] == 0))
    layer, log = _with_bias(leaves.p["q0"], leaves.p["bias0"]), np.empty(len(out))
    for a in range(0, len(out), SCORED):
        some = slice(a, a + SCORED)
        double = np.hstack((guess[some].astype(float), np.ones((len(out[some]), 1))))
        log[some] = among_siblings(double, out[some], at[some], layer, lambda x: (int(starts[x]), int(starts[x + 1])))
    log /= np.log(10)
    others = np.flatnonzero(out == starts[at])
    word = word[order[others]]
    counts = np.zeros(len(word))
    counts[word >= 0] = n[word[word >= 0]]
    log[others] += np.log10(counts + 1) - share[at[others]]
    result = np.empty(len(out))
    result[order] = log
    return result


def language_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The vocabulary is counted over all training texts and stays a table. All its words but rare
    ones are outcomes of the model, which is trained on all training texts, shard by shard. The
    TREE_WORDS most frequent ones are in the tree that every task has; all others are dealt by
    their hash to buckets, which are outcomes and contexts of the tree, and words in their bucket
    are told apart by a layer of their own, trained and scored where the bucket's tokens and
    vocabulary meet. So neither the driver nor a task holds more for a larger vocabulary. A rare
    word has the probability of its bucket's outcome for rare words times its add-one share of
    them, so probabilities of all known words and one unknown in each bucket add up to one; a
    vocabulary that fits in the tree has one bucket, of rare words. Counts of the HEAD_WORDS most
    frequent words are in every task; other words meet theirs with their bucket.

    A null text is empty and has one token, its end. A null id is not held out. Rows that repeat
    an id are scored each, and counted each. Without training texts every word is unknown and the
    model is untrained. Further columns are ignored.
    """
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))
    texts = docs.select(
        F.col(id_col).alias("doc_id"), held.alias("held_out"), text_of(text_col).alias("text")
    ).withColumn("place", F.xxhash64("doc_id", "text"))
    training = texts.filter(~F.col("held_out")).select("text")
    vocabulary = written(count_words(training), "lm-words")
    ends = training.count()
    row = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = row.n + ends, row.v + (ends > 0)
    least = max(RARE, -(-total // SELDOM))
    n_words = vocabulary.filter(F.col("n") >= least).count()
    n_tree, buckets = min(n_words, TREE_WORDS), 1
    while buckets < min(BUCKETS, (n_words - n_tree) / BUCKET_WORDS) or buckets == 1 and n_words > n_tree:
        buckets *= 2
    # where words are in buckets, all words outside the tree are
    n_head = n_tree if buckets > 1 else max(HEAD_WORDS, n_tree)
    top = vocabulary.orderBy(F.desc("n"), "word").limit(n_head).toArrow()
    # one text of all words: they hold no blanks, and only tasks need them one by one
    words = " ".join(top.column("word").to_pylist()).encode()
    counts = top.column("n").to_numpy()
    outside = vocabulary.withColumn("bucket", F.crc32(F.col("word").cast("binary")))
    if len(counts):
        last = top.slice(len(counts) - 1).to_pylist()[0]
        outside = outside.filter(
            (F.col("n") < last["n"]) | (F.col("n") == last["n"]) & (F.col("word") > last["word"])
        )
    del top
    first_word = OTHER + buckets
    size = max(SIZE, n_tree + first_word)
    other_n, other_v = row.n - int(counts[:n_tree].sum()), row.v - n_tree
    unigram = np.zeros(size)
    unigram[[END, OTHER]] = ends, other_n
    if buckets > 1:
        unigram[OTHER] = 0
        for r in outside.groupBy((F.col("bucket") % buckets).alias("b")).agg(F.sum("n").alias("n")).collect():
            unigram[OTHER + r.b] = r.n
    unigram[first_word : first_word + n_tree] = counts[:n_tree]
    held_words = docs.sparkSession.sparkContext.broadcast(words)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = {w: i for i, w in enumerate(held_words.value.split())}
        log_count = np.append(np.log10(counts + 1.0), 0.0)  # the last for words outside the head
        for batch in (part for whole in batches for part in portions(whole)):
            split = _texts(batch)
            ids, lengths = _head_ids(split, head)
            unknown, other = np.flatnonzero(ids < 0), (ids < 0) | (ids >= n_tree)
            text_of_word = np.repeat(np.arange(len(lengths)), lengths)
            every = [w for words in split for w in words]
            rest = [every[i] for i in unknown.tolist()]
            codes = np.where(other, OTHER, ids + first_word).astype(np.int32)
            if buckets > 1:  # the buckets' outcomes take the place of shares of one
                codes[unknown] += np.fromiter(map(crc32, rest), np.int64, len(rest)) % buckets
                other[:] = False

            def per_text(values, at=slice(None)):
                return np.bincount(text_of_word[at], values[at], len(lengths)).astype(float)

            n_rest = per_text(ids < 0).astype(np.int64)
            cuts, ends_of_rest = np.concatenate(([0], np.cumsum(lengths))).tolist(), np.cumsum(n_rest).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"), batch.column("place"), pa.array(lengths + 1),
                    pa.array(lengths - n_rest), pa.array(per_text(log_count[ids])),
                    pa.array(per_text(log_count[ids], other)), pa.array(per_text(other).astype(np.int64)),
                    pa.array([codes[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    pa.array([b" ".join(rest[a:b]) for a, b in zip([0, *ends_of_rest], ends_of_rest)], pa.binary()),
                    pa.array(n_rest),
                ],
                ["doc_id", "held_out", "place", "n_tokens", "head_known", "head_log", "other_log", "other",
                 "codes", "rest", "n_rest"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    kept = f"doc_id {id_type}, held_out boolean, %sn_tokens long, head_known long, head_log double, other_log double, other long"
    coded = written(
        texts.mapInArrow(code, kept % "place long, " + ", codes binary, rest binary, n_rest long")
        .withColumn("_row", F.monotonically_increasing_id()),
        "lm-codes",
    )
    if total:
        model = _trained(coded.filter(~F.col("held_out")).select("place", "codes"), unigram, total)
    else:
        model = LogBilinear(unigram)
    known = docs.sparkSession.sparkContext.broadcast((unigram, model.p))
    del model  # tasks have it; scanning and joining need none of it here

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LogBilinear(known.value[0], p=known.value[1])
        fixed = model.fixed()
        for part, codes, lengths in _coded(batches):
            out, one, two = outcomes(codes, lengths, size)
            log = model.log10_of(out, one, two, fixed)
            sums = np.add.reduceat(log, np.cumsum(lengths + 1) - lengths - 1)
            yield part.drop_columns(["codes"]).append_column("model_sum", pa.array(sums))

    scanned = written(
        coded.drop("place", "rest", "n_rest").mapInArrow(scan, kept % "" + ", _row long, model_sum double"), "lm-texts"
    )
    n_rest = coded.agg(F.coalesce(F.sum("n_rest"), F.lit(0))).first()[0]
    shelves = 1
    while shelves * SHELF < n_rest + row.v and shelves < BUCKETS and (buckets == 1 or shelves < buckets):
        shelves *= 2
    rest_fields = pa.schema([
        ("shelf", pa.int32()), ("words", pa.binary()), ("bucket", pa.binary()), ("row", pa.binary()),
        ("held", pa.binary()), ("one", pa.binary()), ("two", pa.binary()),
    ])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, codes, lengths in _coded(batches):
            n = part.column("n_rest").to_numpy()
            every = b" ".join(x for x in part.column("rest").to_pylist() if x).split()
            if not every:
                continue
            cells = {
                "row": np.repeat(part.column("_row").to_numpy(), n),
                "held": np.repeat(part.column("held_out").to_numpy(zero_copy_only=False).astype(np.int8), n),
            }
            if buckets > 1:
                out, one, two = outcomes(codes, lengths, size)
                at = np.flatnonzero((out >= OTHER) & (out < first_word))
                number = out[at] - OTHER
                cells |= {"one": one[at].astype(np.int32), "two": two[at].astype(np.int32)}
            else:
                number = np.fromiter(map(crc32, every), np.int64, len(every)) % shelves
                cells |= {"one": np.zeros(0, np.int32), "two": np.zeros(0, np.int32)}
            cells["bucket"] = number.astype(np.int32)
            shelf = (number % shelves).astype(np.uint16)
            order = np.argsort(shelf, kind="stable")
            cells = {k: v[order] if len(v) else v for k, v in cells.items()}
            cuts = np.append(np.flatnonzero(np.diff(shelf[order].astype(np.int64), prepend=-1)), len(order)).tolist()
            order = order.tolist()
            rows = [
                {"shelf": int(shelf[order[a]]), "words": b" ".join([every[i] for i in order[a:b]])}
                | {k: v[a:b].tobytes() for k, v in cells.items()}
                for a, b in zip(cuts, cuts[1:])
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=rest_fields)

    def finish(tokens: pa.Table, vocabulary: pa.Table) -> pa.Table:
        def joined(name, kind):
            return np.frombuffer(b"".join(tokens.column(name).to_pylist()), kind).astype(np.int64)

        vocabulary = vocabulary.sort_by([("bucket", "ascending"), ("n", "descending"), ("word", "ascending")])
        place = {w: i for i, w in enumerate(vocabulary.column("word").cast(pa.binary()).to_pylist())}
        every = b" ".join(tokens.column("words").to_pylist()).split()
        word = np.fromiter((place.get(w, -1) for w in every), np.int64, len(every))
        n = vocabulary.column("n").to_numpy()
        log = np.log10(np.append(n, 0)[word] + 1.0)  # the last for unknown words
        row, at = np.unique(joined("row", np.int64), return_inverse=True)
        leaf = log
        if buckets > 1:
            cells = {k: joined(k, np.int32) for k in ("bucket", "one", "two")} | {"held": joined("held", np.int8), "word": word}
            leaf = _in_buckets(
                known.value[1], {"bucket": vocabulary.column("bucket").to_numpy(), "n": n}, cells, shelves, buckets, least
            )
        return pa.Table.from_arrays(
            [pa.array(row), pa.array(np.bincount(at, word >= 0, len(row)).astype(np.int64)),
             pa.array(np.bincount(at, log, len(row))), pa.array(np.bincount(at, leaf, len(row)))],
            ["_row", "rest_known", "rest_log", "leaf"],
        )

    number = F.col("bucket") % (buckets if buckets > 1 else shelves)
    shelved = outside.select((number % shelves).cast("int").alias("shelf"), number.alias("bucket"), "word", "n")
    rest = written(
        coded.filter("n_rest > 0").select("_row", "held_out", "codes", "rest", "n_rest")
        .mapInArrow(deal, "shelf int, words binary, bucket binary, row binary, held binary, one binary, two binary")
        .groupBy("shelf").cogroup(shelved.groupBy("shelf"))
        .applyInArrow(finish, "_row long, rest_known long, rest_log double, leaf double")
        .groupBy("_row").agg(*(F.sum(c).alias(c) for c in ("rest_known", "rest_log", "leaf"))),
        "lm-rest",
    )
    end_log = float(np.log10(ends + 1))
    known_log = F.coalesce("rest_log", F.lit(0.0))
    share = float(np.log10(total + distinct + 1))
    other_share = float(np.log10(other_n + other_v + 1))
    return scanned.join(rest, "_row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("rest_known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_log") + known_log + end_log - F.col("n_tokens") * share).alias("base_score"),
        (F.col("model_sum") + F.col("other_log") + F.coalesce("leaf", F.lit(0.0)) - F.col("other") * other_share)
        .alias("score"),
    )


@query("op10_language_model")
def op10(spark, sf_dir):
    return language_scores(documents(spark, sf_dir))
