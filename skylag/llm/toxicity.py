"""Toxicity: a classifier whose scores must not change when a group's name does."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag.llm.common import free_name, text_of
from skylag.llm.registry import documents, query
from skylag.session import written

# Names of groups, which are swapped inside each line.
IDENTITIES = [
    ["women", "men", "girls", "boys", "mothers", "fathers"],
    ["woman", "man", "girl", "boy", "mother", "father"],
    ["black", "white", "asian", "latino", "arab", "african", "european"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["gay", "straight", "lesbian", "bisexual", "transgender"],
    ["immigrants", "refugees", "foreigners", "citizens", "locals"],
    ["disabled", "blind", "deaf", "old", "young"],
]
_LINE = {term: line for line in IDENTITIES for term in line}

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5, 6)
# labelled rows that the model is fitted on, and the most features it has
MAX_LABELLED, MAX_FEATURES = 20_000, 4096
# toxic rows and likelihood ratio that a feature needs
MIN_ROWS, MIN_RATIO = 4, 20.0
THRESHOLD = 0.7


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings, which carry over to words not seen before."""
    return [word + "$", *(word[:n] for n in PREFIXES if len(word) >= n)]


def features_of_all(words: set[str]) -> set[str]:
    return {f for w in words for f in features_of(w)}


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def swapped(words: set[str]) -> list[set[str]]:
    """The same words under the other names of each group that is named."""
    named = sorted(w for w in words if w in _LINE)
    return [(words - {name}) | {other} for name in named for other in _LINE[name] if other not in words]


def labelled_rows(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    most: int = MAX_LABELLED,
) -> DataFrame:
    """text, toxic of at most `most` labelled training rows, chosen by a hash of the id.

    Held-out ids, and labels that are null, are left out; of several labels of one id the worst
    counts. Ids to look for are at most `most`, so that they fit every task.
    """
    ident = F.col(id_col).cast("string")
    chosen = (
        labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & (F.crc32(ident) % 3 != 1))
        .groupBy(id_col).agg(F.max("toxic").cast("int").alias("_toxic"))
        .orderBy(F.xxhash64(ident), id_col).limit(most).withColumnRenamed(id_col, "_id")
    )
    return docs.join(F.broadcast(chosen), docs[id_col] == chosen["_id"]).select(
        text_of(text_col).alias("text"), F.col("_toxic").alias("toxic")
    )


def select_features(rows: DataFrame, most: int = MAX_FEATURES) -> list[str]:
    """Features whose frequency differs most between the classes, by likelihood ratio."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                for feature in features_of_all(words_of(text)):
                    counts.setdefault(feature, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()),
                 pa.array([c[0] for c in counts.values()], pa.int64()),
                 pa.array([c[1] for c in counts.values()], pa.int64())],
                ["feature", "clean", "toxic"],
            )

    total = rows.agg(
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count("*").alias("n")
    ).first()
    if not 0 < total.t < total.n:
        return []
    counts = (
        rows.mapInArrow(count, "feature string, clean long, toxic long")
        .groupBy("feature").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    )
    share = total.t / total.n
    n = F.col("t") + F.col("c")

    def term(observed, expected):
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    ratio = 2 * (term(F.col("t"), n * share) + term(F.col("c"), n * (1 - share)))
    # words without any bearing on the label are often rare; one class's own are the better ones
    found = (
        counts.filter((F.col("t") >= MIN_ROWS) & (F.col("t") > n * share)).withColumn("r", ratio)
        .filter(F.col("r") >= MIN_RATIO).orderBy(F.desc("r"), "feature").limit(most)
    )
    return [row.feature for row in found.select("feature").collect()]


def indices(words: set[str], index: dict[str, int]) -> list[int]:
    return sorted(index[f] for f in features_of_all(words) if f in index)


def _product(rows: list[list[int]], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.fromiter((i for r in rows for i in r), np.int64, len(row))
    return row, column, np.bincount(row, weights[column], len(rows))


def fit(
    x: list[list[int]], y: np.ndarray, pairs: list[tuple[list[int], list[int]]], n_features: int,
    penalty: float = 5.0, ridge: float = 0.0001, steps: int = 400, rate: float = 0.1,
) -> tuple[np.ndarray, float]:
    """Logistic weights and bias; classes weigh the same.

    `pairs` are sentences before and after a swap of identity terms: the mean square of the
    difference of their logits, times `penalty`, is added to the loss.
    """
    weights, bias = np.zeros(n_features), 0.0
    y = np.asarray(y, float)
    if not len(y) or y.min() == y.max():
        return weights, -2.0
    weigh = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    row, column, _ = _product(x, weights)
    row_a, column_a, _ = _product([a for a, _ in pairs], weights)
    row_b, column_b, _ = _product([b for _, b in pairs], weights)
    mean, square = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        logit = np.bincount(row, weights[column], len(y)) + bias
        error = weigh * (1 / (1 + np.exp(-logit)) - y)
        gradient = np.bincount(column, error[row], n_features) + ridge * weights
        if pairs:
            change = (
                np.bincount(row_a, weights[column_a], len(pairs))
                - np.bincount(row_b, weights[column_b], len(pairs))
            ) * (2 * penalty / len(pairs))
            gradient += np.bincount(column_a, change[row_a], n_features)
            gradient -= np.bincount(column_b, change[row_b], n_features)
        g = np.append(gradient, error.sum())
        mean = 0.9 * mean + 0.1 * g
        square = 0.99 * square + 0.01 * g * g
        move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        weights -= move[:-1]
        bias -= float(move[-1])
    return weights, bias


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          most: int = MAX_LABELLED) -> tuple[dict[str, float], float]:
    """Weight of each feature and the bias, from a bounded sample of the labelled rows."""
    rows = written(labelled_rows(docs, labels, id_col, text_col, most), "toxic-sample")
    names = select_features(rows)
    index = {f: i for i, f in enumerate(names)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ints = pa.list_(pa.int32())
        for batch in batches:
            x, after = [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                x.append(indices(words, index))
                after.append([indices(other, index) for other in swapped(words)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(x, ints), pa.array(after, pa.list_(ints))],
                ["toxic", "x", "after"],
            )

    got = rows.mapInArrow(vectors, "toxic int, x array<int>, after array<array<int>>").toArrow()
    data = sorted(zip(*(got.column(c).to_pylist() for c in ("x", "toxic", "after"))))
    x = [row[0] for row in data]
    pairs = [(a, b) for a, _, others in data for b in others if a != b]
    weights, bias = fit(x, np.array([row[1] for row in data]), pairs, len(names))
    return dict(zip(names, weights.tolist())), bias


def score(docs: DataFrame, model: tuple[dict[str, float], float], text_col: str = "text",
          output: str = "score") -> DataFrame:
    """The documents with all their columns and the model's score of each whole text."""
    weights, bias = model

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain: set[str] = set()  # words without any feature, which most are
        for batch in batches:
            out = []
            for text in batch.column(text_col):
                words = words_of(text.as_py() or "") - plain
                found: set[str] = set()
                for word in words:
                    hit = [f for f in features_of(word) if f in weights]
                    if hit:
                        found.update(hit)
                    else:
                        plain.add(word)
                logit = bias + sum(weights[f] for f in sorted(found))
                out.append(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
            if len(plain) > 300_000:
                plain.clear()
            columns = [batch.column(n) for n in batch.schema.names if n != output]
            names = [n for n in batch.schema.names if n != output]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.float64())], [*names, output])

    fields = [f for f in docs.schema.fields if f.name != output]
    schema = T.StructType(fields).add(output, "double")
    return docs.mapInArrow(scan, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             most: int = MAX_LABELLED) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only the text is scored. A null text is an empty one and has the score of no evidence; so has
    every text where no labelled row, or only one class of them, is there to learn from. A null
    id is not held out. Rows that repeat an id are scored each; further columns are ignored.
    """
    model = train(docs, labels, id_col, text_col, most)
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
    texts = docs.select(
        F.col(id_col).alias("doc_id"), held.alias("held_out"), text_of(text_col).alias("text")
    )
    return score(texts, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               most: int = MAX_LABELLED) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns.

    A null or empty text has the score of no evidence and stays, as all do where there is nothing to learn
    from. Rows that repeat are judged each, alike. No rows give no rows.
    """
    model = train(docs, labels, id_col, text_col, most)
    name = free_name(docs, "_toxic_score")
    return score(docs, model, text_col, name).filter(F.col(name) < THRESHOLD).select(*docs.columns)


@query("op5_toxicity")
def op5(spark, sf_dir):
    return toxicity(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
