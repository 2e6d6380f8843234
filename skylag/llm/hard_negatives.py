"""Hard negatives: rows of other labels that come close to an anchor's positives, by packed products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skylag.llm.common import finite_vectors, vector_matrix
from skylag.llm.registry import documents, query
from skylag.session import written

POSITIVES, NEGATIVES = 5, 5
# a negative's score in hundredths of the positive's: least and most
LEAST, MOST = 80, 100
SCALE = 256
# rows and anchors that meet in one task, and anchors whose scores are in memory at once
BLOCK, STRIP = 16_384, 128
# whole numbers that a double holds
MANTISSA = 53


def quantised(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of doubles: int64, or Python's numbers where these would not do."""
    floors = np.floor(scale * vectors)
    if not floors.size or np.abs(floors).max() < 2.0**31:
        return floors.astype(np.int64)
    return np.array([[int(x) for x in row] for row in floors.tolist()], object).reshape(floors.shape)


def packed_products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of all anchors with all rows, one line for each anchor.

    Both sides are biased by the least value of each component, so nothing is negative. Several
    rows' components then stand in fields of one number, far enough apart for their sums; one
    product for each anchor's component serves them all, and the sums are cut out again. Sums of
    whole numbers below 2**53 are exact in doubles, whatever their order, so numbers of that size
    go through a matrix product; components are summed in parts for it where two fields have no
    room otherwise. Larger values take Python's whole numbers, of one field for every row.
    """
    if not len(anchors) or not len(rows) or not anchors.shape[1]:
        return np.zeros((len(anchors), len(rows)), np.int64)
    largest = int(np.abs(anchors).max()) * int(np.abs(rows).max())
    width = max(int(x.max()) - int(x.min()) for x in (anchors, rows))
    if largest * anchors.shape[1] >> 61 or width * width >> (MANTISSA // 2):
        anchors, rows = anchors.astype(object), rows.astype(object)
    low_a, low_r = anchors.min(0), rows.min(0)
    a, r = anchors - low_a, rows - low_r
    most = a.max(0) * r.max(0)
    # (x - low_a)(y - low_r), summed, and what it lacks of xy
    rest = (anchors * low_r).sum(1)[:, None] + (rows * low_a).sum(1)[None, :] - (low_a * low_r).sum()
    if rows.dtype == object:
        return _wide(a, r, max(int(most.sum()), int(r.max()))) + rest
    part = len(most)
    while part > 1 and int(most[:part].sum()) >> (MANTISSA // 2):
        part = (part + 1) // 2
    out, at = rest, 0
    while at < len(most):
        end = min(at + part, len(most))
        while int(most[at:end].sum()) >> (MANTISSA // 2):
            end -= 1
        out = out + _in_doubles(a[:, at:end], r[:, at:end], int(most[at:end].sum()))
        at = end
    return out


def _in_doubles(a: np.ndarray, r: np.ndarray, most: int) -> np.ndarray:
    width = max(most.bit_length(), 1)
    fields = MANTISSA // width
    words = -(-len(r) // fields)
    padded = np.zeros((fields * words, r.shape[1]))
    padded[: len(r)] = r
    packed = np.zeros((words, r.shape[1]))
    for field in range(fields):
        packed += padded[field * words : (field + 1) * words] * 2.0 ** (width * field)
    sums = (a.astype(np.float64) @ packed.T).astype(np.int64)
    mask = (1 << width) - 1
    return np.concatenate([(sums >> (width * f)) & mask for f in range(fields)], 1)[:, : len(r)]


def _wide(a: np.ndarray, r: np.ndarray, most: int) -> np.ndarray:
    size = most.bit_length() // 8 + 1
    packed = [
        int.from_bytes(b"".join(int(x).to_bytes(size, "little") for x in column), "little") for column in r.T
    ]
    out = np.empty((len(a), len(r)), object)
    for i, anchor in enumerate(a):
        total = sum(int(x) * word for x, word in zip(anchor, packed))
        fields = total.to_bytes(size * len(r) + 1, "little")
        out[i] = [int.from_bytes(fields[k : k + size], "little") for k in range(0, size * len(r), size)]
    return out


def first_of_each(scores: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Line and column of the `most` highest allowed scores of each line; of ties the first columns."""
    if scores.dtype != object and scores.shape[1] > most:
        low = np.where(allowed, scores, np.iinfo(np.int64).min)
        bound = np.partition(low, scores.shape[1] - most, 1)[:, scores.shape[1] - most]
        allowed = allowed & (scores >= bound[:, None])
    line, column = np.nonzero(allowed)
    if scores.dtype == object:
        order = np.array(sorted(range(len(line)), key=lambda k: (line[k], -scores[line[k], column[k]], column[k])), np.int64)
    else:
        order = np.lexsort((column, -scores[line, column], line))
    line, column = line[order], column[order]
    start = np.searchsorted(line, np.arange(len(scores)))
    keep = np.arange(len(line)) - start[line] < most
    return line[keep], column[keep]


def _in_order(table: pa.Table) -> pa.Table:
    """Rows by id, nulls last, then as they were numbered: the order of ties."""
    return table.sort_by([("id", "ascending"), ("row", "ascending")])


def _grid(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int, meet, schema: str):
    """`meet(anchors, rows)` for each block of anchors with each block of rows."""

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = anchors.withColumn("a", F.pmod(F.xxhash64("row"), F.lit(anchor_blocks)).cast("int")).withColumn("r", every(row_blocks))
    right = rows.withColumn("r", F.pmod(F.xxhash64("row"), F.lit(row_blocks)).cast("int")).withColumn(
        "a", every(anchor_blocks)
    )
    return left.groupBy("a", "r").cogroup(right.groupBy("a", "r")).applyInArrow(meet, schema)


def _lines(anchors: pa.Table, rows: pa.Table, scale: int):
    """Runs of anchors, each with its exact scores against all rows."""
    a, r = vector_matrix(anchors.column("vector")), vector_matrix(rows.column("vector"))
    width = max(a.shape[1], r.shape[1])
    a, r = (quantised(np.pad(x, ((0, 0), (0, width - x.shape[1]))), scale) for x in (a, r))
    for first in range(0, len(a), STRIP):
        yield first, packed_products(a[first : first + STRIP], r)


def mine(
    rows: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    scale: int = SCALE,
    block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x), and a score is their inner product, exact. Each row where
    `anchor` is true has as positives the first `positives` other rows of its label, and for each
    of these come the first `negatives` rows of other labels whose score is between `least` and
    `most` hundredths of the positive's. Higher scores come first, then smaller ids, null ids last.

    Anchors, a stated part of the rows, meet all rows in blocks of at most about `block` each, dealt
    by row and not by label or id, so no label, repeated vector or id makes one task larger. A
    block passes on the first few of each anchor only; a window picks the first of all blocks.

    Rows with a null label or vector, or with a null or non-finite component, take no part. Rows
    are told apart by their place: repeated rows are each other's positives, and each repeated
    anchor has its results. A shorter vector counts as continued by zeros; an anchor without
    positives has no result, as has an empty table. A score beyond a long is an error. Further
    columns are ignored.
    """
    valid = written(
        rows.filter(F.col(label_col).isNotNull() & finite_vectors(vector_col)).select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
            F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"),
            F.coalesce(anchor, F.lit(False)).alias("anchor"),
        ),
        "hard-rows",
    )
    size = valid.agg(F.count("*").alias("n"), F.count_if("anchor").alias("a")).first()
    blocks = max(1, -(-size.n // block)), max(1, -(-size.a // block))
    everyone, anchors = valid.drop("anchor"), valid.filter("anchor").drop("anchor")
    id_type, id_arrow = dict(valid.dtypes)["id"], to_arrow_type(valid.schema["id"].dataType)

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        right = _in_order(right)
        parts = []
        by_label = {}
        for side, table in enumerate((left, right)):
            labels = table.column("label").to_numpy()
            for label in np.unique(labels):
                by_label.setdefault(label, [[], []])[side] = np.flatnonzero(labels == label)
        for mine_, theirs in by_label.values():
            if not len(mine_) or not len(theirs):
                continue
            a, r = left.take(mine_), right.take(theirs)
            own, other = a.column("row").to_numpy(), r.column("row").to_numpy()
            for first, scores in _lines(a, r, scale):
                here = own[first : first + len(scores)]
                line, column = first_of_each(scores, here[:, None] != other[None, :], positives)
                parts.append(pa.table({
                    "row": pa.array(here[line], pa.int64()), "id": r.column("id").take(column),
                    "score": pa.array(scores[line, column].astype(np.int64)), "other": pa.array(other[column]),
                }))
        return pa.concat_tables(parts) if parts else _none(id_arrow, "row", "id", "score", "other")

    first = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "other")
    best = (
        _grid(everyone, anchors, *blocks, near, f"row long, id {id_type}, score long, other long")
        .withColumn("k", F.row_number().over(first)).filter(F.col("k") <= positives)
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("k", "id", "score"))).alias("positives"))
    )
    # anchors are as many as before, and each positive is kept once
    goals = written(anchors.join(best, "row"), "hard-anchors")

    def hard(left: pa.Table, right: pa.Table) -> pa.Table:
        right = _in_order(right)
        parts = []
        labels, others = left.column("label").to_numpy(), right.column("label").to_numpy()
        own, there = left.column("row").to_numpy(), right.column("row").to_numpy()
        found = left.column("positives").to_pylist()
        for first, scores in _lines(left, right, scale) if len(right) else ():
            foreign = labels[first : first + len(scores), None] != others[None, :]
            for k in range(positives):
                have = [p[k]["score"] if len(p) > k else None for p in found[first : first + len(scores)]]
                # no row is above the highest and below the least score where there is no positive
                high = [p * most // 100 if p is not None else -1 for p in have]
                low = [-(-p * least // 100) if p is not None else 0 for p in have]
                bounds = [np.array(b, scores.dtype)[:, None] for b in (low, high)]
                inside = foreign & (scores >= bounds[0]) & (scores <= bounds[1])
                line, column = first_of_each(scores, inside.astype(bool), negatives)
                parts.append(pa.table({
                    "row": pa.array(own[first + line], pa.int64()), "k": pa.array(np.full(len(line), k + 1, np.int32)),
                    "id": right.column("id").take(column),
                    "score": pa.array(scores[line, column].astype(np.int64)), "other": pa.array(there[column]),
                }))
        return pa.concat_tables(parts) if parts else _none(id_arrow, "row", "k", "id", "score", "other")

    ranked = Window.partitionBy("row", "k").orderBy(F.desc("score"), F.asc_nulls_last("id"), "other")
    chosen = (
        _grid(everyone, goals.drop("id"), *blocks, hard, f"row long, k int, id {id_type}, score long, other long")
        .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= negatives)
    )
    told = goals.select(F.col("id").alias("anchor_id"), F.col("row"), "positives")
    return chosen.join(told, "row").select(
        "anchor_id", F.element_at("positives", F.col("k"))["id"].alias("positive_id"), "rank",
        F.col("id").alias("negative_id"), F.element_at("positives", F.col("k"))["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def _none(id_type: pa.DataType, *names: str) -> pa.Table:
    kinds = {"id": id_type, "k": pa.int32()}
    return pa.table({n: pa.array([], kinds.get(n, pa.int64())) for n in names})


@query("op13_hard_negatives", """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.own
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
""")
def op13(spark, sf_dir):
    rows = documents(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)
