"""Document fingerprints of closed syncmers, and their positional likeness."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylag.llm.common import blocks, mixed, portions, text_of, utf8
from skylag.llm.registry import documents, query
from skylag.session import written

# bytes of a k-mer and of its inner substrings
K, S = 24, 8
# of a text's anchors, all whose hash is below BELOW are kept, one for about 70 bytes however long
# it is, and in a short text at least its ANCHORS smallest
ANCHORS, BELOW = 64, 1 << 29
# ranges of ids for each partition
RANGES = 4
_WINDOW = K - S + 1


def _shifted(a: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros_like(a)
    if n < len(a):
        out[:-n] = a[n:]
    return out


def syncmers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of every closed syncmer of the texts.

    A k-mer is chosen if its smallest inner substring, by hash, is its first or its last one.
    Nothing outside the k-mer matters, so equal passages have equal anchors wherever they stand.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value = data.astype(np.uint64)
    for n in (1, 2, 4):
        value |= _shifted(value, n) << np.uint64(8 * n)
    inner = mixed(value * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    low = inner
    for n in (1, 2, 4, 8):
        low = np.minimum(low, _shifted(low, n))
    low = np.minimum(low, _shifted(low, _WINDOW - 16))
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    at = np.flatnonzero((room >= K) & ((inner == low) | (_shifted(inner, _WINDOW - 1) == low)))
    return at, mixed(inner[at] + mixed(inner[at + 8] + mixed(inner[at + 16])))


def anchors_of(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, places) of each text's fingerprint: its smallest hashes, in order, each once.

    Their number follows the length of the text, so a passage has as many anchors in a long text
    as in another one. A text without any syncmer has one anchor, made of the whole; an empty one has none.
    """
    out = []
    for _, _, data, offsets in blocks(*utf8(pa.array(texts, pa.string()))):
        at, hashes = syncmers(data, offsets)
        cut = np.searchsorted(at, offsets)
        for i in range(len(offsets) - 1):
            a, b = cut[i], cut[i + 1]
            if a == b:
                whole = bytes(data[offsets[i] : offsets[i + 1]])
                value = int.from_bytes(hashlib.sha256(whole).digest()[:4], "big")
                n = int(bool(whole))
                out.append((np.full(n, value, np.uint32), np.zeros(n, np.int64)))
                continue
            # places ascend, so of equal hashes the first place is kept
            top, first = np.unique((hashes[a:b] >> np.uint64(32)).astype(np.uint32), return_index=True)
            n = max(ANCHORS, int(np.searchsorted(top, BELOW)))
            out.append((top[:n], (at[a:b] - offsets[i])[first[:n]]))
    return out


def written_out(anchors: tuple[np.ndarray, np.ndarray]) -> str:
    """14 hexadecimal digits an anchor: 8 of its hash, 6 of its place."""
    hashes, places = anchors
    row = np.empty((len(hashes), 7), np.uint8)
    row[:, :4] = hashes.astype(">u4").view(np.uint8).reshape(-1, 4)
    row[:, 4:] = (places & 0xFFFFFF).astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:]
    return row.tobytes().hex()


def _known_below(hashes: np.ndarray) -> int:
    """Below this value a fingerprint has every anchor of its text."""
    if len(hashes) < ANCHORS:
        return 1 << 32
    return max(int(hashes[-1]) + 1, BELOW) if len(hashes) == ANCHORS else BELOW


def _in_order(places: np.ndarray) -> int:
    """The most of the places, without changing their order, that ascend."""
    if (np.diff(places) > 0).all():
        return len(places)
    ends: list[int] = []  # the least last place of ascending runs of each length
    for place in places.tolist():
        i = bisect_left(ends, place)
        ends[i : i + 1] = [place]
    return len(ends)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """0 to 1: shared anchors in one order, as a share of the anchors of both texts.

    Only anchors below the value up to which both fingerprints are complete are compared. The
    shared ones count as far as they follow each other alike in both texts, whatever stands
    between them: an insertion moves all that follows to another diagonal and costs only itself,
    while passages in another order count in one order only.

    Two empty texts are alike, an empty and another one are not.
    """
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    known = min(_known_below(a[0]), _known_below(b[0]))
    first, second = (h[: np.searchsorted(h, known)] for h in (a[0], b[0]))
    if not len(first) or not len(second):
        return 0.0
    at = np.minimum(np.searchsorted(second, first), len(second) - 1)
    hit = np.flatnonzero(second[at] == first)
    if not len(hit):
        return 0.0
    order = np.argsort(a[1][hit])
    return _in_order(b[1][at[hit]][order]) / (len(first) + len(second) - len(hit))


def edited(text: str, following: str) -> str:
    """The text with its last half, rounded down, replaced by as much of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


_FIELDS = [
    ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
_NAMES = [n for n, _ in _FIELDS]
_SCHEMA = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _results(texts: list[str], anchors: list, following: list[str], next_anchors: list) -> list[pa.Array]:
    changed = [edited(t, f) for t, f in zip(texts, following)]
    other = anchors_of(changed)
    columns = [
        [len(t) for t in texts], [_sha(t) for t in changed], [written_out(a) for a in anchors],
        [written_out(a) for a in other], [likeness(a, o) for a, o in zip(anchors, other)],
        [likeness(a, n) for a, n in zip(anchors, next_anchors)],
    ]
    return [pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS)]


def _place(value: Column, bounds: list) -> Column:
    """How many of the ascending bounds are below the value, in two steps of a root of their number."""
    if not bounds:
        return F.lit(0)
    step = int(np.ceil(len(bounds) ** 0.5))
    known, coarse = (F.array(*map(F.lit, b)) for b in (bounds, bounds[step - 1 :: step]))

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b < value))

    start = below(coarse) * step
    return start + below(F.slice(known, start + 1, step))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    Ids are cut into ranges, several for each partition. The first text of a range is added to the
    range before it as its end, one row each; then all documents are exchanged once, and each task
    goes through its ranges in order, holding one text at a time besides its batch.

    A null text is empty and has an empty fingerprint. Null ids come last; rows that repeat an id
    follow each other in the order of their texts, and equal texts have equal fingerprints. The
    only document of a table is followed by itself. Further columns are ignored.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    ids = docs.select(F.col(id_col).alias("doc_id"))
    ranges = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # at most as many bounds as ranges
    steps = [i / ranges for i in range(1, ranges)]
    bounds = ids.agg(F.percentile_approx("doc_id", steps, 10 * ranges)).first()[0] or []
    bounds = sorted(set(bounds))
    place = F.when(F.isnull("doc_id"), len(bounds) + 1).otherwise(_place(F.col("doc_id"), bounds)).cast("int")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("range", place)
    first = rows.groupBy("range").agg(F.min("doc_id").alias("least"))
    order = Window.orderBy("range")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # one row for each range: windows and broadcast are as small as the number of ranges
    first = written(
        first.select("range", "least", F.coalesce(F.lag("range").over(order), F.last("range").over(whole)).alias("before")),
        "fingerprint-ranges",
    )
    heads = (
        rows.join(F.broadcast(first.withColumnRenamed("range", "r")),
                  (F.col("range") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("least")))
        .groupBy("before").agg(F.min("text").alias("text"))
        .select(F.lit(None).cast(id_type).alias("doc_id"), "text", F.col("before").alias("range"), F.lit(1).alias("end"))
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(ids, *columns):
            return pa.RecordBatch.from_arrays([ids, *_results(*columns)], ["doc_id", *_NAMES])

        held = None  # id, text and anchors of a document whose next row is in the next batch
        for batch in (part for whole in batches for part in portions(whole)):
            texts, end = batch.column("text").to_pylist(), batch.column("end").to_numpy()
            ids, anchors = batch.column("doc_id"), anchors_of(texts)
            if held is not None:
                yield rows_of(held[0], [held[1]], [held[2]], texts[:1], anchors[:1])
            last = len(texts) - 1
            here = np.flatnonzero(end[:last] == 0).tolist()
            if here:
                yield rows_of(
                    ids.take(pa.array(here)), [texts[i] for i in here], [anchors[i] for i in here],
                    [texts[i + 1] for i in here], [anchors[i + 1] for i in here],
                )
            held = None if end[last] else (ids.slice(last, 1), texts[last], anchors[last])

    return (
        rows.withColumn("end", F.lit(0)).unionByName(heads)
        .repartition("range").sortWithinPartitions("range", "end", "doc_id", "text")
        .mapInArrow(scan, f"doc_id {id_type}, {_SCHEMA}")
    )


@query("op9_fingerprints")
def op9(spark, sf_dir):
    return fingerprints(documents(spark, sf_dir))
