"""Suffix-array de-duplication: bytes of long strings that occur more than once.

A string of LENGTH bytes holds an anchor, the hash of the smallest k-gram in it, which depends on
nothing else. Anchors that occur once in all texts are dropped. The strings that share another one
are compared in suffix arrays over the bytes around it, in steps laid out from the anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import blocks, list_column, mixed, near_keys, portions, text_of, utf8
from skylag.llm.registry import documents, query
from skylag.llm.suffix_sort import suffix_array
from skylag.session import written

LENGTH = 200
# bytes of the k-gram that anchors a string, and of a symbol of the suffix arrays
GRAM, SYMBOL = 64, 32
_STARTS = LENGTH - GRAM + 1
# whole symbols that every string has wherever it begins, and its bytes outside of them
_WHOLE = (LENGTH - SYMBOL + 1) // SYMBOL
_EDGE = LENGTH - _WHOLE * SYMBOL
# distinct surroundings of one anchor that are compared in one suffix array, and bytes of an array
MOST, ARRAY_BYTES = 2000, 1 << 20
# anchors are counted in so many counters; one whose counter is so far above the usual is dealt to
# so many lists
COUNTERS, FREQUENT, SALTS = 1 << 18, 1000, 64
_U = np.uint64


def _ahead(a: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros_like(a)
    if n < len(a):
        out[:-n] = a[n:]
    return out


def anchors(data: np.ndarray, offsets: np.ndarray):
    """(text, place of the anchor, first and last start, hash) of each run of strings with one anchor.

    Starts and places count from the beginning of their text.
    """
    size = np.diff(offsets)
    if not len(data) or size.max() < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.view(_U)
    value, power, width = data.astype(_U) + _U(1), np.array([0x9E3779B97F4A7C15], _U), 1
    while width < GRAM:
        value = value * power + _ahead(value, width)
        power, width = power * power, width * 2
    value = mixed(value)
    # the high half decides, then the place: the leftmost of equal ones
    low = (value & _U(0xFFFFFFFF00000000)) | np.arange(len(value), dtype=_U)
    width = 1
    while width * 2 <= _STARTS:
        after = _ahead(low, width)
        after[len(low) - width :] = ~_U(0)
        low = np.minimum(low, after)
        width *= 2
    after = _ahead(low, _STARTS - width)
    after[len(low) - (_STARTS - width) :] = ~_U(0)
    chosen = (np.minimum(low, after) & _U(0xFFFFFFFF)).astype(np.int64)
    room = np.repeat(offsets[1:], size) - np.arange(len(data))
    start = np.flatnonzero(room >= LENGTH)
    chosen = chosen[start]
    text = np.searchsorted(offsets, start, "right") - 1
    new = np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    base = offsets[text[first]]
    return text[first], chosen[first] - base, start[first] - base, start[last] - base, value[chosen[first]]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct anchors of each document, those that it has twice, and a row of counters a batch."""
    names = ["doc_id", "_key", "n_bytes", "sha", "anchors", "twice", "buckets", "counts"]
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    for batch in batches:
        totals = np.zeros(COUNTERS, np.int64)
        for first, end, data, offsets in blocks(*utf8(batch.column("text"))):
            text, _, _, _, value = anchors(data, offsets)
            order = np.lexsort((value, text))
            text, value = text[order], value[order]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
            second = ~new & np.append(False, new[:-1])[: len(new)]
            totals += np.bincount((value[new] % _U(COUNTERS)).astype(np.int64), minlength=COUNTERS)
            k = end - first
            parts = [data[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, k),
                    pa.array([hashlib.md5(p).digest() for p in parts], pa.binary()),
                    pa.array(np.diff(offsets)), pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string()),
                    *(
                        list_column(value[use].view(np.int64), np.searchsorted(text[use], np.arange(k), "right"), pa.int64())
                        for use in (new, second)
                    ),
                    pa.nulls(k, ints), pa.nulls(k, ints),
                ],
                names,
            )
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, batch.schema.field("doc_id").type), pa.nulls(1, pa.binary()), pa.array([-1], pa.int64()),
             pa.nulls(1, pa.string()), pa.nulls(1, longs), pa.nulls(1, longs),
             pa.array([used.astype(np.int32)], ints), pa.array([totals[used].astype(np.int32)], ints)], names,
        )


def _dealt(batches: Iterator[pa.RecordBatch], frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each anchor of a document; those of frequent ones are dealt by document."""
    for batch in batches:
        lists = batch.column("anchors")
        value = lists.flatten().to_numpy()
        row = np.repeat(batch.column("_row").to_numpy(), lists.value_lengths().to_numpy())
        hot = frequent[(value.view(_U) % _U(COUNTERS)).astype(np.int64)]
        salt = np.where(hot, (mixed(row.astype(_U)) % _U(SALTS)).astype(np.int64) + 1, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(value), pa.array(salt.astype(np.int32)), pa.array(row)], ["anchor", "salt", "_row"]
        )


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of anchors that occur again, from rows in the order of anchor and salt.

    Frequent anchors, which have a salt, all stay; one that is not repeated is found out later.
    """
    def rows(value, row):
        return pa.RecordBatch.from_arrays([pa.array(value), pa.array(row)], ["anchor", "_row"])

    known = None  # the anchor of the rows before, where it has been met twice
    held = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        value, salt, row = (
            np.concatenate((h, batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)))
            for h, c in zip(held, ("anchor", "salt", "_row"))
        )
        if not len(value):
            continue
        new = np.concatenate(([True], value[1:] != value[:-1]))
        run = np.cumsum(new) - 1
        keep = (np.bincount(run)[run] > 1) | (salt > 0) | (value == known)
        if keep[-1]:
            known, held = value[-1], [np.zeros(0, np.int64)] * 3
        else:
            known, held = None, [c[-1:] for c in (value, salt, row)]
        yield rows(value[keep], row[keep])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The surroundings of each anchor that occurs again: all bytes of the strings that have it."""
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    for batch in (part for whole in batches for part in portions(whole, most=1 << 18)):
        data, offsets = utf8(batch.column("text"))
        text, at, lo, hi, value = anchors(data, offsets)
        cuts, out = np.searchsorted(text, np.arange(len(offsets))), []
        for i, (row, wanted) in enumerate(zip(batch.column("_row").to_pylist(), batch.column("wanted"))):
            a, b = cuts[i], cuts[i + 1]
            found = a + np.flatnonzero(np.isin(value[a:b].view(np.int64), wanted.values.to_numpy()))
            body = data[offsets[i] : offsets[i + 1]].tobytes()
            out += [
                (v, row, p, q - p, body[p : r + LENGTH])
                for v, p, q, r in zip(
                    value[found].view(np.int64).tolist(), lo[found].tolist(), at[found].tolist(), hi[found].tolist()
                )
            ]
        columns = zip(*out) if out else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor", "_row", "lo", "off", "bytes"]
        )


def _rank(columns: list[np.ndarray]) -> np.ndarray:
    """Dense ranks of rows of 64-bit columns; equal rows, and only these, have equal ranks."""
    out = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        value = np.unique(column, return_inverse=True)[1].astype(np.int64)
        out = np.unique(out * (len(out) + 1) + value, return_inverse=True)[1].astype(np.int64)
    return out


def string_classes(segments: list[bytes], offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every start in every segment: its segment, its place there, and a class.

    Strings of LENGTH bytes from two starts have the same class if and only if they are equal,
    given that equal ones stand at the same distance from their anchors, at `offs`. Symbols are
    SYMBOL bytes each, counted from the anchor both ways. The suffix array over them brings equal
    runs of symbols together; the bytes before and after these decide the rest.
    """
    lengths = np.array([len(s) for s in segments], np.int64)
    data = np.frombuffer(b"".join(segments) + b"\0" * SYMBOL, np.uint8)
    base = np.cumsum(lengths) - lengths
    lead = offs % SYMBOL
    n_symbols = (lengths - lead) // SYMBOL
    ends = np.cumsum(n_symbols)
    owner = np.repeat(np.arange(len(segments)), n_symbols)
    inner = np.arange(int(n_symbols.sum())) - np.repeat(ends - n_symbols, n_symbols)
    at = base[owner] + lead[owner] + inner * SYMBOL
    whole = data[at[:, None] + np.arange(SYMBOL)].view(_U)
    symbol = _rank([whole[:, i] for i in range(whole.shape[1])]) + 2
    # one sequence: a 1 ends each segment, a 0 ends all
    place = np.arange(len(symbol)) + owner
    text = np.ones(len(symbol) + len(segments) + 1, np.int64)
    text[place] = symbol
    text[-1] = 0
    order = np.array(suffix_array(text))
    padded = np.concatenate((text, np.zeros(_WHOLE, np.int64)))
    differs = np.ones(len(order), bool)
    differs[1:] = False
    for i in range(_WHOLE):
        step = padded[order + i]
        differs[1:] |= step[1:] != step[:-1]
    run = np.empty(len(order), np.int64)
    run[order] = np.cumsum(differs)

    starts = lengths - LENGTH + 1
    segment = np.repeat(np.arange(len(segments)), starts)
    first = np.arange(int(starts.sum())) - np.repeat(np.cumsum(starts) - starts, starts)
    left = (lead[segment] - first) % SYMBOL
    index = (first + left - lead[segment]) // SYMBOL
    symbol_run = run[(ends - n_symbols)[segment] + index + segment]
    # bytes outside the whole symbols, those before them first
    byte = np.arange(_EDGE)
    from_start = base[segment] + first
    edge = np.empty((len(segment), _EDGE), np.uint8)
    for a in range(0, len(segment), 1 << 16):
        b = a + (1 << 16)
        skip = np.where(byte < left[a:b, None], 0, _WHOLE * SYMBOL)
        edge[a:b] = data[from_start[a:b, None] + byte + skip]
    columns = edge.view(_U)
    key = mixed(symbol_run.astype(_U) * _U(SYMBOL) + left.astype(_U))
    for i in range(columns.shape[1]):
        key = mixed(key ^ (columns[:, i] * _U(0x9E3779B97F4A7C15) + _U(i)))
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    # rows with one key are compared byte by byte; should any differ, all are ranked by their bytes
    same = ~new[1:]
    equal = (edge[order][1:] == edge[order][:-1]).all(axis=1) & (
        symbol_run[order][1:] == symbol_run[order][:-1]) & (left[order][1:] == left[order][:-1])
    if (same & ~equal).any():
        ranks = _rank([symbol_run.astype(_U), left.astype(_U), *(columns[:, i] for i in range(columns.shape[1]))])
        return segment, first, ranks
    out = np.empty(len(segment), np.int64)
    out[order] = np.cumsum(new) - 1
    return segment, first, out


def _runs(flag: np.ndarray) -> list[int]:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flag, [False])).astype(np.int8)))
    return edge.tolist()


_FOUND = "anchor long, h binary, runs array<int>, strings array<struct<s:binary,p:int>>"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated starts of each distinct segment; rows of one anchor and part come one after another.

    `runs` are pairs of a first start and one after the last. For an anchor in several parts,
    `strings` names each string that is single in its part, or stands for its class, by a hash;
    p is -1 where the string is known to repeat.
    """
    kinds = (
        pa.int64(), pa.binary(), pa.list_(pa.int32()),
        pa.list_(pa.struct([("s", pa.binary()), ("p", pa.int32())])),
    )

    def solved(rows: list[dict]) -> pa.RecordBatch:
        segments = [r["bytes"] for r in rows]
        count = np.array([r["c"] for r in rows], np.int64)
        segment, first, kind = string_classes(segments, np.array([r["off"] for r in rows], np.int64))
        times = np.bincount(kind, count[segment])
        repeated = times[kind] >= 2
        cuts = np.searchsorted(segment, np.arange(len(rows) + 1))
        met = np.zeros(len(times), bool)
        out = []
        for i, r in enumerate(rows):
            a, b = cuts[i], cuts[i + 1]
            strings = []
            if r["parts"] > 1:
                for p, k, again in zip(first[a:b].tolist(), kind[a:b].tolist(), repeated[a:b].tolist()):
                    if not met[k]:
                        met[k] = True
                        name = hashlib.md5(r["bytes"][p : p + LENGTH]).digest()
                        strings.append({"s": name, "p": -1 if again else p})
            out.append((r["anchor"], r["h"], _runs(repeated[a:b]), strings))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["anchor", "h", "runs", "strings"]
        )

    held: list[dict] = []
    size = 0
    for batch in batches:
        for row in batch.to_pylist():
            same = held and (row["anchor"], row["part"]) == (held[-1]["anchor"], held[-1]["part"])
            if size >= ARRAY_BYTES and not same:
                yield solved(held)
                held, size = [], 0
            held.append(row)
            size += len(row["bytes"])
    if held:
        yield solved(held)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, runs in zip(batch.column("text"), batch.column("found")):
            text = np.frombuffer(text.as_py().encode("utf-8"), np.uint8)
            step = np.zeros(len(text) + 1, np.int64)
            for x in runs.as_py():
                for a, b in zip(x["runs"][::2], x["runs"][1::2]):
                    step[x["lo"] + a] += 1
                    step[x["lo"] + b - 1 + LENGTH] -= 1
            gone = np.cumsum(step[:-1]) > 0
            out.append((int(gone.sum()), len(_runs(gone)) // 2, hashlib.sha256(text[~gone].tobytes()).hexdigest(),
                        text[~gone].tobytes()))
        columns = list(zip(*out)) if out else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.string()), pa.array(columns[3], pa.binary())],
            ["_row", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def repeated_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, _key, kept.

    A byte goes if a string of LENGTH bytes over it also begins anywhere else, in any document.
    `kept` holds the remaining bytes of documents that lose some but not all, else null; `_key` is
    the hash of the whole text. Equal texts are compared once, as their strings repeat anyway.

    Work grows with the passages that repeat: of the rest, only one anchor in about 70 bytes is
    exchanged, once, and frequent anchors are dealt by document. Surroundings of an anchor are counted before they meet; MOST distinct ones share a
    suffix array, and an anchor with more is dealt to several, whose single strings are then
    compared by hash. A null or short text loses nothing; null ids are kept; further columns are
    ignored.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    counted = written(
        texts.mapInArrow(
            _scan,
            f"doc_id {id_type}, _key binary, n_bytes long, sha string, anchors array<long>, twice array<long>, "
            "buckets array<int>, counts array<int>",
        ).withColumn("_row", F.monotonically_increasing_id()),
        "strings-anchors",
    )
    scanned = counted.filter("n_bytes >= 0")
    seen = (
        counted.filter("n_bytes < 0").select(F.explode(F.arrays_zip("buckets", "counts")).alias("b"))
        .groupBy("b.buckets").agg(F.sum("b.counts").alias("c")).toArrow()
    )
    counters = np.zeros(COUNTERS, np.int64)
    counters[seen.column("buckets").to_numpy()] = seen.column("c").to_numpy()
    usual = np.median(counters)
    frequent = counters > usual + 3 * usual**0.5 + FREQUENT
    contents = written(
        scanned.groupBy("_key").agg(
            F.count("*").alias("copies"), F.min("_row").alias("_first"), F.min_by("doc_id", "_row").alias("_id")
        ),
        "strings-texts",
    )
    copies = (
        scanned.select("_key", "_row").join(contents.filter("copies > 1").select("_key", "_first"), "_key")
        .filter("_row != _first").select("_row")
    )
    dealt = (
        scanned.filter(F.size("anchors") > 0).select("_row", "anchors").join(copies, "_row", "left_anti")
        .mapInArrow(lambda b: _dealt(b, frequent), "anchor long, salt int, _row long")
        .repartition("anchor", "salt").sortWithinPartitions("anchor", "salt")
        .mapInArrow(_again, "anchor long, _row long")
    )
    inside = scanned.filter(F.size("twice") > 0).select(F.explode("twice").alias("anchor"), "_row")
    wanted = (
        dealt.unionByName(inside).groupBy("_row").agg(F.collect_set("anchor").alias("wanted"))
        .join(contents.select(F.col("_first").alias("_row"), "_key", "_id"), "_row")
    )
    wanted = written(wanted, "strings-wanted")
    keyed = texts.withColumn("_key", F.unhex(F.md5("text")))
    affected = written(
        near_keys(keyed, "_key", wanted).join(wanted, "_key").filter(F.col("doc_id").eqNullSafe(F.col("_id")))
        .select("_row", "text", "wanted"),
        "strings-affected",
    )
    segments = affected.mapInArrow(_cut, "anchor long, _row long, lo int, off int, bytes binary")
    distinct = written(
        segments.groupBy("anchor", "off", "bytes").agg(F.count("*").alias("c"))
        .withColumn("h", F.unhex(F.md5("bytes"))),
        "strings-segments",
    )
    many = (
        distinct.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > MOST)
        .select("anchor", F.ceil(F.col("n") / MOST).cast("int").alias("parts"))
    )
    parts = (
        distinct.join(many, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.pmod(F.xxhash64("h"), F.col("parts")).cast("int"))
    )
    found = written(
        parts.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
        .mapInArrow(_compare, _FOUND),
        "strings-found",
    )
    strings = found.select("anchor", "h", F.explode("strings").alias("x")).select("anchor", "h", "x.s", "x.p")
    twice = strings.groupBy("s").agg(F.count("*").alias("n")).filter("n > 1").select("s")
    across = strings.join(twice, "s").filter("p >= 0").select("anchor", "h", F.array("p", F.col("p") + 1).alias("runs"))
    # a string that is its part's class and single has all its segments' places in that one row
    runs = found.filter(F.size("runs") > 0).select("anchor", "h", "runs").unionByName(across)
    marked = (
        segments.select("anchor", "_row", "lo", F.unhex(F.md5("bytes")).alias("h")).join(runs, ["anchor", "h"])
        .groupBy("_row").agg(F.collect_list(F.struct("lo", "runs")).alias("found"))
    )
    partly = (
        affected.select("_row", "text").join(marked, "_row")
        .mapInArrow(_remove, "_row long, n_removed long, n_spans long, kept_sha256 string, kept binary")
        .withColumnRenamed("_row", "_first")
    )
    results = contents.join(partly, "_first", "left").drop("_first", "_id")
    all_gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    return scanned.select("doc_id", "_key", "n_bytes", "sha").join(results, "_key").select(
        "doc_id", "n_bytes",
        F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(all_gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(all_gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        "_key", F.when(~all_gone, F.col("kept")).alias("kept"),
    )


@query("op6_substring_dedup")
def op6(spark, sf_dir):
    return repeated_substrings(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
