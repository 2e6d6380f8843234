"""What several operators share: row keys, text buffers, words and hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
# ASCII capitals to small letters; other bytes stay
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
# a-z, 0-9 and every byte of a character outside ASCII
LETTER = np.zeros(256, bool)
LETTER[0x30:0x3A] = LETTER[0x61:0x7B] = LETTER[0x80:] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or with as many underscores before it as make it a name that `df` has no column of."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """16 bytes that identify a row by id and text, nulls included."""
    return F.unhex(
        F.md5(F.concat_ws("\0", F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_of(text_col)))
    )


def near_keys(
    df: DataFrame, key: str, wanted: DataFrame, others: bool = False, buckets: int = 1 << 20
) -> DataFrame:
    """The rows of `df` whose key may be among those of `wanted`, without an exchange of `df`.

    At most `buckets` hash values of the wanted keys are broadcast, whatever their number. A join
    on the key itself has to follow; where there are many keys, it alone decides. With `others`,
    the rows whose key is certainly not among the wanted ones; the two make up the whole.
    """
    def value(name):
        return F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")

    bucket = free_name(df, "__bucket")
    kept = wanted.select(value(key).alias(bucket)).distinct()
    how = "left_anti" if others else "left_semi"
    return df.join(F.broadcast(kept), value(key) == F.col(bucket), how)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column, one after another, and where each begins and ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(
    data: np.ndarray, offsets: np.ndarray, most: int = 1 << 20
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about `most` bytes: first text, end, their bytes and offsets.

    Arrays over the bytes of a run stay in the processor's cache. A longer text is a run alone.
    """
    first, n = 0, len(offsets) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        end = min(end, n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def portions(batch: pa.RecordBatch, column: str = "text", most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about `most` bytes of text."""
    _, offsets = utf8(batch.column(column))
    for first, end, _, _ in blocks(np.zeros(0, np.uint8), offsets, most):
        yield batch.slice(first, end - first)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values with all bits depending on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of word bytes; a run ends with its text."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    starts = inside & (np.concatenate(([True], ~inside[:-1])) | cut[:n])
    ends = inside & (np.concatenate((~inside[1:], [True])) | cut[1:])
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _ODD)
    out[0] = 1
    return np.multiply.accumulate(out)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; spans are in order and do not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    at = np.cumsum(lengths) - lengths
    inner = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
    byte = data[np.repeat(starts, lengths) + inner].astype(np.uint64) + np.uint64(1)
    sums = np.add.reduceat(byte * powers(int(lengths.max()))[inner], at)
    return mixed(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every `n` consecutive word hashes, wherever texts begin and end."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    weight = powers(n + 1)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out += words[i : len(words) - n + 1 + i] * weight[i + 1]
    return mixed(out)


def first_word_of_texts(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text the number of words before it; the last entry counts all."""
    return np.searchsorted(starts, offsets)


def list_column(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column whose i-th list ends at ends[i]."""
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def finite_vectors(column: str) -> Column:
    """Whether a vector and all its components are there and finite."""
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return F.coalesce(F.col(column).isNotNull() & F.forall(column, finite), F.lit(False))


def vector_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors as lines of doubles, shorter ones continued by zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks else pa.array([], column.type)
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    width = int(lengths.max()) if len(lengths) else 0
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out
