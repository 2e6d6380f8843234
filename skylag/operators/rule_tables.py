"""Substring rules kept as a table: any number of terms, found through an index of their characters."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylag.functions.rules import Rules
from skylag.session import written

# bytes of an indexed piece, 7 at most; a shorter term is indexed whole
GRAM = 4
# hash values of indexed pieces that go to every task, as bits, whatever the number of rules: a power of 2
BUCKETS = 1 << 20
ODD = 0x9E3779B97F4A7C15 - (1 << 64)


def rule_rows(spark: SparkSession, rules: Rules) -> DataFrame:
    """An ordered rule list as a table: term, priority (the position of its rule), result."""
    rows = [(term, n, result) for n, (result, terms) in enumerate(rules) for term in terms]
    return spark.createDataFrame(rows, "term string, priority int, result string")


def _gram_scan(lengths: tuple[int, ...], wanted: bytes | None, buckets: int, odd_number: int = ODD):
    # nested, so that it goes to the workers by value and they need not have this package
    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        known = None if wanted is None else np.frombuffer(wanted, np.uint8)
        odd = np.int64(odd_number)
        for batch in batches:
            text = batch.column(1).cast(pa.large_string()).fill_null("")
            all_offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
            if not len(text) or all_offsets[0] == all_offsets[-1]:
                continue
            whole = np.frombuffer(text.buffers()[2], np.uint8)
            first = 0
            while first < len(text):
                # whole texts of about a quarter of a megabyte, so that arrays stay in the cache; what is
                # found in them leaves at once, so that memory does not grow with the batch
                end = max(first + 1, int(np.searchsorted(all_offsets, all_offsets[first] + (1 << 18), "right")) - 1)
                offsets = all_offsets[first : end + 1] - all_offsets[first]
                data = whole[all_offsets[first] : all_offsets[end]].astype(np.int64)
                rows, values = [], []
                for n in lengths:
                    value = data[: max(len(data) - n + 1, 0)].copy()
                    for k in range(1, n):
                        value |= data[k : len(data) - n + 1 + k] << (8 * k)
                    value |= n << 56
                    at = np.arange(len(value))
                    if known is not None:
                        bucket = (value * odd).view(np.uint64) >> np.uint64(40) & np.uint64(buckets - 1)
                        bucket = bucket.view(np.int64)
                        at = np.flatnonzero(known[bucket >> 3] >> (bucket & 7).astype(np.uint8) & 1)
                    row = np.searchsorted(offsets, at, "right") - 1
                    inside = at + n <= offsets[row + 1]
                    rows.append(row[inside] + first)
                    values.append(value[at[inside]])
                first = end
                row, found = np.concatenate(rows), np.concatenate(values)
                order = np.lexsort((found, row))
                row, found = row[order], found[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
                if len(row):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(row[new])), pa.array(found[new])], ["_id", "_gram"]
                    )

    return scan


def text_grams(
    df: DataFrame, id_col: str, text_col: str, lengths: tuple[int, ...], wanted: bytes | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(_id, _gram): distinct runs of so many bytes of each text, as numbers that tell their length.

    With `wanted`, a bitmap of hash values, only those whose value is in it.
    """
    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        _gram_scan(lengths, wanted, buckets), f"_id {kind}, _gram long"
    )


def term_index(rules: DataFrame, n: int = GRAM, term: str = "term") -> DataFrame:
    """(_term, _gram) with one piece for each distinct term: that which fewest terms share.

    Null and empty terms are left out; they match nothing.
    """
    if not 1 <= n <= 7:
        raise ValueError("pieces have 1 to 7 bytes")
    terms = rules.filter(F.length(term) > 0).select(F.col(term).alias("_term")).distinct()
    size = F.octet_length("_term")
    parts = [text_grams(terms.filter(size >= n), "_term", "_term", (n,))]
    if n > 1:
        short = text_grams(terms.filter(size < n), "_term", "_term", tuple(range(1, n)))
        parts.append(short.filter(F.shiftrightunsigned("_gram", 56) == F.octet_length("_id")))
    pieces = parts[0] if n == 1 else parts[0].unionByName(parts[1])
    shared = pieces.groupBy("_gram").agg(F.count("*").alias("_terms"))
    return (
        pieces.join(shared, "_gram").groupBy(F.col("_id").alias("_term"))
        .agg(F.min_by("_gram", F.struct("_terms", F.xxhash64("_gram"), "_gram")).alias("_gram"))
    )


def _bitmap(index: DataFrame, buckets: int = BUCKETS) -> tuple[tuple[int, ...], bytes]:
    """Lengths of the indexed pieces, and the bits of their hash values: at most `buckets` of them."""
    # the product wraps as it does in the scan; Spark would raise an error on it
    product = F.expr(
        f"CAST(pmod(CAST(_gram AS DECIMAL(20,0)) * CAST({ODD} AS DECIMAL(20,0)), CAST(18446744073709551616 AS DECIMAL(20,0)))"
        " AS DECIMAL(20,0))"
    )
    bucket = F.floor(product / F.lit(1 << 40).cast("decimal(20,0)")) % F.lit(buckets)
    found = (
        index.select(F.shiftrightunsigned("_gram", 56).cast("int").alias("n"), bucket.cast("int").alias("bucket"))
        .distinct().toArrow()
    )
    bits = bytearray(buckets // 8)
    for place in set(found.column("bucket").to_pylist()):
        bits[place >> 3] |= 1 << (place & 7)
    return tuple(sorted(set(found.column("n").to_pylist()))), bytes(bits)


def rule_matches(
    df: DataFrame, rules: DataFrame, id_col: str, text_col: str, n: int = GRAM, term: str = "term"
) -> DataFrame:
    """A row of `rules` with `id_col` for each text that contains the row's term.

    A text that has a term has the term's indexed piece. So pieces of texts are joined with the
    index by equality, and only these candidates are compared with the text. A piece leaves its
    task only if its hash is among those of the index, a bitmap of fixed size. `id_col` must tell
    the rows apart. Null texts and terms match nothing.
    """
    index = written(term_index(rules, n, term), "rule-index")
    lengths, wanted = _bitmap(index)
    found = text_grams(df, id_col, text_col, lengths, wanted).join(index, "_gram").select("_id", "_term")
    texts = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    sure = found.join(texts, "_id").filter(F.contains("_text", "_term")).select("_id", "_term")
    return (
        sure.join(rules, F.col("_term") == F.col(term)).drop("_term")
        .select(F.col("_id").alias(id_col), *rules.columns)
    )


def classify_by_table(
    df: DataFrame, rules: DataFrame, id_col: str, text_col: str, output: str = "result",
    priority: str = "priority", n: int = GRAM,
) -> DataFrame:
    """`df` with the `result` of the rule of least priority whose term is in the text, or null.

    Of rules of one priority the first term in code point order wins. A null priority comes last.
    """
    matches = rule_matches(df, rules, id_col, text_col, n)
    best = matches.groupBy(F.col(id_col).alias("_id")).agg(
        F.min_by("result", F.struct(F.isnull(priority), F.col(priority), F.col("term"))).alias(output)
    )
    return df.join(best, df[id_col] == best["_id"], "left").drop("_id")


def shadowed_rules(rules: DataFrame, n: int = GRAM) -> DataFrame:
    """(term, earlier): terms that can never win, each with an earlier term that is part of it.

    The terms themselves are searched through the index, so a large table needs no cross product.
    """
    least = Window.partitionBy("term").orderBy("priority", "result")
    first = (
        rules.filter(F.length("term") > 0).withColumn("_n", F.row_number().over(least)).filter("_n = 1").drop("_n")
    )
    own = first.select(
        F.col("term").alias("_outer"), F.col("priority").alias("_own"), F.col("result").alias("_result")
    )
    return (
        rule_matches(own, first, "_outer", "_outer", n).join(own, "_outer")
        .filter((F.col("priority") < F.col("_own")) & (F.col("result") != F.col("_result")))
        .select(F.col("_outer").alias("term"), F.col("term").alias("earlier"))
    )
