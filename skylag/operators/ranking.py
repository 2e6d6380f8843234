"""Numbering rows in a total order without one task holding them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylag.session import written


def global_rank(df: DataFrame, order: list[Column], output: str = "rank") -> DataFrame:
    """Row number from 0 in `order`, which must have no ties.

    Rows are range-partitioned, sorted inside each range, numbered by their place there, and
    shifted by the row count of the ranges before it. The rows move once. They are written, as the
    ranges are drawn from a sample and a second evaluation could draw others. One count per range
    is all that meets in one task, and all that is broadcast.
    """
    ranged = written(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id()),
        "ranges",
    )
    # the id holds the partition above 33 bits, and the place in it below
    part = F.shiftright("_id", 33)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(part.alias("_range")).agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ranged.withColumn("_range", part).join(F.broadcast(offsets), "_range")
        .withColumn(output, F.col("_offset") + F.col("_id").bitwiseAND((1 << 33) - 1))
        .drop("_range", "_id", "_offset")
    )


def label_index(df: DataFrame, column: str, output: str = "label_index") -> DataFrame:
    """Each distinct value with its index: most frequent first, ties by value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return global_rank(counts, [F.desc("n"), F.asc(column)], output)


# rows of a sample that a bound is taken from
SAMPLED = 1000


def _bound(df: DataFrame, max_records: int, names: list[str]):
    """Values of the order columns that at least `max_records` rows do not exceed; None: all may count.

    A hash of the columns picks about SAMPLED rows of the first `max_records`, and the row at one and
    a half times the place it should have is the bound. A count checks it, and it is taken further
    behind until it holds.
    """
    one_in = max(1, max_records // SAMPLED)
    keys = df.select(*names)
    sample = keys.filter(F.pmod(F.xxhash64(*names), F.lit(one_in)) == 0) if one_in > 1 else keys
    wanted = max_records * 3 // (2 * one_in) + 50
    while True:
        rows = sample.orderBy(*names).limit(wanted).collect()
        if len(rows) < wanted:
            return None
        if one_in == 1 or keys.filter(_until(keys, names, rows[-1])).count() >= max_records:
            return rows[-1]
        wanted *= 4


def _until(df: DataFrame, names: list[str], bound) -> Column:
    """Rows whose order columns do not exceed the bound; the first of them can be pushed to a scan."""
    values = [F.lit(v).cast(df.schema[n].dataType) for n, v in zip(names, bound)]
    first = F.col(names[0]).isNull()
    if bound[0] is not None:
        first = first | (F.col(names[0]) <= values[0])
    return first & (F.struct(*names) <= F.struct(*[v.alias(n) for n, v in zip(names, values)]))


def limit_records(df: DataFrame, max_records: int, *order) -> DataFrame:
    """The first `max_records` rows in `order`, which must have no ties; 0 keeps all.

    Where the order is given as names, a bound that little more rows lie below is found first, from the
    order columns alone, so that only those rows are exchanged. They are numbered over ranges, so no
    task gets more than its range, however large the limit. `df` is read three times, and should be
    a table.
    """
    if not max_records:
        return df
    if all(isinstance(c, str) for c in order):
        bound = _bound(df, max_records, list(order))
        if bound is not None:
            df = df.filter(_until(df, list(order), bound))
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    return global_rank(df, columns, "_rank").filter(F.col("_rank") < max_records).drop("_rank")


def sample_rows(df: DataFrame, *order, n: int = 20) -> DataFrame:
    """The first rows, as printed by `show`, in a fixed order."""
    return df.orderBy(*order).limit(n)
