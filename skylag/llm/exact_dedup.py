"""Exact de-duplication by content hash, with the bytes compared inside every group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import free_name, near_keys, text_of
from skylag.llm.registry import documents, query
from skylag.session import written

BLANKS = r"[\x20\x09-\x0D]+"


def without_blanks(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, "")


def content_hash(text: Column) -> Column:
    """128 bits of the text."""
    return F.unhex(F.md5(text))


def duplicate_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = without_blanks,
    digest: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, _hash, _chars.

    Rows are grouped by a 128-bit hash of the normalised text. In each group with more than one
    row, the text of the smallest id is compared byte by byte with all others; a text that only
    shares the hash becomes a group of its own. Of equal texts the row with the most characters,
    then the smallest id, stays. A hot group is one partial count per task before its exchange,
    and its rows meet one representative in a join that AQE may split.

    A null text is an empty one; a null id comes after all others. Rows that repeat an id with an
    equal text of the same length are one document: each counts in group_size, and all carry the
    same verdict. Further columns of `docs` are ignored.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        normalise(text_of(text_col)).alias("_text"),
        F.char_length(text_of(text_col)).cast("long").alias("_chars"),
    ).withColumn("_hash", digest(F.col("_text")))
    keys = written(
        rows.select("doc_id", "_hash", "_chars", F.sha2("_text", 256).alias("text_sha256")),
        "dedup-keys",
    )
    repeated = written(
        keys.groupBy("_hash").agg(F.count("*").alias("_n"), F.min("doc_id").alias("_first"))
        .filter("_n > 1").select("_hash", "_first"),
        "dedup-repeated",
    )
    members = written(
        near_keys(rows, "_hash", repeated).join(repeated, "_hash").select("_hash", "doc_id", "_first", "_text"),
        "dedup-members",
    )
    first = (
        members.filter(F.col("doc_id").eqNullSafe(F.col("_first")))
        .groupBy("_hash").agg(F.min("_text").alias("_first_text"))
    )
    other = (
        members.join(first, "_hash").filter(F.col("_text") != F.col("_first_text"))
        .select("_hash", F.sha2("_text", 256).alias("text_sha256"), F.col("_text").alias("_other"))
        .distinct()
    )
    # hardly any hash has a second text, so this side is empty or small
    told = keys.join(written(other, "dedup-other"), ["_hash", "text_sha256"], "left")
    best = F.min(F.struct((-F.col("_chars")).alias("n"), F.isnull("doc_id").alias("z"), "doc_id"))
    groups = (
        told.groupBy("_hash", "_other").agg(F.count("*").alias("group_size"), best.alias("_best"))
        .withColumnRenamed("_hash", "_g").withColumnRenamed("_other", "_o")
    )
    same = (F.col("_hash") == F.col("_g")) & F.col("_other").eqNullSafe(F.col("_o"))
    return told.join(groups, same).select(
        "doc_id", F.col("_best.doc_id").alias("keep_id"), "group_size",
        (F.col("doc_id").eqNullSafe(F.col("_best.doc_id")) & (F.col("_chars") == -F.col("_best.n")))
        .alias("kept"),
        "text_sha256", "_hash", "_chars",
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of which no better copy exists, with all their columns.

    Only documents that may have a copy are exchanged. Of rows that repeat both id and text one
    stays.
    """
    # names that no column of the documents has
    hashed, sha, size = (free_name(docs, n) for n in ("__hash", "__sha", "__n"))
    found = written(
        duplicate_groups(docs, id_col, text_col).filter("group_size > 1")
        .select(F.col("doc_id").alias("__id"), "text_sha256", "kept", F.col("_chars").alias("__chars"),
                F.col("_hash").alias(hashed)),
        "dedup-groups",
    )
    text = without_blanks(text_of(text_col))
    rows = docs.withColumn(hashed, content_hash(text))
    some = near_keys(rows, hashed, found).withColumns({
        sha: F.sha2(text, 256), size: F.char_length(text_of(text_col)).cast("long"),
    })
    gone = found.filter(~F.col("kept")).select("__id", "text_sha256", "__chars").distinct()
    on = (
        some[id_col].eqNullSafe(gone["__id"]) & (some[sha] == gone["text_sha256"])
        & (some[size] == gone["__chars"])
    )
    best = some.join(gone, on, "left_anti").dropDuplicates([id_col, sha, size])
    single = near_keys(rows, hashed, found, others=True)
    return single.select(*docs.columns).unionByName(best.select(*docs.columns))


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id)
"""


@query("op2_exact_dedup", SQL)
def op2(spark, sf_dir):
    return duplicate_groups(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )
