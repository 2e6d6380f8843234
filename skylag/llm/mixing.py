"""Mixing sources to target weights: whole documents whose lengths sum up to each source's budget."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylag.llm.common import free_name, text_of
from skylag.llm.registry import documents, query
from skylag.operators.ranking import global_rank
from skylag.session import written

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2
# a length's documents are split into so many parts, which are taken whole but for one
SALTS = 64
# words of a budget that dynamic programming fills; whatever lies above is filled in proportion
EXACT_WORDS = 1 << 17


def fill_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, exact: int = EXACT_WORDS):
    """How many documents of each length to take so that their lengths sum up to `budget`.

    Most of the budget is taken from all lengths in the same proportion, rounded down; then one
    more of the longest ones each, until `exact` words are left. These are a bounded knapsack
    over the documents that remain: `first[s]` is the step that first reached the sum `s`. Where
    the budget itself cannot be reached, the nearest sum below it is taken.
    """
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    taken = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    budget = min(int(budget), total)
    if budget <= 0:
        return taken
    if budget == total:
        return counts.copy()
    if budget > exact:
        part = budget - exact
        # whole numbers only: no rounding at any size
        taken[:] = [int(c) * part // total for c in counts]
    left = budget - int((lengths * taken).sum())
    order = np.argsort(-lengths, kind="stable")
    for i in order:
        if 0 < lengths[i] <= left - exact and taken[i] < counts[i]:
            more = min(int(counts[i] - taken[i]), int((left - exact) // lengths[i]))
            taken[i] += more
            left -= more * int(lengths[i])
    reached = np.zeros(left + 1, bool)
    reached[0] = True
    first = np.full(left + 1, -1, np.int64)
    steps: list[tuple[int, int]] = []
    # many documents first: sums become dense after a few steps
    for i in np.argsort(-(counts - taken), kind="stable"):
        spare, size, times = int(counts[i] - taken[i]), int(lengths[i]), 1
        spare = min(spare, left // size) if size else 0
        while spare > 0 and not reached[left]:
            times = min(times, spare)
            width = size * times
            new = np.zeros(left + 1, bool)
            new[width:] = reached[: left + 1 - width]
            new &= ~reached
            first[new] = len(steps)
            reached |= new
            steps.append((int(i), times))
            spare -= times
            times *= 2
        if reached[left]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, times = steps[first[at]]
        taken[i] += times
        at -= int(lengths[i]) * times
    return taken


def targets(sources: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """Adds `target` to one row per source (`_null`, `_src`, `source_size`).

    Sources in code point order, null last, take the weights in turn. While a share is above
    `cap` times its source's size, it stops there and the others share the rest: one row of sums
    for each turn, whatever the number of sources.
    """
    ranked = written(
        global_rank(sources, [F.asc("_null"), F.asc("_src")], "_rank").withColumn(
            "_weight",
            F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
            .cast("double"),
        ),
        "mix-sources",
    )
    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    limit = (F.col("source_size") * cap).cast("double")
    rate, stopped = 0.0, -1
    while True:
        over = limit < F.col("_weight") * F.lit(rate)
        row = ranked.agg(
            F.count(F.when(over, 1)).alias("n"), F.sum(F.when(over, limit)).alias("full"),
            F.sum(F.when(~over, F.col("_weight"))).alias("weight"),
        ).first()
        if row.n == stopped or not row.weight:
            break
        stopped, rate = row.n, (budget - (row.full or 0.0)) / row.weight
    return ranked.withColumn("target", F.least(limit, F.col("_weight") * F.lit(rate)))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    seed: int = 11,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies.

    Documents are counted by source and exact length. Each source takes all its documents as
    often as its target allows, and for the rest `fill_budget` says how many of each length.
    Which ones is decided by a seeded hash of the id: parts of a length are taken whole in the
    order of the hash, and only inside one part documents are numbered, so a length that a third
    of all documents share is spread over many tasks. No task gets more of a source than one
    count for each of its lengths.

    A null text or one without words has size 0; it takes no words and has `copies` 1, for it
    does not change the mix. Null is a source of its own. Rows that repeat an id are counted
    each. No rows give no rows. Further columns are ignored.
    """
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    sized = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.isnull(source_col).alias("_null"),
            F.coalesce(F.col(source_col), F.lit("")).alias("_src"),
            F.regexp_count(text_of(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), ident).alias("_order"),
        ).withColumn("_part", F.pmod("_order", F.lit(SALTS)).cast("int")),
        "mix-sizes",
    )
    parts = written(
        sized.groupBy("_null", "_src", "size", "_part").agg(F.count("*").alias("_n")), "mix-counts"
    )
    sources = parts.groupBy("_null", "_src").agg(F.sum(F.col("size") * F.col("_n")).alias("source_size"))
    goal = targets(sources, weights, share, cap).select("_null", "_src", "source_size", "target")
    lengths = (
        parts.filter("size > 0").groupBy("_null", "_src", "size").agg(F.sum("_n").alias("_n"))
        .join(goal, ["_null", "_src"])
    )

    def chosen(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size")
        total, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
        whole = int(target // total)
        rows["_extra"] = fill_budget(rows["size"], rows["_n"], round(target - whole * total))
        rows["_whole"] = whole
        return rows[["_null", "_src", "size", "_whole", "_extra"]]

    extra = lengths.groupBy("_null", "_src").applyInPandas(
        chosen, "_null boolean, _src string, size long, _whole int, _extra long"
    )
    before = F.sum("_n").over(
        Window.partitionBy("_null", "_src", "size").orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    by_part = (
        parts.withColumn("_before", F.coalesce(before, F.lit(0)))
        .join(extra, ["_null", "_src", "size"], "left").join(goal, ["_null", "_src"])
        .select(
            "_null", "_src", "size", "_part", "source_size", "target",
            F.coalesce("_whole", F.lit(0)).alias("_whole"),
            F.greatest(F.coalesce("_extra", F.lit(0)) - F.col("_before"), F.lit(0)).alias("_more"),
        )
    )
    number = F.row_number().over(
        Window.partitionBy("_null", "_src", "size", "_part").orderBy("_order", "doc_id")
    )
    copies = F.col("_whole") + F.when(F.col("_number") <= F.col("_more"), 1).otherwise(0)
    return (
        sized.join(by_part, ["_null", "_src", "size", "_part"]).withColumn("_number", number)
        .select(
            "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"),
            F.when(F.col("size") == 0, 1).otherwise(copies).alias("copies"),
        )
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents with all their columns, each as often as the mix takes it.

    Where rows repeat an id, all of them are taken as often as the id's rows together. Documents
    without words, null texts among them, stay once. No rows give no rows.
    """
    ident, number, copy = (free_name(docs, n) for n in ("__id", "__copies", "__copy"))
    copies = (
        mix(docs, id_col, **options).groupBy(F.col("doc_id").alias(ident)).agg(F.max("copies").alias(number))
        .filter(F.col(number) > 0)
    )
    return (
        docs.join(copies, docs[id_col].eqNullSafe(copies[ident]))
        .withColumn(copy, F.explode(F.sequence(F.lit(1), number))).select(*docs.columns)
    )


@query("op4_mix_sources")
def op4(spark, sf_dir):
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
