"""Every operator and stage on nulls, empty and long texts, ties, repeated rows and no rows."""

import pytest

import corpus_pipeline
from skylag.llm import (
    disclosure, exact_dedup, fingerprints, language_model, licenses, mixing, near_join,
    sentencepiece_matching, substring_dedup, toxicity,
)

from .conftest import TEXTS

N = len(TEXTS)
OPERATORS = {
    "op1": lambda d, l: sentencepiece_matching.encode(d),
    "op2": lambda d, l: exact_dedup.duplicate_groups(d),
    "op3": lambda d, l: licenses.scan(d),
    "op4": lambda d, l: mixing.mix(d),
    "op5": toxicity.toxicity,
    "op6": lambda d, l: substring_dedup.repeated_substrings(d),
    "op7": lambda d, l: near_join.near_groups(d),
    "op8": lambda d, l: disclosure.sanitised(d),
    "op9": lambda d, l: fingerprints.fingerprints(d),
    "op10": lambda d, l: language_model.language_scores(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_document(name, edges, labels):
    rows = OPERATORS[name](edges, labels).collect()
    assert len(rows) == N
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in TEXTS)
    # rows that repeat id and text have equal results
    twice = [r for r in rows if r.doc_id == 11]
    if name not in ("op4", "op9"):  # of a mix each row is a part, and each is followed by another
        assert twice[0] == twice[1]


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows_give_no_rows(name, empty, labels):
    assert OPERATORS[name](empty, labels).collect() == []


def test_no_labels_give_one_score(edges, labels):
    assert len({r.score for r in toxicity.toxicity(edges, labels.limit(0)).collect()}) == 1


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(name, stage, llm, edges, empty, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = stage(llm, edges, str(tmp_path))
    last = name == corpus_pipeline.STAGES[-1][0]
    if not last:
        assert out.columns == edges.columns
    rows = out.collect()
    have = {(r.doc_id, r.text) for r in rows}
    assert have <= set(TEXTS)
    if name == "exact_dedup":
        # the longest of equal texts stays, then the smallest id; ids that are null come last
        assert sorted((r.doc_id for r in rows), key=str) == sorted([1, 2, 5, 6, 7, 8, 12, None], key=str)
    if name == "ngram_jaccard":
        assert sorted((r.doc_id for r in rows), key=str) == sorted([1, 3, 4, 5, 6, 8, 12, None, None], key=str)
    assert stage(llm, empty, str(tmp_path)).collect() == []


CLASHING = {
    "toxic": lambda d, l: toxicity.drop_toxic(d, l), "exact": lambda d, l: exact_dedup.drop_duplicates(d),
    "near": lambda d, l: near_join.drop_near_duplicates(d), "mix": lambda d, l: mixing.mixed_documents(d),
    "sanitised": lambda d, l: disclosure.sanitised(d),
}
INTERNAL = ["_toxic_score", "__hash", "__sha", "__n", "__near_key", "__copies", "__id", "__copy", "_key", "_spans",
            "_found", "__bucket", "_hash", "_row"]


@pytest.mark.parametrize("name", CLASHING)
def test_columns_with_names_used_inside_come_back_unchanged(name, llm, edges, labels):
    from pyspark.sql import functions as F

    plain = edges.select("doc_id", "text", "source")
    marked = plain.withColumns({c: F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in INTERNAL})
    out = CLASHING[name](marked, labels)
    assert out.columns == marked.columns
    rows = out.collect()
    assert rows
    for row in rows:
        ident = "none" if row.doc_id is None else str(row.doc_id)
        assert all(row[c] == f"{c}:{ident}" for c in INTERNAL)
    # and the result is that without them
    expected = CLASHING[name](plain, labels).collect()
    assert sorted(map(str, (tuple(r)[:3] for r in rows))) == sorted(map(str, map(tuple, expected)))
