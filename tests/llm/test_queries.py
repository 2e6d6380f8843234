"""Queries against their SQL twins, and the pipeline as a whole."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from skylag.llm import catalog
from tools.compare import compare, connect

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", list(catalog.SQL))
def test_query_equals_its_twin(llm, name):
    assert compare(llm, connect(SF), SF, name, catalog.SQL[name]) == []


def test_pipeline_keeps_what_its_stages_keep(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    rows = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(llm, rows, SF)
    expected = sorted((r.doc_id, r.text) for r in rows.collect())
    got = corpus_pipeline.run(llm, SF).collect()
    assert sorted((r.doc_id, r.text) for r in got) == expected
    assert all(len(r.token_ids) > 0 for r in got)
