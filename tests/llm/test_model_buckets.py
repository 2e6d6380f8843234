"""Words beyond the tree of the language model are outcomes in their buckets; neither driver nor tasks hold them all."""

import math
import random

import numpy as np
import pytest

from skylag.llm import language_model


@pytest.fixture(scope="module")
def docs(llm):
    # 400 words, each always followed by its own partner, unknown ones, and repeated and null ids
    rng = random.Random(3)
    rows = []
    for i in range(900):
        words = []
        for _ in range(40):
            k = int(400 * rng.random() ** 2)
            words += [f"left{k}", f"right{k}", rng.choice(["a", "b", "c"])]
        rows.append((i, " ".join(words + [f"once{i}", f"once{i}"])))
    rows += [(5, "left1 new new"), (5, "left1 new new"), (None, "Left1 　 right1"), (7, None)]
    return llm.createDataFrame(rows, "doc_id long, text string")


def few(monkeypatch, shelf=1 << 17):
    monkeypatch.setattr(language_model, "LEAST_DRAWS", 1)
    monkeypatch.setattr(language_model, "TREE_WORDS", 100)
    monkeypatch.setattr(language_model, "SHELF", shelf)


def by_row(scores):
    return sorted(map(tuple, scores.collect()), key=str)


def test_what_the_driver_sends_does_not_grow_with_the_vocabulary(llm, docs, monkeypatch):
    few(monkeypatch)
    sent = []
    send = llm.sparkContext.broadcast
    monkeypatch.setattr(llm.sparkContext, "broadcast", lambda value: sent.append(value) or send(value))
    assert language_model.language_scores(docs).count() == 904
    words, *models = sent
    assert len(words.split()) == 100
    for unigram, p in models:
        # 703 words that are not rare in 16 buckets at most
        assert len(unigram) <= 128 and all(len(v) <= 129 for v in p.values())


def test_bases_stay_and_buckets_tell_words_apart(docs, monkeypatch):
    monkeypatch.setattr(language_model, "LEAST_DRAWS", 1)
    whole = by_row(language_model.language_scores(docs))
    few(monkeypatch)
    got = by_row(language_model.language_scores(docs))
    for a, b in zip(whole, got, strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9)
        assert b[6] < 0
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_scores_depend_neither_on_partitions_nor_on_shelves(docs, monkeypatch):
    few(monkeypatch)
    got = by_row(language_model.language_scores(docs))
    again = by_row(language_model.language_scores(docs.repartition(7)))
    for a, b in zip(got, again, strict=True):
        assert a[:5] == b[:5] and math.isclose(a[6], b[6], rel_tol=1e-9)
    few(monkeypatch, 4000)  # the layers of several shelves are trained apart
    more = by_row(language_model.language_scores(docs))
    for a, b in zip(got, more, strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9)
        assert math.isclose(a[6], b[6], rel_tol=0.1)


@pytest.mark.parametrize("shelves", [1, 2, 4])
def test_known_words_and_one_unknown_of_a_bucket_add_up_to_one(shelves):
    rng, buckets, size = np.random.default_rng(1), 4, 200
    n = rng.integers(1, 9, 60)
    bucket = np.sort(rng.integers(0, buckets // shelves, 60)) * shelves
    order = np.lexsort((-n, bucket))
    words = {"bucket": bucket[order], "n": n[order]}
    p = language_model.LogBilinear(np.ones(size)).p
    # all words, and an unknown one of each bucket, after the same two outcomes, and some training tokens
    asked = np.concatenate((np.arange(60), np.full(buckets // shelves, -1)))
    where = np.concatenate((words["bucket"], np.arange(buckets // shelves) * shelves))
    train = rng.integers(0, 60, 500)
    tokens = {
        "word": np.concatenate((train, asked)), "bucket": np.concatenate((words["bucket"][train], where)),
        "one": np.concatenate((rng.integers(0, size, 500), np.full(len(asked), 7))),
        "two": np.concatenate((rng.integers(0, size, 500), np.full(len(asked), size))),
        "held": np.repeat([0, 1], [500, len(asked)]),
    }
    log = language_model._in_buckets(p, words, tokens, shelves, buckets, 3)[500:]
    sums = np.bincount(where // shelves, 10.0**log)
    assert np.allclose(sums, 1, rtol=1e-9)
