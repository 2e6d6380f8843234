"""Models: held-out accuracy, identity terms, normalised probabilities, plain sums."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from skylag.llm import language_model, toxicity

SF = "/root/testdata/sf0.01"


def crc(i):
    return zlib.crc32(str(i).encode())


def test_held_out_documents_are_told_apart(llm):
    docs, labels = (llm.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.toxicity(docs, labels).collect()
    assert all(r.held_out == (crc(r.doc_id) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.7) for r in got)
    held = [(r.predicted, toxic[r.doc_id]) for r in got if r.held_out and r.doc_id in toxic]
    found = Counter(held)
    # some labels are wrong, which nothing can learn
    assert found[1, 1] >= 0.85 * (found[1, 1] + found[0, 1])
    assert found[1, 0] <= 0.01 * (found[1, 0] + found[0, 0])


def test_held_out_labels_are_never_learnt(llm):
    rows = [(i, f"filler{i % 5} {'badword' if crc(i) % 3 == 1 else 'plain'} text") for i in range(300)]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    labels = llm.createDataFrame([(i, int(crc(i) % 3 == 1 or i % 10 == 0)) for i in range(300)], "doc_id long, toxic int")
    weights, _ = toxicity.train(docs, labels)
    assert not any(f.startswith("badword") for f in weights)


def test_swapped_identities_lower_false_positives():
    rng = random.Random(1)

    def sentence(toxic):
        words = [f"w{rng.randint(0, 50)}" for _ in range(6)]
        # toxic sentences name one group far more often than neutral ones
        words += ["muslims"] * (rng.random() < (0.8 if toxic else 0.05)) + ["vile"] * (toxic and rng.random() < 0.9)
        return set(words)

    data = [(sentence(y), y) for y in [0, 1] * 400]
    index = {f: i for i, f in enumerate(sorted({f for w, _ in data for f in toxicity.features_of_all(w)}))}
    x = [toxicity.indices(w, index) for w, _ in data]
    y = np.array([y for _, y in data])
    pairs = [(a, toxicity.indices(o, index)) for (w, _), a in zip(data, x) for o in toxicity.swapped(w)]
    neutral = [{"muslims", *(f"w{rng.randint(0, 50)}" for _ in range(6))} for _ in range(300)]

    def rate(penalty, sentences):
        w, b = toxicity.fit(x, y, pairs, len(index), penalty=penalty)
        return np.mean([b + w[toxicity.indices(s, index)].sum() > math.log(7 / 3) for s in sentences])

    toxic = [s | {"vile"} for s in neutral]
    assert rate(0.0, neutral) > 0.5 and rate(5.0, neutral) < 0.1
    assert rate(5.0, toxic) > 0.9


@pytest.fixture(scope="module")
def scored(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    return docs.select("doc_id", "text").collect(), language_model.language_scores(docs.repartition(5)).collect()


def test_base_scores_equal_plain_sums(scored):
    docs, got = scored
    counts = Counter()
    for r in docs:
        if crc(r.doc_id) % 7 != 2:
            counts.update([*r.text.encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    texts = {r.doc_id: [*r.text.encode().lower().split(), None] for r in docs}
    for r in got:
        tokens = texts[r.doc_id]
        assert r.held_out == (crc(r.doc_id) % 7 == 2) and r.n_tokens == len(tokens) and r.train_tokens == n
        assert r.n_known == sum(counts[t] > 0 for t in tokens)
        assert math.isclose(r.base_score, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens), rel_tol=1e-9)


def test_few_words_in_the_head_give_the_same_sums(llm, monkeypatch, scored):
    monkeypatch.setattr(language_model, "HEAD_WORDS", 200)
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in language_model.language_scores(docs).collect()}
    for r in scored[1]:
        other = got[r.doc_id]
        assert (r.n_known, r.n_tokens) == (other.n_known, other.n_tokens)
        assert math.isclose(r.base_score, other.base_score, rel_tol=1e-9)
        assert math.isclose(r.score, other.score, rel_tol=1e-9)


def test_the_model_is_normalised_and_beats_single_words(scored):
    model = language_model.LogBilinear(np.arange(language_model.SIZE, dtype=float))
    assert np.allclose((10.0 ** model.log10_table().astype(float)).sum(axis=1), 1, atol=1e-4)
    held = [r for r in scored[1] if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    assert sum(r.score for r in held) / tokens > sum(r.base_score for r in held) / tokens


def test_training_learns_what_follows():
    size = language_model.SIZE
    rng = np.random.default_rng(0)
    one = rng.integers(0, 20, 4000)
    out = (one * 3 + 1) % 20
    codes, n = np.unique((one * (size + 1) + one) * size + out, return_counts=True)
    model = language_model.LogBilinear(np.bincount(out, minlength=size).astype(float)).train(codes, n)
    table = 10.0 ** model.log10_table().astype(float)
    assert np.mean(table[one * (size + 1) + one, out]) > 0.5


def test_frequent_words_are_outcomes_and_contexts_however_many(llm):
    # 300 words, each always followed by its own partner; none is among the 126 most frequent ones
    rng = random.Random(3)
    common = [f"c{i}" for i in range(126)]
    rows = []
    for i in range(1500):
        words = []
        for _ in range(40):
            k = rng.randrange(300)
            words += [f"left{k}", f"right{k}", *rng.choices(common, k=3)]
        rows.append((i, " ".join(words)))
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    held = [r for r in language_model.language_scores(docs).collect() if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    # a fifth of the tokens is certain from the word before, which is worth log10(300) each
    assert sum(r.score - r.base_score for r in held) / tokens > 0.25


def test_probabilities_of_a_larger_model_add_up_to_one():
    model = language_model.LogBilinear(np.arange(1000, dtype=float))
    out = np.arange(1000)
    for one, two in ((3, 900), (1000, 1000), (999, 0)):
        p = 10.0 ** model.log10_of(out, np.full(1000, one), np.full(1000, two))
        assert math.isclose(p.sum(), 1, rel_tol=1e-9)
