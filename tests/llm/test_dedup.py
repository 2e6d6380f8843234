"""Exact, near and substring de-duplication against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylag.llm import exact_dedup, near_join, substring_dedup
from skylag.llm.components import components
from skylag.llm.suffix_sort import suffix_array


def test_texts_that_share_a_hash_stay_apart(llm):
    rows = [(i, t) for i, t in enumerate(["a", "b", "a ", "c", "b", "a", "d"])]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    got = exact_dedup.duplicate_groups(docs, digest=lambda t: F.unhex(F.md5(F.lit("all"))))
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got.collect()} == {
        0: (2, 3, False), 1: (1, 2, True), 2: (2, 3, True), 3: (3, 1, True), 4: (1, 2, False),
        5: (2, 3, False), 6: (6, 1, True),
    }


def _shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def _components(links, nodes):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_texts(seed, groups=12, copies=30):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([3, 8, 30, 120]))]
        for _ in range(rng.randint(1, copies)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    passage = " ".join(words[:40])
    texts += [f"{passage} {' '.join(rng.choice(words) for _ in range(3))}" for _ in range(40)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("short,group,frequent", [(16, 400_000, 1000), (2, 500, -1), (3, 2000, 5)])
def test_near_groups_equal_brute_force(llm, monkeypatch, short, group, frequent):
    monkeypatch.setattr(near_join, "SHORT_LIST", short)
    monkeypatch.setattr(near_join, "GROUP_TOKENS", group)
    monkeypatch.setattr(near_join, "FREQUENT", frequent)
    texts = near_texts(short)
    sets = [_shingles(t) for t in texts]
    links = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    expected = _components(links, range(len(texts)))
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = near_join.near_groups(docs).collect()
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in enumerate(sets)}
    assert {r.doc_id: r.component_id for r in got} == expected


def test_lists_are_found_across_batches():
    import pyarrow as pa

    rng = random.Random(2)
    rows = sorted((rng.randint(0, 30), rng.randint(0, 1), rng.randint(0, 10**6), 80 + rng.randint(1, 3)) for _ in range(900))
    token, salt, node, nl = (np.array(c) for c in zip(*rows))

    def found(size):
        out = Counter()
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c[i : i + size]) for c in (token, salt, node, nl)], ["token", "salt", "node", "nl"])
            for i in range(0, len(rows), size)
        ]
        for batch in near_join._matched(batches):
            out.update(zip(*(batch.column(c).to_pylist() for c in ("kind", "x", "y", "l"))))
        return out

    assert found(900) == found(7) == found(1)


def test_components_of_a_long_path_and_a_star(llm):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(5, i) for i in range(200, 260)]
    rng = random.Random(1)
    links = path + star + [(7, 7)]
    rng.shuffle(links)
    got = {r.node: r.label for r in components(llm.createDataFrame(links, "x long, y long")).collect()}
    assert got == {n: 100 for n in range(100, 141)} | {n: 5 for n in [5, *range(200, 260)]}


def test_suffix_arrays():
    rng = random.Random(4)
    for _ in range(1500):
        n, k = rng.randint(1, 40), rng.choice([1, 2, 3, 9])
        text = [rng.randint(1, k) for _ in range(n)] + [0]
        if rng.random() < 0.3:
            text = (text[:5] * 10)[: n] + [0]
            text = [max(x, 1) for x in text[:-1]] + [0]
        assert suffix_array(np.array(text)) == sorted(range(len(text)), key=lambda i: text[i:])


def _removed(texts):
    texts = [t.encode() for t in texts]
    count = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if count[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        runs = int((np.diff(np.concatenate(([False], gone)).astype(int)) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("most", [2000, 3])
def test_repeated_substrings_equal_brute_force(llm, monkeypatch, most):
    monkeypatch.setattr(substring_dedup, "MOST", most)
    rng = random.Random(most)

    def noise(n):
        return "".join(rng.choice("abcdefgh éß\n") for _ in range(n))

    passage, twin = noise(320), noise(199)
    texts = [noise(rng.randint(0, 300)) + passage[rng.randint(0, 60) : rng.randint(230, 320)] + noise(rng.randint(0, 300)) for _ in range(60)]
    texts += [noise(50) + twin + noise(50) for _ in range(4)] + [noise(400)] * 3 + ["x" * 1000, "ab" * 300, "", "y" * 199]
    texts += [noise(30) + passage + noise(20) + passage]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = sorted(substring_dedup.repeated_substrings(docs).collect())
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == _removed(texts)
