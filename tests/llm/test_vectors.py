"""Hard negatives and whitening against brute force, and on edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylag.llm import hard_negatives, whitening
from skylag.llm.hard_negatives import mine, packed_products, quantised

SCHEMA = "vec_id long, embedding array<float>, label int, row string, k int, id double"


@pytest.mark.parametrize("low,high,width", [(-130, 140, 64), (-3, 3, 5), (-9000, 9000, 300), (-(2**30), 2**30, 40), (0, 0, 3)])
def test_packed_products_are_exact(low, high, width):
    rng = np.random.default_rng(width)
    a, r = rng.integers(low, high + 1, (7, width)), rng.integers(low, high + 1, (23, width))
    expected = a.astype(object) @ r.astype(object).T
    assert (packed_products(a, r) == expected).all()


def test_products_beyond_a_word_are_exact():
    a = quantised(np.array([[1e12, -3.5, 2.0], [0.5, 1e11, -1e10]]))
    r = quantised(np.array([[1e9, 2e9, 0.25], [-1e10, 0.0, 7.75], [0.0, 0.0, 0.0]]))
    assert a.dtype == object
    assert (packed_products(a, r) == a @ r.T).all()


def test_nothing_to_multiply():
    assert packed_products(np.zeros((2, 0), np.int64), np.zeros((3, 0), np.int64)).tolist() == [[0] * 3] * 2
    assert packed_products(np.zeros((0, 4), np.int64), np.zeros((3, 4), np.int64)).shape == (0, 3)


def brute(rows, is_anchor, positives=5, negatives=5):
    """Rows as (id, vector, label), told apart by their place; null ids last in ties."""
    good = [
        (i, [int(np.floor(256.0 * x)) for x in v], lab) for i, v, lab in rows
        if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for n, (i, v, lab) in enumerate(good):
        if not is_anchor(i):
            continue
        scored = sorted(
            ((-sum(x * y for x, y in zip(v, w)), j is None, j or 0, j, other) for m, (j, w, other) in enumerate(good) if m != n),
            key=lambda t: t[:3],
        )
        for ps, _, _, p, _ in [t for t in scored if t[4] == lab][:positives]:
            fits = [t for t in scored if t[4] != lab and -80 * ps <= -100 * t[0] <= -100 * ps][:negatives]
            out += [(i, p, k, t[3], -ps, -t[0]) for k, t in enumerate(fits, 1)]
    return sorted(out, key=str)


def found(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def planted(n=300, width=6, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, np.float32(rng.normal(size=width)).tolist(), int(rng.integers(0, 3))) for i in range(n)]
    same = [0.5] * width
    rows += [(n + i, same, i % 2) for i in range(40)]  # ties
    return rows


@pytest.mark.parametrize("block", [16_384, 50])
def test_hard_negatives_are_those_of_brute_force(llm, block, monkeypatch):
    rows = planted()
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = mine(df, F.col("vec_id") % 20 == 0, block=block)
    expected = brute(rows, lambda i: i % 20 == 0)
    assert found(got) == expected and expected


def test_strips_and_blocks_do_not_show(llm):
    rows = planted(seed=8)
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = mine(df, F.col("vec_id") % 2 == 0, block=64)
    assert found(got) == brute(rows, lambda i: i % 2 == 0)


def test_hard_negatives_on_edge_cases(llm):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (None, [1.0, 0.5], 1), (2, [1.0, 0.4], 2),
        (3, [1.0], 2), (4, None, 1), (5, [1.0, None], 1), (6, [nan, 1.0], 2), (7, [1.0, inf], 2), (8, [1.0, 0.5], None),
        (9, [], 2), (100, [1.0, 0.45], 2), (100, [1.0, 0.45], 2), (200, [9.0, 9.0], 77), (None, [1.0, 0.4], 5), (10, [-1.0, -1.0], 5),
    ]
    wide = llm.createDataFrame([(*r, "x", 3, 0.5) for r in rows], SCHEMA)
    got = mine(wide, F.col("vec_id") % 100 == 0)
    plain = [(i, v + [0.0] * (2 - len(v)) if v is not None else None, lab) for i, v, lab in rows]
    assert found(got) == brute(plain, lambda i: i is not None and i % 100 == 0)
    # repeated anchors have their results each, a lone label has none
    anchors = [r.anchor_id for r in got.collect()]
    assert anchors.count(100) > 1 and 200 not in anchors
    assert mine(wide.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert mine(wide, F.lit(False)).collect() == []


def test_scores_beyond_doubles_stay_exact(llm):
    rows = [(i, [8.5e6 + i, -2e5, 3.0 * i], i % 2) for i in range(30)]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert found(mine(df, F.col("vec_id") == 4, scale=256)) == brute(rows, lambda i: i == 4)
    assert hard_negatives.quantised(np.array([[1e7]])).dtype == object


def test_query_counts_labels_after_their_change(llm):
    rows = hard_negatives.op13(llm, "/root/testdata/sf0.001").collect()
    assert rows and all(1 <= r["rank"] <= 5 for r in rows)
    assert all(80 * r.positive_score <= 100 * r.negative_score <= 100 * r.positive_score for r in rows)


def added(rows):
    values, vectors = np.zeros(rows.shape[1]), np.eye(rows.shape[1])
    for row in rows:
        values, vectors = whitening.rank_one(values, vectors, row, 1.0)
    return values, vectors


@pytest.mark.parametrize("kind", ["plain", "equal rows", "few values", "one direction", "far scales", "no rows"])
def test_rank_one_updates_give_the_spectrum_of_the_sum(kind):
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(400, 12)) * np.linspace(1, 9, 12)
    if kind == "equal rows":
        rows[100:300] = rows[0]
    if kind == "few values":
        rows = np.round(rows / 6)
    if kind == "one direction":
        rows = np.outer(rng.normal(size=50), np.ones(12))
    if kind == "far scales":
        rows[:, :2] *= 1e6
    if kind == "no rows":
        rows = rows[:0]
    scatter = rows.T @ rows
    largest = max(np.linalg.norm(scatter, 2), 1e-300)
    halves = added(rows[: len(rows) // 2]), added(rows[len(rows) // 2 :])
    for values, vectors in (added(rows), whitening.merged(halves)):
        assert np.abs(vectors.T @ vectors - np.eye(12)).max() < 1e-12
        assert np.abs((vectors * values) @ vectors.T - scatter).max() < 1e-12 * largest
        assert np.abs(values - np.linalg.eigvalsh(scatter)).max() < 1e-12 * largest
        assert (np.diff(values) >= 0).all()


def test_secular_roots_lie_between_the_poles_and_solve_the_equation():
    rng = np.random.default_rng(2)
    poles = np.sort(np.concatenate([rng.uniform(0, 1, 20), [0.5, 0.5 + 1e-9], rng.uniform(1e6, 2e6, 5)]))
    z = rng.normal(size=len(poles)) * 10.0 ** rng.integers(-6, 1, len(poles))
    roots, distance = whitening.secular_roots(poles, z, 0.7)
    assert (roots >= poles).all() and (roots[:-1] <= poles[1:]).all()
    term = 0.7 * z * z / distance
    assert (np.abs(1 + term.sum(1)) <= 1e-12 * (1 + np.abs(term).sum(1))).all()


def plain_whitening(vectors, count=8):
    x = np.floor(1024 * np.asarray(vectors, float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    return centred @ axes[:, :count] / np.sqrt(values[:count]), values[:count] / values.sum(), deviation


@pytest.mark.parametrize("partitions", [1, 20])
def test_whitening_is_that_of_the_plain_eigenproblem(llm, partitions):
    rng = np.random.default_rng(7)
    vectors = np.float32(rng.normal(size=(300, 10)) * np.linspace(0.1, 1, 10))
    df = llm.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = whitening.whiten(df.repartition(partitions)).toPandas().sort_values(["vec_id", "component"])
    assert len(got) == 300 * 8 and set(got["n"]) == {300}
    plain, explained, deviation = plain_whitening(vectors)
    mine_ = got["whitened"].to_numpy().reshape(300, 8)
    sign = np.sign((mine_ * plain).sum(0))
    assert np.abs(mine_ * sign - plain).max() < 1e-9
    assert np.abs(got["explained"].to_numpy().reshape(300, 8) - explained).max() < 1e-12
    assert [int(v) for v in got["deviation"][::8]] == deviation
    assert got["identity_error"].nunique() == 1 and got["identity_error"].max() < 1e-10


def test_whitening_on_edge_cases(llm):
    inf, nan = float("inf"), float("nan")
    good = [[1.0, 0.5, 0.25], [1.0, 0.5, 0.25], [0.5, 0.1], [], [-3.0, 2.0, 0.25]]
    bad = [None, [1.0, None, 2.0], [nan, 0.0, 0.0], [0.0, -inf, 1.0]]
    rows = [(i if i else None, v, i, "r", i, 0.5) for i, v in enumerate(good + bad)]
    wide = llm.createDataFrame(rows, SCHEMA)
    got = whitening.whiten(wide).collect()
    ids = [None, 1, 2, 3, 4]
    assert sorted(((r.vec_id, r.component) for r in got), key=str) == sorted([(i, k) for i in ids for k in (1, 2, 3)], key=str)
    padded = [v + [0.0] * (3 - len(v)) for v in good]
    plain, _, deviation = plain_whitening(padded, 3)
    for row in got:
        at = ids.index(row.vec_id)
        assert row.n == 5 and int(row.deviation) == deviation[at]
        assert abs(abs(row.whitened) - abs(plain[at, row.component - 1])) < 1e-8
    assert whitening.whiten(wide.limit(0)).collect() == []
    assert whitening.whiten(wide.filter("k >= 5")).collect() == []
    alone = whitening.whiten(wide.filter("k = 4")).collect()
    assert [(r.whitened, r.explained, r.deviation, r.identity_error) for r in alone] == [(None, 0.0, 0, None)] * 3
    # a constant entry has no variance: two components are left of three
    flat = whitening.whiten(wide.filter("k in (0, 1, 4)")).collect()
    assert {r.component for r in flat if r.whitened is not None} == {1}
    assert {r.identity_error < 1e-9 for r in flat} == {True}


def test_deviations_beyond_a_long_stay_exact(llm):
    vectors = [[1e9 * (i % 7), -2e8 * i] for i in range(40)]
    df = llm.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(df).collect()}
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x)]
    assert got == {i: sum((40 * c - s) ** 2 for c, s in zip(row, sums)) for i, row in enumerate(x)}
    assert max(got.values()) > 2**63


def test_whitening_query(llm):
    got = whitening.op11(llm, "/root/testdata/sf0.001").toPandas().sort_values(["vec_id", "component"])
    table = llm.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id").collect()
    plain, explained, deviation = plain_whitening([r.embedding for r in table])
    values = got["whitened"].to_numpy().reshape(-1, 8)
    assert np.abs(np.abs(values) - np.abs(plain)).max() < 1e-8
    assert got["deviation"][::8].tolist() == deviation
    assert got["identity_error"].max() <= 1e-4
