"""Whitening of embeddings by an eigendecomposition that grows row by row and is refined at the end."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.llm.common import finite_vectors, vector_matrix
from skylag.llm.registry import documents, query
from skylag.session import written

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
# spectra that one task merges
FAN_IN = 8
EPS = np.finfo(float).eps
# of the largest eigenvalue; a component below has no variance that doubles could tell from none
NO_VARIANCE = 1e-12
LONG = 2**63 - 1


def secular_roots(poles: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z**2 / (pole - root)), each as its distance to all poles.

    Poles rise strictly and no z is 0, so each root lies between its pole and the next. It is
    searched from the nearer pole, which keeps small distances exact, by the two-pole rational
    model and by halves where that leaves the bracket. Returns roots and distances[root, pole].
    """
    k, square = len(poles), rho * z * z
    ends = np.append(poles[1:], poles[-1] + square.sum())
    half = (ends - poles) / 2
    at_half = 1 + (square / (poles[None, :] - poles[:, None] - half[:, None])).sum(1)
    right = (at_half < 0) & (np.arange(k) < k - 1)
    origin = np.where(right, ends, poles)
    gap = poles[None, :] - origin[:, None]
    low = np.where(right, -half, np.where(at_half < 0, half, 0.0))
    high = np.where(right, 0.0, np.where(at_half < 0, 2 * half, half))
    left_pole, right_pole = poles - origin, ends - origin
    below = np.tri(k)
    x = (low + high) / 2
    for _ in range(80):
        distance = gap - x[:, None]
        term = square / distance
        value = 1 + term.sum(1)
        done = np.abs(value) <= 2 * EPS * k * (1 + np.abs(term).sum(1))
        if done.all():
            break
        low, high = np.where(value < 0, x, low), np.where(value < 0, high, x)
        slope = term / distance
        first, both = np.einsum("ij,ij->i", slope, below), slope.sum(1)
        second = both - first
        d1, d2 = left_pole - x, right_pole - x
        c = value - d1 * first - d2 * second
        a = (d1 + d2) * value - d1 * d2 * both
        b = d1 * d2 * value
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = x + step
        bad = ~((new > low) & (new < high))
        new = np.where(done, x, np.where(bad, (low + high) / 2, new))
        if (new == x).all():
            break
        x = new
    return origin + x, gap - x[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, direction: np.ndarray, rho: float):
    """Eigenvalues, rising, and eigenvectors after rho * direction direction' (rho >= 0) is added.

    Where the direction has nothing of an eigenvector, or two eigenvalues are equal, the pair is
    deflated: it stays, the latter after a rotation that moves all of the direction to one of
    the two. The others are roots of the secular equation; their vectors are formed from the
    direction for which the roots would be exact, so they stay orthogonal.
    """
    z = vectors.T @ direction
    norm = float(np.sqrt(z @ z))
    rho *= norm * norm
    if not rho > 0:
        return values, vectors
    z = z / norm
    tol = 8 * EPS * max(float(np.abs(values).max()), rho)
    live = rho * np.abs(z) > tol
    close = np.flatnonzero(live)
    if (np.diff(values[close]) <= tol).any():
        vectors, last = vectors.copy(), -1
        for i in close:
            if last >= 0 and values[i] - values[last] <= tol:
                r = np.hypot(z[last], z[i])
                c, s = z[i] / r, z[last] / r
                vectors[:, [last, i]] = vectors[:, [last, i]] @ np.array([[c, s], [-s, c]])
                z[last], z[i] = 0.0, r
                live[last] = False
            last = i
    active = np.flatnonzero(live)
    poles, weight = values[active], z[active]
    roots, distance = secular_roots(poles, weight, rho)
    k = len(active)
    # the direction whose secular equation has exactly these roots
    between = poles[None, :] - poles[:, None]
    np.fill_diagonal(between, 1.0)
    ratio = distance / between.T
    exact = np.sqrt(np.abs(np.prod(ratio, 0)))
    exact = np.copysign(exact, weight)
    basis = exact[None, :] / distance
    basis /= np.sqrt((basis * basis).sum(1))[:, None]
    new_values, new_vectors = values.copy(), vectors.copy()
    new_values[active] = roots
    new_vectors[:, active] = vectors[:, active] @ basis.T
    if k < len(values):
        order = np.argsort(new_values, kind="stable")
        return new_values[order], new_vectors[:, order]
    return new_values, new_vectors


def merged(spectra) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum of the sum: each eigenvector of the others is one rank-one update of the first."""
    (values, vectors), *rest = spectra
    for others, directions in rest:
        for value, direction in zip(others, directions.T):
            if value > 0:
                values, vectors = rank_one(values, vectors, direction, float(value))
    return values, vectors


def shifted(vectors: np.ndarray, width: int, scale: int = SCALE, shift: int = SHIFT) -> np.ndarray:
    """x = floor(scale * c) + shift, shorter vectors continued by c = 0."""
    floors = np.floor(scale * vectors)
    if floors.size and np.abs(floors).max() >= 2.0**62:
        raise OverflowError("a component leaves the range of a long")
    x = np.full((len(vectors), width), shift, np.int64)
    x[:, : floors.shape[1]] += floors.astype(np.int64)
    return x


@dataclass
class Whitening:
    """What a fit knows: count, exact sums, and components by falling eigenvalue, one a column."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    scale: int = SCALE
    shift: int = SHIFT

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n: the whole part exactly, then the fraction."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - part

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums over the dimensions of (n * x - sum)**2, exactly."""
        whole = [s // self.n for s in self.sums]
        most = max((max(abs(int(x[:, d].max()) - w), abs(int(x[:, d].min()) - w)) + 1 for d, w in enumerate(whole)), default=0)
        if len(x) and (self.n * most) ** 2 * len(whole) <= LONG:
            # n * x - sum = n * (x - whole) - rest, all of it within a long
            rest = np.array([s % self.n for s in self.sums], np.int64)
            gap = self.n * (x - np.array(whole, np.int64)) - rest
            return (gap * gap).sum(1).tolist()
        return [sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]


def _spectra_schema() -> str:
    return "part long, eigenvalues array<double>, eigenvectors array<double>"


def _spectrum_batch(part: int, values: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    kind = pa.list_(pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([values], kind), pa.array([vectors.ravel()], kind)],
        ["part", "eigenvalues", "eigenvectors"],
    )


def _added(rows: DataFrame, matrix_of, size: int) -> np.ndarray:
    """The sum of `matrix_of(batch)` over all batches, added in tasks first and then by place."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += matrix_of(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["values"])

    sums = (
        rows.mapInArrow(partial, "values array<double>").select(F.posexplode("values").alias("at", "value"))
        .groupBy("at").agg(F.sum("value").alias("value"))
    )
    out = np.zeros(size)
    for row in sums.collect():  # as many as the matrix has entries
        out[row.at] = row.value
    return out


def _totals(rows: DataFrame, scale: int, shift: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums by dimension; shorter vectors count as continued by c = 0."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, []
        for batch in batches:
            vectors = vector_matrix(batch.column("vector"))
            x = shifted(vectors, vectors.shape[1], scale, shift)
            # what a row lacks is added for all rows at the end
            sums += [0] * (x.shape[1] - len(sums))
            n += len(x)
            if x.size and int(np.abs(x).max()) * len(x) <= LONG:
                added = (x - shift).sum(0).tolist()
            else:
                added = [sum(int(v) - shift for v in column) for column in x.T]
            for d, value in enumerate(added):
                sums[d] += value
        places = [-1, *range(len(sums))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int32()), pa.array([str(v) for v in (n, *sums)], pa.string())], ["at", "value"]
        )

    got = (
        rows.mapInArrow(partial, "at int, value string").groupBy("at")
        .agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("string").alias("value")).collect()
    )
    by_place = {row.at: int(row.value) for row in got}
    n = by_place.pop(-1, 0)
    return n, [by_place[d] + n * shift for d in sorted(by_place)]


def fit(rows: DataFrame, scale: int = SCALE, shift: int = SHIFT, fan_in: int = FAN_IN) -> Whitening:
    """Components of the rows' `vector` column, all of whose entries are finite.

    Every task starts without variance and applies one centred rank-one update for each row. The
    spectra are merged `fan_in` at a time by further rank-one updates until one is left, so no task
    and not the driver ever holds all of them. Last, all rows are projected on the components
    found, their covariance there is summed up in tasks, and its small eigenproblem turns the
    components: what rounding left over in the updates goes with it.
    """
    n, sums = _totals(rows, scale, shift)
    width = len(sums)
    model = Whitening(n, sums, np.zeros(width), np.eye(width), 0.0, scale, shift)
    if not n or not width:
        return model

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return model.centred(shifted(vector_matrix(batch.column("vector")), width, scale, shift))

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, vectors, seen = np.zeros(width), np.eye(width), False
        for batch in batches:
            for row in centred(batch):
                values, vectors = rank_one(values, vectors, row, 1.0)
                seen = True
        if seen:
            yield _spectrum_batch(0, values, vectors)

    def merge(table: pa.Table) -> pa.Table:
        spectra = [
            (np.array(row["eigenvalues"]), np.array(row["eigenvectors"]).reshape(width, width))
            for row in table.sort_by("part").to_pylist()
        ]
        return pa.Table.from_batches([_spectrum_batch(table.column("part")[0].as_py() // fan_in, *merged(spectra))])

    spectra = written(
        rows.mapInArrow(update, _spectra_schema()).withColumn("part", F.spark_partition_id().cast("long")),
        "spectra",
    )
    parts = spectra.agg(F.max("part")).first()[0] + 1
    while parts > 1:
        spectra = written(
            spectra.groupBy(F.floor(F.col("part") / fan_in).alias("group")).applyInArrow(merge, _spectra_schema()),
            "spectra",
        )
        parts = -(-parts // fan_in)
    only = spectra.first()
    basis, _ = np.linalg.qr(np.array(only.eigenvectors).reshape(width, width))

    def projected(batch: pa.RecordBatch) -> np.ndarray:
        y = centred(batch) @ basis
        return (y.T @ y).ravel()

    inner = _added(rows, projected, width * width).reshape(width, width) / n
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    components = (basis @ turn)[:, ::-1]
    # one sign for all reruns: the largest entry is positive
    sign = np.sign(components[np.abs(components).argmax(0), np.arange(width)])
    model.values, model.components = np.maximum(values[::-1], 0.0), components * sign
    model.trace = float(np.trace(inner))
    return model


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
    scale: int = SCALE, shift: int = SHIFT,
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    Entries become x = floor(scale * c) + shift. Each row with a finite vector has a row for each of
    the first `components` components by falling eigenvalue e of the covariance (divisor n): its
    centred vector on the component, over sqrt(e). `deviation` is exact, a decimal(38,0);
    `explained` is e's share of the trace; `identity_error` is the largest entry of the covariance of
    what is returned, less the identity.

    Rows with a null vector, or with a null or non-finite entry, are dropped. A shorter vector
    counts as continued by zeros. Rows that repeat an id or a vector count each. Where a component has
    no variance (a single row, equal rows, constant entries), `whitened` is null, and it does not
    enter `identity_error`, which is null where no component has any; without any variance
    `explained` is 0. Vectors without entries and empty tables give no rows. Equal eigenvalues
    have some orthogonal pair of components. Further columns are ignored.
    """
    vectors = rows.filter(finite_vectors(vector_col)).select(
        F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector")
    )
    model = fit(vectors, scale, shift)
    count = min(components, len(model.sums)) if model.n else 0
    top = max(float(model.values[0]), 0.0) if count else 0.0
    alive = [k for k in range(count) if top > 0 and model.values[k] > NO_VARIANCE * top]
    axes = model.components[:, alive] / np.sqrt(model.values[alive]) if alive else np.zeros((len(model.sums), 0))
    width = len(model.sums)

    def places(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        x = shifted(vector_matrix(batch.column("vector")), width, scale, shift)
        return x, model.centred(x) @ axes

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        y = places(batch)[1]
        return np.concatenate([y.sum(0), (y.T @ y).ravel()])

    error = None
    if alive:
        k = len(alive)
        sums = _added(vectors, moments, k + k * k) / model.n
        covariance = sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k])
        error = float(np.abs(covariance - np.eye(k)).max())
    explained = [float(v) / model.trace if model.trace > 0 else 0.0 for v in model.values[:count]]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if count else ():
            x, y = places(batch)
            rows_ = np.repeat(np.arange(len(x)), count)
            values = np.full((len(x), count), np.nan)
            values[:, alive] = y
            missing = np.tile(~np.isin(np.arange(count), alive), len(x))
            exact = pa.array([str(v) for v in model.deviations(x)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows_)),
                 pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                 exact.take(pa.array(rows_)), pa.array(values.ravel(), mask=missing),
                 pa.array(np.tile(explained, len(x)))],
                ["vec_id", "component", "deviation", "whitened", "explained"],
            )

    id_type = dict(vectors.dtypes)["vec_id"]
    return vectors.mapInArrow(
        project, f"vec_id {id_type}, component int, deviation string, whitened double, explained double"
    ).select(
        "vec_id", "component", F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").cast("decimal(38,0)").alias("deviation"), "whitened", "explained",
        F.lit(error).cast("double").alias("identity_error"),
    )


@query("op11_whitening")
def op11(spark, sf_dir):
    return whiten(documents(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))
