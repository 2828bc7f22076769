"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Two passes gather whole numbers: the sums per dimension, then the scatter of the centred components. Tasks hand on
partial sums, which Spark adds up exactly as decimals, so the result does not depend on the order of rows or tasks; what
is collected has one row per pair of dimensions. The scatter is factored with pivoting, V = L L', and the
columns of the triangular factor are rotated against each other until they are orthogonal: their squared norms are the
eigenvalues and the normalised columns the components. A third pass measures how far the whitened rows are from the
unit covariance.

Vectors that are NULL or hold NULL or a component that is not finite are dropped. The commonest length (of
equally common ones the smaller) is the dimension and vectors of other lengths are dropped too; the empty vector is never used. A component c becomes
floor(SCALE * c) + SHIFT, held at plus or minus 2**53. Repeated rows and rows with a NULL id count each. Components whose eigenvalue is no more
than rounding (1e-12 of the largest) are left out, so equal vectors give no rows at all. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallywire.session import materialize

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
#: The factor is computed on the driver, so the dimension has a bound.
MAX_DIMENSION = 2048
_HELD = float(1 << 53)
_BLOCK = 4096


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray       # eigenvalues, falling
    axes: np.ndarray         # (dimensions, components)
    trace: float

    @property
    def centre(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of whole-number rows; centred before anything is multiplied."""
        base = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([float(Fraction(s % self.n, self.n)) for s in self.sums])
        return ((x - base).astype(np.float64) - rest) @ self.axes / np.sqrt(self.values)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    value = F.col(vector_column).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.select(F.col(id_column).alias("id"), value.alias("v"), F.coalesce(finite & (F.size(value) > 0), F.lit(False)).alias("ok"))
    return rows.filter("ok").select("id", "v")


def _matrices(batches: Iterator[pa.RecordBatch], dimension: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Blocks of rows of one length, as whole numbers."""
    for batch in batches:
        lengths = batch.column("v").value_lengths().to_numpy()
        for length in np.unique(lengths) if dimension is None else [dimension]:
            same = batch.filter(pa.array(lengths == length))
            for at in range(0, same.num_rows, _BLOCK):
                part = same.slice(at, _BLOCK)
                flat = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, int(length))
                yield part, np.clip(np.floor(SCALE * flat), -_HELD, _HELD).astype(np.int64) + SHIFT


def _decimals(values) -> pa.Array:
    from decimal import Decimal
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _dot(y: np.ndarray) -> np.ndarray:
    """y' y of whole numbers, exactly."""
    most = int(np.abs(y).max(initial=0))
    if most * most * max(1, len(y)) < 1 << 53:  # every partial sum is a whole number that a double holds
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    whole = y.astype(object)
    return whole.T @ whole


def column_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """How many vectors have the commonest length, and their sum per dimension."""
    def run(batches):
        sums: dict[int, list] = {}
        for _, x in _matrices(batches):
            own = sums.setdefault(x.shape[1], [0, np.zeros(x.shape[1], object)])
            own[0] += len(x)
            own[1] = own[1] + (x.sum(axis=0) if np.abs(x).max() < 1 << 50 else x.astype(object).sum(axis=0))
        for size, (n, total) in sums.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([size] * (size + 1), pa.int32()), pa.array(range(-1, size), pa.int32()), _decimals([n, *total])],
                names=["size", "i", "total"])

    # At most one row per dimension and length.
    table = materialize(rows.mapInArrow(run, "size int, i int, total decimal(38,0)").groupBy("size", "i").agg(
        F.sum("total").cast("decimal(38,0)").alias("total")))
    head = table.filter("i = -1").orderBy(F.desc("total"), "size").first()
    if head is None:
        return 0, []
    if head["size"] > MAX_DIMENSION:
        raise ValueError(f"vectors of {head['size']} components; the largest dimension is {MAX_DIMENSION}")
    own = table.filter((F.col("size") == head["size"]) & (F.col("i") >= 0)).orderBy("i").collect()
    return int(head["total"]), [int(r["total"]) for r in own]


def scatter(rows: DataFrame, n: int, sums: list[int]) -> list[list[int]]:
    """n * n times the covariance, exactly. Rows are centred on the nearest whole numbers; the rest is corrected after."""
    d = len(sums)
    near = [round(Fraction(s, n)) for s in sums]
    upper = np.triu_indices(d)

    def run(batches):
        total, base = np.zeros((d, d), object), np.array(near, np.int64)
        for _, x in _matrices(batches, d):
            total = total + _dot(x - base)
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), _decimals(total[upper])], names=["i", "j", "s"])

    found = rows.mapInArrow(run, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()
    rest = [s - n * c for s, c in zip(sums, near)]
    out = [[-rest[i] * rest[j] for j in range(d)] for i in range(d)]
    for r in found:  # one row per pair of dimensions
        out[r["i"]][r["j"]] += n * int(r["s"])
        if r["i"] != r["j"]:
            out[r["j"]][r["i"]] += n * int(r["s"])
    return out


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with a = L L', one column per step, each step on the largest diagonal entry that is left.

    Rows stay in the order of ``a``; sorted by pivot, L is lower triangular.
    """
    left, columns = a.copy(), []
    floor = 1e-15 * max(float(np.diag(a).max(initial=0.0)), 0.0)
    free = np.ones(len(a), bool)
    for _ in range(len(a)):
        diagonal = np.where(free, np.diag(left), -np.inf)
        p = int(diagonal.argmax())
        if diagonal[p] <= floor:
            break
        column = np.where(free, left[:, p], 0.0) / np.sqrt(diagonal[p])
        left -= np.outer(column, column)
        columns.append(column)
        free[p] = False
    return np.array(columns).T.reshape(len(a), len(columns))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor with its columns rotated until they are orthogonal.

    Every step rotates disjoint pairs of columns, drawn as in a round-robin tournament, so that
    each sweep meets all pairs once.
    """
    b = factor.copy()
    k = b.shape[1]
    if k < 2:
        return b
    seats = list(range(k)) + ([-1] if k % 2 else [])
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(seats) - 1):
            pairs = [(p, q) for p, q in zip(seats[:len(seats) // 2], reversed(seats[len(seats) // 2:])) if p >= 0 and q >= 0]
            i, j = (np.array(side) for side in zip(*pairs))
            u, v = b[:, i], b[:, j]
            uu, vv, uv = (u * u).sum(axis=0), (v * v).sum(axis=0), (u * v).sum(axis=0)
            size = np.sqrt(uu * vv)
            turn = np.abs(uv) > 1e-16 * size
            worst = max(worst, float((np.abs(uv) / np.where(size > 0, size, 1.0)).max(initial=0.0)))
            zeta = (vv - uu) / np.where(turn, 2 * uv, 1.0)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = np.where(turn, 1 / np.hypot(1.0, t), 1.0)
            s = np.where(turn, c * t, 0.0)
            b[:, i], b[:, j] = c * u - s * v, s * u + c * v
            seats = [seats[0], seats[-1], *seats[1:-1]]
        if worst < 1e-15:
            break
    return b


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all ``rows`` (id, v), or None where there is no row."""
    n, sums = column_sums(rows)
    if not n:
        return None
    whole = scatter(rows, n, sums)
    a = np.array([[float(Fraction(x, n * n)) for x in row] for row in whole])
    turned = one_sided_jacobi(pivoted_cholesky(a))
    values = (turned * turned).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > 1e-12 * values.max(initial=0.0)][:components]
    trace = float(Fraction(sum(whole[i][i] for i in range(len(sums))), n * n))
    return Whitening(n, sums, values[order], turned[:, order] / np.sqrt(values[order]), trace)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    d, k = len(model.sums), len(model.values)
    if not k:
        return 0.0

    def run(batches):
        total = np.zeros((k + 1, k))
        for _, x in _matrices(batches, d):
            w = model.project(x)
            total[0] += w.sum(axis=0)
            total[1:] += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "s"])

    found = rows.mapInArrow(run, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()  # k * (k + 1) rows
    flat = np.zeros((k + 1) * k)
    for r in found:
        flat[r["at"]] = r["s"] / model.n
    mean, square = flat[:k], flat[k:].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(x: np.ndarray, model: Whitening) -> list[int]:
    """The sum of (n * x - S)**2 of each row, exactly."""
    n, sums = model.n, np.array(model.sums, object)
    base = np.array([s // n for s in model.sums], np.int64)
    most = (int(np.abs(x - base).max(initial=0)) + 1) * n
    if most * most * max(1, x.shape[1]) < 1 << 62:
        e = n * (x - base) - (sums - n * base.astype(object)).astype(np.int64)
        return (e * e).sum(axis=1).tolist()
    e = n * x.astype(object) - sums
    return (e * e).sum(axis=1).tolist()


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error, deviation_exact), a row per vector and component.

    ``deviation`` is NULL where the number is beyond 64 bits, as happens for very many rows; ``deviation_exact`` has it always.
    """
    rows = usable(vectors, id_column, vector_column)
    kind = rows.schema["id"].dataType.simpleString()
    schema = (f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, "
              "deviation_exact decimal(38,0)")
    model = fit(rows, components)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    error, d, k = identity_error(rows, model), len(model.sums), len(model.values)
    explained = model.values / model.trace

    def run(batches):
        for part, x in _matrices(batches, d):
            exact, m = _deviations(x, model), part.num_rows
            rows_ = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                part.column("id").take(pa.array(rows_)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n)), pa.array([e if e < 1 << 63 else None for e in exact], pa.int64()).take(pa.array(rows_)),
                pa.array(model.project(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                _decimals(exact).take(pa.array(rows_)),
            ], names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"])

    return rows.mapInArrow(run, schema)
