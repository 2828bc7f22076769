"""Per-class diagonal Gaussian mixtures, fitted by distributed expectation-maximisation.

One Spark job per iteration serves every class and every candidate size: each task adds
up responsibilities, weighted values and weighted squares of its rows, the sums are
combined by Spark, and only the few sums per component reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from tallywire.session import materialize

SIZES = (2, 3, 4, 5)
FLOOR = 1e-4
SEED_ROUNDS = 5
_SUMS = "label int, size int, part int, dim int, r double, x double, xx double"


@dataclass(frozen=True)
class Mixture:
    weights: np.ndarray     # (k,)
    means: np.ndarray       # (k, d)
    variances: np.ndarray   # (k, d)

    @property
    def size(self) -> int:
        return len(self.weights)

    def log_joint(self, x: np.ndarray) -> np.ndarray:
        """log(weight) + log density of every row under every component."""
        inverse = 1 / self.variances
        square = (x**2) @ inverse.T - 2 * x @ (self.means * inverse).T + (self.means**2 * inverse).sum(axis=1)
        constant = np.log(2 * np.pi * self.variances).sum(axis=1)
        return np.log(self.weights) - 0.5 * (constant + square)

    def memberships(self, x: np.ndarray) -> np.ndarray:
        return self.expected(x)[0]

    def expected(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(memberships, log-likelihood) of every row."""
        joint = self.log_joint(x)
        top = joint.max(axis=1)
        level = top + np.log(np.exp(joint - top[:, None]).sum(axis=1))
        return np.exp(joint - level[:, None]), level

    def log_likelihood(self, x: np.ndarray) -> np.ndarray:
        return self.expected(x)[1]

    def bic(self, total_log_likelihood: float, n: int) -> float:
        k, d = self.means.shape
        return -2 * total_log_likelihood + (2 * k * d + k - 1) * np.log(n)


Fits = dict[tuple[int, int], Mixture]


def _sums(data: DataFrame, fits: Fits, hard: bool = False) -> dict[tuple[int, int], dict]:
    """Totals per (class, size): r (k,), x (k, d), xx (k, d) and the log-likelihood."""
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            x_all = np.asarray(batch.column("vec").flatten(), dtype=float).reshape(batch.num_rows, -1)
            own = {label: x_all[labels == label] for label in {label for label, _ in fits}}
            for (label, size), m in fits.items():
                x = own[label]
                if not len(x):
                    continue
                share, level = m.expected(x)
                if hard:
                    # Nearest centre: equal weights and unit variances make it the likeliest.
                    share = (share == share.max(axis=1, keepdims=True)).astype(float)
                    share /= share.sum(axis=1, keepdims=True)
                new = [share.sum(axis=0), share.T @ x, share.T @ x**2, level.sum()]
                old = held.get((label, size))
                held[(label, size)] = new if old is None else [a + b for a, b in zip(old, new)]
        rows = []
        for (label, size), (r, x, xx, total) in held.items():
            rows.append((label, size, -1, -1, float(total), 0.0, 0.0))
            for p in range(size):
                rows += [(label, size, p, j, float(r[p]), float(x[p, j]), float(xx[p, j])) for j in range(x.shape[1])]
        if rows:
            cols = list(zip(*rows))
            types = [pa.int32()] * 4 + [pa.float64()] * 3
            names = ["label", "size", "part", "dim", "r", "x", "xx"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    totals = data.mapInArrow(add_up, _SUMS).groupBy("label", "size", "part", "dim").agg(
        *[F.sum(c).alias(c) for c in ("r", "x", "xx")])
    out: dict[tuple[int, int], dict] = {}
    for row in totals.collect():  # components x features rows, whatever the data size
        key = (row["label"], row["size"])
        m = fits[key]
        s = out.setdefault(key, {"r": np.zeros(m.size), "x": np.zeros(m.means.shape), "xx": np.zeros(m.means.shape)})
        if row["part"] < 0:
            s["log"] = row["r"]
        else:
            s["r"][row["part"]] = row["r"]
            s["x"][row["part"], row["dim"]] = row["x"]
            s["xx"][row["part"], row["dim"]] = row["xx"]
    return out


def _update(s: dict) -> Mixture:
    r = s["r"] + 1e-15
    means = s["x"] / r[:, None]
    variances = np.maximum(s["xx"] / r[:, None] - means**2, 0) + FLOOR
    return Mixture(r / r.sum(), means, variances)


def _seed_centres(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """Start centres from all rows: parallel k-means seeding and a few averaging rounds."""
    fitted = KMeans(k=k, initMode="k-means||", initSteps=2, maxIter=SEED_ROUNDS, seed=seed, featuresCol="v").fit(points)
    centres = np.array(fitted.clusterCenters())
    # Fewer different points than components: repeat what there is.
    return centres[np.arange(k) % len(centres)]


def fit_per_class(
    rows: DataFrame, sizes: tuple[int, ...] = SIZES, seed: int = 42, max_iter: int = 200, tol: float = 1e-3
) -> dict[int, Mixture]:
    """One mixture per class of ``rows`` (id, label, vec of scaled features).

    The number of components is the one with the least BIC; sizes that would leave a
    class fewer than 2 x features rows per component are not tried, and a class too
    small for all of them gets a single Gaussian.
    """
    data = materialize(rows.select("id", F.col("label").cast("int").alias("label"), F.col("vec").cast("array<double>").alias("vec")))
    counts = {r["label"]: r["count"] for r in data.groupBy("label").count().collect()}
    vectors = data.select("label", "vec").persist()  # lost blocks are read again from the checkpoint
    width = len(data.select("vec").first()["vec"]) if counts else 0
    starts: Fits = {}
    for label, n in sorted(counts.items()):
        points = vectors.filter(F.col("label") == label).select(array_to_vector("vec").alias("v"))
        for k in [k for k in sizes if n >= k * 2 * width] or [1]:
            centres = _seed_centres(points, k, seed) if k > 1 else np.zeros((1, width))
            starts[(label, k)] = Mixture(np.full(k, 1 / k), centres, np.ones((k, width)))
    fits: Fits = {key: _update(s) for key, s in _sums(vectors, starts, hard=True).items()}
    before: dict[tuple[int, int], float] = {}
    going = dict(fits)
    for _ in range(max_iter):
        if not going:
            break
        for key, s in _sums(vectors, going).items():
            level = s["log"] / counts[key[0]]
            settled = key in before and abs(level - before[key]) < tol
            before[key] = level
            fits[key] = going[key] = _update(s)
            if settled:
                del going[key]
    final = _sums(vectors, fits)
    vectors.unpersist()
    chosen: dict[int, Mixture] = {}
    for label in sorted(counts):
        options = [(fits[key].bic(final[key]["log"], counts[label]), key[1]) for key in fits if key[0] == label]
        chosen[label] = fits[(label, min(options)[1])]
    return chosen


def bic_table(rows: DataFrame, fits: Fits) -> list[tuple[int, int, float]]:
    """(class, size, BIC) of given mixtures on the rows of their class."""
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    return [(c, k, float(fits[(c, k)].bic(s["log"], n[c]))) for (c, k), s in _sums(rows.select("label", "vec"), fits).items()]


def column_names(mixtures: dict[int, Mixture]) -> list[str]:
    return [f"gmm_c{c}_k{k}" for c in sorted(mixtures) for k in range(mixtures[c].size)]


def memberships(vec: Column | str, mixtures: dict[int, Mixture]) -> Column:
    """Memberships under the mixture of every class, one after the other, as an array."""
    ordered_parts = [mixtures[c] for c in sorted(mixtures)]

    @F.pandas_udf("array<double>")
    def shares(v: pd.Series) -> pd.Series:
        if len(v) == 0:
            return pd.Series(dtype=object)
        x = np.stack(v.to_numpy())
        return pd.Series(list(np.concatenate([m.memberships(x) for m in ordered_parts], axis=1)))

    return shares(vec)


def best_membership(shares: Column | str) -> Column:
    return F.array_max(shares)


def entropy(shares: Column | str) -> Column:
    """Entropy of the memberships after they are scaled to sum to one."""
    shares = F.col(shares) if isinstance(shares, str) else shares
    total = F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    whole = F.when(total == 0, F.lit(1.0)).otherwise(total)
    terms = F.transform(shares, lambda x: x / whole * F.log(x / whole + F.lit(1e-12)))
    return -F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
