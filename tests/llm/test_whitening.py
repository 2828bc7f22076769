"""Whitening against numpy's own decomposition."""

import math
import os
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywire.llm import whitening
from tallywire.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def compare(got, rows, components):
    """``rows``: (vec_id, vector) that remain; ``got``: result rows."""
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(col) for col in zip(*x)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(row, sums)] for row in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, d, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == n * k
    want = centred @ axes[:, :k] / np.sqrt(values[:k])
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    by_key = {}
    for r in got:
        by_key.setdefault((r.vec_id, r.component), []).append(r)
    at = {}
    for place, (i, _) in enumerate(rows):
        at.setdefault(i, []).append(place)
    for j in range(k):
        ids = list(at)
        mine = {i: sorted(r.whitened for r in by_key[i, j + 1]) for i in ids}
        plus = {i: sorted(want[p, j] for p in at[i]) for i in ids}
        minus = {i: sorted(-want[p, j] for p in at[i]) for i in ids}
        far = lambda side: max(abs(a - b) for i in ids for a, b in zip(mine[i], side[i]))
        assert min(far(plus), far(minus)) < 1e-6
    for i in at:
        for j in range(k):
            assert sorted(r.deviation for r in by_key[i, j + 1]) == sorted(deviation[p] for p in at[i])
    for r in got:
        assert r.n == n and abs(r.explained - values[r.component - 1] / values.sum()) < 1e-9 and r.identity_error < 1e-9
        assert int(r.deviation_exact) == r.deviation


def as_query(df):
    return df.withColumnRenamed("id", "vec_id").collect()


@pytest.mark.parametrize("d,n", [(1, 5), (3, 50), (9, 200), (12, 6)])
def test_whitened(spark, d, n):
    draw = random.Random(d)
    rows = [(i, [draw.gauss(k, 1 + k) for k in range(d)]) for i in range(n)]
    rows += rows[:2] + [(None, rows[0][1])]
    odd = [(1001, None), (1002, [None] + [0.5] * (d - 1)), (1003, [float("nan")] * d), (1004, [float("-inf")] * d), (1005, []), (1006, [0.5] * (d + 1))]
    table = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").repartition(3)
    table = table.withColumn("id", F.lit("clash")).withColumn("v", F.lit("clash")).withColumn("n", F.lit(1))
    compare(as_query(whitening.whiten(table)), rows, 8)
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.filter("vec_id > 1000")).filter("id <> 1006").count() == 0


def test_equal_and_huge_vectors(spark):
    same = spark.createDataFrame([(i, [0.25, -3.0]) for i in range(10)], "vec_id bigint, embedding array<float>")
    assert whitening.whiten(same).count() == 0
    huge = spark.createDataFrame([(i, [1e300 * (-1) ** i, float(i)]) for i in range(10)], "vec_id bigint, embedding array<double>")
    got = whitening.whiten(huge).collect()
    assert len({r.id for r in got}) == 10 and all(math.isfinite(r.whitened) and r.deviation is None for r in got)


def test_factors():
    draw = np.random.default_rng(3)
    for d in (1, 2, 7, 40):
        m = draw.normal(size=(d + 3, d)) * np.logspace(0, 3, d)
        a = m.T @ m
        factor = whitening.pivoted_cholesky(a)
        assert np.allclose(factor @ factor.T, a, rtol=1e-12, atol=1e-12 * a.max())
        turned = whitening.one_sided_jacobi(factor)
        gram = turned.T @ turned
        size = np.sqrt(np.diag(gram))
        assert np.abs(gram / np.outer(size, size) - np.eye(len(gram))).max() < 1e-13
        assert np.allclose(np.sort(size ** 2), np.linalg.eigvalsh(a), rtol=1e-9)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
def test_query(spark):
    out = QUERIES["op13_whitened_embeddings"](spark, SF)
    assert out.dtypes[:7] == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"),
                              ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compare(out.collect(), [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])], 8)
