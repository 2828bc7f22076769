import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywire.functions import quantiles
from tallywire.functions.quantiles import median_and_deviation, oversized_groups, quantile_table


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows; values have ties, gaps and wide ranges."""
    rng = np.random.default_rng(0)
    n = 3000
    keys = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 400, n))
    values = np.where(rng.random(n) < 0.3, 7.0, np.exp(rng.normal(size=n) * 6) * rng.choice([-1, 1], n))
    rows = [(int(k), None if i % 50 == 0 else float(v)) for i, (k, v) in enumerate(zip(keys, values))]
    return spark.createDataFrame(rows, "k int, v double").persist(), rows


def _groups(rows):
    out = {}
    for k, v in rows:
        out.setdefault(k, [])
        if v is not None:
            out[k].append(v)
    return {k: np.array(v) for k, v in out.items() if v}


@pytest.mark.parametrize("limit", [10, 200, 1_000_000])
def test_grouped_quantiles(skewed, limit):
    df, rows = skewed
    wanted = {"q05": (F.col("v"), 0.05), "q50": (F.col("v"), 0.5), "q99": (F.col("v"), 0.99), "abs50": (F.abs("v"), 0.5)}
    got = {r["k"]: r for r in quantile_table(df, ["k"], wanted, limit).collect()}
    for k, v in _groups(rows).items():
        want = [np.percentile(v, 5), np.percentile(v, 50), np.percentile(v, 99), np.percentile(np.abs(v), 50)]
        assert [got[k][c] for c in wanted] == pytest.approx(want, rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_global_quantiles(skewed, limit):
    df, rows = skewed
    v = np.array([x for _, x in rows if x is not None])
    got = quantile_table(df, [], {"a": (F.col("v"), 0.0), "b": (F.col("v"), 0.37), "c": (F.col("v"), 1.0)}, limit).first()
    assert [got["a"], got["b"], got["c"]] == pytest.approx([v.min(), np.percentile(v, 37), v.max()], rel=1e-9)


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_median_and_deviation(skewed, limit):
    df, rows = skewed
    got = {r["k"]: r for r in median_and_deviation(df, ["k"], {"v": F.col("v")}, limit).collect()}
    for k, v in _groups(rows).items():
        m = np.median(v)
        assert got[k]["v_median"] == pytest.approx(m, rel=1e-9)
        assert got[k]["v_mad"] == pytest.approx(np.median(np.abs(v - m)), rel=1e-9, abs=1e-12)


def test_only_oversized_keys_are_split(skewed):
    df, rows = skewed
    assert [r["k"] for r in oversized_groups(df, ["k"], 100).collect()] == [0]
    assert oversized_groups(df, ["k"], 100_000) is None


@pytest.mark.parametrize("limit", [5, 1_000_000])
def test_odd_groups_are_the_same_on_both_paths(spark, limit):
    inf, nan = float("inf"), float("nan")
    rows = [("a", float(i)) for i in range(20)] + [("b", None)] * 20 + [(None, float(i * i)) for i in range(21)]
    rows += [("inf", -inf)] * 7 + [("inf", float(i)) for i in range(9)] + [("inf", inf)] * 8
    rows += [("nan", nan)] * 6 + [("nan", float(i)) for i in range(14)] + [("wide", v) for v in (-1.7e308, 1.7e308)] * 10
    df = spark.createDataFrame(rows, "k string, v double")
    wanted = {"low": (F.col("v"), 0.1), "mid": (F.col("v"), 0.5), "high": (F.col("v"), 0.9)}
    plain = {r["k"]: str(r) for r in df.groupBy("k").agg(
        *[F.percentile(c, F.lit(p)).alias(n) for n, (c, p) in wanted.items()]).collect()}
    assert {r["k"]: str(r) for r in quantile_table(df, ["k"], wanted, limit).collect()} == plain and len(plain) == 6
    nothing = df.filter("k = 'b'")
    assert [r["mid"] for r in quantile_table(nothing, [], {"mid": wanted["mid"]}, limit).collect()] == [None]
    assert quantile_table(df.limit(0), ["k"], wanted, limit).count() == 0
    some = df.filter("k IS NULL OR k IN ('a', 'b')")
    both = {r["k"]: (r["v_median"], r["v_mad"]) for r in median_and_deviation(some, ["k"], {"v": F.col("v")}, limit).collect()}
    squares = np.arange(21.0) ** 2
    assert both == {"a": (9.5, 5.0), "b": (None, None), None: (100.0, np.median(np.abs(squares - 100)))}


def test_several_rounds_find_the_same(spark, monkeypatch):
    rows = [("a", float(i % 37)) for i in range(120)] + [("nan", float("nan"))] * 30 + [("nan", float(i)) for i in range(50)] + [(None, 1.0)] * 9
    df = spark.createDataFrame(rows, "k string, v double").coalesce(1)
    rounds, sketched = [], quantiles._sketched
    monkeypatch.setattr(quantiles, "SPLITTERS", 5)
    monkeypatch.setattr(quantiles, "_sketched", lambda *a: rounds.append(1) or sketched(*a))
    plain = {r["k"]: str(r["mid"]) for r in df.groupBy("k").agg(F.percentile("v", F.lit(0.4)).alias("mid")).collect()}
    assert {r["k"]: str(r["mid"]) for r in quantile_table(df, ["k"], {"mid": (F.col("v"), 0.4)}, 5).collect()} == plain and rounds


def test_no_table_is_kept_that_has_more_rows_than_the_input(skewed, monkeypatch):
    df, rows = skewed
    kept, keep = [], quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda t: kept.append((out := keep(t)).count()) or out)
    quantile_table(df, [], {f"q{i}": (F.col("v") * i, i / 4) for i in range(1, 4)}, 100).collect()
    assert max(kept) == len(rows)
