import random

import pytest
from pyspark.sql import functions as F

from tallywire.operators import curves

SHAPE = "model string, y int, p double"


def _plain(rows):
    """Every threshold on its own, from the definition."""
    out = {}
    for model in {m for m, _, _ in rows}:
        own = [(y, p) for m, y, p in rows if m == model]
        actual = sum(y for y, _ in own)
        for t in {p for _, p in own if p is not None}:
            said = [y for y, p in own if p is not None and p >= t]
            out[model, t] = (sum(said), len(said) - sum(said), actual - sum(said), sum(said) / len(said), sum(said) / actual if actual else 0.0)
    return out


def _given(rows=600):
    draw = random.Random(9)
    out = [(m, int(draw.random() < 0.2), 0.5 if draw.random() < 0.35 else round(draw.random(), 2)) for m in "ab" for _ in range(rows)]
    return out + [("a", 1, None), ("a", 0, None), ("c", 0, 0.3), ("c", 0, 0.7), (None, 1, 0.4), (None, 0, 0.4)]


@pytest.mark.parametrize("limit", [5, 1000])
def test_curve_equals_definition(spark, limit):
    rows = _given()
    curve = curves.precision_recall(spark.createDataFrame(rows, SHAPE), ["model"], F.col("y") == 1, "p", limit)
    got = {(r["model"], r["threshold"]): (r["tp"], r["fp"], r["fn"], r["precision"], r["recall"]) for r in curve.collect()}
    want = _plain(rows)
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(v) for k, v in want.items())
    area = {r["model"]: r["pr_auc"] for r in curves.average_precision(curve, ["model"]).collect()}
    for model in area:
        steps = sorted(((k[1], v) for k, v in want.items() if k[0] == model), reverse=True)
        before, total = 0.0, 0.0
        for _, (_, _, _, precision, recall) in steps:
            total, before = total + precision * (recall - before), recall
        assert area[model] == pytest.approx(total)
    assert area["c"] == 0.0


def test_threshold_for_recall(spark):
    rows = _given()
    curve = curves.precision_recall(spark.createDataFrame(rows, SHAPE), ["model"], F.col("y") == 1, "p")
    got = {r["model"]: (r["precision"], r["threshold"]) for r in curves.threshold_for_recall(curve, ["model"], 0.9).collect()}
    want = {}
    for (model, t), (_, _, _, precision, recall) in _plain(rows).items():
        if recall >= 0.9:
            want[model] = max(want.get(model, (0, 0)), (precision, t))
    assert got == want and "c" not in got
    whole = curves.threshold_for_recall(curve, ["model"], 1.0).filter("model = 'a'")
    assert whole.isEmpty()      # one positive row of it has no score


def test_given_threshold_and_empty(spark):
    df = spark.createDataFrame(_given(), SHAPE)
    row = curves.at_threshold(df, ["model"], F.col("y") == 1, "p", 0.5).filter("model = 'a'").first()
    assert (row["tp"], row["fp"], row["fn"]) == _plain(_given())["a", 0.5][:3]
    curve = curves.precision_recall(df.limit(0), ["model"], F.col("y") == 1, "p")
    assert curve.isEmpty() and curves.average_precision(curve, ["model"]).isEmpty()


def test_missed(spark):
    df = spark.createDataFrame([(53, 2, 2, 10), (53, 2, 0, 30), (53, 2, None, 50), (80, 2, 2, 7), (80, 1, 2, 9)],
                               "port int, y_true int, y_pred int, speed int")
    got = {r["port"]: (r["n"], r["n_missed"], r["speed_caught"], r["speed_missed"]) for r in curves.missed(df, ["port"], ["speed"], 2).collect()}
    assert got == {53: (3, 2, 10.0, 40.0), 80: (1, 0, 7.0, None)}
