import pytest

from tallywire import names
from tallywire.operators import metrics


def _scores(spark, pairs):
    df = spark.createDataFrame([("m", t, p) for t, p in pairs], "model string, y_true int, y_pred int")
    counts = metrics.confusion(df, ["model"])
    rows = {r["class"]: r for r in metrics.per_class(counts, ["model"]).collect()}
    return rows, metrics.overall(counts, ["model"]).first(), counts


def test_known_values(spark):
    rows, overall, counts = _scores(spark, [(0, 0)] * 6 + [(0, 2)] * 2 + [(1, 1)] * 3 + [(1, 0)] + [(2, 2)] * 4)
    assert rows["Normal traffic"]["precision"] == pytest.approx(6 / 7)
    assert rows["Normal traffic"]["recall"] == pytest.approx(6 / 8)
    assert rows["DDoS attack"]["precision"] == pytest.approx(4 / 6)
    assert rows[names.MACRO]["support"] == 16
    assert overall["accuracy"] == pytest.approx(13 / 16)
    f1 = [rows[c]["f1"] for c in names.CLASSES]
    assert rows[names.MACRO]["f1"] == pytest.approx(sum(f1) / 3) == overall["f1_macro"] == overall["f1_macro_fixed"]
    assert overall["f1_weighted"] == pytest.approx((f1[0] * 8 + f1[1] * 4 + f1[2] * 4) / 16)
    cells = metrics.confusion_rows(counts, ["model"]).collect()
    assert sum(c["n"] for c in cells) == 16 and len(cells) == 9


def test_class_absent_everywhere(spark):
    rows, overall, _ = _scores(spark, [(0, 0), (0, 1), (1, 1)])
    assert rows["DDoS attack"]["f1"] == 0 and rows["DDoS attack"]["support"] == 0
    f1 = [rows[c]["f1"] for c in names.CLASSES]
    assert rows[names.MACRO]["f1"] == pytest.approx(sum(f1) / 2)
    assert overall["f1_macro_fixed"] == pytest.approx(sum(f1) / 3)
    assert rows[names.MACRO]["precision"] == pytest.approx(sum(rows[c]["precision"] for c in names.CLASSES) / 3)


def test_class_only_predicted_counts_as_present(spark):
    rows, overall, _ = _scores(spark, [(0, 0), (0, 2)])
    assert overall["f1_macro"] == pytest.approx((2 / 3 + 0) / 2)
    assert rows["DDoS attack"]["recall"] == 0


def test_lookup_fills_zero(spark):
    table = spark.createDataFrame([("a", "x", 0.5)], "model string, class string, f1 double")
    grid = metrics.grid_of(table, ["model"], "class", ["x", "y"])
    got = {r["class"]: r["f1"] for r in metrics.looked_up(table, grid, ["model", "class"], "f1").collect()}
    assert got == {"x": 0.5, "y": 0.0}
