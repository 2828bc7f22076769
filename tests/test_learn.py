import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywire import names
from tallywire.operators import learn, metrics, mixture
from tallywire.sources import modelstore

COLUMNS = ["a", "b", "c"]
FAST = learn.Settings(gbt_rounds=3, gbt_depth=3, forest_trees=5, forest_depth=5, lr_iterations=50)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    y = rng.choice(3, 600, p=[0.7, 0.2, 0.1])
    x = rng.normal(size=(600, 3)) + np.stack([y * 3, -y * 2, np.zeros(600)], axis=1)
    x[:, 2] = 4.0
    data = [(i, int(c), *map(float, r)) for i, (c, r) in enumerate(zip(y, x))]
    return spark.createDataFrame(data, "attack_id bigint, label int, a double, b double, c double").persist(), x, y


def test_scaler_uses_population_deviation(rows):
    df, x, _ = rows
    s = learn.Scaler.fit(df, COLUMNS)
    assert s.means == pytest.approx(x.mean(axis=0)) and s.deviations[:2] == pytest.approx(x.std(axis=0)[:2])
    assert s.deviations[2] == 1.0


def test_weights():
    assert learn.balanced_weights({0: 6, 1: 3, 2: 1}) == pytest.approx({0: 10 / 18, 1: 10 / 9, 2: 10 / 3})
    w = learn.prior_weights({0: 900, 1: 60, 2: 40})
    raw = [0.9014 / 0.9, 0.0649 / 0.06, 0.0337 / 0.04]
    assert w == {i: round(r / (sum(raw) / 3), 4) for i, r in enumerate(raw)}
    assert learn.majority_class({1: 5, 0: 5, 2: 1}) == 0


def test_suite_beats_majority(rows):
    df, _, y = rows
    suite = learn.fit_suite(df, COLUMNS, settings=FAST)
    said = suite.predictions(df)
    scores = {r["model"]: r["f1_macro"] for r in metrics.overall(metrics.confusion(said, ["model"]), ["model"]).collect()}
    base = metrics.overall(metrics.confusion(df.select(F.col("label").alias("y_true"), F.lit(0).alias("y_pred"), F.lit(1).alias("m")), ["m"]), ["m"])
    floor = base.first()["f1_macro"]
    assert list(scores) and set(scores) == set(names.MODELS)
    assert all(v > floor + 0.2 for v in scores.values())
    best = F.greatest("p_0", "p_1", "p_2")
    chosen = F.when(F.col("y_pred") == 0, F.col("p_0")).when(F.col("y_pred") == 1, F.col("p_1")).otherwise(F.col("p_2"))
    for name in names.MODELS:
        p = suite.probabilities(name, df)
        assert p.count() == 600
        assert p.filter(F.abs(F.col("p_0") + F.col("p_1") + F.col("p_2") - 1) > 1e-9).isEmpty(), name
        assert p.filter(chosen < best - 1e-9).isEmpty(), name
        same = p.select("attack_id", F.col("y_pred").alias("p")).join(suite.predict(name, df), "attack_id")
        assert same.filter("p <> y_pred").isEmpty(), name


def test_duplicate_ids_are_refused(rows):
    df = rows[0]
    with pytest.raises(ValueError):
        learn.fit_suite(df.unionByName(df.limit(1)), COLUMNS, models=["Decision Tree"], settings=FAST)


def test_same_rows_give_the_same_forest(rows):
    df = rows[0]
    said = [learn.fit_suite(df.repartition(n), COLUMNS, models=["Random Forest"], settings=FAST).probabilities("Random Forest", df)
            .orderBy("attack_id").collect() for n in (1, 7)]
    assert said[0] == said[1]


def test_training_rows_keep_to_a_number_of_partitions(rows):
    df = rows[0]
    parts = lambda n, key: learn._spread(df, n, 4_000, key).rdd.getNumPartitions()
    assert [parts(n, "attack_id") for n in (600, 75_000, 4_500_000)] == [1, 19, learn.MOST_PARTITIONS]
    assert parts(4_500_000, None) == learn.MOST_PARTITIONS


def test_store_checks_version(spark, rows, tmp_path):
    df = rows[0]
    path = str(tmp_path / "models")
    calls = []

    def train():
        calls.append(1)
        scaled = df.select(F.col("attack_id").alias("id"), "label", F.array("a", "b").alias("vec"))
        return learn.fit_suite(df, COLUMNS, models=["Decision Tree", "KNN (k=5)"], settings=FAST), mixture.fit_per_class(scaled, sizes=(2,), max_iter=5)

    modelstore.load_or_train(spark, path, train, version="old")
    suite, mixtures, default = modelstore.load_or_train(spark, path, train)
    again, _, _ = modelstore.load_or_train(spark, path, train)
    assert len(calls) == 2 and default == "Decision Tree" and set(mixtures) == {0, 1, 2}
    for name in ("Decision Tree", "KNN (k=5)"):
        same = suite.predict(name, df).join(again.predict(name, df).select("attack_id", F.col("y_pred").alias("z")), "attack_id")
        assert same.count() == 600 and same.filter("y_pred <> z").isEmpty()


def _brute_step(x, m):
    logs = np.log(m.weights) - 0.5 * (np.log(2 * np.pi * m.variances)[None] + (x[:, None] - m.means[None]) ** 2 / m.variances[None]).sum(axis=2)
    top = logs.max(axis=1, keepdims=True)
    total = top[:, 0] + np.log(np.exp(logs - top).sum(axis=1))
    return np.exp(logs - total[:, None]), total


def test_mixture_finds_clusters(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(200, 2)) * 0.3 + c for c in ([0, 0], [4, 4], [0, 6])])
    df = spark.createDataFrame([(i, 0, [float(v) for v in r]) for i, r in enumerate(x)], "id bigint, label int, vec array<double>")
    m = mixture.fit_per_class(df)[0]
    assert m.size == 3 and m.weights == pytest.approx([1 / 3] * 3, abs=0.02)
    shares, total = _brute_step(x, m)
    got = np.array([r["s"] for r in df.select("id", mixture.memberships("vec", {0: m}).alias("s")).orderBy("id").collect()])
    assert got == pytest.approx(shares, abs=1e-9)
    table = mixture.bic_table(df, {(0, 3): m})
    assert table[0][2] == pytest.approx(-2 * total.sum() + 14 * np.log(600))
    # A settled fit hardly moves under one more plain update.
    r = shares.sum(axis=0)
    assert (shares.T @ x / r[:, None]) == pytest.approx(m.means, abs=0.05)


def test_small_class_gets_one_gaussian(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(9, 3))
    df = spark.createDataFrame([(i, 2, [float(v) for v in r]) for i, r in enumerate(x)], "id bigint, label int, vec array<double>")
    m = mixture.fit_per_class(df)[2]
    assert m.size == 1 and m.means[0] == pytest.approx(x.mean(axis=0)) and m.variances[0] == pytest.approx(x.var(axis=0) + 1e-4)


def test_projection(rows):
    df, x, _ = rows
    p = learn.fit_projection(df, ["a", "b"], components=2)
    assert sum(p.explained) == pytest.approx(1.0)
    z = np.minimum(x[:, :2], np.percentile(x[:, :2], 99, axis=0))
    z = (z - z.mean(axis=0)) / z.std(axis=0)
    assert p.explained == pytest.approx(sorted(np.linalg.eigvalsh(np.cov(z.T)) / np.trace(np.cov(z.T)), reverse=True))
    got = np.array([(r["pc1"], r["pc2"]) for r in p.transform(df).orderBy("attack_id").collect()])
    assert np.abs(got) == pytest.approx(np.abs(z @ p.axes))


def test_learners_side_by_side_fit_the_same_models(rows, monkeypatch):
    """Together they share one table; each gives the model that it gives alone."""
    df, x, _ = rows
    spread, tables = learn._spread, []
    monkeypatch.setattr(learn, "_spread", lambda *a: tables.append(1) or spread(*a))
    one, many = (learn.fit_suite(df, COLUMNS, settings=FAST, side_by_side=b) for b in (False, True))
    assert len(tables) == 2 and list(many.models) == names.MODELS and set(many.fit_seconds) == set(names.MODELS)
    for name in ("Random Forest", "Gradient Boosting"):
        assert (one.models[name].probabilities(x) == many.models[name].probabilities(x)).all()
    assert one.models["Decision Tree"].toDebugString.split("\n")[1:] == many.models["Decision Tree"].toDebugString.split("\n")[1:]
    lr = [s.models["Logistic Regression"].coefficientMatrix.toArray() for s in (one, many)]
    assert lr[0] == pytest.approx(lr[1], abs=1e-9)


def test_a_query_fits_its_models_on_one_table(spark, rows, monkeypatch):
    from tallywire.plans import learn_q
    df, calls, fit = rows[0], [], learn.fit_suite
    monkeypatch.setattr(learn_q, "AB", COLUMNS)
    monkeypatch.setattr(learn_q, "stored_features", lambda *a: df.withColumn("split", F.lit("train")))
    monkeypatch.setattr(learn, "fit_suite", lambda *a, **k: calls.append(k["models"]) or fit(*a, **k))
    wanted = ["Decision Tree", "KNN (k=5)"]
    first = learn_q.fitted_models(spark, "one table", wanted, settings=FAST)
    again = learn_q.fitted_models(spark, "one table", [*wanted, "Logistic Regression"], settings=FAST)
    assert calls == [wanted, ["Logistic Regression"]] and all(again[n] is first[n] for n in wanted)
    assert all(list(s.models) == [n] for n, s in again.items())


def test_a_step_works_densities_out_once(monkeypatch):
    m, calls, plain = mixture.Mixture(np.array([0.4, 0.6]), np.array([[0.0, 1.0], [2.0, -1.0]]), np.array([[1.0, 2.0], [0.5, 1.0]])), [], mixture.Mixture.log_joint
    x = np.random.default_rng(2).normal(size=(50, 2))
    joint = m.log_joint(x)
    monkeypatch.setattr(mixture.Mixture, "log_joint", lambda self, x: calls.append(len(x)) or plain(self, x))
    share, level = m.expected(x)
    assert calls == [50] and (m.memberships(x) == share).all() and (m.log_likelihood(x) == level).all()
    assert level == pytest.approx(np.log(np.exp(joint).sum(axis=1))) and share.sum(axis=1) == pytest.approx(np.ones(50))
    assert share == pytest.approx(np.exp(joint - level[:, None]))
