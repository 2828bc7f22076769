"""Queries for neighbours, resampling, mixtures and models."""

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tallywire import names
from tallywire.functions.expressions import class_code
from tallywire.operators import explore, learn, metrics, mixture, neighbours, resample
from tallywire.plans.features_q import LABEL_SQL, ab, round_sql, rounded
from tallywire.plans.registry import query, share
from tallywire.plans.tables import EV, SCHEMAS, ST, components, events, stream
from tallywire.session import materialize, scratch_path
from tallywire.sources import modelstore
from tallywire.streaming import live
from tallywire.streaming.windows import first_instant, window_records, windowed

share("vecs", "SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings")
share("nn", """SELECT q, qlabel, id, label, d, row_number() OVER (PARTITION BY q ORDER BY d, id) AS rn FROM
 (SELECT a.id AS q, a.label AS qlabel, b.id, b.label, list_distance(a.vec, b.vec) AS d FROM vecs a JOIN vecs b ON a.id <> b.id)""")
share("nnc", """SELECT q, qlabel, id, d, row_number() OVER (PARTITION BY q ORDER BY d, id) AS rn FROM
 (SELECT a.id AS q, a.label AS qlabel, b.id, list_distance(a.vec, b.vec) AS d FROM vecs a JOIN vecs b ON a.id <> b.id AND a.label = b.label)""")


def vectors(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), "label", F.col("embedding").cast("array<double>").alias("vec"))


@query("join_knn", "SELECT q AS query_id, id AS neighbour_id, round(d, 6) AS distance, CAST(rn AS INT) AS rank FROM nn WHERE rn <= 5")
def join_knn(spark, sf_dir):
    """Every vector with its five nearest others."""
    v = vectors(spark, sf_dir)
    return rounded(neighbours.nearest(v, v, 5, skip_same_id=True).drop("neighbour_label"))


@query("ml_knn", """WITH v AS (SELECT q, label, count(*) AS votes FROM nn WHERE rn <= 5 GROUP BY q, label)
SELECT q AS query_id, label AS y_pred, votes FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY votes DESC, label) AS r FROM v) WHERE r = 1""")
def ml_knn(spark, sf_dir):
    v = vectors(spark, sf_dir)
    return neighbours.classify(v, v, 5, skip_same_id=True)


share("vsize", "SELECT label, count(*) AS n, max(count(*)) OVER () AS target FROM vecs GROUP BY label")
_BLENDED = """SELECT {b}.id, b.copy, b.label,
 round(list_sum(list_transform(range(1, len(b.vec) + 1), lambda i: (b.vec[i] + b.gap * (o.vec[i] - b.vec[i])) * i)), 6) AS checksum,
 round(b.vec[1] + b.gap * (o.vec[1] - b.vec[1]), 6) AS first_value
FROM drawn b JOIN nnc x ON x.q = b.id AND x.rn = b.rank JOIN vecs o ON o.id = x.id""".replace("{b}", "b")
_DRAWN = """drawn AS (SELECT c.*, u.copy, (c.id % 2147483647 * 31 + u.copy * 17 + 42) % least(5, c.n - 1) + 1 AS rank,
 ((c.id % 2147483647 * 7919 + u.copy * 104729 + 42) % 10007) / 10007.0::DOUBLE AS gap FROM copies c, LATERAL (SELECT unnest(range(0, c.copies)) AS copy) u)"""


def _shown(new):
    weighted = F.aggregate(F.transform("vec", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return rounded(new.select("id", "copy", "label", weighted.alias("checksum"), F.get("vec", F.lit(0)).alias("first_value")))


@query("ml_smote", f"""WITH ranked AS (SELECT v.*, s.n, s.target, row_number() OVER (PARTITION BY v.label ORDER BY {explore.draw_sql("v.id", 42)}, v.id) AS rn
 FROM vecs v JOIN vsize s ON v.label = s.label WHERE s.n < s.target AND s.n > 1),
copies AS (SELECT *, (target - n) // n + CASE WHEN rn <= (target - n) % n THEN 1 ELSE 0 END AS copies FROM ranked),
{_DRAWN} {_BLENDED}""")
def ml_smote(spark, sf_dir):
    return _shown(resample.smote(vectors(spark, sf_dir)))


# Classes of unequal size that overlap, which is what this operator is about.
_MIXED = "CASE WHEN {id} % 7 = 0 THEN 1 WHEN {id} % 11 = 0 THEN 2 ELSE 0 END"
share("mvecs", f"SELECT vec_id AS id, {_MIXED.format(id='vec_id')} AS label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings")
share("mnn", """SELECT q, qlabel, id, label, d, row_number() OVER (PARTITION BY q ORDER BY d, id) AS rn,
 row_number() OVER (PARTITION BY q, label = qlabel ORDER BY d, id) AS own_rn FROM
 (SELECT a.id AS q, a.label AS qlabel, b.id, b.label, list_distance(a.vec, b.vec) AS d FROM mvecs a JOIN mvecs b ON a.id <> b.id)""")


@query("ml_adasyn", f"""WITH f AS (SELECT q AS id, avg(CASE WHEN label <> qlabel THEN 1.0::DOUBLE ELSE 0 END) AS r FROM mnn WHERE rn <= 5 GROUP BY q),
s AS (SELECT label, count(*) AS n, max(count(*)) OVER () AS target FROM mvecs GROUP BY label),
copies AS (SELECT v.*, s.n, CAST(round_even(f.r / sum(f.r) OVER (PARTITION BY v.label) * (s.target - s.n), 0) AS BIGINT) AS copies
 FROM mvecs v JOIN s ON v.label = s.label JOIN f ON f.id = v.id WHERE s.n < s.target AND s.n > 1),
{_DRAWN} {_BLENDED.replace("JOIN nnc x ON x.q = b.id AND x.rn = b.rank JOIN vecs o", "JOIN mnn x ON x.q = b.id AND x.label = x.qlabel AND x.own_rn = b.rank JOIN mvecs o")}""")
def ml_adasyn(spark, sf_dir):
    return _shown(resample.adasyn(vectors(spark, sf_dir).withColumn("label", F.expr(_MIXED.format(id="id")))))


AB = names.FEATURES_AB
K = 2  # components per class of the given mixtures
share("trainab", "SELECT * FROM fab WHERE split = 'train'")
share("scl", "SELECT {} FROM trainab".format(", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) > 1e-12 * greatest(1, abs(avg({c}))) THEN stddev_pop({c}) ELSE 1 END AS s_{c}" for c in AB)))
share("scaledab", "SELECT f.attack_id, f.split, f.label, {} FROM fab f CROSS JOIN scl".format(
    ", ".join(f"(f.{c} - m_{c}) / s_{c} AS {c}" for c in AB)))
share("scaledlong", f"SELECT attack_id, split, label, f, z FROM scaledab UNPIVOT (z FOR f IN ({', '.join(AB)}))")
# Given mixtures: in every class the training rows with even and odd id are the components.
share("gmp", """SELECT label AS c, attack_id % 2 AS k, f, avg(z) AS m, var_pop(z) + 0.0001::DOUBLE AS v FROM scaledlong WHERE split = 'train' GROUP BY 1, 2, 3""")
share("gmw", """SELECT label AS c, attack_id % 2 AS k, count(*) / CAST(sum(count(*)) OVER (PARTITION BY label) AS DOUBLE) AS w FROM trainab GROUP BY 1, 2""")
share("gml", """SELECT s.attack_id, any_value(s.label) AS label, any_value(s.split) AS split, p.c, p.k,
 ln(any_value(w.w)) - 0.5 * sum(ln(2 * pi() * p.v) + (s.z - p.m) ** 2 / p.v) AS lj
FROM scaledlong s JOIN gmp p ON s.f = p.f JOIN gmw w ON w.c = p.c AND w.k = p.k GROUP BY s.attack_id, p.c, p.k""")
share("gmll", """SELECT attack_id, label, split, c, k, lj, max(lj) OVER w + ln(sum(exp(lj - t)) OVER w) AS ll FROM
 (SELECT *, max(lj) OVER (PARTITION BY attack_id, c) AS t FROM gml) WINDOW w AS (PARTITION BY attack_id, c)""")
share("gmm", "SELECT attack_id, {} FROM gmll GROUP BY attack_id".format(
    ", ".join(f"max(exp(lj - ll)) FILTER (c = {c} AND k = {k}) AS gmm_c{c}_k{k}" for c in range(3) for k in range(K))))
_MEMBERS = [f"gmm_c{c}_k{k}" for c in range(3) for k in range(K)]


def features_of(spark, sf_dir, blocks=("ab",)):
    return ab(spark, sf_dir, blocks=blocks, keep=("split",)).drop("type")


_STORED: dict[tuple, DataFrame] = {}


def stored_features(spark, sf_dir, blocks=("ab", "extras", "v1")):
    """The feature table, written once per session and reused by the model queries."""
    key = (spark.sparkContext.applicationId, sf_dir, blocks)
    if key not in _STORED:
        _STORED[key] = materialize(features_of(spark, sf_dir, blocks))
    return _STORED[key]


def training(df):
    return df.filter("split = 'train'")


@query("ml_scale", f"SELECT attack_id, {round_sql(AB, 5)} FROM scaledab")
def ml_scale(spark, sf_dir):
    df = features_of(spark, sf_dir)
    scaler = learn.Scaler.fit(training(df), AB)
    return rounded(df.select("attack_id", *scaler.scaled()), 5)


def _weights(spark, weights):
    return spark.createDataFrame([(int(c), float(w)) for c, w in weights.items()], "label int, weight double")


@query("ml_weights_balanced", f"""SELECT {LABEL_SQL} AS label, round((SELECT count(*) FROM evtrain) / (3.0::DOUBLE * count(*)), 6) AS weight
FROM evtrain e GROUP BY 1""")
def ml_weights_balanced(spark, sf_dir):
    return rounded(_weights(spark, learn.balanced_weights(_train_counts(spark, sf_dir))))


@query("ml_weights_prior", f"""WITH r AS (SELECT {LABEL_SQL} AS label, CASE {LABEL_SQL} WHEN 0 THEN 0.9014::DOUBLE WHEN 1 THEN 0.0649::DOUBLE ELSE 0.0337::DOUBLE END
 / (count(*) / CAST((SELECT count(*) FROM evtrain) AS DOUBLE)) AS w FROM evtrain e GROUP BY 1) SELECT label, round(w / avg(w) OVER (), 4) AS weight FROM r""")
def ml_weights_prior(spark, sf_dir):
    return _weights(spark, learn.prior_weights(_train_counts(spark, sf_dir)))


def _train_counts(spark, sf_dir):
    return learn.class_counts(training(events(spark, sf_dir)).select(class_code("type").alias("label")))


@query("ml_majority", f"""WITH t AS (SELECT {LABEL_SQL} AS label, count(*) AS n FROM evtrain e GROUP BY 1 ORDER BY n DESC, label LIMIT 1)
SELECT e.attack_id, {LABEL_SQL} AS y_true, t.label AS y_pred FROM ev e CROSS JOIN t WHERE e.split <> 'train'""")
def ml_majority(spark, sf_dir):
    said = learn.majority_class(_train_counts(spark, sf_dir))
    held = events(spark, sf_dir).filter("split <> 'train'")
    return held.select("attack_id", class_code("type").alias("y_true"), F.lit(said).alias("y_pred"))


def given_mixtures(spark, sf_dir):
    """Mixtures whose parameters are plain statistics of the training rows."""
    df = features_of(spark, sf_dir)
    scaler = learn.Scaler.fit(training(df), AB)
    scaled = df.select("attack_id", "split", "label", *scaler.scaled())
    stats = training(scaled).groupBy("label", (F.col("attack_id") % K).alias("k")).agg(
        F.count("*").alias("n"), F.array(*[F.avg(c) for c in AB]).alias("m"), F.array(*[F.var_pop(c) for c in AB]).alias("v"))
    parts = {}
    for r in sorted(stats.collect(), key=lambda r: (r["label"], r["k"])):  # one row per component
        parts.setdefault(r["label"], []).append(r)
    mixtures = {
        c: mixture.Mixture(np.array([r["n"] for r in rs]) / sum(r["n"] for r in rs), np.array([r["m"] for r in rs]),
                           np.array([r["v"] for r in rs]) + mixture.FLOOR)
        for c, rs in parts.items()
    }
    return scaled, mixtures


@query("feat_member", f"SELECT attack_id, {round_sql(_MEMBERS)} FROM gmm")
def feat_member(spark, sf_dir):
    scaled, mixtures = given_mixtures(spark, sf_dir)
    shares = scaled.select("attack_id", mixture.memberships(F.array(*AB), mixtures).alias("s"))
    return rounded(shares.select("attack_id", *[F.get("s", F.lit(i)).alias(n) for i, n in enumerate(mixture.column_names(mixtures))]))


@query("feat_ood", f"""WITH s AS (SELECT attack_id, [{", ".join(_MEMBERS)}] AS s, {" + ".join(_MEMBERS)} AS t FROM gmm)
SELECT attack_id, round(list_max(s), 6) AS gmm_max_prob, round(-list_sum(list_transform(s, lambda x: x / t * ln(x / t + 1e-12))), 6) AS gmm_entropy FROM s""")
def feat_ood(spark, sf_dir):
    scaled, mixtures = given_mixtures(spark, sf_dir)
    shares = scaled.select("attack_id", mixture.memberships(F.array(*AB), mixtures).alias("s"))
    return rounded(shares.select("attack_id", mixture.best_membership("s").alias("gmm_max_prob"), mixture.entropy("s").alias("gmm_entropy")))


@query("ml_gmm_bic", f"""SELECT label, {K} AS size, round(-2 * sum(ll) + ({2 * K * len(AB) + K - 1}) * ln(count(*)), 3) AS bic FROM
 (SELECT DISTINCT attack_id, label, ll FROM gmll WHERE c = label AND split = 'train') GROUP BY label""")
def ml_gmm_bic(spark, sf_dir):
    scaled, mixtures = given_mixtures(spark, sf_dir)
    rows = training(scaled).select("label", F.array(*AB).alias("vec"))
    table = mixture.bic_table(rows, {(c, m.size): m for c, m in mixtures.items()})
    return rounded(spark.createDataFrame(table, "label int, size int, bic double"), 3)


@query("ml_gmm")
def ml_gmm(spark, sf_dir):
    """Mixtures fitted per class on the training rows; memberships of all events."""
    df = stored_features(spark, sf_dir)
    scaler = learn.Scaler.fit(training(df), AB)
    rows = training(df).select(F.col("attack_id").alias("id"), "label", scaler.vector().alias("vec"))
    mixtures = mixture.fit_per_class(rows)
    return rounded(df.select("attack_id", mixture.memberships(scaler.vector(), mixtures).alias("s")).select(
        "attack_id", F.size("s").alias("width"), mixture.best_membership("s").alias("gmm_max_prob"), mixture.entropy("s").alias("gmm_entropy")))


@query("ml_pca")
def ml_pca(spark, sf_dir):
    """Explained variance per axis, single and cumulative, in percent."""
    projection = learn.fit_projection(events(spark, sf_dir), names.PROFILE_COLUMNS)
    rows, total = [], 0.0
    for i, v in enumerate(projection.explained, start=1):
        total += v
        rows.append((i, v * 100, total * 100))
    return rounded(spark.createDataFrame(rows, "axis int, pct double, cum_pct double"))


_FITTED: dict[tuple, learn.Suite] = {}


def fitted_models(spark, sf_dir, names_, strategy="none", settings=None):
    """Some models, one suite each, on the training rows. Fitting is the costly part, so within a session every query
    that shows a model uses the same fit, and the models of one query are fitted side by side on one table."""
    settings = settings or learn.Settings()
    keys = {name: (spark.sparkContext.applicationId, sf_dir, name, strategy, str(settings)) for name in names_}
    missing = [name for name in names_ if keys[name] not in _FITTED]
    if missing:
        train = training(stored_features(spark, sf_dir)) if strategy == "none" else resampled_training(spark, sf_dir, strategy)
        s = learn.fit_suite(train, AB, models=missing, settings=settings, side_by_side=True)
        for name in missing:
            _FITTED[keys[name]] = learn.Suite(s.scaler, {name: s.models[name]}, s.reference, s.settings, {name: s.fit_seconds[name]})
    return {name: _FITTED[key] for name, key in keys.items()}


def fitted(spark, sf_dir, name, strategy="none", settings=None):
    return fitted_models(spark, sf_dir, [name], strategy, settings)[name]


def held_out(spark, sf_dir):
    return stored_features(spark, sf_dir).filter("split <> 'train'")


def _scored(spark, sf_dir, names_, strategy="none", settings=None):
    held = held_out(spark, sf_dir)
    said = None
    for suite in fitted_models(spark, sf_dir, names_, strategy, settings).values():
        part = suite.predictions(held)
        said = part if said is None else said.unionByName(part)
    said = said.join(held.select("attack_id", F.col("split").alias("dataset")), "attack_id")
    return rounded(metrics.overall(metrics.confusion(said, ["model", "dataset"]), ["model", "dataset"]), 4)


@query("ml_logreg")
def ml_logreg(spark, sf_dir):
    return _scored(spark, sf_dir, ["Logistic Regression"])


@query("ml_tree")
def ml_tree(spark, sf_dir):
    return _scored(spark, sf_dir, ["Decision Tree"])


@query("ml_forest")
def ml_forest(spark, sf_dir):
    return _scored(spark, sf_dir, ["Random Forest"])


@query("ml_gbt")
def ml_gbt(spark, sf_dir):
    return _scored(spark, sf_dir, ["Gradient Boosting"])


@query("ml_proba")
def ml_proba(spark, sf_dir):
    """Class probabilities of all five models on the held-out events."""
    out = None
    for name, suite in fitted_models(spark, sf_dir, names.MODELS).items():
        part = suite.probabilities(name, held_out(spark, sf_dir)).withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return rounded(out)


def whole_suite(spark, sf_dir):
    """The five models as one suite; they share scaler and training rows."""
    each = fitted_models(spark, sf_dir, names.MODELS)
    one = next(iter(each.values()))
    return learn.Suite(one.scaler, {n: s.models[n] for n, s in each.items()}, one.reference, one.settings)


@query("ml_train_suite")
def ml_train_suite(spark, sf_dir):
    """All five models over one feature set, scored on both held-out splits."""
    return _scored(spark, sf_dir, names.MODELS)


_RESAMPLED: dict[tuple, DataFrame] = {}


def resampled_training(spark, sf_dir, strategy):
    """Training rows with the new rows of the strategy. The blend runs on the feature
    columns as they are, before any scaling."""
    key = (spark.sparkContext.applicationId, sf_dir, strategy)
    if key not in _RESAMPLED:
        rows = training(stored_features(spark, sf_dir)).select(
            F.col("attack_id").alias("id"), "label", F.array(*AB).alias("vec"))
        more = resample.resampled(rows, strategy).withColumn("attack_id", F.monotonically_increasing_id())
        _RESAMPLED[key] = materialize(more.select("attack_id", "label", *[F.get("vec", F.lit(i)).alias(c) for i, c in enumerate(AB)]))
    return _RESAMPLED[key]


@query("ml_resample_grid")
def ml_resample_grid(spark, sf_dir):
    out = None
    for strategy in ("none", "smote", "adasyn"):
        part = _scored(spark, sf_dir, names.MODELS, strategy).withColumn("resample", F.lit(strategy))
        out = part if out is None else out.unionByName(part)
    return out


@query("store_models")
def store_models(spark, sf_dir):
    """Store, load and use; a store of another feature version is trained anew."""
    df = stored_features(spark, sf_dir)
    path = scratch_path(spark, "models")

    def train():
        scaler = learn.Scaler.fit(training(df), AB)
        rows = training(df).select(F.col("attack_id").alias("id"), "label", scaler.vector().alias("vec"))
        return whole_suite(spark, sf_dir), mixture.fit_per_class(rows)

    modelstore.load_or_train(spark, path, train, version="older")
    suite, mixtures, default = modelstore.load_or_train(spark, path, train)
    said = suite.predictions(held_out(spark, sf_dir), [default])
    scores = metrics.overall(metrics.confusion(said, ["model"]), ["model"])
    return rounded(scores.withColumn("mixture_columns", F.lit(len(mixture.column_names(mixtures)))), 4)


def _event_stream(spark, sf_dir, view):
    table, columns = view
    return live.file_stream(spark, f"{sf_dir}/{table}*.parquet", SCHEMAS[table], columns)


@query("str_score")
def str_score(spark, sf_dir):
    """Every event, arriving as a stream, scored with the batch features and the default model."""
    suite = fitted(spark, sf_dir, modelstore.DEFAULT_MODEL)
    path = scratch_path(spark, "scored")
    live.score_stream(_event_stream(spark, sf_dir, EV), components(spark, sf_dir), suite, modelstore.DEFAULT_MODEL,
                      path, live.checkpoint_path(spark, "score"))
    return rounded(spark.read.parquet(path).drop("scored_at", "batch"))


@query("str_totals", """SELECT count(*) AS total_events, count(*) FILTER (y_pred = 2) AS total_ddos_detected,
 count(*) FILTER (y_true = 2) AS total_ddos_actual, count(*) FILTER (y_true = y_pred) AS total_correct FROM st""")
def str_totals(spark, sf_dir):
    path = scratch_path(spark, "totals")
    live.write_latest(live.totals(_event_stream(spark, sf_dir, ST)), path, live.checkpoint_path(spark, "totals"))
    return live.latest(spark, path)


@query("sink_window_json", """SELECT window_start, window_end, n_events, n_predicted_ddos, n_actual_ddos, round(accuracy, 6) AS accuracy, alert_raised FROM walert""")
def sink_window_json(spark, sf_dir):
    """All windows written as JSON by a stream, the last one included."""
    st = _event_stream(spark, sf_dir, ST)
    anchor = first_instant(stream(spark, sf_dir), "start_time")
    path = scratch_path(spark, "windows")
    live.write_windows(live.windowed_alerts(st, 3600.0, anchor), path, live.checkpoint_path(spark, "windows"))
    shape = """window_start timestamp, window_end timestamp, n_events bigint, n_predicted_ddos bigint, n_actual_ddos bigint,
        accuracy double, alert_raised boolean"""
    back = live.read_windows(spark, path, shape)
    return rounded(back.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}))


@query("str_window_records", """WITH f AS (SELECT window_start, count(*) AS samples, string_agg(attack_id, ',' ORDER BY rn DESC) AS ids FROM
 (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY start_time DESC, attack_id DESC) AS rn FROM win) WHERE rn <= 8 GROUP BY 1)
SELECT w.window_index, w.n_events, round(w.accuracy, 4) AS accuracy, w.alert_raised, w.c00 + w.c11 + w.c22 AS on_diagonal, CAST(f.samples AS INT) AS samples
FROM walert w JOIN f USING (window_start)""")
def str_window_records(spark, sf_dir):
    """The nested record per window, shown by some of its parts."""
    rows = windowed(stream(spark, sf_dir), "start_time", 3600.0)
    records = window_records(rows, "Random Forest", "replay", "stored")
    cell = lambda i: F.get(F.get("confusion", F.lit(i)), F.lit(i))
    return records.select("window_index", "n_events", "accuracy", "alert_raised",
                          (cell(0) + cell(1) + cell(2)).alias("on_diagonal"), F.size("event_samples").alias("samples"))
