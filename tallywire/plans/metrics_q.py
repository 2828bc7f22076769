"""Queries for metrics, on predictions derived from the events for five models.

A prediction is the truth, moved to the next class on a share of the events that
depends on model and configuration.
"""

from pyspark.sql import functions as F

from tallywire import names
from tallywire.functions.expressions import class_code
from tallywire.operators import metrics
from tallywire.plans.features_q import LABEL_SQL, rounded
from tallywire.plans.registry import query, share
from tallywire.plans.tables import events
from tallywire.session import scratch_path
from tallywire.sources.sinks import save_metrics

CONFIGS = ["v2", "ab", "abc"]
KEYS = ["model", "config", "dataset"]

share("pr", f"""SELECT m.model, g.config, e.split AS dataset, e.attack_id, {LABEL_SQL} AS y_true,
 CAST(({LABEL_SQL} + CASE WHEN e.attack_id % (11 + m.i) < 2 + g.i THEN 1 ELSE 0 END) % 3 AS INT) AS y_pred
FROM ev e CROSS JOIN (VALUES {", ".join(f"({i}, '{m}')" for i, m in enumerate(names.MODELS))}) m(i, model)
CROSS JOIN (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(CONFIGS))}) g(i, config) WHERE e.split <> 'train'""")
share("cm", "SELECT model, config, dataset, {} FROM pr GROUP BY model, config, dataset".format(", ".join(
    f"count(*) FILTER (y_true = {t} AND y_pred = {p}) AS c{t}{p}" for t in range(3) for p in range(3))))
share("pc", "\nUNION ALL ".join(f"""SELECT model, config, dataset, {i} AS k, '{c}' AS class,
 coalesce(c{i}{i} / nullif(CAST(c0{i} + c1{i} + c2{i} AS DOUBLE), 0), 0) AS precision,
 coalesce(c{i}{i} / nullif(CAST(c{i}0 + c{i}1 + c{i}2 AS DOUBLE), 0), 0) AS recall,
 coalesce(2 * c{i}{i} / nullif(CAST(c0{i} + c1{i} + c2{i} + c{i}0 + c{i}1 + c{i}2 AS DOUBLE), 0), 0) AS f1,
 c{i}0 + c{i}1 + c{i}2 AS support, c0{i} + c1{i} + c2{i} + c{i}0 + c{i}1 + c{i}2 > 0 AS present FROM cm"""
    for i, c in enumerate(names.CLASSES)))
share("mac", """SELECT model, config, dataset, avg(precision) AS precision, avg(recall) AS recall,
 coalesce(avg(f1) FILTER (present), 0) AS f1, CAST(sum(support) AS BIGINT) AS support, avg(f1) AS f1_fixed,
 coalesce(avg(precision) FILTER (present), 0) AS precision_present, coalesce(avg(recall) FILTER (present), 0) AS recall_present,
 sum(f1 * support) / sum(support) AS f1_weighted FROM pc GROUP BY model, config, dataset""")


def predictions(spark, sf_dir):
    """Every event under every model and configuration, tagged with its split."""
    ev = events(spark, sf_dir).filter("split <> 'train'")
    runs = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(m).alias("model"), F.lit(j).alias("j"), F.lit(c).alias("config"))
        for i, m in enumerate(names.MODELS) for j, c in enumerate(CONFIGS)
    ])
    rows = ev.select("attack_id", F.col("split").alias("dataset"), class_code("type").alias("y_true"), F.explode(runs).alias("r"))
    moved = F.when(F.col("attack_id") % (11 + F.col("r.i")) < 2 + F.col("r.j"), 1).otherwise(0)
    return rows.select("r.model", "r.config", "dataset", "attack_id", "y_true",
                       ((F.col("y_true") + moved) % 3).cast("int").alias("y_pred"))


def counts(spark, sf_dir, keys=KEYS):
    return metrics.confusion(predictions(spark, sf_dir), keys)


@query("agg_confusion", "\nUNION ALL ".join(
    f"SELECT model, config, dataset, {t} AS y_true, {p} AS y_pred, c{t}{p} AS n FROM cm" for t in range(3) for p in range(3)))
def agg_confusion(spark, sf_dir):
    return metrics.confusion_rows(counts(spark, sf_dir), KEYS).drop("row_pct")


@query("agg_confusion_rowpct", "\nUNION ALL ".join(
    f"""SELECT model, config, dataset, {t} AS y_true, {p} AS y_pred,
 round(c{t}{p} / greatest(c{t}0 + c{t}1 + c{t}2, 1) * 100, 1) AS row_pct FROM cm""" for t in range(3) for p in range(3)))
def agg_confusion_rowpct(spark, sf_dir):
    return metrics.confusion_rows(counts(spark, sf_dir), KEYS).drop("n")


@query("agg_per_class", "SELECT model, config, dataset, class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM pc")
def agg_per_class(spark, sf_dir):
    return rounded(metrics.per_class(counts(spark, sf_dir), KEYS, macro=False))


@query("agg_macro_row", """SELECT model, config, dataset, '__macro__' AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
 round(f1, 6) AS f1, support FROM mac""")
def agg_macro_row(spark, sf_dir):
    return rounded(metrics.per_class(counts(spark, sf_dir), KEYS).filter(F.col("class") == names.MACRO))


@query("agg_scores", """SELECT m.model, m.config, m.dataset, m.support AS n_events, round((c00 + c11 + c22) / CAST(m.support AS DOUBLE), 6) AS accuracy,
 round(precision_present, 6) AS precision_macro, round(recall_present, 6) AS recall_macro, round(f1, 6) AS f1_macro,
 round(f1_fixed, 6) AS f1_macro_fixed, round(f1_weighted, 6) AS f1_weighted, CAST(round(m.support / 2.0) AS BIGINT) AS throughput_eps
 FROM mac m JOIN cm USING (model, config, dataset)""")
def agg_scores(spark, sf_dir):
    scores = metrics.overall(counts(spark, sf_dir), KEYS).withColumn("seconds", F.lit(2.0))
    return rounded(metrics.with_throughput(scores, "seconds").drop("seconds"))


@query("ml_eval_splits", """SELECT model, dataset, sum(support)::BIGINT AS n_events, round(avg(f1), 4) AS f1_macro FROM mac WHERE config = 'abc'
 GROUP BY model, dataset""")
def ml_eval_splits(spark, sf_dir):
    """All models on both held-out splits: the union of their predictions, one aggregate."""
    abc = predictions(spark, sf_dir).filter("config = 'abc'")
    scores = metrics.overall(metrics.confusion(abc, ["model", "dataset"]), ["model", "dataset"])
    return rounded(scores.select("model", "dataset", "n_events", "f1_macro"), 4)


_BOTH = """SELECT model, config, dataset, class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM pc
UNION ALL SELECT model, config, dataset, '__macro__', round(precision, 6), round(recall, 6), round(f1, 6), support FROM mac"""


@query("ml_ablation", _BOTH)
def ml_ablation(spark, sf_dir):
    """The whole grid of configurations, models and splits as per-class and macro rows."""
    return rounded(metrics.per_class(counts(spark, sf_dir), KEYS))


@query("sink_metrics_csv", _BOTH)
def sink_metrics_csv(spark, sf_dir):
    table = ml_ablation(spark, sf_dir)
    path = scratch_path(spark, "metrics")
    save_metrics(table, path)
    return spark.read.schema(table.schema).option("header", True).csv(path)


_RUNS = [f"{c}_{d}" for c in CONFIGS for d in ("test", "genericity")]


@query("agg_results_pivot", "SELECT model, {}, CAST(CASE model {} END AS INT) AS place FROM mac GROUP BY model".format(
    ", ".join(f"round(max(f1) FILTER (config || '_' || dataset = '{r}'), 6) AS {r}" for r in _RUNS),
    " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(names.MODELS, start=1))))
def agg_results_pivot(spark, sf_dir):
    scores = metrics.overall(counts(spark, sf_dir), KEYS).withColumn("run", F.concat_ws("_", "config", "dataset"))
    return rounded(metrics.pivoted(scores, "run", _RUNS, "f1_macro"))


@query("agg_lookup_zero", """SELECT m.model, m.config, m.dataset, c.class, round(coalesce(p.f1, 0), 6) AS f1
FROM (SELECT DISTINCT model, config, dataset FROM pr) m CROSS JOIN (VALUES ('Normal traffic'), ('Suspicious traffic'), ('DDoS attack'), ('Unknown')) c(class)
LEFT JOIN pc p ON p.model = m.model AND p.config = m.config AND p.dataset = m.dataset AND p.class = c.class""")
def agg_lookup_zero(spark, sf_dir):
    table = metrics.per_class(counts(spark, sf_dir), KEYS, macro=False)
    grid = metrics.grid_of(table, KEYS, "class", names.CLASSES + ["Unknown"])
    return rounded(metrics.looked_up(table, grid, KEYS + ["class"], "f1"))


@query("join_delta", """SELECT a.model, a.dataset, round(a.f1, 6) AS before, round(b.f1, 6) AS after, round(b.f1 - a.f1, 6) AS delta
FROM mac a JOIN mac b ON a.model = b.model AND a.dataset = b.dataset WHERE a.config = 'v2' AND b.config = 'abc'""")
def join_delta(spark, sf_dir):
    scores = metrics.overall(counts(spark, sf_dir), KEYS)
    part = lambda c: scores.filter(F.col("config") == c)
    return rounded(metrics.delta(part("v2"), part("abc"), ["model", "dataset"], "f1_macro"))


@query("agg_best_config", """SELECT dataset, model, config, round(f1, 6) AS f1_macro FROM (SELECT *, row_number() OVER (PARTITION BY dataset
 ORDER BY round(f1, 9) DESC, model, config) AS rn FROM mac) WHERE rn = 1""")
def agg_best_config(spark, sf_dir):
    scores = metrics.overall(counts(spark, sf_dir), KEYS).withColumn("f1_macro", F.round("f1_macro", 9))
    return rounded(metrics.best_configuration(scores, ["dataset"], "f1_macro"))


_SOURCE = "CASE WHEN attack_id % 2 = 0 THEN 'synthetic_' ELSE 'hping3_' END || CASE attack_id % 3 WHEN 0 THEN 'syn' WHEN 1 THEN 'dns' ELSE 'mixed' END"


@query("agg_source_mean", f"""WITH s AS (SELECT *, {_SOURCE} AS source FROM pr WHERE config = 'ab'),
c AS (SELECT model, source, y.k, count(*) FILTER (y_true = y.k AND y_pred = y.k) AS hit, count(*) FILTER (y_true = y.k) + count(*) FILTER (y_pred = y.k) AS seen
 FROM s CROSS JOIN (VALUES (0), (1), (2)) y(k) GROUP BY model, source, y.k),
f AS (SELECT model, source, avg(2 * hit / CAST(seen AS DOUBLE)) FILTER (seen > 0) AS f1 FROM c GROUP BY model, source)
SELECT model, CASE WHEN starts_with(source, 'synthetic') THEN 'synthetic' ELSE 'hping3' END AS kind, round(avg(f1), 6) AS f1_macro FROM f GROUP BY 1, 2""")
def agg_source_mean(spark, sf_dir):
    rows = predictions(spark, sf_dir).filter("config = 'ab'").withColumn("source", F.expr(_SOURCE))
    scores = metrics.overall(metrics.confusion(rows, ["model", "source"]), ["model", "source"])
    return rounded(metrics.source_means(scores, ["synthetic", "hping3"], "f1_macro"))
