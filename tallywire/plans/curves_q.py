"""Queries for precision and recall over all thresholds, on the stream's attack probabilities."""

from pyspark.sql import functions as F

from tallywire import names
from tallywire.operators import curves
from tallywire.plans.features_q import rounded
from tallywire.plans.registry import query, share
from tallywire.plans.tables import stream

KEYS = ["port"]

share("prstep", """SELECT port, p_ddos AS threshold, count(*) FILTER (y_true = 2) AS hits, count(*) AS n FROM st GROUP BY 1, 2""")
share("prc", """SELECT port, threshold, hits, tp, said - tp AS fp, actual - tp AS fn, tp / CAST(said AS DOUBLE) AS precision,
 coalesce(tp / nullif(CAST(actual AS DOUBLE), 0), 0) AS recall FROM (SELECT *, CAST(sum(hits) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS said,
 CAST(sum(hits) OVER (PARTITION BY port) AS BIGINT) AS actual FROM prstep WINDOW w AS (PARTITION BY port ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))""")
_ROUNDED = "port, round(threshold, 6) AS threshold, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall"


def curve(spark, sf_dir):
    return curves.precision_recall(stream(spark, sf_dir), KEYS, F.col("y_true") == names.DDOS, "p_ddos")


@query("ml_pr_curve", f"SELECT {_ROUNDED}, hits FROM prc")
def ml_pr_curve(spark, sf_dir):
    return rounded(curve(spark, sf_dir))


@query("ml_pr_auc", "SELECT port, round(coalesce(sum(hits * precision) / nullif(max(tp + fn), 0), 0), 6) AS pr_auc FROM prc GROUP BY port")
def ml_pr_auc(spark, sf_dir):
    return rounded(curves.average_precision(curve(spark, sf_dir), KEYS))


@query("ml_threshold_sweep", f"""SELECT {_ROUNDED}, 'swept' AS kind FROM (SELECT *, row_number() OVER (PARTITION BY port ORDER BY precision DESC, threshold DESC) AS rn FROM prc
 WHERE recall >= 0.95) WHERE rn = 1 UNION ALL SELECT port, 0.5, tp, fp, fn, round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0), 6),
 round(coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0), 6), 'default' FROM (SELECT port, count(*) FILTER (p_ddos >= 0.5 AND y_true = 2) AS tp,
 count(*) FILTER (p_ddos >= 0.5 AND y_true <> 2) AS fp, count(*) FILTER (p_ddos < 0.5 AND y_true = 2) AS fn FROM st GROUP BY port)""")
def ml_threshold_sweep(spark, sf_dir):
    """The threshold that keeps 95 % of the attacks at the best precision, beside the default one."""
    best = curves.threshold_for_recall(curve(spark, sf_dir), KEYS).withColumn("kind", F.lit("swept"))
    plain = curves.at_threshold(stream(spark, sf_dir), KEYS, F.col("y_true") == names.DDOS, "p_ddos", 0.5)
    return rounded(best.unionByName(plain.withColumn("kind", F.lit("default"))))


@query("agg_missed_attacks", """SELECT port, count(*) AS n, count(*) FILTER (y_pred <> 2) AS n_missed, round(count(*) FILTER (y_pred <> 2) / CAST(count(*) AS DOUBLE), 6) AS miss_rate,
 {} FROM st WHERE y_true = 2 GROUP BY port""".format(", ".join(
    f"round(avg({m}) FILTER (y_pred {sign} 2), 6) AS {m}_{kind}"
    for m in ("packet_speed", "avg_packet_len") for kind, sign in (("caught", "="), ("missed", "<>")))))
def agg_missed_attacks(spark, sf_dir):
    return rounded(curves.missed(stream(spark, sf_dir), KEYS, ["packet_speed", "avg_packet_len"], names.DDOS))
