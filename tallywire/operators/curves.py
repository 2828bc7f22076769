"""Precision and recall over all thresholds of a score, the threshold that reaches a recall, and what is missed.

Rows shrink to one per distinct score first, so ties are one step and a score that a third of all rows share is one row.
The running counts over those are made in ranges of the score, whatever their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallywire.functions.quantiles import matching
from tallywire.functions.ranking import ordered


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def precision_recall(scored: DataFrame, keys: list[str], positive: Column, score: str, limit: int | None = None) -> DataFrame:
    """Per key and distinct score: hits at that score, and precision and recall when all rows from it upward are called positive.

    Rows without a score are never called positive; their positives count as missed. NaN is above every number, as in Spark's order.
    Recall is 0 where a key has no positive row. ``keys`` must not be empty.
    """
    steps = scored.groupBy(*keys, F.col(score).alias("threshold")).agg(F.count_if(positive).alias("hits"), F.count("*").alias("_n"))
    actual = steps.groupBy(*keys).agg(F.sum("hits").alias("actual"))
    running = ordered(steps.filter("threshold IS NOT NULL"), keys, [F.desc("threshold")], "_rn",
                      {"tp": F.col("hits"), "_said": F.col("_n")}, limit)
    out = matching(running, actual, keys, "inner")
    return out.select(
        *keys, "threshold", "hits", "tp", (F.col("_said") - F.col("tp")).alias("fp"), (F.col("actual") - F.col("tp")).alias("fn"),
        _ratio(F.col("tp"), F.col("_said")).alias("precision"), _ratio(F.col("tp"), F.col("actual")).alias("recall"))


def average_precision(curve: DataFrame, keys: list[str]) -> DataFrame:
    """Area under the steps of the curve: the precision at each step weighted by the recall it adds."""
    gained = F.sum(F.col("hits") * F.col("precision"))
    return curve.groupBy(*keys).agg(_ratio(gained, F.max(F.col("tp") + F.col("fn"))).alias("pr_auc"))


def threshold_for_recall(curve: DataFrame, keys: list[str], recall: float = 0.95) -> DataFrame:
    """Per key the step of highest precision among those that reach ``recall``, ties to the higher threshold.

    Keys that cannot reach it, for want of positives or scores, have no row.
    """
    best = F.max_by(F.struct("threshold", "tp", "fp", "fn", "precision", "recall"), F.struct("precision", "threshold"))
    return curve.filter(F.col("recall") >= recall).groupBy(*keys).agg(best.alias("r")).select(*keys, "r.*")


def at_threshold(scored: DataFrame, keys: list[str], positive: Column, score: str, threshold: float) -> DataFrame:
    """The same figures at one given threshold, such as the default of 0.5."""
    said = F.coalesce(F.col(score) >= threshold, F.lit(False))
    counts = scored.groupBy(*keys).agg(
        F.count_if(said & positive).alias("tp"), F.count_if(said & ~positive).alias("fp"), F.count_if(~said & positive).alias("fn"))
    return counts.select(*keys, F.lit(float(threshold)).alias("threshold"), "tp", "fp", "fn",
                         _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                         _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def missed(scored: DataFrame, groups: list[str], measures: list[str], code: int, truth: str = "y_true", said: str = "y_pred") -> DataFrame:
    """Of the rows of class ``code`` per group: how many, how many were called something else, and the mean of each
    measure over the caught and over the missed (NULL where there is none)."""
    own = scored.filter(F.col(truth) == code).withColumn("_hit", F.coalesce(F.col(said) == code, F.lit(False)))
    means = [F.avg(F.when(F.col("_hit") if kind == "caught" else ~F.col("_hit"), F.col(m).cast("double"))).alias(f"{m}_{kind}")
             for m in measures for kind in ("caught", "missed")]
    out = own.groupBy(*groups).agg(F.count("*").alias("n"), F.count_if(~F.col("_hit")).alias("n_missed"), *means)
    return out.withColumn("miss_rate", _ratio(F.col("n_missed"), F.col("n")))
