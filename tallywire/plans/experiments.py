"""Whole experiments: feature configurations x models x held-out splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tallywire import names
from tallywire.operators import learn, metrics, mixture
from tallywire.session import materialize


@dataclass(frozen=True)
class Configuration:
    """A named choice of feature columns and of class weights: balanced or prior."""

    name: str
    columns: list[str]
    weights: str = "balanced"


def with_mixture_columns(df: DataFrame, columns: list[str], train: str = "train") -> tuple[DataFrame, list[str]]:
    """Add per-class mixture memberships, fitted on the training split, and their two
    summaries. Returns the table and the names of the membership columns."""
    rows = df.filter(F.col("split") == train)
    scaler = learn.Scaler.fit(rows, columns)
    vec = scaler.vector()
    mixtures = mixture.fit_per_class(rows.select(F.col("attack_id").alias("id"), "label", vec.alias("vec")))
    members = mixture.column_names(mixtures)
    shares = df.withColumn("_s", mixture.memberships(vec, mixtures))
    out = shares.select(
        *df.columns, *[F.get("_s", F.lit(i)).alias(n) for i, n in enumerate(members)],
        mixture.best_membership("_s").alias("gmm_max_prob"), mixture.entropy("_s").alias("gmm_entropy"))
    return materialize(out), members


def configurations(members: list[str]) -> list[Configuration]:
    """The published comparison on the 21-column block."""
    ab, extras, ood = names.FEATURES_AB, names.FEATURES_EXTRA, names.FEATURES_OOD
    return [
        Configuration("ab", ab), Configuration("abc", ab, "prior"), Configuration("ab_cluster", ab + members),
        Configuration("ab_extras", ab + extras), Configuration("ab_extras_ood", ab + extras + ood),
    ]


def ablation(
    table: DataFrame, chosen: list[Configuration], models: list[str] = names.MODELS,
    settings: learn.Settings | None = None,
) -> DataFrame:
    """Fit every configuration on the training split of ``table`` (attack_id, split, label,
    features) and score it on the others, as per-class and macro rows.

    All predictions are one table with one aggregate over it.
    """
    train = table.filter("split = 'train'")
    held = table.filter("split <> 'train'")
    counts = learn.class_counts(train)
    said = None
    for c in chosen:
        weights = learn.prior_weights(counts) if c.weights == "prior" else learn.balanced_weights(counts)
        suite = learn.fit_suite(train, c.columns, weights, models, settings)
        part = suite.predictions(held, models).withColumn("config", F.lit(c.name))
        said = part if said is None else said.unionByName(part)
    tagged = said.join(held.select("attack_id", F.col("split").alias("dataset")), "attack_id")
    keys = ["model", "config", "dataset"]
    return metrics.per_class(metrics.confusion(tagged, keys), keys)
