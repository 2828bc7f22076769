"""Scaling, class weights, the five classifiers, and their predictions."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tallywire import names
from tallywire.functions.quantiles import quantile_table
from tallywire.operators import boosting, forest, neighbours


#: Partitions of the training rows; the larger ones are spilled if they must be.
MOST_PARTITIONS = 48


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per feature; a constant feature keeps its scale."""

    columns: list[str]
    means: list[float]
    deviations: list[float]

    @staticmethod
    def fit(df: DataFrame, columns: list[str]) -> "Scaler":
        row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
        means = [float(row[f"m_{c}"] or 0.0) for c in columns]
        spread = [float(row[f"s_{c}"] or 0.0) for c in columns]
        return Scaler(list(columns), means, [s if s > 1e-12 * max(1.0, abs(m)) else 1.0 for s, m in zip(spread, means)])

    def scaled(self) -> list[Column]:
        return [((F.col(c) - F.lit(m)) / F.lit(s)).alias(c) for c, m, s in zip(self.columns, self.means, self.deviations)]

    def vector(self) -> Column:
        return F.array(*self.scaled())


def class_counts(df: DataFrame, label: str = "label") -> dict[int, int]:
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect()}  # one row per class


def balanced_weights(counts: dict[int, int]) -> dict[int, float]:
    n, k = sum(counts.values()), len(counts)
    return {c: n / (k * m) for c, m in counts.items()}


def prior_weights(counts: dict[int, int], prior: dict[int, float] = names.TARGET_PRIOR) -> dict[int, float]:
    """Target prior over training share, divided by the mean of these, four decimals."""
    n = sum(counts.values())
    raw = {c: p / (counts[c] / n) for c, p in prior.items() if counts.get(c)}
    mean = sum(raw.values()) / len(raw)
    return {c: round(w / mean, 4) for c, w in raw.items()}


def weight_column(weights: dict[int, float], label: str = "label") -> Column:
    return F.create_map(*[F.lit(v) for pair in weights.items() for v in pair])[F.col(label)]


def majority_class(counts: dict[int, int]) -> int:
    return max(sorted(counts), key=lambda c: counts[c])


def model_table(df: DataFrame, scaler: Scaler, weights: dict[int, float] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Label, raw and scaled feature vectors and the class weight."""
    raw = F.array(*[F.col(c).cast("double") for c in scaler.columns])
    out = [
        *[F.col(c) for c in keep], F.col("label").cast("double").alias("label"),
        array_to_vector(raw).alias("features"), array_to_vector(scaler.vector()).alias("scaled"),
    ]
    if weights is not None:
        out.append(weight_column(weights).alias("weight"))
    return df.select(*out)


@dataclass
class Settings:
    """The settings of the five classifiers."""

    lr_iterations: int = 1000
    lr_c: float = 1.0
    tree_depth: int = 10
    forest_trees: int = 100
    forest_depth: int = 15
    neighbours: int = 5
    gbt_rounds: int = 200
    gbt_depth: int = 5
    gbt_rate: float = 0.1
    bins: int = 255
    seed: int = 42
    rows_per_partition: int = 4_000


@dataclass(frozen=True)
class BoostedClassifier:
    settings: boosting.Boosting

    def fit(self, table: DataFrame) -> boosting.BoostedModel:
        return boosting.fit(table, self.settings)


@dataclass(frozen=True)
class ForestClassifier:
    settings: forest.Forest

    def fit(self, table: DataFrame) -> forest.ForestModel:
        return forest.fit(table, self.settings)


def estimator(name: str, weight_sum: float, s: Settings):
    """The estimator of a model, or None for neighbours, which only keep their rows."""
    if name == "Logistic Regression":
        return LogisticRegression(
            family="multinomial", maxIter=s.lr_iterations, standardization=False,
            regParam=1.0 / (s.lr_c * weight_sum), featuresCol="scaled", weightCol="weight")
    if name == "Decision Tree":
        return DecisionTreeClassifier(maxDepth=s.tree_depth, weightCol="weight", seed=s.seed, maxBins=s.bins)
    if name == "Random Forest":
        return ForestClassifier(forest.Forest(s.forest_trees, s.forest_depth, s.bins, s.seed))
    if name == "Gradient Boosting":
        return BoostedClassifier(boosting.Boosting(s.gbt_rounds, s.gbt_depth, s.gbt_rate, s.bins, classes=len(names.CLASSES)))
    if name == "KNN (k=5)":
        return None
    raise ValueError(f"unknown model {name!r}")


@dataclass
class Suite:
    """Fitted classifiers over one feature set, with the scaler of its training rows."""

    scaler: Scaler
    models: dict[str, object]
    reference: DataFrame | None = None      # scaled training rows, for neighbours
    settings: Settings = field(default_factory=Settings)
    fit_seconds: dict[str, float] = field(default_factory=dict)

    def predict(self, name: str, df: DataFrame, key: str = "attack_id") -> DataFrame:
        """Columns: key, y_true, y_pred."""
        if name == "KNN (k=5)":
            queries = df.select(F.col(key).alias("id"), self.scaler.vector().alias("vec"))
            votes = neighbours.classify(queries, self.reference, self.settings.neighbours)
            said = df.select(key, F.col("label").alias("y_true")).join(
                votes.withColumnRenamed("query_id", key), key, "left")
            return said.select(key, "y_true", "y_pred")
        table = model_table(df, self.scaler, keep=(key,))
        said = self.models[name].transform(table)
        return said.select(key, F.col("label").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"))

    def probabilities(self, name: str, df: DataFrame, key: str = "attack_id") -> DataFrame:
        """Probability per class in class order; classes the model never saw get zero.

        For neighbours these are the shares of votes.
        """
        if name == "KNN (k=5)":
            return self._vote_shares(df, key)
        model, table = self.models[name], model_table(df, self.scaler, keep=(key,))
        said = model.transform(table)
        p = vector_to_array("probability")
        columns = [F.coalesce(F.get(p, F.lit(c)), F.lit(0.0)).alias(f"p_{c}") for c in range(len(names.CLASSES))]
        return said.select(key, F.col("label").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"), *columns)

    def _vote_shares(self, df: DataFrame, key: str) -> DataFrame:
        queries = df.select(F.col(key).alias("id"), self.scaler.vector().alias("vec"))
        near = neighbours.nearest(queries, self.reference, self.settings.neighbours)
        share = [F.avg((F.col("neighbour_label") == c).cast("double")).alias(f"p_{c}") for c in range(len(names.CLASSES))]
        voted = near.groupBy("query_id").agg(*share).join(neighbours.majority_vote(near).select("query_id", "y_pred"), "query_id")
        said = df.select(key, F.col("label").alias("y_true")).join(voted.withColumnRenamed("query_id", key), key, "left")
        return said.select(key, "y_true", "y_pred", *[f"p_{c}" for c in range(len(names.CLASSES))])

    def predictions(self, df: DataFrame, models: list[str] | None = None, key: str = "attack_id") -> DataFrame:
        """Predictions of several models as one table, tagged with the model."""
        out = None
        for name in models or list(self.models):
            part = self.predict(name, df, key).withColumn("model", F.lit(name))
            out = part if out is None else out.unionByName(part)
        return out


def _spread(table: DataFrame, rows: int, per_partition: int, key: str | None) -> DataFrame:
    """Partitions and an order that depend on the rows alone, because learners sample and add up row by row in each
    partition: with a key, the same rows give the same model on any number of cores. ``draw`` numbers the rows.

    Every partition hands on one set of counts per tree level, so beyond ``MOST_PARTITIONS`` partitions grow instead of their number.
    """
    parts = max(1, min(-(-rows // per_partition), MOST_PARTITIONS))
    if key is None:
        return table.repartition(parts).withColumn("draw", F.monotonically_increasing_id())
    return table.repartition(parts, key).sortWithinPartitions(key).withColumn("draw", F.xxhash64(key)).drop(key)


def fit_suite(
    train: DataFrame, columns: list[str], weights: dict[int, float] | None = None,
    models: list[str] = names.MODELS, settings: Settings | None = None, key: str = "attack_id", side_by_side: bool = False,
) -> Suite:
    """Fit the wanted classifiers on rows (key, label, features).

    ``weights`` per class default to balanced ones. ``train`` is read once per pass of
    each learner, so it should be stored or cached by the caller. Learners that run ``side_by_side`` share the cores, so
    that one which keeps few of them busy does not hold up the others; their seconds then overlap.
    """
    settings = settings or Settings()
    if key in train.columns and not train.groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError(f"{key} is not unique in the training rows")
    counts = class_counts(train)
    weights = weights or balanced_weights(counts)
    scaler = Scaler.fit(train, columns)
    named = key if key in train.columns else None
    table = model_table(train, scaler, weights, keep=(named,) if named else ())
    table = _spread(table, sum(counts.values()), settings.rows_per_partition, named)
    table.persist()
    weight_sum = sum(weights[c] * n for c, n in counts.items())
    fitted, seconds = {}, {}

    def fit(name: str) -> tuple[object, float]:
        begin = time.perf_counter()
        learner = estimator(name, weight_sum, settings)
        return learner.fit(table) if learner is not None else None, time.perf_counter() - begin

    try:
        with ThreadPoolExecutor(len(models) if side_by_side and models else 1) as pool:
            ran = {name: pool.submit(inheritable_thread_target(train.sparkSession)(fit), name) for name in models}
        for name in models:
            fitted[name], seconds[name] = ran[name].result()
    finally:
        table.unpersist()
    reference = train.select(F.col(key).alias("id"), "label", scaler.vector().alias("vec")) if key in train.columns else None
    return Suite(scaler, fitted, reference, settings, seconds)


@dataclass(frozen=True)
class Projection:
    """Principal axes of clipped, scaled features; each axis points where its largest
    loading is positive."""

    columns: list[str]
    caps: list[float]
    scaler: Scaler
    axes: np.ndarray        # (features, components)
    explained: list[float]

    def _clipped(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.least(F.col(c).cast("double"), F.lit(cap)) for c, cap in zip(self.columns, self.caps)})

    def transform(self, df: DataFrame, n: int = 2) -> DataFrame:
        scaled = self.scaler.scaled()
        axes = [
            sum((z * F.lit(float(w)) for z, w in zip(scaled, self.axes[:, j])), F.lit(0.0)).alias(f"pc{j + 1}")
            for j in range(n)
        ]
        return self._clipped(df).select("*", *axes)


def fit_projection(df: DataFrame, columns: list[str], q: float = 0.99, components: int = 5) -> Projection:
    """PCA on features clipped at their q-quantile and scaled."""
    row = quantile_table(df, [], {c: (F.col(c), q) for c in columns}).first()
    caps = [float(row[c]) for c in columns]
    clipped = df.withColumns({c: F.least(F.col(c).cast("double"), F.lit(cap)) for c, cap in zip(columns, caps)})
    scaler = Scaler.fit(clipped, columns)
    table = clipped.select(array_to_vector(scaler.vector()).alias("v"))
    model = PCA(k=min(components, len(columns)), inputCol="v", outputCol="pc").fit(table)
    axes = model.pc.toArray()
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    return Projection(list(columns), caps, scaler, axes * np.where(signs == 0, 1, signs), [float(v) for v in model.explainedVariance])


def probability_alert(p: Column | str, threshold: float = 0.5) -> Column:
    return (F.col(p) if isinstance(p, str) else p) >= threshold
