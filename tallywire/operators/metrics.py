"""Classification metrics from one pass over predictions.

Everything starts from the nine cells of the confusion matrix, counted side by side
in one aggregate that combines on the map side. The metrics are arithmetic on that
one row per model, so no grid join fills missing classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywire import names

N = len(names.CLASSES)
CELLS = [f"c{t}{p}" for t in range(N) for p in range(N)]


def confusion(predictions: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with the counts c<true><predicted>."""
    return predictions.groupBy(*keys).agg(*cells_of())


def cells_of(truth: str = "y_true", said: str = "y_pred") -> list[Column]:
    return [F.expr(f"count_if({truth} = {t} AND {said} = {p}) AS c{t}{p}") for t in range(N) for p in range(N)]


def _total(t: int | None, p: int | None) -> str:
    """Sum over cells with the given truth and/or prediction."""
    cells = [f"c{i}{j}" for i in range(N) for j in range(N) if (t is None or i == t) and (p is None or j == p)]
    return f"({' + '.join(cells)})"


_DIAGONAL = f"({' + '.join(f'c{i}{i}' for i in range(N))})"


def confusion_rows(counts: DataFrame, keys: list[str]) -> DataFrame:
    """The nine cells as rows, with the share of their true class in percent (one decimal)."""
    cells = ", ".join(
        f"""named_struct('y_true', {t}, 'y_pred', {p}, 'n', c{t}{p},
         'row_pct', round(c{t}{p} / greatest({_total(t, None)}, 1) * 100, 1))"""
        for t in range(N) for p in range(N)
    )
    return counts.select(*keys, F.expr(f"inline(array({cells}))"))


def _ratio(top: str, bottom: str) -> str:
    return f"coalesce(try_divide(double({top}), double({bottom})), 0D)"


def _class_scores(c: int) -> dict[str, str]:
    hit, truth, said = f"c{c}{c}", _total(c, None), _total(None, c)
    return {
        "precision": _ratio(hit, said), "recall": _ratio(hit, truth), "f1": _ratio(f"2 * {hit}", f"{truth} + {said}"),
        "support": truth, "present": f"({truth} + {said}) > 0",
    }


_SCORES = [_class_scores(c) for c in range(N)]
_MEASURES = ("precision", "recall", "f1", "support")


def _mean(measure: str) -> str:
    return f"({' + '.join(s[measure] for s in _SCORES)}) / {N}D"


def _present_mean(measure: str) -> str:
    """Mean over the classes that occur in truth or prediction."""
    total = " + ".join(f"if({s['present']}, {s[measure]}, 0D)" for s in _SCORES)
    there = " + ".join(f"if({s['present']}, 1, 0)" for s in _SCORES)
    return _ratio(total, there)


def per_class(counts: DataFrame, keys: list[str], macro: bool = True) -> DataFrame:
    """Precision, recall, F1 and support per class, zero where undefined.

    The macro row averages precision and recall over all classes, but F1 only over
    the classes that occur in truth or prediction.
    """
    rows = list(zip(names.CLASSES, _SCORES))
    if macro:
        rows.append((names.MACRO, {
            "precision": _mean("precision"), "recall": _mean("recall"), "f1": _present_mean("f1"),
            "support": _total(None, None),
        }))
    structs = ", ".join(
        f"named_struct('class', '{label}', {', '.join(f'{m!r}, {s[m]}' for m in _MEASURES)})" for label, s in rows)
    return counts.select(*keys, F.expr(f"inline(array({structs}))"))


def overall(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Accuracy, macro scores over occurring classes, macro F1 over all, weighted F1."""
    everything = _total(None, None)
    weighted = " + ".join(f"{s['f1']} * {s['support']}" for s in _SCORES)
    columns = {
        "n_events": everything, "accuracy": _ratio(_DIAGONAL, everything),
        "precision_macro": _present_mean("precision"), "recall_macro": _present_mean("recall"),
        "f1_macro": _present_mean("f1"), "f1_macro_fixed": _mean("f1"), "f1_weighted": _ratio(weighted, everything),
    }
    return counts.select(*keys, *[F.expr(f"{sql} AS {n}") for n, sql in columns.items()])


def with_throughput(scores: DataFrame, seconds: str) -> DataFrame:
    """Add whole events per second from a measured inference time."""
    return scores.withColumn(
        "throughput_eps", F.coalesce(F.round(F.try_divide(F.col("n_events"), F.col(seconds))), F.lit(0.0)).cast("bigint"))


def pivoted(results: DataFrame, column: str, values: list[str], measure: str) -> DataFrame:
    """Models down, configurations across, in the fixed model order. The value lists are
    given, so Spark need not scan for them first."""
    wide = results.groupBy("model").pivot(column, values).agg(F.first(measure, ignorenulls=True))
    place = F.array_position(F.array(*[F.lit(m) for m in names.MODELS]), F.col("model"))
    return wide.withColumn("place", place.cast("int")).orderBy("place")


def looked_up(results: DataFrame, grid: DataFrame, on: list[str], measure: str) -> DataFrame:
    """The measure for every point of ``grid``, zero where there is no result."""
    found = results.groupBy(*on).agg(F.first(measure, ignorenulls=True).alias(measure))
    return grid.join(found, on, "left").withColumn(measure, F.coalesce(measure, F.lit(0.0)))


def grid_of(results: DataFrame, base: list[str], column: str, values: list[str]) -> DataFrame:
    """Every occurring combination of ``base`` with every listed value."""
    return results.select(*base).distinct().select(
        *base, F.explode(F.array(*[F.lit(v) for v in values])).alias(column))


def delta(old: DataFrame, new: DataFrame, on: list[str], measure: str) -> DataFrame:
    """Results present in both tables and how much the new ones gained."""
    a = old.select(*on, F.col(measure).alias("before"))
    b = new.select(*on, F.col(measure).alias("after"))
    return a.join(b, on).withColumn("delta", F.col("after") - F.col("before"))


def best_configuration(results: DataFrame, objectives: list[str], measure: str) -> DataFrame:
    """Per objective the model and configuration with the highest value; ties go to the
    alphabetically first."""
    order = Window.partitionBy(*objectives).orderBy(F.desc(measure), "model", "config")
    ranked = results.withColumn("_rn", F.row_number().over(order))
    return ranked.filter("_rn = 1").select(*objectives, "model", "config", measure)


def source_means(results: DataFrame, prefixes: list[str], measure: str) -> DataFrame:
    """Mean of a measure per model over all scenarios, by prefix of the source name."""
    kind = None
    for p in prefixes:
        hit = F.startswith(F.col("source"), F.lit(p))
        kind = F.when(hit, F.lit(p)) if kind is None else kind.when(hit, F.lit(p))
    return results.withColumn("kind", kind).filter(F.col("kind").isNotNull()).groupBy("model", "kind").agg(
        F.avg(measure).alias(measure))
