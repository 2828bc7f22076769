"""Train-fitted cleaning: thresholds are fitted once and then only applied."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tallywire import names
from tallywire.functions.expressions import capped, duration_seconds, flag, token_flags
from tallywire.functions.quantiles import quantile_table
from tallywire.functions.sketches import quantile_sketches, sketched_quantiles


@dataclass(frozen=True)
class Thresholds:
    """Eleven numbers fitted on the training split."""

    event_caps: dict[str, float] = field(default_factory=dict)
    component_caps: dict[str, float] = field(default_factory=dict)
    event_avg_pkt_len_median: float = 0.0
    component_avg_pkt_len_median: float = 0.0
    cap_quantile: float = names.CAP_QUANTILE

    def as_dict(self) -> dict:
        return asdict(self)


def _fit(df: DataFrame, columns: list[str], q: float) -> tuple[dict[str, float], float]:
    length = F.col("avg_packet_len")
    wanted = {c: (F.col(c), q) for c in columns if c in df.columns}
    wanted["_median"] = (F.when(length > 0, length), 0.5)
    row = quantile_table(df, [], wanted).first().asDict()
    median = row.pop("_median")
    return {c: v for c, v in row.items() if v is not None}, 0.0 if median is None else median


def fit_thresholds(
    events: DataFrame | None = None, components: DataFrame | None = None, q: float = names.CAP_QUANTILE
) -> Thresholds:
    """Exact cap quantiles and non-zero length medians of the given training tables; one that
    is not needed can be left out and is then not read."""
    event_caps, event_median = _fit(events, names.EVENT_CAP_COLUMNS, q) if events is not None else ({}, 0.0)
    component_caps, component_median = (
        _fit(components, names.COMPONENT_CAP_COLUMNS, q) if components is not None else ({}, 0.0))
    return Thresholds(event_caps, component_caps, event_median, component_median, q)


def threshold_sketches(df: DataFrame, kind: str, by: list[str]) -> DataFrame:
    """What the thresholds need to know of ``df`` ("events" or "components"), per file, set or day: one sketch for each column.

    Rows are small whatever they stand for; keep them, and ``thresholds_from_sketches`` refits without the old data.
    """
    columns = names.EVENT_CAP_COLUMNS if kind == "events" else names.COMPONENT_CAP_COLUMNS
    length = F.col("avg_packet_len")
    wanted = {c: F.col(c) for c in columns if c in df.columns}
    return quantile_sketches(df, by, {**wanted, "_median": F.when(length > 0, length)})


def thresholds_from_sketches(
    events: DataFrame | None = None, components: DataFrame | None = None, q: float = names.CAP_QUANTILE
) -> Thresholds:
    """Thresholds from kept sketches, within half a percent in rank; ``fit_thresholds`` is exact and reads all rows."""
    def near(kept: DataFrame | None, columns: list[str]) -> tuple[dict[str, float], float]:
        if kept is None:
            return {}, 0.0
        wanted = {c: q for c in columns if c in kept.columns}
        found = {r["name"]: r["value"] for r in sketched_quantiles(kept, {**wanted, "_median": 0.5}).collect()}  # a row a column
        median = found.pop("_median", 0.0)
        return found, median

    (event_caps, event_median), (component_caps, component_median) = (
        near(events, names.EVENT_CAP_COLUMNS), near(components, names.COMPONENT_CAP_COLUMNS))
    return Thresholds(event_caps, component_caps, event_median, component_median, q)


def zero_length_filled(length: Column, median: float) -> Column:
    """Zero lengths take the whole part of the fitted median."""
    return F.when(length == 0, F.lit(int(median))).otherwise(length)


def _cleaned_numbers(df: DataFrame, caps: dict[str, float], median: float) -> dict[str, Column]:
    out = {}
    for name in df.columns:
        value = F.col(name)
        if name == "avg_packet_len":
            value = zero_length_filled(value, median)
        if name in caps:
            value = capped(value, caps[name])
        out[name] = value
    return out


def clean_events(events: DataFrame, fitted: Thresholds) -> DataFrame:
    """Cleaned events in one projection."""
    df = events.drop("card", "set_name")
    numbers = _cleaned_numbers(df, fitted.event_caps, fitted.event_avg_pkt_len_median)
    gone = {"data_speed", "start_time", "end_time", "attack_code"}
    return df.select(
        *[c.alias(n) for n, c in numbers.items() if n not in gone],
        duration_seconds("start_time", F.coalesce("end_time", "start_time")).alias("duration_s"),
        flag(F.col("avg_packet_len") == 0).alias("avg_pkt_len_was_zero"),
        *token_flags("attack_code"),
        flag(F.col("port") == 0).alias("is_port_zero"),
    )


def clean_components(components: DataFrame, fitted: Thresholds) -> DataFrame:
    """Cleaned components in one projection."""
    df = components.drop("card", "set_name")
    numbers = _cleaned_numbers(df, fitted.component_caps, fitted.component_avg_pkt_len_median)
    gone = {"data_speed", "time", "attack_code"}
    return df.select(
        *[c.alias(n) for n, c in numbers.items() if n not in gone],
        flag(F.col("avg_packet_len") == 0).alias("avg_pkt_len_was_zero"),
        *token_flags("attack_code"),
        flag(F.col("port") == 0).alias("is_port_zero"),
    )


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_code``: the position of the value among the sorted distinct values, -1 for NULL."""
    from tallywire.functions.ranking import ordered

    distinct = df.select(column).filter(F.col(column).isNotNull()).distinct()
    coded = ordered(distinct, [], [F.col(column)], "_rank")
    coded = coded.select(column, (F.col("_rank") - 1).cast("int").alias(f"{column}_code"))
    return df.join(coded, column, "left").withColumn(f"{column}_code", F.coalesce(f"{column}_code", F.lit(-1)))
