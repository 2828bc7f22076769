"""Component-to-event features, one definition for batch and stream.

All per-event statistics come from one aggregation of the components. Plain sums,
extremes and deviations combine on the map side for any event size. Order statistics
need the values themselves: events under the group limit keep them in one array,
larger ones are handled by counting (see functions.quantiles).
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from tallywire import names
from tallywire.functions.expressions import class_code, finite_or_zero, flag, port_flags
from tallywire.functions.quantiles import (
    bounded_broadcast, deviation, median_and_deviation, oversized_groups, quantile_table, sorted_quantile,
)

KEY = "attack_id"


def source_count(columns: list[str]) -> Column:
    """The source-count column the table has; zero where it has none."""
    for name in ("source_ip_count", "avg_source_ip_count"):
        if name in columns:
            return F.col(name).cast("double")
    return F.lit(0.0)


def _measures(components: DataFrame) -> DataFrame:
    length = F.col("avg_packet_len").cast("double")
    return components.select(
        KEY,
        F.col("packet_speed").cast("double").alias("pps"),
        F.when(length > 0, length).alias("len"),
        source_count(components.columns).alias("src"),
    )


# SQL text keeps these long lists to one call each; Column objects would cost one
# round trip to the JVM per operator.
_STATISTICS = {
    "pps_mean": "avg(pps)", "pps_max": "max(pps)", "pps_std": "stddev_samp(pps)",
    "bytes_per_pkt_mean": "avg(len)", "bytes_per_pkt_max": "max(len)", "bytes_per_pkt_min": "min(len)",
    "src_ip_mean": "avg(src)", "src_ip_max": "max(src)", "src_ip_std": "stddev_samp(src)",
}


def _plain_statistics() -> list[Column]:
    stats = [F.expr(f"coalesce({sql}, 0D) AS {n}") for n, sql in _STATISTICS.items()]
    return stats + [F.count("*").alias("n_rows")]


_ROBUST = ["pps_median", "pps_mad", "len_median", "len_mad"]


def component_statistics(
    components: DataFrame, robust: bool = False, limit: int | None = None
) -> DataFrame:
    """Per event: mean/max/std/p95 of rate, mean/max/min of non-zero length,
    mean/max/std of sources, row count; with ``robust`` also medians and MADs."""
    rows = _measures(components)
    big = oversized_groups(components.select(KEY), [KEY], limit)
    if big is None:
        return _in_one_pass(rows, robust)
    big = bounded_broadcast(big)
    small = _in_one_pass(rows.join(big, KEY, "left_anti"), robust)
    large = rows.join(big, KEY, "left_semi")
    parts = large.groupBy(KEY).agg(*_plain_statistics())
    parts = parts.join(quantile_table(large, [KEY], {"pps_p95": (F.col("pps"), 0.95)}, limit), KEY, "left")
    if robust:
        parts = parts.join(
            median_and_deviation(large, [KEY], {"pps": F.col("pps"), "len": F.col("len")}, limit), KEY, "left"
        )
    return small.unionByName(parts.fillna(0.0, ["pps_p95"] + (_ROBUST if robust else [])))


def _in_one_pass(rows: DataFrame, robust: bool) -> DataFrame:
    arrays = [F.sort_array(F.collect_list("pps")).alias("_pps")]
    if robust:
        arrays.append(F.sort_array(F.collect_list("len")).alias("_len"))
    # Arrays do not shrink on the map side, so go to the final grouping at once. The
    # groups here are bounded, and the left join needs the same partitioning.
    packed = rows.repartition(KEY).groupBy(KEY).agg(*_plain_statistics(), *arrays)
    out = packed.withColumn("pps_p95", F.coalesce(sorted_quantile(F.col("_pps"), 0.95), F.lit(0.0)))
    if not robust:
        return out.drop("_pps")
    out = out.select(
        "*",
        sorted_quantile(F.col("_pps"), 0.5).alias("pps_median"),
        sorted_quantile(F.col("_len"), 0.5).alias("len_median"),
    )
    out = out.select(
        "*",
        deviation(F.col("_pps"), F.col("pps_median")).alias("pps_mad"),
        deviation(F.col("_len"), F.col("len_median")).alias("len_mad"),
    )
    return out.drop("_pps", "_len").fillna(0.0, _ROBUST)


def event_features(
    events: DataFrame,
    components: DataFrame,
    blocks: tuple[str, ...] = ("ab",),
    label: str | None = "type",
    keep: tuple[str, ...] = (),
    limit: int | None = None,
) -> DataFrame:
    """Feature columns per event for the wanted blocks: base, ab, extras, v1.

    ``ab`` and ``extras`` share one aggregation and one join. ``base`` has its own
    meaning for some column names, so it cannot be asked for together with ``ab``.
    """
    if "base" in blocks and "ab" in blocks:
        raise ValueError("base and ab share column names; build them separately")
    for table, role in ((events, "events"), (components, "components")):
        if KEY not in table.columns:
            raise ValueError(f"{role} must contain '{KEY}'")

    stats = component_statistics(components, robust="extras" in blocks, limit=limit)
    have = set(events.columns)
    raw = {
        "_speed": F.col("packet_speed") if "packet_speed" in have else F.lit(None),
        "_length": F.col("avg_packet_len") if "avg_packet_len" in have else F.lit(None),
        "_sources": F.col("avg_source_ip_count") if "avg_source_ip_count" in have else F.lit(None),
    }
    carried = list(dict.fromkeys([*keep, *([label] if label else [])]))
    left = events.select(
        KEY, *[c for c in carried if c != KEY], "port", *[c.cast("double").alias(n) for n, c in raw.items()],
        *([F.col(c).cast("double").alias(f"_v1_{c}") for c in names.FEATURES_V1] if "v1" in blocks else []),
    )
    # An event without components stands for one sample of itself: the event values take
    # the place of the missing statistics, and the formulas below need no second form.
    joined = left.join(stats, KEY, "left")
    settled = joined.select(
        *[c for c in left.columns if c not in raw], "_speed", "_length", "n_rows",
        *[F.expr(f"coalesce({n}, {value}, 0D) AS {n}") for n, value in _STAND_IN.items()],
        *(_ROBUST if "extras" in blocks else []),
    )
    out: list[Column] = [F.col(KEY), *[F.col(c) for c in carried if c != KEY]]
    if label:
        out.append(class_code(label).alias("label"))
    if "ab" in blocks:
        out += _in_order(_SHARED_SQL | _rates(_log) | _AB_SQL, names.FEATURES_AB)
    if "base" in blocks:
        out += _in_order(_SHARED_SQL | _rates(_same) | _BASE_SQL, names.FEATURES_BASE)
    if "ab" in blocks or "base" in blocks:
        out += port_flags("port")
    if "extras" in blocks:
        out += _in_order(_EXTRA_SQL, names.FEATURES_EXTRA)
    if "v1" in blocks:
        out += [F.col(f"_v1_{c}").alias(c) for c in names.FEATURES_V1]
    return settled.select(*out)


_STAND_IN = {
    "pps_mean": "_speed", "pps_max": "_speed", "pps_p95": "_speed", "pps_std": "0D",
    "bytes_per_pkt_mean": "_length", "bytes_per_pkt_max": "_length", "bytes_per_pkt_min": "_length",
    "src_ip_mean": "_sources", "src_ip_max": "_sources", "src_ip_std": "0D",
}


def _in_order(columns: dict[str, str], order: list[str]) -> list[Column]:
    return [F.expr(f"{columns[n]} AS {n}") for n in order if n in columns]


def _log(value: str) -> str:
    return f"log1p(greatest({value}, 0D))"


def _same(value: str) -> str:
    return value


def _over(top: str, bottom: str) -> str:
    """Ratio with the denominator raised to at least one."""
    return f"({top}) / greatest({bottom}, 1D)"


def _rates(scale) -> dict[str, str]:
    return {c: scale(c) for c in ("pps_mean", "pps_max", "pps_p95", "pps_std")}


# Ratios use raw values, before any logarithm.
_SHARED_SQL = {
    "pps_burstiness": f"if(n_rows IS NULL, 1D, {_over('pps_max', 'pps_mean')})",
    "bytes_per_pkt_mean": "bytes_per_pkt_mean", "bytes_per_pkt_max": "bytes_per_pkt_max",
    "bytes_per_pkt_min": "bytes_per_pkt_min",
    "src_ip_mean": _log("src_ip_mean"), "src_ip_max": _log("src_ip_max"), "src_ip_std": _log("src_ip_std"),
}
_AB_SQL = {
    "pps_cv": _over("pps_std", "pps_mean"),
    "pps_skew_proxy": _over("pps_max - pps_p95", "pps_max - pps_mean"),
    "bytes_per_pkt_range": _over("bytes_per_pkt_max - bytes_per_pkt_min", "bytes_per_pkt_mean"),
    # An unknown speed on both levels leaves no ratio.
    "bytes_to_pkts_ratio": f"if(n_rows IS NULL AND _speed IS NULL, 0D, {_over('bytes_per_pkt_mean', 'pps_mean')})",
}
_BASE_SQL = {"bps_estimate": "pps_mean * bytes_per_pkt_mean"}

# A zero median falls back to the event value, whether or not there are components.
_EXTRA_SQL = {
    "n_components": "double(coalesce(n_rows, 0))",
    "log1p_n_components": "log1p(double(coalesce(n_rows, 0)))",
    "is_single_sample": "if(n_rows = 1, 1D, 0D)",
    "pps_median_log": f"if(coalesce(pps_median, 0D) = 0D, {_log('_speed')}, {_log('pps_median')})",
    "pps_mad_log": _log("pps_mad"),
    "bytes_per_pkt_median": "if(coalesce(len_median, 0D) = 0D, greatest(_length, 0D), len_median)",
    "bytes_per_pkt_mad": "coalesce(len_mad, 0D)",
}


def scrubbed(features: DataFrame, columns: list[str]) -> DataFrame:
    """NaN, infinity and NULL to zero in the feature columns."""
    return features.withColumns({c: finite_or_zero(c) for c in columns})


def raw_event_features(events: DataFrame, label: str = "type") -> DataFrame:
    """The six raw event columns as doubles; no components, no shuffle."""
    return events.select(
        KEY, class_code(label).alias("label"), *[F.col(c).cast("double").alias(c) for c in names.FEATURES_V1]
    )


def component_counts(events: DataFrame, components: DataFrame) -> DataFrame:
    """Components per event, zero where there are none."""
    counts = components.groupBy(KEY).agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return events.select(KEY).join(counts, KEY, "left").select(
        KEY, n.alias("n_components"), F.log1p(n.cast("double")).alias("log1p_n_components"),
        flag(n == 1).alias("is_single_sample"),
    )


def concat_blocks(left: DataFrame, *others: DataFrame) -> DataFrame:
    """Feature blocks side by side, aligned on the event key."""
    out = left
    for block in others:
        out = out.join(block, KEY)
    return out


def assembled(features: DataFrame, columns: list[str], into: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=into, handleInvalid="error").transform(features)
