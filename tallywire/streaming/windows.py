"""Tumbling windows over event time, in a form shared by batch and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywire import names
from tallywire.functions.expressions import data_rate, micros
from tallywire.functions.ranking import ordered, top_per_group
from tallywire.operators.metrics import cells_of


def first_instant(df: DataFrame, time: str) -> int:
    """Earliest time in microseconds since the epoch."""
    return df.agg(F.min(micros(time))).first()[0]


def appended_chunks(chunks: list[DataFrame], seconds: int, times: list[str]) -> DataFrame:
    """Chunks one after the other: chunk i is moved by i times the chunk length."""
    out = None
    for i, chunk in enumerate(chunks):
        shift = F.expr(f"INTERVAL '{i * seconds}' SECOND")
        moved = chunk.withColumns({c: F.col(c) + shift for c in times}).select(F.lit(i).alias("chunk"), "*")
        out = moved if out is None else out.unionByName(moved)
    return out


def shifted_chunks(df: DataFrame, chunk: str, seconds: int, times: list[str]) -> DataFrame:
    """The same for rows that carry their chunk number: one scan, one projection."""
    moved = lambda c: F.timestamp_add("SECOND", F.col(chunk) * seconds, F.col(c))
    return df.withColumns({c: moved(c) for c in times})


def windowed(
    df: DataFrame, time: str, seconds: float, anchor_us: int | None = None, drop_edge: bool = False
) -> DataFrame:
    """Add ``window_start`` and ``window_end`` of the tumbling window [start, end).

    Windows start at ``anchor_us`` (the first event); by default, in batch, it is looked
    up. Empty windows never appear. With ``drop_edge`` events that lie exactly on the
    border after the last window, at the latest time of all, are left out.
    """
    size = int(round(seconds * 1_000_000))
    if drop_edge:
        first, last = df.agg(F.min(micros(time)), F.max(micros(time))).first()
        anchor_us = first if anchor_us is None else anchor_us
        if last is not None and (last - anchor_us) % size == 0:
            df = df.filter(micros(time) < F.lit(last))
    if anchor_us is None:
        anchor_us = first_instant(df, time)
    w = window_of(time, seconds, anchor_us or 0)
    return df.withColumn("_w", w).select(
        *df.columns, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"))


def window_of(time: str, seconds: float, anchor_us: int) -> Column:
    """The window expression alone, usable under a watermark."""
    size = int(round(seconds * 1_000_000))
    return F.window(time, f"{size} microseconds", f"{size} microseconds", f"{anchor_us % size} microseconds")


KEYS = ["window_start", "window_end"]


def window_counts(scored: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per window: events, predicted and actual counts per class, accuracy, confusion cells."""
    by_class = [
        F.expr(f"count_if({column} = {i}) AS n_{said}_{kind}")
        for said, column in (("predicted", "y_pred"), ("actual", "y_true"))
        for i, kind in enumerate(("normal", "suspicious", "ddos"))
    ]
    accuracy = F.expr("avg(if(y_true = y_pred, 1D, 0D)) AS accuracy")
    return scored.groupBy(*(keys or KEYS)).agg(F.count("*").alias("n_events"), *by_class, accuracy, *cells_of())


def window_traffic(df: DataFrame, ports: int = 3) -> DataFrame:
    """Per window: mean and peak packet rate, mean data rate, most frequent ports.

    The rows are read once and shrink to one row per window and port; everything else,
    also the ranking of ports, works on those.
    """
    per_port = df.withColumn("_rate", data_rate(df.columns)).groupBy(*KEYS, "port").agg(
        F.count("*").alias("count"), F.sum("packet_speed").alias("_speed"), F.sum("_rate").alias("_data"),
        F.max("packet_speed").alias("_peak"))
    rates = per_port.groupBy(*KEYS).agg(
        F.expr("sum(_speed) / sum(count) AS avg_pkt_rate"), F.expr("sum(_data) / sum(count) AS avg_data_rate"),
        F.expr("double(max(_peak)) AS peak_pkt_rate"))
    leading = top_per_group(per_port, KEYS, [F.desc("count"), F.asc("port")], ports)
    lists = leading.groupBy(*KEYS).agg(
        F.sort_array(F.collect_list(F.struct("rn", "port", "count"))).alias("_p"))  # at most ``ports`` each
    lists = lists.select(*KEYS, F.transform("_p", lambda s: F.struct(s["port"].alias("port"), s["count"].alias("count"))).alias("top_ports"))
    return rates.join(lists, KEYS)


def last_per_window(df: DataFrame, n: int = 8, time: str = "start_time", key: str = "attack_id") -> DataFrame:
    """The last n events of each window, oldest of them with the highest rank."""
    return top_per_group(df, KEYS, [F.desc(time), F.desc(key)], n).withColumn(
        "correct", F.col("y_true") == F.col("y_pred"))


def with_alerts(counts: DataFrame, threshold: int = 3) -> DataFrame:
    """Alert flag per window, and whether it is false or an attack was missed."""
    alert = F.col("n_predicted_ddos") >= threshold
    return counts.withColumns({
        "alert_raised": alert,
        "false_alert": alert & (F.col("n_actual_ddos") == 0),
        "missed_attack": (F.col("n_actual_ddos") > 0) & ~alert,
    })


def indexed(counts: DataFrame, limit: int | None = None) -> DataFrame:
    """Consecutive 0-based index over the windows that exist."""
    ranked = ordered(counts, [], [F.asc("window_start")], "_rn", limit=limit)
    return ranked.withColumn("window_index", F.col("_rn") - 1).drop("_rn")


def running_totals(alerts: DataFrame, limit: int | None = None) -> DataFrame:
    """Totals up to and including each window: events, DDoS, alerts, correct, confusion."""
    right = F.col("c00") + F.col("c11") + F.col("c22")
    sums = {
        "total_events": F.col("n_events"), "total_ddos_detected": F.col("n_predicted_ddos"),
        "total_ddos_actual": F.col("n_actual_ddos"), "alert_count": F.col("alert_raised").cast("bigint"),
        "false_alert_count": F.col("false_alert").cast("bigint"), "total_correct": right,
        **{f"total_c{t}{p}": F.col(f"c{t}{p}") for t in range(3) for p in range(3)},
    }
    ranked = ordered(alerts, [], [F.asc("window_start")], "_rn", sums, limit)
    return ranked.withColumn("window_index", F.col("_rn") - 1).select("window_index", *KEYS, *sums)


def rolling_mean(numbered: DataFrame, value: str, span: int = 5) -> DataFrame:
    """Mean of the last ``span`` windows, from the first window that has so many.

    Each row is handed to the windows it counts for, so it shuffles evenly by index
    and no task sees the whole run.
    """
    here = numbered.select(
        F.explode(F.sequence(F.col("window_index"), F.col("window_index") + (span - 1))).alias("window_index"),
        F.col(value).alias("_v"))
    sums = here.groupBy("window_index").agg(F.avg("_v").alias("rolling"), F.count("*").alias("_n"))
    # Indices past the last window have fewer rows as well.
    return sums.filter(F.col("_n") == span).select("window_index", "rolling")


def summary(alerts: DataFrame) -> DataFrame:
    """One row for a whole run, from its window table."""
    return alerts.agg(
        F.sum("n_events").alias("total_events"), F.sum("n_predicted_ddos").alias("total_ddos_detected"),
        F.sum("n_actual_ddos").alias("total_ddos_actual"),
        F.expr("coalesce(sum(c00 + c11 + c22) / sum(n_events), 0D) AS overall_accuracy"),
        F.count("*").alias("windows"), F.count_if("alert_raised").alias("alert_count"),
        F.count_if("false_alert").alias("false_alert_count"), F.count_if("missed_attack").alias("missed_attack_windows"))


def threat_level(counts: DataFrame) -> DataFrame:
    """The level shown for the newest window."""
    n = F.col("n_predicted_ddos")
    level = (F.when(n > 5, "CRITICAL").when(n > 2, "HIGH").when(n > 0, "ELEVATED").otherwise("NORMAL"))
    return newest(counts, 1).withColumn("threat_level", level)


def newest(df: DataFrame, n: int, time: str = "window_start") -> DataFrame:
    """The n latest rows: a distributed top-n."""
    return df.orderBy(F.desc(time)).limit(n)


def alert_report(alerts: DataFrame) -> DataFrame:
    """Alerts by outcome."""
    kind = F.when(F.col("n_actual_ddos") > 0, "TRUE").otherwise("FALSE")
    return alerts.filter("alert_raised").groupBy(kind.alias("outcome")).agg(
        F.count("*").alias("n"), F.sum("n_predicted_ddos").alias("predicted_ddos"),
        F.sum("n_actual_ddos").alias("actual_ddos"))


def probability_alerts(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows whose DDoS probability reaches the threshold, with a message."""
    hits = scored.filter(F.col("p_ddos") >= threshold)
    message = F.format_string(
        "attack probability %.2f at %.0f packets a second from %d sources", F.col("p_ddos"),
        F.col("packet_speed").cast("double"), F.col("avg_source_ip_count"))
    return hits.withColumn("message", message)


def window_records(scored: DataFrame, model: str, scenario: str, source: str, threshold: int = 3) -> DataFrame:
    """The full nested record per window, as it is published."""
    counts = indexed(with_alerts(window_counts(scored), threshold))
    samples = last_per_window(scored.withColumn("_rate", data_rate(scored.columns)))
    sample = F.struct(
        F.col("rn"), F.col("avg_source_ip_count").alias("src_ip_count"), F.col("packet_speed").alias("pkt_speed"),
        F.col("_rate").cast("bigint").alias("data_speed"), "port",
        F.element_at(_class_array(), F.col("y_true") + 1).alias("actual"),
        F.element_at(_class_array(), F.col("y_pred") + 1).alias("predicted"), "correct")
    feeds = samples.groupBy(*KEYS).agg(F.sort_array(F.collect_list(sample), asc=False).alias("_s"))  # at most 8 each
    feeds = feeds.select(*KEYS, F.transform("_s", lambda s: s.dropFields("rn")).alias("event_samples"))
    joined = counts.join(window_traffic(scored), KEYS).join(feeds, KEYS)
    rows = [F.array(*[F.col(f"c{t}{p}") for p in range(3)]) for t in range(3)]
    one_decimal = ["avg_pkt_rate", "avg_data_rate", "peak_pkt_rate"]
    return joined.select(
        "window_index", *KEYS, "n_events", *[f"n_{s}_{k}" for s in ("predicted", "actual") for k in ("normal", "suspicious", "ddos")],
        F.round("accuracy", 4).alias("accuracy"), "alert_raised", F.lit(model).alias("model_name"),
        F.lit(scenario).alias("scenario_id"), F.lit(source).alias("source"),
        *[F.round(c, 1).alias(c) for c in one_decimal], "top_ports", F.array(*rows).alias("confusion"), "event_samples")


def _class_array() -> Column:
    return F.array(*[F.lit(c) for c in names.CLASSES])
