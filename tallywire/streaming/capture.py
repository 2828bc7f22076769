"""From raw counter readings and a phase schedule to events and components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallywire.functions.expressions import micros
from tallywire.functions.quantiles import bounded_broadcast
from tallywire.functions.ranking import ordered, with_previous
from tallywire.session import materialize


def counter_rates(
    readings: DataFrame, group: str = "interface", time: str = "t", tie: str = "reading_id",
    min_gap_s: float = 0.001, limit: int | None = None,
) -> DataFrame:
    """Growing counters to rates. A reset counts as no growth; readings without new
    packets are dropped; the time step is at least ``min_gap_s``."""
    rows = readings.withColumn("_us", micros(time))
    seen = with_previous(rows, [group], [F.asc("_us"), F.asc(tie)], ["packets", "bytes", "_us"], limit)
    packets = F.greatest(F.col("packets") - F.col("prev_packets"), F.lit(0))
    size = F.greatest(F.col("bytes") - F.col("prev_bytes"), F.lit(0))
    gap = F.greatest((F.col("_us") - F.col("prev__us")) / 1e6, F.lit(float(min_gap_s)))
    return seen.filter(F.col("prev__us").isNotNull()).select(
        group, tie, time, packets.alias("d_packets"), size.alias("d_bytes"), gap.alias("gap_s"),
    ).filter("d_packets > 0").withColumns({
        "pps": F.col("d_packets") / F.col("gap_s"), "bps": F.col("d_bytes") / F.col("gap_s"),
        "avg_pkt_len": F.col("d_bytes") / F.col("d_packets"),
    })


def effective_phases(phases: DataFrame, limit: int | None = None) -> DataFrame:
    """Phases cut where the next one starts: a new phase replaces the running one."""
    later = with_previous(phases, [], [F.desc("start_offset_s"), F.desc("duration_s")], ["start_offset_s"], limit)
    end = F.col("start_offset_s") + F.col("duration_s")
    cut = F.least(end, F.coalesce("prev_start_offset_s", end))
    return later.withColumn("end_offset_s", cut).drop("prev_start_offset_s")


def in_phase(samples: DataFrame, phases: DataFrame, at: str = "offset_s", bucket_s: float | None = None) -> DataFrame:
    """Attach the phase with start <= at < end; samples outside every phase are dropped.

    A phase is listed under each time bucket it touches and joined on the bucket, then
    filtered: an equi-join, never a comparison of every sample with every phase. Without a
    given width, buckets are as wide as the shortest phase, or a sixteenth of the mean one if that is wider, so a sample
    meets few phases and a phase few buckets.
    """
    cut = materialize(effective_phases(phases).filter("end_offset_s > start_offset_s"))
    if bucket_s is None:
        length = F.col("end_offset_s") - F.col("start_offset_s")
        shortest, mean = cut.agg(F.min(length), F.avg(length)).first()
        bucket_s = max(shortest, mean / 16) if shortest else 1.0
    first = F.floor(F.col("start_offset_s") / bucket_s)
    last = F.floor(F.col("end_offset_s") / bucket_s)
    spread = cut.withColumn("_bucket", F.explode(F.sequence(first, last)))
    placed = samples.withColumn("_bucket", F.floor(F.col(at) / bucket_s))
    inside = (F.col(at) >= F.col("start_offset_s")) & (F.col(at) < F.col("end_offset_s"))
    return placed.join(bounded_broadcast(spread), "_bucket").filter(inside).drop("_bucket")


def phase_windows(phases: DataFrame, window_s: float, sample_s: float) -> DataFrame:
    """Windows of ``window_s`` inside each phase, the last one shortened; windows too
    short for two samples are dropped."""
    end = F.col("start_offset_s") + F.col("duration_s")
    count = F.ceil(F.col("duration_s") / window_s).cast("int")
    cut = phases.filter(F.col("duration_s") > 0).withColumn("window_no", F.explode(F.sequence(F.lit(0), count - 1)))
    start = F.col("start_offset_s") + F.col("window_no") * F.lit(window_s)
    return cut.withColumns({"win_start_s": start, "win_end_s": F.least(start + window_s, end)}).filter(
        F.col("win_end_s") - F.col("win_start_s") >= F.lit(2 * sample_s))


def phase_mix(phases: DataFrame) -> DataFrame:
    """Seconds per class over a schedule and their share."""
    seconds = phases.groupBy("type").agg(F.sum("duration_s").alias("seconds"))
    total = F.sum("seconds").over(Window.partitionBy(F.lit(0)))  # three rows
    return seconds.withColumn("share", F.coalesce(F.try_divide(F.col("seconds"), total), F.lit(0.0)))


def sources_in_ranges(
    sightings: DataFrame, ranges: DataFrame, bucket_s: float, source: str = "src", at: str = "offset_s"
) -> DataFrame:
    """Distinct sources over all buckets overlapping each range [t0, t1).

    Sightings shrink to distinct (bucket, source) pairs first; a range is listed under
    the buckets it overlaps and joined on the bucket.
    """
    pairs = sightings.select(F.floor(F.col(at) / bucket_s).alias("bucket"), source).distinct()
    first, last = F.floor(F.col("t0") / bucket_s), F.ceil(F.col("t1") / bucket_s) - 1
    listed = ranges.filter("t1 > t0").withColumn("bucket", F.explode(F.sequence(first, last)))
    found = listed.join(pairs, "bucket").groupBy("range_id").agg(F.countDistinct(source).alias("sources"))
    return ranges.join(found, "range_id", "left").withColumn("sources", F.coalesce("sources", F.lit(0)))


def captured_events(windows: DataFrame, samples: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """One event row per window from its samples; a window without samples gives zeros.

    ``windows`` needs window_id, port, type, start_time, end_time; ``samples`` window_id,
    pps, avg_pkt_len; ``sources`` window_id, n_sources. Means lose their fraction.
    """
    per_window = samples.groupBy("window_id").agg(F.avg("pps").alias("_pps"), F.avg("avg_pkt_len").alias("_len"))
    out = windows.join(per_window, "window_id", "left")
    out = out.join(sources, "window_id", "left") if sources is not None else out.withColumn("n_sources", F.lit(0))
    whole = lambda c: F.coalesce(F.floor(c), F.lit(0))
    return out.select(
        F.col("window_id").alias("attack_id"), "port", whole("_pps").cast("bigint").alias("packet_speed"),
        whole("_len").cast("int").alias("avg_packet_len"),
        F.coalesce("n_sources", F.lit(0)).cast("int").alias("avg_source_ip_count"), "start_time", "end_time", "type")


def captured_components(
    windows: DataFrame, samples: DataFrame, sources: DataFrame | None = None, limit: int | None = None
) -> DataFrame:
    """Component rows numbered from 1 inside each window; one zero row for an empty window."""
    numbered = ordered(samples, ["window_id"], [F.asc("t"), F.asc("reading_id")], "detect_count", limit=limit)
    out = windows.join(numbered, "window_id", "left")
    out = out.join(sources, "window_id", "left") if sources is not None else out.withColumn("n_sources", F.lit(0))
    whole = lambda c: F.coalesce(F.floor(c), F.lit(0))
    return out.select(
        F.col("window_id").alias("attack_id"), F.coalesce("detect_count", F.lit(1)).cast("bigint").alias("detect_count"),
        "port", whole("pps").cast("bigint").alias("packet_speed"), whole("avg_pkt_len").cast("int").alias("avg_packet_len"),
        F.coalesce("n_sources", F.lit(0)).cast("int").alias("source_ip_count"),
        F.coalesce("t", "start_time").alias("time"))
