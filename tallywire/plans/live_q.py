"""Queries for streams with state of their own and for kept sketches, beside the SQL of their exact batch forms."""

from pyspark.sql import functions as F

from tallywire import names
from tallywire.functions import sketches
from tallywire.functions.expressions import micros
from tallywire.plans.cleaning_q import _train
from tallywire.plans.features_q import rounded
from tallywire.plans.registry import query
from tallywire.plans.stream_q import cut_phases, offsets
from tallywire.plans.tables import SCHEMAS, ST, stream
from tallywire.session import scratch_path
from tallywire.streaming import capture, keyed, live, windows

HOUR = 3600.0
LATENESS = "10 minutes"
#: Windows that the watermark of all events has closed; it counts whole milliseconds.
_CLOSED = "epoch_us(window_end) <= (SELECT (epoch_ms(max(start_time)) - 600000) * 1000 FROM st)"
#: Largest relative error that a sketch is allowed here: six standard errors.
NEAR = 0.05


def _arriving(spark, sf_dir):
    table, columns = ST
    return live.file_stream(spark, f"{sf_dir}/{table}*.parquet", SCHEMAS[table], columns)


def _anchor(spark, sf_dir):
    return windows.first_instant(stream(spark, sf_dir), "start_time") or 0


def _naive(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("str_tail_n", """SELECT window_start, attack_id, packet_speed, port, y_true = y_pred AS correct, CAST(rn AS INT) AS rn FROM
 (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY start_time DESC, attack_id DESC) AS rn FROM win) WHERE rn <= 8""")
def str_tail_n(spark, sf_dir):
    """The last 8 events of every window from keyed state, open windows included."""
    path = scratch_path(spark, "tail")
    table = keyed.last_events(_arriving(spark, sf_dir), HOUR, _anchor(spark, sf_dir), 8, LATENESS)
    keyed.write_state(table, path, live.checkpoint_path(spark, "tail"))
    found = keyed.read_state(spark, path, table.schema, ["key"])
    return found.select(F.timestamp_micros("key").cast("timestamp_ntz").alias("window_start"), "attack_id", "packet_speed", "port",
                        (F.col("y_true") == F.col("y_pred")).alias("correct"), "rn")


@query("str_history", f"""WITH c AS (SELECT * FROM walert WHERE {_CLOSED}),
w AS (SELECT 'windows' AS feed, window_start, n_events, round(accuracy, 6) AS accuracy FROM c ORDER BY window_start DESC LIMIT 60),
a AS (SELECT 'alerts' AS feed, window_start, n_events, round(accuracy, 6) AS accuracy FROM c WHERE alert_raised ORDER BY window_start DESC LIMIT 10)
SELECT * FROM w UNION ALL SELECT * FROM a""")
def str_history(spark, sf_dir):
    """The last 60 closed windows and the last 10 alerts from keyed state behind the window aggregation."""
    anchor = _anchor(spark, sf_dir)
    out = None
    for feed, n, only in (("windows", 60, None), ("alerts", 10, "alert_raised")):
        path = scratch_path(spark, feed)
        closed = live.windowed_alerts(_arriving(spark, sf_dir), HOUR, anchor, LATENESS)
        table = keyed.newest_windows(closed, n, only)
        keyed.write_state(table, path, live.checkpoint_path(spark, feed))
        part = keyed.read_state(spark, path, table.schema).select(F.lit(feed).alias("feed"), "window_start", "n_events", "accuracy")
        out = part if out is None else out.unionByName(part)
    return rounded(_naive(out, "window_start"))


@query("str_traffic_stream", f"""WITH r AS (SELECT window_start, window_end, avg(packet_speed) AS a, avg(CAST(packet_speed * avg_packet_len AS DOUBLE)) AS d, max(packet_speed) AS m
 FROM win GROUP BY 1, 2), p AS (SELECT window_start, port, count(*) AS n, row_number() OVER (PARTITION BY window_start ORDER BY count(*) DESC, port) AS rn FROM win GROUP BY 1, 2)
SELECT r.window_start, r.window_end, round(r.a, 3) AS avg_pkt_rate, round(r.d, 3) AS avg_data_rate, CAST(r.m AS DOUBLE) AS peak_pkt_rate,
 (SELECT string_agg(p.port || ':' || p.n, ',' ORDER BY p.rn) FROM p WHERE p.window_start = r.window_start AND p.rn <= 3) AS top_ports FROM r WHERE {_CLOSED}""")
def str_traffic_stream(spark, sf_dir):
    """Rates and leading ports of every closed window, from two chained aggregations."""
    path = scratch_path(spark, "traffic")
    table = live.windowed_traffic(_arriving(spark, sf_dir), HOUR, _anchor(spark, sf_dir), LATENESS)
    live.write_batches(table, path, live.checkpoint_path(spark, "traffic"))
    found = rounded(_naive(spark.read.schema(table.schema).parquet(path).select(table.columns), "window_start", "window_end"), 3)
    text = F.array_join(F.transform("top_ports", lambda s: F.concat_ws(":", s["port"], s["count"])), ",")
    return found.withColumn("top_ports", text)


def _near(exact, estimate):
    return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(F.lit(1.0), NEAR * F.col(exact))


@query("str_source_sketch", """SELECT CAST(floor(epoch_us(start_time) / 1e6 / 3600) AS BIGINT) AS bucket, count(DISTINCT victim) AS sources, true AS near FROM st GROUP BY 1""")
def str_source_sketch(spark, sf_dir):
    """Sketches of the sources per hour from a stream, beside the exact counts: ``near`` says whether they agree within 5 %."""
    path = scratch_path(spark, "sketches")
    at = lambda df: df.select((micros("start_time") / 1e6).alias("offset_s"), "victim")
    live.stream_sources(at(_arriving(spark, sf_dir)), path, live.checkpoint_path(spark, "sketches"), HOUR, "victim")
    near = sketches.sources_in_buckets(sketches.kept_sketches(spark, path)).withColumnRenamed("sources", "about")
    exact = at(stream(spark, sf_dir)).groupBy(F.floor(F.col("offset_s") / HOUR).alias("bucket")).agg(F.countDistinct("victim").alias("sources"))
    return exact.join(near, "bucket").select("bucket", "sources", _near("sources", "about").alias("near"))


@query("join_overlap_sketch", """WITH b AS (SELECT DISTINCT floor(offset_s / 7200) * 7200 AS s, victim FROM ofs),
r AS (SELECT day * 1000 + window_no AS range_id, win_start_s AS t0, win_end_s AS t1 FROM phw)
SELECT r.range_id, count(DISTINCT b.victim) AS sources, true AS near FROM r LEFT JOIN b ON b.s < r.t1 AND b.s + 7200 > r.t0 GROUP BY r.range_id""")
def join_overlap_sketch(spark, sf_dir):
    """Distinct sources of each range from one sketch per bucket, beside the exact counts."""
    rows = offsets(spark, sf_dir)
    ranges = cut_phases(rows).select((F.col("day") * 1000 + F.col("window_no")).alias("range_id"), F.col("win_start_s").alias("t0"), F.col("win_end_s").alias("t1"))
    exact = capture.sources_in_ranges(rows, ranges, 7200.0, "victim").select("range_id", "sources")
    near = sketches.estimated_sources(sketches.source_sketches(rows, 7200.0, "victim"), ranges, 7200.0)
    return exact.join(near.select("range_id", F.col("sources").alias("about")), "range_id").select(
        "range_id", "sources", _near("sources", "about").alias("near"))


@query("fit_caps_sketch", "\nUNION ALL ".join(
    f"SELECT '{kind}' AS source, '{c}' AS name, count({c}) AS n, true AS near FROM {table} WHERE split = 'train'"
    for kind, table, columns in (("events", "ev", names.EVENT_CAP_COLUMNS), ("components", "co", names.COMPONENT_CAP_COLUMNS)) for c in columns))
def fit_caps_sketch(spark, sf_dir):
    """Cap quantiles from one kept sketch per set: ``near`` says whether the rank is within half a percent of the wanted one."""
    q, out = names.CAP_QUANTILE, None
    for source, df, columns in zip(("events", "components"), _train(spark, sf_dir), (names.EVENT_CAP_COLUMNS, names.COMPONENT_CAP_COLUMNS)):
        path = scratch_path(spark, "caps")
        sketches.quantile_sketches(df, ["set_name"], {c: F.col(c) for c in columns}).write.parquet(path)
        caps = sketches.sketched_quantiles(spark.read.parquet(path), {c: q for c in columns})
        wide = caps.groupBy().pivot("name", columns).agg(F.first("value"))  # one row
        ranks = df.select(*columns).crossJoin(F.broadcast(wide.select(*[F.col(c).alias(f"_{c}") for c in columns])))
        checked = ranks.agg(*[F.struct(
            F.lit(c).alias("name"), F.count(c).alias("n"),
            ((F.count_if(F.col(c) < F.col(f"_{c}")) / F.count(c) - 0.005 <= q) & (F.count_if(F.col(c) <= F.col(f"_{c}")) / F.count(c) + 0.005 >= q)).alias("near"),
        ).alias(c) for c in columns])
        rows = checked.select(F.explode(F.array(*columns)).alias("r")).select(F.lit(source).alias("source"), "r.*")
        out = rows if out is None else out.unionByName(rows)
    return out
