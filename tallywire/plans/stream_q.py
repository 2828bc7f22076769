"""Queries for windows, alerts and capture operators, in their batch form."""

from pyspark.sql import functions as F

from tallywire.functions.expressions import micros
from tallywire.functions.ranking import ordered
from tallywire.plans.features_q import rounded
from tallywire.plans.registry import query, share
from tallywire.plans.tables import stream
from tallywire.session import materialize
from tallywire.streaming import capture, windows

HOUR = 3600.0


def scored(spark, sf_dir):
    return windows.windowed(stream(spark, sf_dir), "start_time", HOUR)


def counts(spark, sf_dir):
    return windows.window_counts(scored(spark, sf_dir))


def alerts(spark, sf_dir):
    return windows.with_alerts(counts(spark, sf_dir))


share("anch", "SELECT min(epoch_us(start_time)) AS a, max(epoch_us(start_time)) AS z FROM st")
share("win", """SELECT s.*, make_timestamp(a.a + ((epoch_us(s.start_time) - a.a) // 3600000000) * 3600000000) AS window_start,
 make_timestamp(a.a + ((epoch_us(s.start_time) - a.a) // 3600000000 + 1) * 3600000000) AS window_end FROM st s CROSS JOIN anch a""")
_N = [f"n_{s}_{k}" for s in ("predicted", "actual") for k in ("normal", "suspicious", "ddos")]
share("wcnt", "SELECT window_start, window_end, count(*) AS n_events, {}, {}, avg(CASE WHEN y_true = y_pred THEN 1.0::DOUBLE ELSE 0 END) AS accuracy, {} FROM win GROUP BY 1, 2".format(
    ", ".join(f"count(*) FILTER (y_pred = {i}) AS n_predicted_{k}" for i, k in enumerate(("normal", "suspicious", "ddos"))),
    ", ".join(f"count(*) FILTER (y_true = {i}) AS n_actual_{k}" for i, k in enumerate(("normal", "suspicious", "ddos"))),
    ", ".join(f"count(*) FILTER (y_true = {t} AND y_pred = {p}) AS c{t}{p}" for t in range(3) for p in range(3))))
share("walert", """SELECT *, n_predicted_ddos >= 3 AS alert_raised, n_predicted_ddos >= 3 AND n_actual_ddos = 0 AS false_alert,
 n_actual_ddos > 0 AND n_predicted_ddos < 3 AS missed_attack, row_number() OVER (ORDER BY window_start) - 1 AS window_index FROM wcnt""")
_CELLS = [f"c{t}{p}" for t in range(3) for p in range(3)]


@query("str_tumbling", "SELECT window_start, window_end, count(*) AS n, min(attack_id) AS first_id, max(attack_id) AS last_id FROM win GROUP BY 1, 2")
def str_tumbling(spark, sf_dir):
    return scored(spark, sf_dir).groupBy(*windows.KEYS).agg(
        F.count("*").alias("n"), F.min("attack_id").alias("first_id"), F.max("attack_id").alias("last_id"))


@query("str_tumbling_edge", """WITH k AS (SELECT attack_id, date_trunc('minute', start_time) AS t FROM st),
a AS (SELECT min(t) AS a, max(t) AS z FROM k)
SELECT make_timestamp(epoch_us(a.a) + ((epoch_us(k.t) - epoch_us(a.a)) // 60000000) * 60000000) AS window_start, count(*) AS n
FROM k CROSS JOIN a WHERE k.t < a.z GROUP BY 1""")
def str_tumbling_edge(spark, sf_dir):
    """Times cut to the minute, one-minute windows: the latest event lies on the edge."""
    cut = stream(spark, sf_dir).select("attack_id", F.date_trunc("minute", "start_time").cast("timestamp_ntz").alias("t"))
    out = windows.windowed(cut, "t", 60.0, drop_edge=True)
    return out.groupBy("window_start").agg(F.count("*").alias("n"))


@query("str_window_counts", f"SELECT window_start, window_end, n_events, {', '.join(_N)}, round(accuracy, 6) AS accuracy, {', '.join(_CELLS)} FROM wcnt")
def str_window_counts(spark, sf_dir):
    return rounded(counts(spark, sf_dir))


@query("str_window_traffic", """WITH r AS (SELECT window_start, window_end, avg(packet_speed) AS a, avg(CAST(packet_speed * avg_packet_len AS DOUBLE)) AS d, max(packet_speed) AS m
 FROM win GROUP BY 1, 2), p AS (SELECT window_start, port, count(*) AS n, row_number() OVER (PARTITION BY window_start ORDER BY count(*) DESC, port) AS rn FROM win GROUP BY 1, 2)
SELECT r.window_start, r.window_end, round(r.a, 3) AS avg_pkt_rate, round(r.d, 3) AS avg_data_rate, CAST(r.m AS DOUBLE) AS peak_pkt_rate,
 (SELECT string_agg(p.port || ':' || p.n, ',' ORDER BY p.rn) FROM p WHERE p.window_start = r.window_start AND p.rn <= 3) AS top_ports FROM r""")
def str_window_traffic(spark, sf_dir):
    table = rounded(windows.window_traffic(scored(spark, sf_dir)), 3)
    text = F.array_join(F.transform("top_ports", lambda s: F.concat_ws(":", s["port"], s["count"])), ",")
    return table.withColumn("top_ports", text)


@query("str_alert_count", "SELECT window_start, n_predicted_ddos FROM walert WHERE alert_raised")
def str_alert_count(spark, sf_dir):
    return alerts(spark, sf_dir).filter("alert_raised").select("window_start", "n_predicted_ddos")


@query("str_alert_prob", """SELECT attack_id, round(p_ddos, 6) AS p_ddos, printf('attack probability %.2f at %.0f packets a second from %d sources', p_ddos, CAST(packet_speed AS DOUBLE), avg_source_ip_count) AS message
FROM st WHERE p_ddos >= 0.5""")
def str_alert_prob(spark, sf_dir):
    return rounded(windows.probability_alerts(stream(spark, sf_dir)).select("attack_id", "p_ddos", "message"))


@query("str_alert_audit", "SELECT window_start, alert_raised, false_alert, missed_attack FROM walert")
def str_alert_audit(spark, sf_dir):
    return alerts(spark, sf_dir).select("window_start", "alert_raised", "false_alert", "missed_attack")


@query("str_summary", """SELECT count(*) AS total_events, count(*) FILTER (y_pred = 2) AS total_ddos_detected, count(*) FILTER (y_true = 2) AS total_ddos_actual,
 round(avg(CASE WHEN y_true = y_pred THEN 1.0::DOUBLE ELSE 0 END), 6) AS overall_accuracy, (SELECT count(*) FROM walert) AS windows,
 (SELECT count(*) FROM walert WHERE alert_raised) AS alert_count, (SELECT count(*) FROM walert WHERE false_alert) AS false_alert_count,
 (SELECT count(*) FROM walert WHERE missed_attack) AS missed_attack_windows FROM win""")
def str_summary(spark, sf_dir):
    return rounded(windows.summary(alerts(spark, sf_dir)))


@query("str_threat_level", """SELECT window_start, n_predicted_ddos, CASE WHEN n_predicted_ddos > 5 THEN 'CRITICAL' WHEN n_predicted_ddos > 2 THEN 'HIGH'
 WHEN n_predicted_ddos > 0 THEN 'ELEVATED' ELSE 'NORMAL' END AS threat_level FROM wcnt ORDER BY window_start DESC LIMIT 1""")
def str_threat_level(spark, sf_dir):
    return windows.threat_level(counts(spark, sf_dir)).select("window_start", "n_predicted_ddos", "threat_level")


@query("agg_alert_report", """SELECT CASE WHEN n_actual_ddos > 0 THEN 'TRUE' ELSE 'FALSE' END AS outcome, count(*) AS n,
 CAST(sum(n_predicted_ddos) AS BIGINT) AS predicted_ddos, CAST(sum(n_actual_ddos) AS BIGINT) AS actual_ddos FROM walert WHERE alert_raised GROUP BY 1""")
def agg_alert_report(spark, sf_dir):
    return windows.alert_report(alerts(spark, sf_dir))


@query("win_tail_n", """SELECT window_start, attack_id, packet_speed, port, y_true = y_pred AS correct, CAST(rn AS INT) AS rn FROM
 (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY start_time DESC, attack_id DESC) AS rn FROM win) WHERE rn <= 8""")
def win_tail_n(spark, sf_dir):
    return windows.last_per_window(scored(spark, sf_dir)).select("window_start", "attack_id", "packet_speed", "port", "correct", "rn")


@query("win_dense_index", "SELECT window_start, window_index FROM walert")
def win_dense_index(spark, sf_dir):
    return windows.indexed(counts(spark, sf_dir)).select("window_start", "window_index")


@query("win_rolling5", """SELECT window_index, round(rolling, 6) AS rolling FROM (SELECT window_index,
 avg(accuracy) OVER (ORDER BY window_index ROWS 4 PRECEDING) AS rolling FROM walert) WHERE window_index >= 4""")
def win_rolling5(spark, sf_dir):
    return rounded(windows.rolling_mean(windows.indexed(counts(spark, sf_dir)), "accuracy"))


def _cum(c):
    return f"CAST(sum({c}) OVER (ORDER BY window_start ROWS UNBOUNDED PRECEDING) AS BIGINT)"


@query("win_running_totals", f"""SELECT window_index, window_start, window_end, {_cum('n_events')} AS total_events, {_cum('n_predicted_ddos')} AS total_ddos_detected,
 {_cum('n_actual_ddos')} AS total_ddos_actual, {_cum('CAST(alert_raised AS INT)')} AS alert_count, {_cum('CAST(false_alert AS INT)')} AS false_alert_count,
 {_cum('c00 + c11 + c22')} AS total_correct, {", ".join(f"{_cum(c)} AS total_{c}" for c in _CELLS)} FROM walert""")
def win_running_totals(spark, sf_dir):
    return windows.running_totals(alerts(spark, sf_dir))


@query("win_history", """WITH w AS (SELECT 'windows' AS feed, window_start FROM wcnt ORDER BY window_start DESC LIMIT 60),
a AS (SELECT 'alerts' AS feed, window_start FROM walert WHERE alert_raised ORDER BY window_start DESC LIMIT 10)
SELECT * FROM w UNION ALL SELECT * FROM a""")
def win_history(spark, sf_dir):
    table = alerts(spark, sf_dir)
    show = lambda df, feed: df.select(F.lit(feed).alias("feed"), "window_start")
    return show(windows.newest(table, 60), "windows").unionByName(
        show(windows.newest(table.filter("alert_raised"), 10), "alerts"))


@query("str_distinct_src", "SELECT window_start, count(DISTINCT victim) AS sources FROM win GROUP BY window_start")
def str_distinct_src(spark, sf_dir):
    return scored(spark, sf_dir).groupBy("window_start").agg(F.countDistinct("victim").alias("sources"))


# Readings: per user a counter that grows by the event value and restarts every 100th reading.
share("rd", """SELECT user_id AS interface, event_id AS reading_id, ts AS t,
 CAST(sum(CAST(floor(value) AS BIGINT)) OVER w AS BIGINT) AS packets, CAST(sum(CAST(floor(value * 64) AS BIGINT)) OVER w AS BIGINT) AS bytes FROM
 (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 100 AS seg FROM events)
 WINDOW w AS (PARTITION BY user_id, seg ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
share("rates", """WITH p AS (SELECT *, lag(packets) OVER w AS pp, lag(bytes) OVER w AS pb, lag(epoch_us(t)) OVER w AS pt FROM rd
 WINDOW w AS (PARTITION BY interface ORDER BY t, reading_id)),
d AS (SELECT interface, reading_id, t, greatest(packets - pp, 0) AS d_packets, greatest(bytes - pb, 0) AS d_bytes,
 greatest((epoch_us(t) - pt) / 1e6, 0.001) AS gap_s FROM p WHERE pt IS NOT NULL)
SELECT *, d_packets / gap_s AS pps, d_bytes / gap_s AS bps, d_bytes / d_packets AS avg_pkt_len FROM d WHERE d_packets > 0""")


def readings(spark, sf_dir):
    raw = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").alias("interface"), F.col("event_id").alias("reading_id"), F.col("ts").alias("t"),
        F.floor("value").alias("p"), F.floor(F.col("value") * 64).alias("b"))
    order = [F.asc("t"), F.asc("reading_id")]
    numbered = ordered(raw, ["interface"], order, "rn").withColumn("seg", F.floor((F.col("rn") - 1) / 100)).drop("rn")
    grown = ordered(numbered, ["interface", "seg"], order, "rn", {"packets": F.col("p"), "bytes": F.col("b")}, at_most=100)
    return grown.select("interface", "reading_id", "t", "packets", "bytes")


@query("win_counter_rate", """SELECT interface, reading_id, d_packets, d_bytes, round(gap_s, 6) AS gap_s, round(pps, 6) AS pps, round(bps, 6) AS bps,
 round(avg_pkt_len, 6) AS avg_pkt_len FROM rates""")
def win_counter_rate(spark, sf_dir):
    return rounded(capture.counter_rates(readings(spark, sf_dir)).drop("t"))


# Phases: one per day of the stream, from its first to its last event, the class by the day.
share("ofs", "SELECT s.*, (epoch_us(s.start_time) - a.a) / 1e6 AS offset_s FROM st s CROSS JOIN anch a")
share("ph", """SELECT day, min(offset_s) AS start_offset_s, max(offset_s) - min(offset_s) AS duration_s,
 CASE day % 3 WHEN 0 THEN 'Normal traffic' WHEN 1 THEN 'DDoS attack' ELSE 'Suspicious traffic' END AS type, CAST(min(port) AS INT) AS port
 FROM (SELECT *, CAST(floor(offset_s / 86400) AS INT) AS day FROM ofs) GROUP BY day""")


def offsets(spark, sf_dir):
    st = stream(spark, sf_dir)
    return st.withColumn("offset_s", (micros("start_time") - F.lit(windows.first_instant(st, "start_time"))) / 1e6)


def phases(rows):
    day = F.floor(F.col("offset_s") / 86400).cast("int")
    kind = F.when(F.col("day") % 3 == 0, "Normal traffic").when(F.col("day") % 3 == 1, "DDoS attack").otherwise("Suspicious traffic")
    return rows.withColumn("day", day).groupBy("day").agg(
        F.min("offset_s").alias("start_offset_s"), (F.max("offset_s") - F.min("offset_s")).alias("duration_s"),
        F.min("port").alias("port")).withColumn("type", kind)


@query("agg_phase_mix", """SELECT type, round(sum(duration_s), 4) AS seconds, round(sum(duration_s) / (SELECT sum(duration_s) FROM ph), 6) AS share FROM ph GROUP BY type""")
def agg_phase_mix(spark, sf_dir):
    mix = capture.phase_mix(phases(offsets(spark, sf_dir)))
    return mix.select("type", F.round("seconds", 4).alias("seconds"), F.round("share", 6).alias("share"))


@query("join_phase_range", """SELECT o.attack_id, p.day, p.type AS phase_type FROM ofs o JOIN ph p
 ON o.offset_s >= p.start_offset_s AND o.offset_s < p.start_offset_s + p.duration_s""")
def join_phase_range(spark, sf_dir):
    rows = offsets(spark, sf_dir)
    plan = phases(rows).withColumnRenamed("type", "phase_type").drop("port")
    return capture.in_phase(rows.select("attack_id", "offset_s"), plan).select("attack_id", "day", "phase_type")


share("phw", """WITH c AS (SELECT p.*, CAST(i.i AS INT) AS window_no FROM ph p, LATERAL (SELECT unnest(range(0, CAST(ceil(p.duration_s / 5000) AS BIGINT))) AS i) i WHERE p.duration_s > 0)
SELECT *, start_offset_s + window_no * 5000 AS win_start_s, least(start_offset_s + window_no * 5000 + 5000, start_offset_s + duration_s) AS win_end_s FROM c
WHERE least(start_offset_s + window_no * 5000 + 5000, start_offset_s + duration_s) - (start_offset_s + window_no * 5000) >= 600""")


def cut_phases(rows):
    return capture.phase_windows(phases(rows), 5000.0, 300.0)


@query("str_phase_windows", "SELECT day, window_no, type, round(win_start_s, 4) AS win_start_s, round(win_end_s, 4) AS win_end_s FROM phw")
def str_phase_windows(spark, sf_dir):
    cut = cut_phases(offsets(spark, sf_dir))
    return rounded(cut.select("day", "window_no", "type", "win_start_s", "win_end_s"), 4)


@query("join_bucket_overlap", """WITH b AS (SELECT DISTINCT floor(offset_s / 7200) * 7200 AS s, victim FROM ofs),
r AS (SELECT day * 1000 + window_no AS range_id, win_start_s AS t0, win_end_s AS t1 FROM phw)
SELECT r.range_id, count(DISTINCT b.victim) AS sources FROM r LEFT JOIN b ON b.s < r.t1 AND b.s + 7200 > r.t0 GROUP BY r.range_id""")
def join_bucket_overlap(spark, sf_dir):
    rows = offsets(spark, sf_dir)
    ranges = cut_phases(rows).select((F.col("day") * 1000 + F.col("window_no")).alias("range_id"), F.col("win_start_s").alias("t0"), F.col("win_end_s").alias("t1"))
    return capture.sources_in_ranges(rows, ranges, 7200.0, "victim").select("range_id", "sources")


share("smp", """SELECT w.day * 1000 + w.window_no AS window_id, r.* FROM (SELECT x.*, (epoch_us(x.t) - a.a) / 1e6 AS offset_s FROM rates x CROSS JOIN anch a) r
 JOIN phw w ON r.offset_s >= w.win_start_s AND r.offset_s < w.win_end_s""")


def _capture(spark, sf_dir):
    rows = offsets(spark, sf_dir)
    start = F.lit(windows.first_instant(rows, "start_time"))
    at = lambda s: F.timestamp_micros(start + F.floor(F.col(s) * 1e6)).cast("timestamp_ntz")
    cut = cut_phases(rows).withColumns({
        "window_id": F.col("day") * 1000 + F.col("window_no"), "start_time": at("win_start_s"), "end_time": at("win_end_s")})
    rates = capture.counter_rates(readings(spark, sf_dir)).withColumn("offset_s", (micros("t") - start) / 1e6)
    spans = cut.select("window_id", F.col("win_start_s").alias("start_offset_s"),
                       (F.col("win_end_s") - F.col("win_start_s")).alias("duration_s"))
    # Read twice or more, so that rates and phases are worked out once.
    samples = materialize(capture.in_phase(rates, spans).select("window_id", "reading_id", "t", "pps", "avg_pkt_len", "interface"))
    sources = samples.groupBy("window_id").agg(F.countDistinct("interface").alias("n_sources"))
    return cut, samples, sources


@query("str_window_events", """SELECT w.day * 1000 + w.window_no AS attack_id, w.port, w.type, coalesce(CAST(floor(avg(s.pps)) AS BIGINT), 0) AS packet_speed,
 coalesce(CAST(floor(avg(s.avg_pkt_len)) AS INT), 0) AS avg_packet_len, CAST(count(DISTINCT s.interface) AS INT) AS avg_source_ip_count
FROM phw w LEFT JOIN smp s ON s.window_id = w.day * 1000 + w.window_no GROUP BY 1, 2, 3""")
def str_window_events(spark, sf_dir):
    cut, samples, sources = _capture(spark, sf_dir)
    return capture.captured_events(cut, samples, sources).drop("start_time", "end_time")


@query("str_window_components", """SELECT w.day * 1000 + w.window_no AS attack_id, coalesce(row_number() OVER (PARTITION BY w.day, w.window_no ORDER BY s.t, s.reading_id), 1) AS detect_count,
 w.port, coalesce(CAST(floor(s.pps) AS BIGINT), 0) AS packet_speed, coalesce(CAST(floor(s.avg_pkt_len) AS INT), 0) AS avg_packet_len
FROM phw w LEFT JOIN smp s ON s.window_id = w.day * 1000 + w.window_no""")
def str_window_components(spark, sf_dir):
    cut, samples, sources = _capture(spark, sf_dir)
    return capture.captured_components(cut, samples, sources).drop("time", "source_ip_count")
