"""Queries for exploratory aggregates, joins, sets and sampling."""

from pyspark.sql import functions as F

from tallywire import names
from tallywire.operators import explore
from tallywire.plans.features_q import rounded
from tallywire.plans.registry import query, share
from tallywire.plans.tables import components, events, stream
from tallywire.session import materialize

_CLASS_ROWS = "(VALUES (0, 'Normal traffic'), (1, 'Suspicious traffic'), (2, 'DDoS attack')) t(ordinal, type)"
_FOUR = ["avg_packet_len", "avg_source_ip_count", "detect_count", "packet_speed"]
_P = names.PROFILE_COLUMNS


def _joined(parts):
    return ", ".join(parts)


@query("agg_class_mix", f"""SELECT t.ordinal, t.type, count(e.attack_id) AS n,
 round(count(e.attack_id) * 100.0::DOUBLE / sum(count(e.attack_id)) OVER (), 6) AS pct
FROM {_CLASS_ROWS} LEFT JOIN ev e ON e.type = t.type GROUP BY t.ordinal, t.type""")
def agg_class_mix(spark, sf_dir):
    return rounded(explore.class_mix(events(spark, sf_dir)))


share("codetype", "SELECT split, attack_code, min_by(type, attack_id) AS type FROM ev GROUP BY split, attack_code")
share("cotyped", "SELECT c.split, k.type FROM co c LEFT JOIN codetype k ON c.split = k.split AND c.attack_code = k.attack_code")


@query("agg_class_mix_splits", f"""
WITH s AS (SELECT DISTINCT split FROM ev), g AS (SELECT * FROM s, {_CLASS_ROWS}),
u AS (SELECT 'events' AS kind, split, type FROM ev UNION ALL SELECT 'components', split, type FROM cotyped WHERE type IS NOT NULL),
k AS (SELECT DISTINCT kind FROM u)
SELECT k.kind, g.split, g.ordinal, g.type, count(u.type) AS n,
 round(coalesce(count(u.type) * 100.0::DOUBLE / nullif(sum(count(u.type)) OVER (PARTITION BY k.kind, g.split), 0), 0), 6) AS pct
FROM k CROSS JOIN g LEFT JOIN u ON u.kind = k.kind AND u.split = g.split AND u.type = g.type GROUP BY k.kind, g.split, g.ordinal, g.type""")
def agg_class_mix_splits(spark, sf_dir):
    ev, co = events(spark, sf_dir), components(spark, sf_dir)
    both = explore.class_mix(ev, ["split"]).withColumn("kind", F.lit("events")).unionByName(
        explore.component_class_mix(ev, co, ["split"]).withColumn("kind", F.lit("components")))
    return rounded(both)


@query("join_code_type", """WITH k AS (SELECT attack_code, min_by(type, attack_id) AS type FROM ev GROUP BY attack_code)
SELECT c.attack_id, c.detect_count, k.type FROM co c LEFT JOIN k ON c.attack_code = k.attack_code""")
def join_code_type(spark, sf_dir):
    codes = explore.code_types(events(spark, sf_dir))
    return components(spark, sf_dir).join(codes, "attack_code", "left").select("attack_id", "detect_count", "type")


@query("agg_class_median", f"SELECT type, {_joined(f'median(CAST({c} AS DOUBLE)) AS {c}' for c in _FOUR)} FROM ev GROUP BY type")
def agg_class_median(spark, sf_dir):
    return explore.class_medians(events(spark, sf_dir), _FOUR)


@query("agg_class_mean", f"SELECT type, {_joined(f'round(avg({c}), 6) AS {c}' for c in _FOUR)} FROM ev GROUP BY type")
def agg_class_mean(spark, sf_dir):
    return rounded(explore.class_means(events(spark, sf_dir), _FOUR))


@query("agg_top_n", """WITH a AS (SELECT victim, count(*) AS n FROM ev GROUP BY victim ORDER BY n DESC, victim LIMIT 10),
d AS (SELECT victim, count(*) AS n FROM ev WHERE type = 'DDoS attack' GROUP BY victim ORDER BY n DESC, victim LIMIT 10)
SELECT 'all' AS scope, * FROM a UNION ALL SELECT 'ddos', * FROM d""")
def agg_top_n(spark, sf_dir):
    ev = events(spark, sf_dir)
    ddos = ev.filter(F.col("type") == names.CLASSES[names.DDOS])
    tag = lambda df, s: df.select(F.lit(s).alias("scope"), "*")
    return tag(explore.top_values(ev, "victim", 10), "all").unionByName(tag(explore.top_values(ddos, "victim", 10), "ddos"))


@query("agg_top_n_other", """WITH c AS (SELECT attack_code, count(*) AS n FROM co GROUP BY attack_code),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, attack_code) AS rn FROM c)
SELECT CASE WHEN rn <= 5 THEN attack_code ELSE 'Other' END AS attack_code, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY 1""")
def agg_top_n_other(spark, sf_dir):
    return explore.top_values_and_other(components(spark, sf_dir), "attack_code", 5)


@query("agg_top_n_per_class", """SELECT type, attack_code, n, CAST(rn AS INT) AS rn FROM (SELECT type, attack_code, count(*) AS n,
 row_number() OVER (PARTITION BY type ORDER BY count(*) DESC, attack_code) AS rn FROM ev GROUP BY type, attack_code) WHERE rn <= 4""")
def agg_top_n_per_class(spark, sf_dir):
    return explore.top_values_per_class(events(spark, sf_dir), "attack_code", 4)


@query("agg_daily", "SELECT CAST(start_time AS DATE) AS day, type, count(*) AS n FROM ev GROUP BY 1, 2")
def agg_daily(spark, sf_dir):
    return explore.daily_counts(events(spark, sf_dir))


share("clip99", """SELECT e.type, e.attack_id, least(CAST(e.packet_speed AS DOUBLE), q.cap) AS packet_speed FROM ev e JOIN
 (SELECT type, quantile_cont(CAST(packet_speed AS DOUBLE), 0.99) AS cap FROM ev GROUP BY type) q ON e.type = q.type""")


@query("agg_group_clip", "SELECT type, attack_id, round(packet_speed, 6) AS packet_speed FROM clip99")
def agg_group_clip(spark, sf_dir):
    ev = events(spark, sf_dir).select("type", "attack_id", "packet_speed")
    return rounded(explore.class_clipped(ev, "packet_speed", 0.99)).select("type", "attack_id", "packet_speed")


def _hist_sql(source, value, bins, edge):
    return f"""WITH v AS (SELECT type, {value} AS v FROM {source}),
s AS (SELECT type, min(v) AS lo, max(v) AS hi, count(*) AS total FROM v GROUP BY type),
c AS (SELECT v.type, CAST(least(floor((v.v - s.lo) / (s.hi - s.lo) * {bins}), {bins - 1}) AS INT) AS bin, count(*) AS n
 FROM v JOIN s ON v.type = s.type GROUP BY 1, 2),
g AS (SELECT s.*, CAST(b.bin AS INT) AS bin, {edge.format(i='b.bin')} AS l, {edge.format(i='(b.bin + 1)')} AS r
 FROM s, range(0, {bins}) b(bin))
SELECT g.type, g.bin, round(g.l, 4) AS left_edge, coalesce(c.n, 0) AS n,
 round(coalesce(c.n, 0) / (g.total * (g.r - g.l)), 9) AS density FROM g LEFT JOIN c ON g.type = c.type AND g.bin = c.bin"""


def _hist(df):
    return df.withColumns({"left_edge": F.round("left_edge", 4), "density": F.round("density", 9)})


@query("agg_hist_linear", _hist_sql("clip99", "packet_speed", 50, "(s.lo + (s.hi - s.lo) / 50 * {i})"))
def agg_hist_linear(spark, sf_dir):
    clipped = explore.class_clipped(events(spark, sf_dir).select("type", "packet_speed"), "packet_speed", 0.99)
    return _hist(explore.histogram(clipped, "packet_speed", 50))


share("clipdur", """WITH d AS (SELECT type, (epoch_us(end_time) - epoch_us(start_time)) / 1e6 AS d FROM ev
 WHERE end_time > start_time), q AS (SELECT type, quantile_cont(d, 0.99) AS cap FROM d GROUP BY type)
 SELECT d.type, least(d.d, q.cap) AS d FROM d JOIN q ON d.type = q.type""")


@query("agg_hist_log", _hist_sql("clipdur", "log10(d)", 40, "pow(10, s.lo + (s.hi - s.lo) / 40 * {i})"))
def agg_hist_log(spark, sf_dir):
    durations = explore.with_durations(events(spark, sf_dir)).filter("duration_s > 0").select("type", "duration_s")
    return _hist(explore.histogram(explore.class_clipped(durations, "duration_s", 0.99), "duration_s", 40, log=True))


@query("agg_log_if_skewed", "\nUNION ALL ".join(f"""SELECT '{c}' AS name, CAST(max({c}) AS DOUBLE) AS most, median(CAST({c} AS DOUBLE)) AS median,
 max({c}) > 10 * median({c}) AND median({c}) > 0 AS use_log,
 round(CASE WHEN max({c}) > 10 * median({c}) AND median({c}) > 0 THEN avg(ln(1 + {c})) ELSE avg({c}) END, 4) AS shown_mean FROM ev"""
 for c in _P))
def agg_log_if_skewed(spark, sf_dir):
    ev = events(spark, sf_dir)
    switch = materialize(explore.skew_switch(ev, _P))
    shown = explore.log_where_skewed(ev, _P, switch).agg(*[F.avg(c).alias(c) for c in _P])
    shown = shown.select(F.explode(F.create_map(*[v for c in _P for v in (F.lit(c), F.round(c, 4))])).alias("name", "shown_mean"))
    return switch.join(shown, "name")


@query("agg_duration_dist", """WITH d AS (SELECT type, log10(greatest((epoch_us(end_time) - epoch_us(start_time)) / 1e6, 0.1)) AS v
 FROM ev WHERE end_time > start_time) SELECT type, round(avg(v), 6) AS mean, round(median(v), 6) AS median,
 round(min(v), 6) AS least, round(max(v), 6) AS most FROM d GROUP BY type""")
def agg_duration_dist(spark, sf_dir):
    return rounded(explore.duration_spread(events(spark, sf_dir)))


@query("agg_component_shares", """SELECT round(avg(CASE WHEN detect_count = 1 THEN 100.0 ELSE 0 END), 6) AS single,
 round(avg(CASE WHEN detect_count > 1 THEN 100.0 ELSE 0 END), 6) AS several,
 round(avg(CASE WHEN detect_count > 10 THEN 100.0 ELSE 0 END), 6) AS many FROM ev""")
def agg_component_shares(spark, sf_dir):
    return rounded(explore.component_shares(events(spark, sf_dir)))


@query("agg_corr", "\nUNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM ev" for a in _P for b in _P))
def agg_corr(spark, sf_dir):
    return rounded(explore.correlations(events(spark, sf_dir), _P))


@query("agg_profile", "\nUNION ALL ".join(f"""SELECT '{c}' AS name, round(avg({c}), 6) AS mean, CAST(max({c}) AS DOUBLE) AS most,
 median(CAST({c} AS DOUBLE)) AS median, round(quantile_cont(CAST({c} AS DOUBLE), 0.99), 6) AS p99 FROM ev""" for c in _P))
def agg_profile(spark, sf_dir):
    return rounded(explore.profile(events(spark, sf_dir), _P))


_AUDITED = ["attack_id", "card", "victim", "port", "packet_speed", "avg_packet_len", "end_time"]
_NUM = ["port", "packet_speed", "avg_packet_len"]


@query("agg_quality_audit", "\nUNION ALL ".join(
    [f"""SELECT 'nulls:{c}' AS "check", CAST(count(*) - count({c}) AS DOUBLE) AS value FROM ev
UNION ALL SELECT 'constant:{c}', CAST(CAST(count(DISTINCT {c}) = 1 AS INT) AS DOUBLE) FROM ev""" for c in _AUDITED]
    + [f"""SELECT 'negative:{c}', CAST(count(*) FILTER ({c} < 0) AS DOUBLE) FROM ev
UNION ALL SELECT 'zero_pct:{c}', round(avg(CASE WHEN {c} = 0 THEN 100.0 ELSE 0 END), 6) FROM ev""" for c in _NUM]
    + ["SELECT 'bad_port', CAST(count(*) FILTER (port NOT BETWEEN 0 AND 65535) AS DOUBLE) FROM ev",
       f"""SELECT 'duplicate_rows', CAST((SELECT count(*) FROM ev) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_AUDITED)} FROM ev)) AS DOUBLE)"""]))
def agg_quality_audit(spark, sf_dir):
    return rounded(explore.quality_audit(events(spark, sf_dir).select(*_AUDITED), _NUM))


_MEANS = _joined(f"avg({c}) AS {c}" for c in _P)


def _z_sql(dev, r=4):
    return _joined(f"round(({c} - avg({c}) OVER ()) / ({dev}({c}) OVER () + 1e-9), {r}) AS z_{c}" for c in _P)


@query("agg_fingerprint", f"""WITH t AS (SELECT attack_code, count(*) AS n, {_MEANS},
 count(*) FILTER (type = 'Normal traffic') AS a, count(*) FILTER (type = 'Suspicious traffic') AS b, count(*) FILTER (type = 'DDoS attack') AS c
 FROM ev GROUP BY attack_code ORDER BY n DESC, attack_code LIMIT 15)
SELECT attack_code, n, CASE WHEN a >= b AND a >= c THEN 'Normal traffic' WHEN b >= c THEN 'Suspicious traffic' ELSE 'DDoS attack' END AS modal_type,
 {_joined(f"round({c}, 4) AS {c}" for c in _P)}, {_z_sql("stddev_pop")} FROM t""")
def agg_fingerprint(spark, sf_dir):
    return rounded(explore.fingerprints(events(spark, sf_dir), _P), 4)


share("evfam", """SELECT *, CASE WHEN contains(lower(attack_code), 'syn') THEN 'SYN Flood'
 WHEN contains(lower(attack_code), 'dns') THEN 'DNS Amplification' WHEN contains(lower(attack_code), 'ntp') THEN 'NTP Amplification'
 WHEN contains(lower(attack_code), 'udp') THEN 'UDP Flood' ELSE 'Other' END AS family FROM ev WHERE type = 'DDoS attack'""")


@query("agg_family_mix", """SELECT t.ordinal, t.family, count(e.attack_id) AS n,
 round(count(e.attack_id) * 100.0::DOUBLE / sum(count(e.attack_id)) OVER (), 6) AS pct
FROM (VALUES (0, 'SYN Flood'), (1, 'DNS Amplification'), (2, 'NTP Amplification'), (3, 'UDP Flood'), (4, 'Other')) t(ordinal, family)
LEFT JOIN evfam e ON e.family = t.family GROUP BY t.ordinal, t.family""")
def agg_family_mix(spark, sf_dir):
    return rounded(explore.family_mix(events(spark, sf_dir)))


@query("agg_family_signature", f"""WITH t AS (SELECT family, {_MEANS} FROM evfam GROUP BY family)
SELECT family, {_joined(f"round({c}, 4) AS {c}" for c in _P)}, {_z_sql("stddev_samp")} FROM t""")
def agg_family_signature(spark, sf_dir):
    return rounded(explore.family_signature(events(spark, sf_dir), _P), 4)


@query("agg_port_heat", """SELECT port, count(*) AS n, {} FROM ev GROUP BY port ORDER BY n DESC, port LIMIT 10""".format(
    _joined(f"round(count(*) FILTER (type = '{t}') * 100.0::DOUBLE / (SELECT count(*) FROM ev WHERE type = '{t}'), 6) AS pct_{i}"
            for i, t in enumerate(names.CLASSES))))
def agg_port_heat(spark, sf_dir):
    return rounded(explore.port_heat(events(spark, sf_dir)))


share("fscore", "WITH u AS ({}), g AS (SELECT feature, avg(v) AS grand FROM u GROUP BY feature), c AS ({})\n{}".format(
    " UNION ALL ".join(f"SELECT '{c}' AS feature, type, CAST({c} AS DOUBLE) AS v FROM ev" for c in _P),
    "SELECT feature, type, count(*) AS n, avg(v) AS m, var_pop(v) AS s FROM u GROUP BY feature, type",
    """SELECT c.feature, sum(c.n * (c.m - g.grand) ** 2) / (sum(c.s * c.n) + 1e-9) AS score
 FROM c JOIN g ON c.feature = g.feature GROUP BY c.feature"""))


@query("agg_fscore", "SELECT feature, round(score, 8) AS score, CAST(row_number() OVER (ORDER BY score DESC, feature) AS INT) AS place FROM fscore")
def agg_fscore(spark, sf_dir):
    return rounded(explore.separability(events(spark, sf_dir), _P), 8)


@query("agg_fscore_pairs", """WITH r AS (SELECT feature, row_number() OVER (ORDER BY score DESC, feature) AS place FROM fscore)
SELECT w.pair, a.feature AS feature_x, b.feature AS feature_y FROM (VALUES (0, 1, 2), (1, 1, 3), (2, 2, 4)) w(pair, x, y)
JOIN r a ON a.place = w.x JOIN r b ON b.place = w.y""")
def agg_fscore_pairs(spark, sf_dir):
    return explore.separating_pairs(explore.separability(events(spark, sf_dir), _P))


@query("agg_ellipse", """WITH p AS (SELECT type, CAST(packet_speed AS DOUBLE) / 1000 AS x, CAST(avg_source_ip_count AS DOUBLE) AS y FROM ev),
q AS (SELECT type, quantile_cont(x, 0.05) AS x0, quantile_cont(x, 0.95) AS x1, quantile_cont(y, 0.05) AS y0, quantile_cont(y, 0.95) AS y1 FROM p GROUP BY type),
m AS (SELECT p.type, count(*) AS n, avg(x) AS mean_x, avg(y) AS mean_y, covar_samp(x, x) AS a, covar_samp(x, y) AS b, covar_samp(y, y) AS d
 FROM p JOIN q ON p.type = q.type WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 GROUP BY p.type HAVING count(*) >= 10),
e AS (SELECT *, sqrt(((a - d) / 2) ** 2 + b ** 2) AS r, (a + d) / 2 AS c FROM m)
SELECT type, n, round(mean_x, 5) AS mean_x, round(mean_y, 5) AS mean_y, round(2 * sqrt(greatest(c - r, 0) * 5.991), 5) AS width,
 round(2 * sqrt(greatest(c + r, 0) * 5.991), 5) AS height, round(degrees(atan2(c + r - a, b)), 5) AS angle FROM e""")
def agg_ellipse(spark, sf_dir):
    scaled = events(spark, sf_dir).select("type", (F.col("packet_speed").cast("double") / 1000).alias("x"), F.col("avg_source_ip_count").alias("y"))
    return rounded(explore.ellipses(scaled, "x", "y"), 5)


share("cumshare", """SELECT victim, n, row_number() OVER (ORDER BY n DESC, victim) AS place,
 sum(n) OVER (ORDER BY n DESC, victim ROWS UNBOUNDED PRECEDING) * 100.0::DOUBLE / sum(n) OVER () AS cum_pct
 FROM (SELECT victim, count(*) AS n FROM ev GROUP BY victim)""")


@query("win_cum_share", "SELECT victim, n, place, round(cum_pct, 6) AS cum_pct FROM cumshare")
def win_cum_share(spark, sf_dir):
    return rounded(explore.concentration(events(spark, sf_dir)))


@query("win_cum_share_n80", "SELECT count(*) AS n_covering FROM cumshare WHERE cum_pct <= 80")
def win_cum_share_n80(spark, sf_dir):
    return explore.covering(explore.concentration(events(spark, sf_dir)))


_DRAW = explore.draw_sql("attack_id", 42)


@query("win_strat_sample", f"""WITH r AS (SELECT attack_id, type, row_number() OVER (PARTITION BY type ORDER BY {_DRAW}, attack_id) AS rn,
 count(*) OVER (PARTITION BY type) AS nc, count(*) OVER () AS n FROM ev)
SELECT attack_id, type FROM r WHERE rn <= least(nc, greatest(1, (5000 * nc) // n))""")
def win_strat_sample(spark, sf_dir):
    return explore.stratified_sample(events(spark, sf_dir).select("attack_id", "type"), "attack_id", 5000, seed=42)


@query("win_sample_n", f"SELECT attack_id, type FROM ev ORDER BY {_DRAW}, attack_id LIMIT 10000")
def win_sample_n(spark, sf_dir):
    return explore.sample_rows(events(spark, sf_dir).select("attack_id", "type"), "attack_id", 10000, seed=42)


@query("join_semi", f"""SELECT attack_id, detect_count, packet_speed FROM co WHERE attack_id IN
 (SELECT attack_id FROM ev ORDER BY {_DRAW}, attack_id LIMIT 10000)""")
def join_semi(spark, sf_dir):
    sample = explore.sample_rows(events(spark, sf_dir).select("attack_id"), "attack_id", 10000, seed=42)
    return components(spark, sf_dir).join(sample, "attack_id", "left_semi").select("attack_id", "detect_count", "packet_speed")


@query("srt_time", "SELECT attack_id, start_time FROM ev WHERE start_time IS NOT NULL ORDER BY start_time, attack_id")
def srt_time(spark, sf_dir):
    ev = events(spark, sf_dir).select("attack_id", "start_time").dropna()
    return ev.orderBy("start_time", "attack_id")


@query("srt_fixed_order", """SELECT t.ordinal, t.type, count(e.attack_id) AS n FROM (VALUES (0, 'DDoS attack'), (1, 'Normal traffic'),
 (2, 'Absent class'), (3, 'Suspicious traffic')) t(ordinal, type) LEFT JOIN ev e ON e.type = t.type GROUP BY t.ordinal, t.type""")
def srt_fixed_order(spark, sf_dir):
    order = ["DDoS attack", "Normal traffic", "Absent class", "Suspicious traffic"]
    return explore.fixed_counts(events(spark, sf_dir), "type", order).drop("pct").orderBy("ordinal")


@query("set_union_shift", """WITH c AS (SELECT attack_id % 6 AS chunk, attack_id, start_time + CAST(attack_id % 6 AS INT) * INTERVAL '50' SECOND AS start_time FROM st)
SELECT CAST(chunk AS INT) AS chunk, attack_id, start_time FROM c""")
def set_union_shift(spark, sf_dir):
    from tallywire.streaming.windows import shifted_chunks

    st = stream(spark, sf_dir).select((F.col("attack_id") % 6).cast("int").alias("chunk"), "attack_id", "start_time")
    return shifted_chunks(st, "chunk", 50, ["start_time"])


@query("set_common", """SELECT victim FROM ev WHERE split = 'test' INTERSECT SELECT victim FROM ev WHERE split = 'genericity' ORDER BY victim""")
def set_common(spark, sf_dir):
    ev = events(spark, sf_dir)
    part = lambda s: ev.filter(F.col("split") == s).select("victim")
    return part("test").intersect(part("genericity")).orderBy("victim")
