"""Queries for sources, sinks, projections, filters and cleaning."""

from pyspark.sql import functions as F

from tallywire import names
from tallywire.functions import expressions as x
from tallywire.functions.quantiles import quantile_table
from tallywire.operators import cleaning
from tallywire.operators import explore
from tallywire.plans.features_q import rounded
from tallywire.plans.registry import query, share
from tallywire.plans.tables import components, events
from tallywire.session import scratch_path
from tallywire.sources import loaders, sinks

_EV_COLS = """attack_id, card, CAST(victim AS VARCHAR) AS victim, port, attack_code, detect_count, packet_speed,
 data_speed, avg_packet_len, avg_source_ip_count, start_time, end_time, type"""
_CO_COLS = """attack_id, detect_count, card, CAST(victim AS VARCHAR) AS victim, port, attack_code, packet_speed,
 data_speed, avg_packet_len, source_ip_count, time"""


def _text(df, kind):
    """The table as it stands in the raw files: times as text, "0" where unknown."""
    times = {c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("0"))
             for c in loaders.TIME_COLUMNS[kind]}
    return df.withColumns(times).select(*[f.name for f in loaders.SCHEMAS[kind].fields])


def _raw_files(spark, sf_dir, kind, sets):
    df = events(spark, sf_dir) if kind == "events" else components(spark, sf_dir)
    root = scratch_path(spark, "raw")
    for s in sets:
        sinks.save_csv_set(_text(df.filter(F.col("set_name") == s), kind), root, s, kind)
    return root


@query("src_csv_typed", f"SELECT {_CO_COLS}, set_name FROM co")
def src_csv_typed(spark, sf_dir):
    sets = [s for group in names.SPLIT_SETS.values() for s in group]
    root = _raw_files(spark, sf_dir, "components", sets)
    return loaders.read_csv(spark, root, "components", sets)


@query("src_lenient_ts", "SELECT attack_id, start_time, end_time FROM ev")
def src_lenient_ts(spark, sf_dir):
    raw = _text(events(spark, sf_dir), "events")
    return raw.select("attack_id", *[loaders.lenient_timestamp(c).alias(c) for c in ("start_time", "end_time")])


@query("src_tagged_union", f"SELECT {_EV_COLS}, set_name FROM ev WHERE split = 'train'")
def src_tagged_union(spark, sf_dir):
    ev = events(spark, sf_dir)
    parts = {s: ev.filter(F.col("set_name") == s).drop("set_name", "split") for s in names.SPLIT_SETS["train"]}
    return loaders.tagged_union(parts).withColumn("victim", F.col("victim").cast("string"))


def _stored(spark, sf_dir, kind):
    df = events(spark, sf_dir) if kind == "events" else components(spark, sf_dir)
    root = scratch_path(spark, "stored")
    sinks.save_parquet(df, root, kind)
    return root


@query("src_split_load", "SELECT split, count(*) AS n, CAST(sum(packet_speed) AS BIGINT) AS speed_sum FROM co GROUP BY split")
def src_split_load(spark, sf_dir):
    root = _stored(spark, sf_dir, "components")
    out = None
    for split in names.SPLIT_SETS:
        part = loaders.load_split(spark, root, "components", split)
        part = part.groupBy("split").agg(F.count("*").alias("n"), F.sum("packet_speed").alias("speed_sum"))
        out = part if out is None else out.unionByName(part)
    return out


@query("src_prefer_parquet", """SELECT 'parquet' AS origin, attack_id, set_name, end_time FROM ev WHERE split = 'test'
UNION ALL SELECT 'csv', attack_id, set_name, end_time FROM ev WHERE split = 'genericity'""")
def src_prefer_parquet(spark, sf_dir):
    """The test split exists as Parquet, the genericity split only as CSV."""
    ev = events(spark, sf_dir)
    root = _raw_files(spark, sf_dir, "events", names.SPLIT_SETS["genericity"])
    sinks.save_parquet(ev.filter("split = 'test'"), root, "events")
    show = lambda split, origin: loaders.load_split(spark, root, "events", split).select(
        F.lit(origin).alias("origin"), "attack_id", "set_name", "end_time")
    return show("test", "parquet").unionByName(show("genericity", "csv"))


@query("sink_parquet_zstd", "SELECT attack_id, split, type, packet_speed, end_time FROM ev")
def sink_parquet_zstd(spark, sf_dir):
    root = _stored(spark, sf_dir, "events")
    sinks.save_parquet(events(spark, sf_dir).limit(0), root, "events")  # exists, so left alone
    return spark.read.parquet(f"{root}/parquet/events").select(
        "attack_id", F.col("split").cast("string"), "type", "packet_speed", "end_time")


share("evtrain", "SELECT * FROM ev WHERE split = 'train'")
share("cotrain", "SELECT * FROM co WHERE split = 'train'")
share("caps", f"""
SELECT e.*, c.* FROM (SELECT {", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.99) AS ev_{c}" for c in names.EVENT_CAP_COLUMNS)},
  median(CASE WHEN avg_packet_len > 0 THEN CAST(avg_packet_len AS DOUBLE) END) AS ev_median FROM evtrain) e,
 (SELECT {", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.99) AS co_{c}" for c in names.COMPONENT_CAP_COLUMNS)},
  median(CASE WHEN avg_packet_len > 0 THEN CAST(avg_packet_len AS DOUBLE) END) AS co_median FROM cotrain) c""")


def _train(spark, sf_dir):
    keep = F.col("split") == "train"
    return events(spark, sf_dir).filter(keep), components(spark, sf_dir).filter(keep)


def fitted(spark, sf_dir, kind=None):
    """The thresholds of both tables, or of the one that is named."""
    ev, co = _train(spark, sf_dir)
    return cleaning.fit_thresholds(ev if kind != "components" else None, co if kind != "events" else None)


_CAP_SQL = "\nUNION ALL ".join(
    [f"SELECT 'events' AS source, '{c}' AS name, round(ev_{c}, 6) AS cap FROM caps" for c in names.EVENT_CAP_COLUMNS]
    + [f"SELECT 'components' AS source, '{c}' AS name, round(co_{c}, 6) AS cap FROM caps"
       for c in names.COMPONENT_CAP_COLUMNS])


@query("fit_caps", _CAP_SQL)
def fit_caps(spark, sf_dir):
    ev, co = _train(spark, sf_dir)
    out = None
    for source, df, cols in (("events", ev, names.EVENT_CAP_COLUMNS), ("components", co, names.COMPONENT_CAP_COLUMNS)):
        caps = quantile_table(df, [], {c: (F.col(c), names.CAP_QUANTILE) for c in cols})
        rows = caps.select(F.lit(source).alias("source"), F.explode(F.create_map(
            *[v for c in cols for v in (F.lit(c), F.col(c))])).alias("name", "cap"))
        out = rows if out is None else out.unionByName(rows)
    return rounded(out)


@query("fit_nonzero_median", """SELECT 'events' AS source, ev_median AS median FROM caps
UNION ALL SELECT 'components', co_median FROM caps""")
def fit_nonzero_median(spark, sf_dir):
    length = F.when(F.col("avg_packet_len") > 0, F.col("avg_packet_len"))
    parts = [
        quantile_table(df, [], {"median": (length, 0.5)}).select(F.lit(n).alias("source"), "median")
        for n, df in zip(("events", "components"), _train(spark, sf_dir))
    ]
    return parts[0].unionByName(parts[1])


@query("sink_config_json", _CAP_SQL + """
UNION ALL SELECT 'events', 'median', ev_median FROM caps UNION ALL SELECT 'components', 'median', co_median FROM caps""")
def sink_config_json(spark, sf_dir):
    path = scratch_path(spark, "thresholds")
    sinks.save_thresholds(spark, fitted(spark, sf_dir), path)
    back = spark.read.schema(sinks.THRESHOLD_SCHEMA).json(path)
    side = lambda s, caps, median: back.select(
        F.lit(s).alias("source"), F.explode(F.map_concat(caps, F.create_map(F.lit("median"), median))).alias("name", "cap"))
    both = side("events", F.col("event_caps"), F.col("event_avg_pkt_len_median")).unionByName(
        side("components", F.col("component_caps"), F.col("component_avg_pkt_len_median")))
    return rounded(both)


def _tokens_sql(code):
    return ", ".join(
        f"CAST(contains(lower(trim({code})), '{t.lower()}') AS INT) AS {x.token_column(t)}" for t in names.ATTACK_TOKENS)


share("evclean", f"""
SELECT e.attack_id, e.victim, e.port, e.type, e.split,
 least(CAST(e.detect_count AS DOUBLE), k.ev_detect_count) AS detect_count,
 least(CAST(e.packet_speed AS DOUBLE), k.ev_packet_speed) AS packet_speed,
 least(CASE WHEN e.avg_packet_len = 0 THEN floor(k.ev_median) ELSE CAST(e.avg_packet_len AS DOUBLE) END, k.ev_avg_packet_len) AS avg_packet_len,
 least(CAST(e.avg_source_ip_count AS DOUBLE), k.ev_avg_source_ip_count) AS avg_source_ip_count,
 greatest((epoch_us(coalesce(e.end_time, e.start_time)) - epoch_us(e.start_time)) / 1e6, 0) AS duration_s,
 CAST(e.avg_packet_len = 0 AS INT) AS avg_pkt_len_was_zero, {_tokens_sql("e.attack_code")},
 CAST(e.port = 0 AS INT) AS is_port_zero
FROM ev e CROSS JOIN caps k""")
share("coclean", f"""
SELECT c.attack_id, c.detect_count, c.victim, c.port, c.split,
 least(CAST(c.packet_speed AS DOUBLE), k.co_packet_speed) AS packet_speed,
 least(CASE WHEN c.avg_packet_len = 0 THEN floor(k.co_median) ELSE CAST(c.avg_packet_len AS DOUBLE) END, k.co_avg_packet_len) AS avg_packet_len,
 least(CAST(c.source_ip_count AS DOUBLE), k.co_source_ip_count) AS source_ip_count,
 CAST(c.avg_packet_len = 0 AS INT) AS avg_pkt_len_was_zero, {_tokens_sql("c.attack_code")},
 CAST(c.port = 0 AS INT) AS is_port_zero
FROM co c CROSS JOIN caps k""")
_EV_NUM = ["packet_speed", "avg_packet_len", "avg_source_ip_count", "detect_count", "duration_s"]
_EV_REST = ["attack_id", "victim", "port", "type", "split", "avg_pkt_len_was_zero", "is_port_zero"] + [
    x.token_column(t) for t in names.ATTACK_TOKENS]


def _r(cols):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


@query("prj_clean_events", f"SELECT {', '.join(_EV_REST)}, {_r(_EV_NUM)} FROM evclean")
def prj_clean_events(spark, sf_dir):
    return rounded(cleaning.clean_events(events(spark, sf_dir), fitted(spark, sf_dir, "events")))


@query("prj_clean_components", f"""SELECT attack_id, detect_count, victim, port, split, avg_pkt_len_was_zero, is_port_zero,
 {", ".join(x.token_column(t) for t in names.ATTACK_TOKENS)}, {_r(["packet_speed", "avg_packet_len", "source_ip_count"])} FROM coclean""")
def prj_clean_components(spark, sf_dir):
    return rounded(cleaning.clean_components(components(spark, sf_dir), fitted(spark, sf_dir, "components")))


@query("fit_apply_splits", """SELECT split, count(*) AS n, round(avg(packet_speed), 4) AS speed, round(avg(avg_packet_len), 4) AS length,
 CAST(sum(avg_pkt_len_was_zero) AS BIGINT) AS zero_lengths, round(max(packet_speed), 4) AS top_speed, round(avg(duration_s), 4) AS duration
FROM evclean WHERE split <> 'train' GROUP BY split""")
def fit_apply_splits(spark, sf_dir):
    cleaned = cleaning.clean_events(events(spark, sf_dir).filter("split <> 'train'"), fitted(spark, sf_dir, "events"))
    return rounded(cleaned.groupBy("split").agg(
        F.count("*").alias("n"), F.avg("packet_speed").alias("speed"), F.avg("avg_packet_len").alias("length"),
        F.sum("avg_pkt_len_was_zero").alias("zero_lengths"), F.max("packet_speed").alias("top_speed"),
        F.avg("duration_s").alias("duration")), 4)


@query("prj_drop_if_present", "SELECT attack_id, victim, port, type, split, packet_speed FROM ev")
def prj_drop_if_present(spark, sf_dir):
    narrow = events(spark, sf_dir).select("attack_id", "victim", "port", "type", "split", "packet_speed", "card")
    return narrow.drop("card", "set_name", "data_speed")


@query("prj_fill_end", "SELECT attack_id, coalesce(end_time, start_time) AS end_time FROM ev")
def prj_fill_end(spark, sf_dir):
    return events(spark, sf_dir).select("attack_id", F.coalesce("end_time", "start_time").alias("end_time"))


@query("prj_duration", "SELECT attack_id, greatest((epoch_us(end_time) - epoch_us(start_time)) / 1e6, CASE WHEN end_time IS NOT NULL THEN 0 END) AS duration_s FROM ev")
def prj_duration(spark, sf_dir):
    return events(spark, sf_dir).select("attack_id", x.duration_seconds("start_time", "end_time").alias("duration_s"))


@query("prj_zero_impute", """SELECT e.attack_id, CAST(e.avg_packet_len = 0 AS INT) AS was_zero,
 CASE WHEN e.avg_packet_len = 0 THEN CAST(floor(k.ev_median) AS INT) ELSE e.avg_packet_len END AS avg_packet_len FROM ev e CROSS JOIN caps k""")
def prj_zero_impute(spark, sf_dir):
    median = fitted(spark, sf_dir, "events").event_avg_pkt_len_median
    length = F.col("avg_packet_len")
    return events(spark, sf_dir).select(
        "attack_id", x.flag(length == 0).alias("was_zero"),
        cleaning.zero_length_filled(length, median).alias("avg_packet_len"))


@query("prj_cap", "SELECT c.attack_id, c.detect_count, round(least(CAST(c.packet_speed AS DOUBLE), k.co_packet_speed), 6) AS packet_speed FROM co c CROSS JOIN caps k")
def prj_cap(spark, sf_dir):
    cap = fitted(spark, sf_dir, "components").component_caps["packet_speed"]
    return rounded(components(spark, sf_dir).select("attack_id", "detect_count", x.capped("packet_speed", cap).alias("packet_speed")))


@query("prj_token_flags", f"SELECT attack_id, detect_count, {_tokens_sql('attack_code')} FROM co")
def prj_token_flags(spark, sf_dir):
    return components(spark, sf_dir).select("attack_id", "detect_count", *x.token_flags("attack_code"))


@query("prj_port_zero", "SELECT attack_id, CAST(port = 0 AS INT) AS is_port_zero FROM ev")
def prj_port_zero(spark, sf_dir):
    return events(spark, sf_dir).select("attack_id", x.flag(F.col("port") == 0).alias("is_port_zero"))


@query("prj_category_code", "SELECT attack_id, attack_code, CAST(dense_rank() OVER (ORDER BY attack_code) - 1 AS INT) AS attack_code_code FROM ev")
def prj_category_code(spark, sf_dir):
    return cleaning.category_codes(events(spark, sf_dir).select("attack_id", "attack_code"), "attack_code")


@query("prj_family", """SELECT attack_id, CASE WHEN contains(lower(attack_code), 'syn') THEN 'SYN Flood'
 WHEN contains(lower(attack_code), 'dns') THEN 'DNS Amplification' WHEN contains(lower(attack_code), 'ntp') THEN 'NTP Amplification'
 WHEN contains(lower(attack_code), 'udp') THEN 'UDP Flood' ELSE 'Other' END AS family FROM ev""")
def prj_family(spark, sf_dir):
    return events(spark, sf_dir).select("attack_id", x.family("attack_code").alias("family"))


_TAGGED = "CASE attack_id % 3 WHEN 0 THEN 'Random Forest' WHEN 1 THEN 'Random Forest [SMOTE]' ELSE 'KNN (k=5) [ADASYN]' END"


@query("prj_strategy_tag", """SELECT attack_id, CASE attack_id % 3 WHEN 2 THEN 'KNN (k=5)' ELSE 'Random Forest' END AS base,
 CASE attack_id % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'SMOTE' ELSE 'ADASYN' END AS strategy FROM ev""")
def prj_strategy_tag(spark, sf_dir):
    tagged = events(spark, sf_dir).selectExpr("attack_id", f"{_TAGGED} AS model")
    return tagged.select("attack_id", x.base_model_of("model").alias("base"), x.strategy_of("model").alias("strategy"))


@query("prj_data_rate_fallback", """SELECT attack_id, CAST(data_speed AS DOUBLE) AS with_column,
 CAST(packet_speed * avg_packet_len AS DOUBLE) AS without_column FROM ev""")
def prj_data_rate_fallback(spark, sf_dir):
    ev = events(spark, sf_dir)
    have = ev.columns
    lacking = [c for c in have if c != "data_speed"]
    return ev.select("attack_id", x.data_rate(have).alias("with_column"), x.data_rate(lacking).alias("without_column"))


@query("prj_burst_flag", """SELECT event_id AS attack_id, (epoch_us(ts) - min(epoch_us(ts)) OVER ()) / 1e6 % 60 < 10 AS in_burst FROM events""")
def prj_burst_flag(spark, sf_dir):
    from tallywire.plans.tables import stream
    from tallywire.streaming.windows import first_instant

    st = stream(spark, sf_dir)
    offset = (x.micros("start_time") - F.lit(first_instant(st, "start_time"))) / F.lit(1e6)
    return st.select("attack_id", x.in_burst(offset, 60.0, 10.0).alias("in_burst"))


@query("flt_positive", """SELECT attack_id, (epoch_us(end_time) - epoch_us(start_time)) / 1e6 AS duration_s FROM ev
WHERE end_time IS NOT NULL AND end_time > start_time""")
def flt_positive(spark, sf_dir):
    return explore.with_durations(events(spark, sf_dir)).filter("duration_s > 0").select("attack_id", "duration_s")


@query("flt_class", "SELECT attack_id, type, attack_code FROM ev WHERE type = 'DDoS attack' AND attack_code = 'NTP'")
def flt_class(spark, sf_dir):
    picked = events(spark, sf_dir).filter((F.col("type") == names.CLASSES[names.DDOS]) & (F.col("attack_code") == "NTP"))
    return picked.select("attack_id", "type", "attack_code")
