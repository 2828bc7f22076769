"""Queries for feature sets and the aggregates under them."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallywire import names
from tallywire.functions.expressions import class_code, guarded_ratio, log1p_floor0, port_flags
from tallywire.functions.quantiles import median_and_deviation, quantile_table
from tallywire.operators import features
from tallywire.plans.registry import query, share
from tallywire.plans.tables import components, events


def rounded(df, digits=6):
    """All double columns rounded, so that both engines show the same digits."""
    return df.selectExpr(*[f"round(`{n}`, {digits}) AS `{n}`" if t == "double" else f"`{n}`" for n, t in df.dtypes])


share("cstat", """
SELECT attack_id, count(*) AS n_rows,
 avg(CAST(packet_speed AS DOUBLE)) AS pps_mean, CAST(max(packet_speed) AS DOUBLE) AS pps_max,
 coalesce(stddev_samp(CAST(packet_speed AS DOUBLE)), 0) AS pps_std,
 quantile_cont(CAST(packet_speed AS DOUBLE), 0.95) AS pps_p95,
 coalesce(avg(CASE WHEN avg_packet_len > 0 THEN CAST(avg_packet_len AS DOUBLE) END), 0) AS bytes_per_pkt_mean,
 CAST(coalesce(max(CASE WHEN avg_packet_len > 0 THEN avg_packet_len END), 0) AS DOUBLE) AS bytes_per_pkt_max,
 CAST(coalesce(min(CASE WHEN avg_packet_len > 0 THEN avg_packet_len END), 0) AS DOUBLE) AS bytes_per_pkt_min,
 avg(CAST(source_ip_count AS DOUBLE)) AS src_ip_mean, CAST(max(source_ip_count) AS DOUBLE) AS src_ip_max,
 coalesce(stddev_samp(CAST(source_ip_count AS DOUBLE)), 0) AS src_ip_std
FROM co GROUP BY attack_id""")

PORT_SQL = """
 CAST(e.port = 0 AS INT)::DOUBLE AS is_port_zero, CAST(e.port = 53 AS INT)::DOUBLE AS is_port_dns,
 CAST(e.port IN (19, 123, 161, 389, 1900, 3702, 5683, 11211) AS INT)::DOUBLE AS is_amplification_port,
 CAST(e.port IN (80, 8080) AS INT)::DOUBLE AS is_http_port,
 CAST(e.port IN (443, 8443) AS INT)::DOUBLE AS is_https_port,
 CAST(e.port >= 32768 AS INT)::DOUBLE AS is_ephemeral_port"""
LABEL_SQL = "CASE e.type WHEN 'Normal traffic' THEN 0 WHEN 'Suspicious traffic' THEN 1 WHEN 'DDoS attack' THEN 2 END"

share("fab", f"""
SELECT e.attack_id, e.split, {LABEL_SQL} AS label,
 ln(1 + CASE WHEN c.n_rows IS NULL THEN e.packet_speed ELSE c.pps_mean END) AS pps_mean,
 ln(1 + CASE WHEN c.n_rows IS NULL THEN e.packet_speed ELSE c.pps_max END) AS pps_max,
 ln(1 + CASE WHEN c.n_rows IS NULL THEN e.packet_speed ELSE c.pps_p95 END) AS pps_p95,
 ln(1 + CASE WHEN c.n_rows IS NULL THEN 0 ELSE c.pps_std END) AS pps_std,
 CASE WHEN c.n_rows IS NULL THEN 1 ELSE c.pps_max / greatest(c.pps_mean, 1) END AS pps_burstiness,
 CASE WHEN c.n_rows IS NULL THEN 0 ELSE c.pps_std / greatest(c.pps_mean, 1) END AS pps_cv,
 CASE WHEN c.n_rows IS NULL THEN 0
  ELSE (c.pps_max - c.pps_p95) / greatest(c.pps_max - c.pps_mean, 1) END AS pps_skew_proxy,
 CASE WHEN c.n_rows IS NULL THEN e.avg_packet_len ELSE c.bytes_per_pkt_mean END AS bytes_per_pkt_mean,
 CASE WHEN c.n_rows IS NULL THEN e.avg_packet_len ELSE c.bytes_per_pkt_max END AS bytes_per_pkt_max,
 CASE WHEN c.n_rows IS NULL THEN e.avg_packet_len ELSE c.bytes_per_pkt_min END AS bytes_per_pkt_min,
 CASE WHEN c.n_rows IS NULL THEN 0
  ELSE (c.bytes_per_pkt_max - c.bytes_per_pkt_min) / greatest(c.bytes_per_pkt_mean, 1) END AS bytes_per_pkt_range,
 CASE WHEN c.n_rows IS NULL THEN e.avg_packet_len / greatest(CAST(e.packet_speed AS DOUBLE), 1)
  ELSE c.bytes_per_pkt_mean / greatest(c.pps_mean, 1) END AS bytes_to_pkts_ratio,
 ln(1 + CASE WHEN c.n_rows IS NULL THEN e.avg_source_ip_count ELSE c.src_ip_mean END) AS src_ip_mean,
 ln(1 + CASE WHEN c.n_rows IS NULL THEN e.avg_source_ip_count ELSE c.src_ip_max END) AS src_ip_max,
 ln(1 + CASE WHEN c.n_rows IS NULL THEN 0 ELSE c.src_ip_std END) AS src_ip_std,
 {PORT_SQL}
FROM ev e LEFT JOIN cstat c ON e.attack_id = c.attack_id""")


def round_sql(columns, digits=6):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def ab(spark, sf_dir, **kw):
    return features.event_features(events(spark, sf_dir), components(spark, sf_dir), **kw)


@query("feat_ab", f"SELECT attack_id, label, {round_sql(names.FEATURES_AB)} FROM fab")
def feat_ab(spark, sf_dir):
    return rounded(ab(spark, sf_dir).drop("type"))


@query("feat_v1", f"""SELECT attack_id, {LABEL_SQL} AS label,
 {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in names.FEATURES_V1)} FROM ev e""")
def feat_v1(spark, sf_dir):
    return features.raw_event_features(events(spark, sf_dir))


share("fbase", f"""
SELECT e.attack_id, {LABEL_SQL} AS label,
 CASE WHEN c.n_rows IS NULL THEN e.packet_speed ELSE c.pps_mean END AS pps_mean,
 CASE WHEN c.n_rows IS NULL THEN e.packet_speed ELSE c.pps_max END AS pps_max,
 CASE WHEN c.n_rows IS NULL THEN e.packet_speed ELSE c.pps_p95 END AS pps_p95,
 CASE WHEN c.n_rows IS NULL THEN 0 ELSE c.pps_std END AS pps_std,
 CASE WHEN c.n_rows IS NULL THEN 1 ELSE c.pps_max / greatest(c.pps_mean, 1) END AS pps_burstiness,
 CASE WHEN c.n_rows IS NULL THEN e.avg_packet_len ELSE c.bytes_per_pkt_mean END AS bytes_per_pkt_mean,
 CASE WHEN c.n_rows IS NULL THEN e.avg_packet_len ELSE c.bytes_per_pkt_max END AS bytes_per_pkt_max,
 CASE WHEN c.n_rows IS NULL THEN e.avg_packet_len ELSE c.bytes_per_pkt_min END AS bytes_per_pkt_min,
 CASE WHEN c.n_rows IS NULL THEN CAST(e.packet_speed AS DOUBLE) * e.avg_packet_len
  ELSE c.pps_mean * c.bytes_per_pkt_mean END AS bps_estimate,
 ln(1 + CASE WHEN c.n_rows IS NULL THEN e.avg_source_ip_count ELSE c.src_ip_mean END) AS src_ip_mean,
 ln(1 + CASE WHEN c.n_rows IS NULL THEN e.avg_source_ip_count ELSE c.src_ip_max END) AS src_ip_max,
 ln(1 + CASE WHEN c.n_rows IS NULL THEN 0 ELSE c.src_ip_std END) AS src_ip_std,
 {PORT_SQL}
FROM ev e LEFT JOIN cstat c ON e.attack_id = c.attack_id""")


@query("feat_base", f"SELECT attack_id, label, {round_sql(names.FEATURES_BASE, 3)} FROM fbase")
def feat_base(spark, sf_dir):
    return rounded(ab(spark, sf_dir, blocks=("base",)).drop("type"), 3)


share("cmed", """
SELECT attack_id, count(*) AS n, median(CAST(packet_speed AS DOUBLE)) AS pps_median,
 median(CASE WHEN avg_packet_len > 0 THEN CAST(avg_packet_len AS DOUBLE) END) AS len_median
FROM co GROUP BY attack_id""")
share("cmad", """
SELECT c.attack_id, any_value(m.n) AS n, any_value(m.pps_median) AS pps_median, any_value(m.len_median) AS len_median,
 median(abs(c.packet_speed - m.pps_median)) AS pps_mad,
 median(CASE WHEN c.avg_packet_len > 0 THEN abs(c.avg_packet_len - m.len_median) END) AS len_mad
FROM co c JOIN cmed m ON c.attack_id = m.attack_id GROUP BY c.attack_id""")
share("fext", f"""
SELECT e.attack_id, {LABEL_SQL} AS label, CAST(coalesce(c.n, 0) AS DOUBLE) AS n_components,
 ln(1 + coalesce(c.n, 0)) AS log1p_n_components, CAST(CAST(coalesce(c.n, 0) = 1 AS INT) AS DOUBLE) AS is_single_sample,
 ln(1 + CASE WHEN coalesce(c.pps_median, 0) = 0 THEN e.packet_speed ELSE c.pps_median END) AS pps_median_log,
 ln(1 + coalesce(c.pps_mad, 0)) AS pps_mad_log,
 CASE WHEN coalesce(c.len_median, 0) = 0 THEN e.avg_packet_len ELSE c.len_median END AS bytes_per_pkt_median,
 coalesce(c.len_mad, 0) AS bytes_per_pkt_mad
FROM ev e LEFT JOIN cmad c ON e.attack_id = c.attack_id""")


@query("feat_extras", f"SELECT attack_id, label, {round_sql(names.FEATURES_EXTRA)} FROM fext")
def feat_extras(spark, sf_dir):
    return rounded(ab(spark, sf_dir, blocks=("extras",)).drop("type"))


@query("agg_extras", f"SELECT attack_id, {round_sql(names.FEATURES_EXTRA)} FROM fext")
def agg_extras(spark, sf_dir):
    return rounded(ab(spark, sf_dir, blocks=("extras",), label=None))


_ALL = names.FEATURES_AB + names.FEATURES_EXTRA


@query("join_feature_concat", f"""SELECT a.attack_id, a.label,
 {", ".join(f"round(a.{c}, 6) AS {c}" for c in names.FEATURES_AB)},
 {", ".join(f"round(x.{c}, 6) AS {c}" for c in names.FEATURES_EXTRA)}
FROM fab a JOIN fext x ON a.attack_id = x.attack_id""")
def join_feature_concat(spark, sf_dir):
    left = ab(spark, sf_dir).drop("type")
    right = ab(spark, sf_dir, blocks=("extras",), label=None)
    return rounded(features.concat_blocks(left, right))


_STACK = " + ".join(f"x.{c}" for c in names.FEATURES_EXTRA)


@query("feat_stack", f"""SELECT a.attack_id, a.label, round({" + ".join(f"a.{c}" for c in names.FEATURES_AB)}, 4) AS ab_sum,
 round({_STACK}, 4) AS extras_sum, 28 AS width FROM fab a JOIN fext x ON a.attack_id = x.attack_id""")
def feat_stack(spark, sf_dir):
    """The stacked vector, shown as its width and the sums of its two blocks."""
    table = features.assembled(ab(spark, sf_dir, blocks=("ab", "extras")), _ALL)
    parts = table.select("attack_id", "label", vector_to_array("features").alias("v"))
    total = lambda a, b: F.aggregate(F.slice("v", a, b), F.lit(0.0), lambda acc, x: acc + x)
    n = len(names.FEATURES_AB)
    return parts.select(
        "attack_id", "label", F.round(total(1, n), 4).alias("ab_sum"),
        F.round(total(n + 1, len(names.FEATURES_EXTRA)), 4).alias("extras_sum"), F.size("v").alias("width"),
    )


_STAT_COLS = ["pps_mean", "pps_max", "pps_std", "pps_p95", "bytes_per_pkt_mean", "bytes_per_pkt_max",
              "bytes_per_pkt_min", "src_ip_mean", "src_ip_max", "src_ip_std"]


@query("agg_component_stats", f"SELECT attack_id, {round_sql(_STAT_COLS, 3)} FROM cstat")
def agg_component_stats(spark, sf_dir):
    stats = features.component_statistics(components(spark, sf_dir))
    return rounded(stats.select("attack_id", *_STAT_COLS), 3)


@query("agg_p95", "SELECT attack_id, round(pps_p95, 3) AS pps_p95 FROM cstat")
def agg_p95(spark, sf_dir):
    co = components(spark, sf_dir)
    return rounded(quantile_table(co, ["attack_id"], {"pps_p95": (F.col("packet_speed"), 0.95)}), 3)


@query("agg_source_col", """
SELECT 'source_ip_count' AS layout, round(avg(source_ip_count), 6) AS mean_sources FROM co
UNION ALL SELECT 'avg_source_ip_count', round(avg(source_ip_count), 6) FROM co
UNION ALL SELECT 'none', CAST(0 AS DOUBLE)""")
def agg_source_col(spark, sf_dir):
    """The same aggregate over the three layouts a component table may have."""
    co = components(spark, sf_dir)
    layouts = {
        "source_ip_count": co,
        "avg_source_ip_count": co.withColumnRenamed("source_ip_count", "avg_source_ip_count"),
        "none": co.drop("source_ip_count"),
    }
    parts = [
        t.agg(F.round(F.avg(features.source_count(t.columns)), 6).alias("mean_sources"))
        .select(F.lit(n).alias("layout"), "mean_sources")
        for n, t in layouts.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("agg_count_zero_fill", """SELECT attack_id, CAST(n_components AS BIGINT) AS n_components,
 round(log1p_n_components, 6) AS log1p_n_components, CAST(is_single_sample AS INT) AS is_single_sample FROM fext""")
def agg_count_zero_fill(spark, sf_dir):
    return rounded(features.component_counts(events(spark, sf_dir), components(spark, sf_dir)))


def _robust():
    return {"pps": F.col("packet_speed"), "len": F.when(F.col("avg_packet_len") > 0, F.col("avg_packet_len"))}


@query("agg_median", "SELECT attack_id, pps_median, len_median FROM cmed")
def agg_median(spark, sf_dir):
    co = components(spark, sf_dir)
    return quantile_table(co, ["attack_id"], {f"{n}_median": (c, 0.5) for n, c in _robust().items()})


@query("agg_mad", "SELECT attack_id, pps_median, len_median, pps_mad, len_mad FROM cmad")
def agg_mad(spark, sf_dir):
    return median_and_deviation(components(spark, sf_dir), ["attack_id"], _robust())


@query("join_left_features", """SELECT e.attack_id, e.port, e.type, round(c.pps_mean, 6) AS pps_mean, c.pps_max
FROM ev e LEFT JOIN cstat c ON e.attack_id = c.attack_id""")
def join_left_features(spark, sf_dir):
    stats = features.component_statistics(components(spark, sf_dir)).select("attack_id", "pps_mean", "pps_max")
    return rounded(events(spark, sf_dir).select("attack_id", "port", "type").join(stats, "attack_id", "left"))


_FALLBACK = ["pps_mean", "pps_max", "pps_p95", "pps_burstiness", "bytes_per_pkt_mean", "bytes_to_pkts_ratio",
             "src_ip_mean", "src_ip_std"]


@query("join_fallback", f"""SELECT f.attack_id, {", ".join(f"round(f.{c}, 6) AS {c}" for c in _FALLBACK)}
FROM fab f WHERE NOT EXISTS (SELECT 1 FROM co WHERE co.attack_id = f.attack_id)""")
def join_fallback(spark, sf_dir):
    """Events without any component, whose features come from the event itself."""
    ev, co = events(spark, sf_dir), components(spark, sf_dir)
    both = features.event_features(ev, co, blocks=("ab", "extras"), label=None)
    return rounded(both.filter("n_components = 0").select("attack_id", *_FALLBACK))


@query("prj_port_groups", f"""SELECT e.attack_id, e.port, {PORT_SQL} FROM ev e""")
def prj_port_groups(spark, sf_dir):
    return events(spark, sf_dir).select("attack_id", "port", *port_flags("port"))


@query("prj_log1p", """SELECT attack_id, detect_count, round(ln(1 + greatest(CAST(packet_speed - 50000 AS DOUBLE), 0)), 6) AS pps_log,
 round(ln(1 + source_ip_count), 6) AS src_log FROM co""")
def prj_log1p(spark, sf_dir):
    return rounded(components(spark, sf_dir).select(
        "attack_id", "detect_count", log1p_floor0(F.col("packet_speed") - 50000).alias("pps_log"),
        log1p_floor0("source_ip_count").alias("src_log"),
    ))


@query("prj_ratio_guard", """SELECT attack_id, detect_count, round(packet_speed / greatest(CAST(avg_packet_len AS DOUBLE), 1), 6) AS ratio FROM co""")
def prj_ratio_guard(spark, sf_dir):
    return rounded(components(spark, sf_dir).select(
        "attack_id", "detect_count", guarded_ratio(F.col("packet_speed"), F.col("avg_packet_len")).alias("ratio")))


@query("prj_finite_scrub", """SELECT attack_id,
 CASE WHEN attack_id % 4 = 3 THEN CAST(packet_speed AS DOUBLE) ELSE 0 END AS value FROM ev""")
def prj_finite_scrub(spark, sf_dir):
    dirty = events(spark, sf_dir).selectExpr("attack_id", """CASE attack_id % 4 WHEN 0 THEN double('NaN')
        WHEN 1 THEN double('Infinity') WHEN 2 THEN NULL ELSE double(packet_speed) END AS value""")
    return features.scrubbed(dirty, ["value"])


@query("prj_label_code", f"SELECT attack_id, {LABEL_SQL} AS label FROM ev e")
def prj_label_code(spark, sf_dir):
    return events(spark, sf_dir).select("attack_id", class_code("type").alias("label"))
