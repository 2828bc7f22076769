"""The given tables seen as events, components, stream, readings and predictions.

Every view is a list of (column, SQL expression) that reads the same in Spark and in
ANSI SQL, so the Spark frame and the oracle text come from one definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_CODES = """CASE {key} % {n} WHEN 0 THEN 'DNS, High volume traffic' WHEN 1 THEN 'SYN Attack' WHEN 2 THEN 'NTP'
 WHEN 3 THEN 'Generic UDP' WHEN 4 THEN 'High volume traffic' WHEN 5 THEN 'Suspicious traffic, Memcached'
 ELSE 'SSDP, CLDAP' END"""
_PORTS = """CASE {key} % 10 WHEN 0 THEN 0 WHEN 1 THEN 53 WHEN 2 THEN 123 WHEN 3 THEN 80 WHEN 4 THEN 443
 WHEN 5 THEN 8443 WHEN 6 THEN 40000 WHEN 7 THEN 11211 WHEN 8 THEN 4500 ELSE 22 END"""

EV = ("orders", {
    "attack_id": "o_orderkey",
    "victim": "o_custkey",
    "port": _PORTS.format(key="o_custkey"),
    "type": "CASE o_orderstatus WHEN 'O' THEN 'Normal traffic' WHEN 'P' THEN 'Suspicious traffic' ELSE 'DDoS attack' END",
    "attack_code": _CODES.format(key="o_orderkey", n=6),
    "split": "CASE WHEN o_orderkey % 10 < 5 THEN 'train' WHEN o_orderkey % 10 < 7 THEN 'test' ELSE 'genericity' END",
    "set_name": """CASE WHEN o_orderkey % 10 < 3 THEN 'SetA' WHEN o_orderkey % 10 < 5 THEN 'SetB'
 WHEN o_orderkey % 10 < 7 THEN 'SetC' ELSE 'SetD' END""",
    "card": "'card0'",
    "detect_count": "CAST(o_orderkey % 13 + 1 AS INT)",
    "packet_speed": "CAST(floor(o_totalprice) AS BIGINT)",
    "data_speed": "CAST(floor(o_totalprice * (o_orderkey % 7) / 5) AS BIGINT)",
    "avg_packet_len": "CAST((o_orderkey % 7) * 200 AS INT)",
    "avg_source_ip_count": "CAST(o_custkey % 61 + 1 AS INT)",
    "start_time": "o_orderdate",
    "end_time": """CASE WHEN o_orderkey % 97 = 0 THEN NULL
 ELSE o_orderdate + CAST(o_orderkey % 50 - 5 AS INT) * INTERVAL '1' SECOND END""",
})
CO = ("lineitem", {
    "attack_id": "l_orderkey",
    "detect_count": "l_linenumber",
    "card": "'card0'",
    "victim": "l_suppkey",
    "port": _PORTS.format(key="l_suppkey"),
    "attack_code": _CODES.format(key="l_partkey", n=7),
    "split": "CASE WHEN l_orderkey % 10 < 5 THEN 'train' WHEN l_orderkey % 10 < 7 THEN 'test' ELSE 'genericity' END",
    "set_name": """CASE WHEN l_orderkey % 10 < 3 THEN 'SetA' WHEN l_orderkey % 10 < 5 THEN 'SetB'
 WHEN l_orderkey % 10 < 7 THEN 'SetC' ELSE 'SetD' END""",
    "packet_speed": "CAST(floor(l_extendedprice) AS BIGINT)",
    "data_speed": "CAST(floor(l_extendedprice * l_quantity / 5) AS BIGINT)",
    "avg_packet_len": "CAST((l_quantity - 1) * 30 AS INT)",
    "source_ip_count": "CAST(l_suppkey + 1 AS INT)",
    "time": "l_shipdate",
})
# One row per stream event, with truth, a prediction and a DDoS probability.
ST = ("events", {
    "attack_id": "event_id",
    "start_time": "ts",
    "victim": "user_id",
    "port": _PORTS.format(key="user_id"),
    "packet_speed": "CAST(floor(value * 1000) AS BIGINT)",
    "avg_packet_len": "CAST((event_id % 7) * 200 AS INT)",
    "avg_source_ip_count": "CAST(user_id % 61 + 1 AS INT)",
    "type": """CASE event_type WHEN 'purchase' THEN 'DDoS attack' WHEN 'error' THEN 'Suspicious traffic'
 ELSE 'Normal traffic' END""",
    "y_true": "CASE event_type WHEN 'purchase' THEN 2 WHEN 'error' THEN 1 ELSE 0 END",
    "y_pred": """CAST((CASE event_type WHEN 'purchase' THEN 2 WHEN 'error' THEN 1 ELSE 0 END
 + CASE WHEN event_id % 11 < 2 THEN 1 ELSE 0 END) % 3 AS INT)""",
    "p_ddos": """CASE WHEN event_type = 'purchase' THEN 0.5e0 + (event_id % 50) / 100e0 ELSE (event_id % 60) / 100e0 END""",
})


# Declared, so that no job has to look into the files first.
SCHEMAS = {
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
 o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
 l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
 l_shipdate timestamp_ntz""",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def frame(spark: SparkSession, sf_dir: str, view) -> DataFrame:
    table, columns = view
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    raw = spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")
    return raw.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])


def select_sql(view) -> str:
    table, columns = view
    body = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"SELECT {body} FROM {table}"


def events(spark, sf_dir):
    return frame(spark, sf_dir, EV)


def components(spark, sf_dir):
    return frame(spark, sf_dir, CO)


def stream(spark, sf_dir):
    return frame(spark, sf_dir, ST)


CTES = {"ev": select_sql(EV), "co": select_sql(CO), "st": select_sql(ST)}
