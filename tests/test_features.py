import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywire import names
from tallywire.operators import features

EVENTS = [
    # id, port, type, speed, length, sources, detect, data
    (1, 53, "Normal traffic", 100, 500, 3, 4, 9),
    (2, 40000, "DDoS attack", 0, 700, 5, 1, 9),
    (3, 0, "Suspicious traffic", 50, 0, 9, 1, 9),
    (4, 8080, "Suspicious traffic", 60, 300, 0, 1, 9),
]
COMPONENTS = [
    (1, 10, 0, 1), (1, 20, 100, 2), (1, 40, 300, 2), (1, 90, 200, 7),   # a zero length is left out
    (3, 5, 0, 2), (3, 7, 0, 2), (3, 9, 0, 2),                            # only zero lengths: stays 0
    (4, 0, 60, 1),                                                       # a single slow sample
    (9, 1, 1, 1),                                                        # an event we do not have
]


@pytest.fixture(scope="module")
def tables(spark):
    ev = spark.createDataFrame(EVENTS, """attack_id bigint, port int, type string, packet_speed bigint, avg_packet_len int,
        avg_source_ip_count int, detect_count int, data_speed bigint""")
    co = spark.createDataFrame(COMPONENTS, "attack_id bigint, packet_speed bigint, avg_packet_len int, source_ip_count int")
    return ev.persist(), co.persist()


def _by_id(df):
    return {r["attack_id"]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("limit", [2, 1000])
def test_statistics_and_fallback(tables, limit):
    rows = _by_id(features.event_features(*tables, blocks=("ab", "extras"), limit=limit))
    assert sorted(rows) == [1, 2, 3, 4]
    one = rows[1]
    pps = np.array([10, 20, 40, 90.0])
    assert one["pps_mean"] == pytest.approx(math.log1p(40))
    assert one["pps_p95"] == pytest.approx(math.log1p(np.percentile(pps, 95)))
    assert one["pps_std"] == pytest.approx(math.log1p(pps.std(ddof=1)))
    assert one["pps_burstiness"] == pytest.approx(90 / 40)
    assert one["pps_skew_proxy"] == pytest.approx((90 - np.percentile(pps, 95)) / 50)
    assert (one["bytes_per_pkt_mean"], one["bytes_per_pkt_min"]) == (200, 100)
    assert one["bytes_to_pkts_ratio"] == pytest.approx(5)
    assert (one["n_components"], one["pps_median_log"]) == (4, pytest.approx(math.log1p(30)))
    assert one["pps_mad_log"] == pytest.approx(math.log1p(np.median(np.abs(pps - 30))))
    assert one["label"] == 0 and one["is_port_dns"] == 1

    none = rows[2]  # no components: its own values, unit burstiness even at speed zero
    assert none["pps_mean"] == 0 and none["pps_burstiness"] == 1 and none["pps_std"] == 0
    assert none["bytes_per_pkt_max"] == 700 and none["bytes_to_pkts_ratio"] == 700
    assert none["src_ip_max"] == pytest.approx(math.log1p(5)) and none["is_ephemeral_port"] == 1
    assert none["n_components"] == 0 and none["bytes_per_pkt_median"] == 700

    zero = rows[3]  # components, but no length: no fallback for ab, one for the median
    assert zero["bytes_per_pkt_mean"] == 0 and zero["bytes_to_pkts_ratio"] == 0
    assert zero["bytes_per_pkt_median"] == 0 and zero["is_port_zero"] == 1

    single = rows[4]
    assert single["pps_std"] == 0 and single["pps_burstiness"] == 0 and single["is_single_sample"] == 1
    assert single["pps_median_log"] == pytest.approx(math.log1p(60))  # a zero median falls back
    assert single["is_http_port"] == 1


def test_no_value_is_missing(tables):
    df = features.event_features(*tables, blocks=("ab", "extras", "v1"))
    columns = names.FEATURES_AB + names.FEATURES_EXTRA + names.FEATURES_V1
    bad = df.filter(" OR ".join(f"{c} IS NULL OR isnan({c})" for c in columns))
    assert bad.isEmpty()


def test_base_block(tables):
    rows = _by_id(features.event_features(*tables, blocks=("base",)))
    assert rows[1]["pps_mean"] == 40 and rows[1]["bps_estimate"] == 40 * 200
    assert rows[2]["bps_estimate"] == 0 and rows[3]["bps_estimate"] == 0
    with pytest.raises(ValueError):
        features.event_features(*tables, blocks=("base", "ab"))


def test_narrow_live_tables(tables):
    ev, co = tables
    live = features.event_features(ev.select("attack_id", "port"), co.drop("source_ip_count"), label=None)
    rows = _by_id(live)
    assert rows[2]["pps_mean"] == 0 and rows[2]["bytes_to_pkts_ratio"] == 0
    assert rows[1]["src_ip_mean"] == 0 and "label" not in rows[1]
    with pytest.raises(ValueError):
        features.event_features(ev.drop("attack_id"), co)


def test_scrubbing(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (-float("inf"),), (None,), (2.5,)], "x double")
    assert sorted(r["x"] for r in features.scrubbed(df, ["x"]).collect()) == [0, 0, 0, 0, 2.5]


def test_skewed_event_equals_unsplit(spark):
    """One event with a third of all components gives the same features on both paths."""
    co = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 1, id % 500 + 2) AS attack_id", "(id * 7919) % 1000 AS packet_speed",
        "cast((id * 31) % 9 * 100 AS int) AS avg_packet_len", "cast(id % 17 AS int) AS source_ip_count")
    ev = spark.range(1, 510).selectExpr(
        "id AS attack_id", "80 AS port", "'Normal traffic' AS type", "id AS packet_speed", "10 AS avg_packet_len",
        "1 AS avg_source_ip_count")
    whole = _by_id(features.event_features(ev, co, blocks=("ab", "extras"), limit=10**6))
    split = _by_id(features.event_features(ev, co, blocks=("ab", "extras"), limit=100))
    assert whole.keys() == split.keys()
    for key, row in whole.items():
        for c in names.FEATURES_AB + names.FEATURES_EXTRA:
            assert split[key][c] == pytest.approx(row[c], rel=1e-9), (key, c)
