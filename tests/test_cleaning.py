import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallywire import names
from tallywire.operators import cleaning
from tallywire.sources import loaders, sinks


def _events(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [
        (1, "c", "v", 0, "DNS, High volume traffic", 1, 10, 1, 0, 1, t, t + dt.timedelta(seconds=2.5), names.CLASSES[0], "SetA"),
        (2, "c", "v", 80, " suspicious traffic, Memcached", 2, 20, 1, 101, 2, t, None, names.CLASSES[1], "SetA"),
        (3, "c", "v", 443, "ntp", 3, 1000, 1, 200, 300, t, t - dt.timedelta(seconds=9), names.CLASSES[2], "SetB"),
        (4, "c", "v", 443, None, 3, 30, 1, 300, 3, None, None, names.CLASSES[2], "SetB"),
    ]
    return spark.createDataFrame(rows, """attack_id bigint, card string, victim string, port int, attack_code string, detect_count int,
        packet_speed bigint, data_speed bigint, avg_packet_len int, avg_source_ip_count int, start_time timestamp_ntz,
        end_time timestamp_ntz, type string, set_name string""")


def test_clean_events(spark):
    ev = _events(spark)
    fitted = cleaning.Thresholds({"packet_speed": 100.0, "avg_packet_len": 190.5}, {}, 150.7, 0.0)
    out = {r["attack_id"]: r for r in cleaning.clean_events(ev, fitted).collect()}
    assert len(out[1]) == 20
    assert out[1]["avg_packet_len"] == 150 and out[1]["avg_pkt_len_was_zero"] == 1   # whole part, then the cap
    assert out[3]["avg_packet_len"] == 190.5 and out[3]["packet_speed"] == 100
    assert [out[i]["duration_s"] for i in (1, 2, 3, 4)] == [2.5, 0, 0, None]
    assert out[2]["atk_suspicious_traffic"] == 1 and out[2]["atk_memcached"] == 1 and out[2]["atk_dns"] == 0
    assert out[1]["is_port_zero"] == 1 and out[4]["atk_ntp"] == 0


@pytest.mark.parametrize("limit", ["2", "1000000"])
def test_thresholds_come_from_train_only(spark, limit):
    spark.conf.set("spark.tallywire.groupRows", limit)
    try:
        ev = _events(spark)
        co = ev.select("attack_id", "packet_speed", "data_speed", "avg_packet_len", F.col("detect_count").alias("source_ip_count"))
        fitted = cleaning.fit_thresholds(ev, co)
    finally:
        spark.conf.unset("spark.tallywire.groupRows")
    assert fitted.event_caps["packet_speed"] == pytest.approx(30 + (1000 - 30) * 0.97)
    assert fitted.event_avg_pkt_len_median == 200
    changed = ev.withColumn("packet_speed", F.lit(10**9))
    assert cleaning.clean_events(changed, fitted).agg(F.max("packet_speed")).first()[0] == pytest.approx(fitted.event_caps["packet_speed"])


def test_thresholds_round_trip(spark, tmp_path):
    fitted = cleaning.Thresholds({"packet_speed": 1.5}, {"data_speed": 2.25}, 3.0, 4.0, 0.98)
    sinks.save_thresholds(spark, fitted, str(tmp_path / "t"))
    assert sinks.load_thresholds(spark, str(tmp_path / "t")) == fitted


def test_split_loading(spark, tmp_path):
    ev = _events(spark).withColumn("split", F.lit("train"))
    root = str(tmp_path)
    for s in ("SetA", "SetB"):
        text = ev.filter(F.col("set_name") == s).withColumns({
            c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("0")) for c in ("start_time", "end_time")})
        sinks.save_csv_set(text.select(*[f.name for f in loaders.EVENT_SCHEMA.fields]), root, s, "events")
    from_csv = loaders.load_split(spark, root, "events", "train")
    assert {r["attack_id"]: r["set_name"] for r in from_csv.collect()} == {1: "SetA", 2: "SetA", 3: "SetB", 4: "SetB"}
    assert from_csv.filter("end_time IS NULL").count() == 2
    sinks.save_parquet(ev.limit(3), root, "events")
    assert loaders.load_split(spark, root, "events", "train").count() == 3      # Parquet is preferred
    sinks.save_parquet(ev, root, "events")
    assert loaders.load_split(spark, root, "events", "train").count() == 3      # and never overwritten
    with pytest.raises(ValueError):
        loaders.load_split(spark, root, "events", "validation")
    plan = loaders.load_split(spark, root, "events", "train")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_csv_columns_are_found_by_name(spark, tmp_path):
    import gzip

    from tallywire.sources.loaders import SCHEMAS, read_csv
    columns = [f.name for f in SCHEMAS["events"]]
    row = {c: "7" for c in columns} | {"packet_speed": "11", "data_speed": "22", "start_time": "2024-01-02 03:04:05", "end_time": "0",
                                       "victim": "v", "type": "Normal traffic", "port": "no number"}
    order = columns[::-1] + ["further"]
    text = ",".join(order) + "\n" + ",".join(row.get(c, "x") for c in order) + "\n"
    (tmp_path / "traffic_SetA_events.csv").write_text(text)
    with gzip.open(tmp_path / "traffic_SetB_events.csv.gz", "wt") as f:
        f.write(text)
    for got in read_csv(spark, str(tmp_path), "events", ["SetA", "SetB"]).collect():
        assert (got["packet_speed"], got["data_speed"], got["port"], got["end_time"]) == (11, 22, None, None)
        assert got["start_time"].hour == 3 and got["set_name"] in ("SetA", "SetB")
    (tmp_path / "traffic_SetC_events.csv").write_text("attack_id\n1\n")
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path), "events", ["SetC"])


def test_missing_category_has_its_own_code(spark):
    from tallywire.operators.cleaning import category_codes
    df = spark.createDataFrame([("b",), (None,), ("a",)], "c string")
    assert {r["c"]: r["c_code"] for r in category_codes(df, "c").collect()} == {"a": 0, "b": 1, None: -1}


def test_top_lists_leave_null_out(spark):
    from tallywire.operators.explore import top_values_and_other
    df = spark.createDataFrame([(None,)] * 3 + [("a",)] * 2 + [("b",)], "c string")
    assert {r["c"]: r["n"] for r in top_values_and_other(df, "c", 1).collect()} == {"a": 2, "Other": 1}


def test_scratch_must_be_shared():
    from tallywire.session import is_local
    assert is_local("local[8]") and is_local("local") and not is_local("local-cluster[2,1,512]") and not is_local("spark://host:7077")
