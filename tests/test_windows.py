import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallywire.streaming import capture, live, windows

T0 = dt.datetime(2024, 1, 1, 10, 0, 3, 250000)


def _at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def _stream(spark):
    # Windows of 5 s from the first event: [0,5) [5,10) empty [10,15) and one event on the edge at 15.
    rows = [(1, 0.0, 2, 2), (2, 1.0, 0, 2), (3, 4.999, 2, 2), (4, 10.0, 0, 0), (5, 12.0, 2, 0), (6, 15.0, 1, 1)]
    return spark.createDataFrame(
        [(i, _at(s), t, p, 80 if i % 2 else 53, i * 10, 100, i) for i, s, t, p in rows],
        """attack_id bigint, start_time timestamp_ntz, y_true int, y_pred int, port int, packet_speed bigint,
           avg_packet_len int, avg_source_ip_count int""")


def test_anchored_windows_and_edge(spark):
    df = _stream(spark)
    kept = windows.windowed(df, "start_time", 5.0)
    got = {r["attack_id"]: (r["window_start"] - T0).total_seconds() for r in kept.collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 10, 5: 10, 6: 15}
    dropped = windows.windowed(df, "start_time", 5.0, drop_edge=True)
    assert sorted(r["attack_id"] for r in dropped.collect()) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("limit", [1, 1000])
def test_counts_alerts_totals(spark, limit):
    scored = windows.windowed(_stream(spark), "start_time", 5.0)
    alerts = windows.with_alerts(windows.window_counts(scored), threshold=3)
    rows = alerts.orderBy("window_start").collect()
    assert [r["n_events"] for r in rows] == [3, 2, 1]
    assert [r["alert_raised"] for r in rows] == [True, False, False]
    assert [r["missed_attack"] for r in rows] == [False, True, False]
    assert rows[0]["accuracy"] == pytest.approx(2 / 3) and rows[0]["c02"] == 1
    totals = windows.running_totals(alerts, limit).orderBy("window_index").collect()
    assert [r["total_events"] for r in totals] == [3, 5, 6]
    assert [r["total_ddos_actual"] for r in totals] == [2, 3, 3]
    assert [r["window_index"] for r in totals] == [0, 1, 2]
    summary = windows.summary(alerts).first()
    assert (summary["total_events"], summary["alert_count"], summary["missed_attack_windows"]) == (6, 1, 1)
    assert windows.threat_level(windows.window_counts(scored)).first()["threat_level"] == "NORMAL"


def test_rolling_mean_starts_late(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(7)], "window_index bigint, accuracy double")
    got = {r["window_index"]: r["rolling"] for r in windows.rolling_mean(df, "accuracy").collect()}
    assert got == {4: 2.0, 5: 3.0, 6: 4.0}


def test_records_are_nested(spark):
    scored = windows.windowed(_stream(spark), "start_time", 5.0)
    first = windows.window_records(scored, "m", "s", "test").orderBy("window_index").first()
    assert first["confusion"] == [[0, 0, 1], [0, 0, 0], [0, 0, 2]]
    assert [(p["port"], p["count"]) for p in first["top_ports"]] == [(80, 2), (53, 1)]
    assert [s["src_ip_count"] for s in first["event_samples"]] == [1, 2, 3]     # oldest first
    assert first["avg_data_rate"] == 2000.0


@pytest.mark.parametrize("limit", [1, 1000])
def test_counter_reset_and_idle(spark, limit):
    rows = [(1, 1, 0, 100, 1000), (1, 2, 1, 300, 5000), (1, 3, 2, 300, 5000), (1, 4, 3, 50, 200), (1, 5, 5, 60, 700), (2, 6, 0, 7, 7)]
    df = spark.createDataFrame([(i, n, _at(s), p, b) for i, n, s, p, b in rows],
                               "interface int, reading_id int, t timestamp, packets bigint, bytes bigint")
    got = {r["reading_id"]: (r["pps"], r["bps"], r["avg_pkt_len"]) for r in capture.counter_rates(df, limit=limit).collect()}
    assert got == {2: (200.0, 4000.0, 20.0), 5: (5.0, 250.0, 50.0)}


def test_phases(spark):
    phases = spark.createDataFrame([(0.0, 20.0, "a"), (12.0, 10.0, "b"), (30.0, 11.0, "c")],
                                   "start_offset_s double, duration_s double, type string")
    samples = spark.createDataFrame([(float(s),) for s in (0, 11.9, 12, 21.9, 22, 29, 30, 40.9, 41)], "offset_s double")
    got = {r["offset_s"]: r["type"] for r in capture.in_phase(samples, phases, bucket_s=7.0).collect()}
    assert got == {0: "a", 11.9: "a", 12: "b", 21.9: "b", 30: "c", 40.9: "c"}
    assert "strategy=broadcast" in capture.in_phase(samples, phases)._jdf.queryExecution().logical().toString()    # samples stay where they are
    cut = capture.phase_windows(phases.filter("type = 'c'"), 5.0, 1.0).orderBy("win_start_s").collect()
    assert [(r["win_start_s"], r["win_end_s"]) for r in cut] == [(30, 35), (35, 40)]    # the last second is too short


def test_empty_window_gives_one_zero_row(spark):
    frame = spark.createDataFrame([(1, 80, "a", _at(0), _at(5)), (2, 80, "a", _at(5), _at(10))],
                                  "window_id int, port int, type string, start_time timestamp, end_time timestamp")
    samples = spark.createDataFrame([(1, 10.9, 99.5, _at(1), 1), (1, 12.2, 100.9, _at(2), 2)],
                                    "window_id int, pps double, avg_pkt_len double, t timestamp, reading_id int")
    ev = {r["attack_id"]: r for r in capture.captured_events(frame, samples).collect()}
    assert (ev[1]["packet_speed"], ev[1]["avg_packet_len"], ev[2]["packet_speed"]) == (11, 100, 0)
    co = sorted((r["attack_id"], r["detect_count"], r["packet_speed"]) for r in capture.captured_components(frame, samples).collect())
    assert co == [(1, 1, 10), (1, 2, 12), (2, 1, 0)]


def test_stream_equals_batch(spark, tmp_path):
    df = _stream(spark)
    source = str(tmp_path / "in")
    for i in range(3):      # three files, read one per trigger
        df.filter(F.col("attack_id").isin(2 * i + 1, 2 * i + 2)).coalesce(1).write.mode("append").parquet(source)
    anchor = windows.first_instant(df, "start_time")
    stream = live.file_stream(spark, source, df.schema, files_per_trigger=1)
    alerts = live.windowed_alerts(stream, 5.0, anchor, lateness="1 minute", threshold=3)
    path = str(tmp_path / "out")
    live.write_latest(alerts, path, str(tmp_path / "ck"))
    got = {(r["window_start"] - T0).total_seconds(): (r["n_events"], r["alert_raised"]) for r in live.latest(spark, path).collect()}
    assert got == {0.0: (3, True), 10.0: (2, False), 15.0: (1, False)}

    live.write_latest(live.totals(stream), str(tmp_path / "tot"), str(tmp_path / "ck2"))
    assert live.latest(spark, str(tmp_path / "tot")).first()["total_events"] == 6


def test_json_sink_writes_closed_windows_once(spark, tmp_path):
    df = _stream(spark)
    source = str(tmp_path / "in")
    df.coalesce(1).write.parquet(source)
    anchor = windows.first_instant(df, "start_time")

    def run():
        alerts = live.windowed_alerts(live.file_stream(spark, source, df.schema), 5.0, anchor, lateness="2 seconds")
        live.write_json(alerts, str(tmp_path / "json"), str(tmp_path / "ck"))
        return sorted(r["value"] for r in spark.read.text(str(tmp_path / "json")).collect())

    first = run()
    assert len(first) == 1 and '"n_events":3' in first[0]   # [10,15) may still get late events
    late = df.filter("attack_id = 6").withColumn("start_time", F.col("start_time") + F.expr("INTERVAL '60' SECOND"))
    late.coalesce(1).write.mode("append").parquet(source)
    assert len(run()) == 3      # the later watermark closes the other two
