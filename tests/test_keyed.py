"""Streams with keyed state against their batch forms, over restarts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F, types as T

from tallywire.streaming import keyed, live, windows

T0 = dt.datetime(2024, 1, 1, 10, 0, 3, 250000)
SHAPE = "attack_id bigint, start_time timestamp_ntz, y_true int, y_pred int, port int, rate double, note string"


def _events(spark, count=400, hot=0.35):
    """Events of 40 s in windows of 5 s; a third of them lies in the fourth window, ten at one instant."""
    draw = random.Random(5)
    rows = []
    for i in range(count):
        at = 16.0 if i < 10 else 15.0 + 4.9 * draw.random() if draw.random() < hot else 40 * draw.random()
        rows.append((i, T0 + dt.timedelta(seconds=at), draw.randrange(3), draw.randrange(3), None if i % 9 == 0 else i % 4,
                     None if i % 7 == 0 else draw.random() * 1e6, None if i % 5 == 0 else f'a "{i}" \n é'))
    rows.append((count, T0, 0, 0, 1, 0.0, None))
    return sorted(rows, key=lambda r: r[1])


def _feed(spark, rows, path):
    spark.createDataFrame(rows, SHAPE).repartition(3).write.mode("append").parquet(path)


def _batch_tail(spark, rows, n):
    df = windows.windowed(spark.createDataFrame(rows, SHAPE), "start_time", 5.0)
    tail = windows.last_per_window(df, n).select(F.unix_micros(F.col("window_start").cast("timestamp")).alias("key"), "rn", "attack_id", "port", "rate", "note")
    return sorted(map(tuple, tail.collect()))


def test_last_events_equal_batch_after_restart(spark, tmp_path):
    rows = _events(spark)
    source, out, ck = (str(tmp_path / p) for p in ("in", "out", "ck"))
    anchor = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)

    def run():
        stream = live.file_stream(spark, source, spark.createDataFrame([], SHAPE).schema)
        table = keyed.last_events(stream, 5.0, anchor, n=8, lateness="10 seconds")
        keyed.write_state(table, out, ck)
        found = keyed.read_state(spark, out, table.schema, ["key"])
        return sorted(map(tuple, found.select("key", "rn", "attack_id", "port", "rate", "note").collect()))

    _feed(spark, rows[:250], source)
    assert run() == _batch_tail(spark, rows[:250], 8)
    _feed(spark, rows[250:], source)        # a new query on the old checkpoint; a window is split over both
    whole = _batch_tail(spark, rows, 8)
    assert run() == whole
    _feed(spark, [(900, T0, 0, 0, 1, 1.0, "late")], source)     # its window ended before the watermark
    assert run() == whole
    later = [(901, T0 + dt.timedelta(seconds=33), 0, 0, 1, 1.0, "in time")]
    _feed(spark, later, source)
    assert run() == _batch_tail(spark, rows + later, 8)


def test_unplaced_rows_are_left_out(spark, tmp_path):
    source, out, ck = (str(tmp_path / p) for p in ("in", "out", "ck"))
    _feed(spark, [(1, T0, 0, 0, None, None, None), (None, T0, 0, 0, 1, 1.0, ""), (2, None, 0, 0, 1, 1.0, "")], source)
    table = keyed.last_events(live.file_stream(spark, source, spark.createDataFrame([], SHAPE).schema), 5.0)
    keyed.write_state(table, out, ck)
    found = keyed.read_state(spark, out, table.schema, ["key"]).collect()
    assert [(r["rn"], r["attack_id"], r["port"], r["note"], r["start_time"]) for r in found] == [(1, 1, None, None, T0)]


@pytest.mark.parametrize("held", [3, 100_000])
def test_cut_hands_on_when_full(spark, held, monkeypatch):
    monkeypatch.setattr(keyed, "HELD", held)
    rows = [(k, 0, t, k * 100 + t, "x") for k in range(5) for t in range(20)]
    df = spark.createDataFrame(rows, "key bigint, ends_ms bigint, at_us bigint, id bigint, row string").coalesce(1)
    kept = {(r["key"], r["at_us"]) for r in keyed._cut(df, 2).collect()}
    assert kept >= {(k, t) for k in range(5) for t in (18, 19)}
    assert held == 3 or len(kept) == 10


def test_history_equals_batch_after_restart(spark, tmp_path):
    rows = _events(spark)
    source, out, ck, alarms, ck2 = (str(tmp_path / p) for p in ("in", "out", "ck", "alarms", "ck2"))
    anchor = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    given = rows[:200]

    def run(earlier=None, where=(out, ck), only=None, n=4):
        stream = live.file_stream(spark, source, spark.createDataFrame([], SHAPE).schema)
        closed = live.windowed_alerts(stream, 5.0, anchor, lateness="0 seconds")
        table = keyed.newest_windows(closed, n, only, earlier)
        keyed.write_state(table, *where)
        return [tuple(r) for r in keyed.read_state(spark, where[0], table.schema).orderBy("rn").select(
            "rn", F.col("window_start").cast("timestamp_ntz"), "n_events", "accuracy", "alert_raised").collect()]

    def batch(rows, n=4, only="true"):
        df = windows.windowed(spark.createDataFrame(rows, SHAPE), "start_time", 5.0)
        closed = windows.with_alerts(windows.window_counts(df)).filter(F.col("window_end") <= F.lit(max(r[1] for r in rows)))
        best = windows.newest(closed.filter(only), n).orderBy(F.desc("window_start")).collect()
        return [(i, r["window_start"], r["n_events"], r["accuracy"], r["alert_raised"]) for i, r in enumerate(best, start=1)]

    _feed(spark, given, source)
    assert run() == batch(given)
    _feed(spark, rows[200:], source)
    assert run() == batch(rows)
    assert run(where=(alarms, ck2), only="alert_raised", n=2) == batch(rows, 2, "alert_raised")


def test_history_starts_with_earlier_windows(spark, tmp_path):
    source, out, ck = (str(tmp_path / p) for p in ("in", "out", "ck"))
    rows = _events(spark)
    _feed(spark, rows, source)
    stream = live.file_stream(spark, source, spark.createDataFrame([], SHAPE).schema)
    closed = live.windowed_alerts(stream, 5.0, 0, lateness="0 seconds")
    old = spark.createDataFrame(rows, SHAPE).withColumn("start_time", F.col("start_time").cast("timestamp") - F.expr("INTERVAL 1 HOUR"))
    earlier = windows.with_alerts(windows.window_counts(
        windows.windowed(old, "start_time", 5.0, 0))).select(closed.columns)
    keyed.write_state(keyed.newest_windows(closed, 12, earlier=earlier), out, ck)
    starts = [r[0] for r in keyed.read_state(spark, out, T.StructType([*closed.schema, T.StructField("rn", T.IntegerType())])).orderBy("rn").select("window_start").collect()]
    assert len(starts) == 12 and starts == sorted(starts, reverse=True)
    assert (starts[0] - starts[-1]).total_seconds() > 3500     # the earlier run fills the places left


def test_traffic_stream_equals_batch(spark, tmp_path):
    rows = [(*r, 100 + r[0], r[0] % 13) for r in _events(spark)]
    shape = SHAPE + ", packet_speed bigint, avg_packet_len int"
    source, out, ck = (str(tmp_path / p) for p in ("in", "out", "ck"))
    df = spark.createDataFrame(rows, shape).drop("rate").withColumn("port", F.coalesce("port", F.lit(9)))
    anchor = windows.first_instant(df, "start_time")

    def run(part):
        part.repartition(2).write.mode("append").parquet(source)
        table = live.windowed_traffic(live.file_stream(spark, source, df.schema), 5.0, anchor, lateness="1 second")
        live.write_batches(table, out, ck)
        return {(r["window_start"] - T0).total_seconds(): (round(r["avg_pkt_rate"], 6), r["peak_pkt_rate"], round(r["avg_data_rate"], 6),
                [tuple(p) for p in r["top_ports"]]) for r in spark.read.parquet(out).collect()}

    whole = windows.window_traffic(windows.windowed(df, "start_time", 5.0, anchor)).collect()
    want = {(r["window_start"] - T0).total_seconds(): (round(r["avg_pkt_rate"], 6), r["peak_pkt_rate"], round(r["avg_data_rate"], 6),
            [tuple(p) for p in r["top_ports"]]) for r in whole}
    middle = F.lit(T0 + dt.timedelta(seconds=18)).cast("timestamp_ntz")
    first = run(df.filter(F.col("start_time") < middle))
    assert set(first) == {0.0, 5.0, 10.0} and all(want[k] == v for k, v in first.items())
    late = df.limit(1)                                  # lies in a closed window: dropped
    end = df.limit(1).withColumn("start_time", F.lit(T0 + dt.timedelta(seconds=300)).cast("timestamp_ntz"))
    run(df.filter(F.col("start_time") >= middle).unionByName(late))
    got = run(end)
    assert got == want
