"""Streams with state of their own: the last events of each window, the newest windows of a run.

The state of a key is a list of at most n rows. Every batch is cut to n rows per key inside each input partition first,
so a window that holds a third of all rows sends n rows a task through the shuffle, not its rows. Timers drop a window's
list when the watermark passes its end. Rows travel as (time, id, JSON of the row).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tallywire.functions.expressions import micros
from tallywire.streaming.live import TIME_FORMAT, write_batches
from tallywire.streaming.windows import window_of

_ORDER = ["at_us", "id"]
_ROW = "at_us bigint, id bigint, row string"
#: Rows that a task holds before it hands them on.
HELD = 100_000
_JSON = {"timestampFormat": TIME_FORMAT, "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def _newest(rows: pd.DataFrame, n: int) -> pd.DataFrame:
    return rows.sort_values(_ORDER, ascending=False, kind="stable").groupby("key", sort=False).head(n)


def _cut(rows: DataFrame, n: int) -> DataFrame:
    """The n newest rows of each key in every partition."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = _newest(batch if held is None else pd.concat([held, batch]), n)
            if len(held) > HELD:
                yield held
                held = None
        if held is not None:
            yield held

    return rows.mapInPandas(run, rows.schema)


class Newest(StatefulProcessor):
    """Keeps the n newest rows of a key and gives them, newest first, whenever some arrive.

    With ``timed`` a key ends at its ``ends_ms``: rows that come when the watermark is there are dropped, and the
    timer clears what was kept.
    """

    def __init__(self, n: int, timed: bool) -> None:
        self.n, self.timed = n, timed

    def init(self, handle) -> None:
        self._handle = handle
        self._rows = handle.getListState("rows", _ROW)

    def _keep(self, rows: pd.DataFrame) -> pd.DataFrame:
        held = pd.DataFrame(list(self._rows.get()), columns=[*_ORDER, "row"]) if self._rows.exists() else rows[:0]
        out = pd.concat([held, rows[[*_ORDER, "row"]]]).sort_values(_ORDER, ascending=False, kind="stable").head(self.n)
        self._rows.put([(int(t), int(i), r) for t, i, r in out[[*_ORDER, "row"]].itertuples(index=False)])
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out = None
        for batch in rows:
            if self.timed:
                ends = int(batch["ends_ms"].iloc[0])
                if ends <= timerValues.getCurrentWatermarkInMs():
                    continue
                if out is None:
                    self._handle.registerTimer(ends)
            out = self._keep(batch)
        if out is not None:
            yield pd.DataFrame({"key": key[0], "rn": range(1, len(out) + 1), "row": out["row"].to_list()})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._rows.clear()
        return iter(())

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._keep(initialState)

    def close(self) -> None:
        pass


def _rows(df: DataFrame, key: Column, time: str, tie: str, ends_ms: Column) -> DataFrame:
    """(key, ends_ms, at_us, id, row); rows without key, time or id have no place and are left out."""
    shown = df.select(
        key.cast("bigint").alias("key"), ends_ms.cast("bigint").alias("ends_ms"), micros(time).alias("at_us"),
        F.col(tie).cast("bigint").alias("id"), F.to_json(F.struct(*df.columns), _JSON).alias("row"))
    return shown.filter("key IS NOT NULL AND at_us IS NOT NULL AND id IS NOT NULL")


def _opened(found: DataFrame, shape: T.StructType, rank: str) -> DataFrame:
    own = {f.name: f for f in shape.fields}
    return found.select("key", F.col("rn").alias(rank), F.from_json("row", shape, _JSON).alias("r")).select(
        "key", rank, *[F.col("r")[c].alias(c) for c in own])


def last_events(
    events: DataFrame, seconds: float, anchor_us: int = 0, n: int = 8, lateness: str = "10 minutes",
    time: str = "start_time", tie: str = "attack_id",
) -> DataFrame:
    """The last n events of each window as a stream: (key: start of the window in microseconds, rn, the event).

    Whenever events of a window arrive its whole list is given again, so the newest batch of a key is its state.
    Events of windows that the watermark has passed are dropped; NULL times and ids are left out.
    """
    window = window_of(time, seconds, anchor_us)
    rows = _rows(events.withColumn("_w", window), F.unix_micros("_w.start"), time, tie, F.ceil(F.unix_micros("_w.end") / 1000))
    # The cut keeps the latest time of every partition, so the watermark is that of all events.
    cut = _cut(rows, n).withColumn("at", F.timestamp_micros("at_us")).withWatermark("at", lateness)
    found = cut.groupBy("key").transformWithStateInPandas(
        Newest(n, timed=True), "key bigint, rn int, row string", "append", "EventTime")
    return _opened(found, events.schema, "rn")


def newest_windows(windows: DataFrame, n: int = 60, only: str | None = None, earlier: DataFrame | None = None) -> DataFrame:
    """The n newest of the windows that arrive (those that hold ``only``, a SQL condition), with rank 1 for the newest.

    ``earlier`` are windows of a run before, with the same columns: they are the state that the stream starts with.
    """
    def shown(df: DataFrame) -> DataFrame:
        some = df.filter(only) if only else df
        return _cut(_rows(some, F.lit(0), "window_start", "_id", F.lit(0)), n)

    named = windows.withColumn("_id", F.lit(0))
    first = None if earlier is None else shown(earlier.withColumn("_id", F.lit(0))).drop("ends_ms").groupBy("key")
    found = shown(named).groupBy("key").transformWithStateInPandas(
        Newest(n, timed=False), "key bigint, rn int, row string", "append", "None", initialState=first)
    return _opened(found, windows.schema, "rn").drop("key")


@contextmanager
def _keyed_state(spark: SparkSession) -> Iterator[None]:
    """Lists and timers need the state store that is kept on disk."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_state(table: DataFrame, path: str, checkpoint: str) -> None:
    """Write what every batch gives to a folder of its own; a repeated batch replaces only itself."""
    with _keyed_state(table.sparkSession):
        write_batches(table, path, checkpoint)


def read_state(spark: SparkSession, path: str, shape: T.StructType, keys: list[str] | None = None) -> DataFrame:
    """The rows of the newest batch of each key, or of all rows without ``keys``."""
    every = spark.read.schema(shape.add("batch", "long") if "batch" not in shape.names else shape).parquet(path)
    last = every.groupBy(*(keys or [])).agg(F.max("batch").alias("batch"))
    return every.join(last, [*(keys or []), "batch"]).drop("batch")
