"""Shards of nearly equal size by sampled splitters.

A size-weighted sample of the keys gives quantile boundaries; records are dealt to
the ranges between them, and ranges that turn out too full are cut again by samples of
their own. The ranges' exact totals then place every record on one scale of bytes, on which shards are equal pieces.
Only (key, id, size) is shuffled, never the text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from tallywire.session import materialize

RANGES = 128
RANGE_ROWS = 500_000
_ROUNDS = 8


def shard_by_size(
    docs: DataFrame, shards: int, key: Column, tie: Column, size: Column, columns: dict[str, Column] | None = None,
    sample: int | None = None, ranges: int | None = None,
) -> DataFrame:
    """Range-partition by (key, tie) into ``shards`` pieces whose summed sizes differ by about one record.

    ``key`` and ``tie`` are bigint; NULL counts as the smallest. The first round makes ``ranges`` ranges (by default one for each
    ``RANGE_ROWS`` rows, ``RANGES`` at least) from a sample of ``sample`` rows (32 a range), and each of at most ``_ROUNDS`` more rounds cuts those
    that hold over twice their due. Rows that are equal in both are kept in any order. Returns ``columns`` with range, shard, slot (0, 1, ... within a shard) and the
    bytes before the record. An empty table gives an empty result.
    """
    columns = columns or {}
    rows = materialize(docs.select(
        *[c.alias(n) for n, c in columns.items()], F.coalesce(key, F.lit(-2**63)).alias("_key"),
        F.coalesce(tie, F.lit(-2**63)).alias("_tie"), size.cast("bigint").alias("_size"),
    ))
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("_size"), F.lit(0))).first()
    total = total or 1
    ranges = ranges or max(RANGES, -(-n // RANGE_ROWS))
    due = total / ranges
    splitters = _splitters(rows, total, ranges, sample or 32 * ranges)
    placed, stats = _measured(rows, splitters)
    for _ in range(_ROUNDS):
        more = set()
        for r, (held, size) in stats.items():
            if size > 2 * due and held > 1:
                pieces = int(np.ceil(size / due))
                more.update(_splitters(placed.filter(F.col("range") == r), size, pieces, 32 * pieces))
        if more <= set(splitters):
            break  # nothing is overfull but records that no boundary can part
        splitters = sorted(more | set(splitters))
        placed, stats = _measured(rows, splitters)

    order = sorted(stats)
    before_bytes = dict(zip(order, np.cumsum([0] + [stats[r][1] for r in order])[:-1].tolist()))
    before_rows = dict(zip(order, np.cumsum([0] + [stats[r][0] for r in order])[:-1].tolist()))
    by = Window.partitionBy("range").orderBy("_key", "_tie")
    earlier = by.rowsBetween(Window.unboundedPreceding, -1)
    offsets = docs.sparkSession.createDataFrame(
        [(int(r), int(before_bytes[r]), int(before_rows[r])) for r in order] or [(0, 0, 0)],
        "range int, _b bigint, _r bigint")
    spread = placed.join(F.broadcast(offsets), "range").select(  # a row per range, at most ranges x rounds
        *columns, "range", "_size",
        (F.col("_b") + F.coalesce(F.sum("_size").over(earlier), F.lit(0))).alias("bytes_before"),
        (F.col("_r") + F.row_number().over(by) - 1).cast("bigint").alias("_at"),
    )
    middle = F.col("bytes_before") + F.floor(F.col("_size") / 2)
    sharded = materialize(spread.withColumn("shard", F.least(
        F.floor(middle.cast("decimal(38,0)") * shards / F.lit(total)), F.lit(shards - 1)).cast("int")))
    starts = sharded.groupBy("shard").agg(F.min("_at").alias("_first"))  # a row per shard
    return sharded.join(F.broadcast(starts), "shard").select(
        *columns, "range", "shard", (F.col("_at") - F.col("_first")).alias("slot"), "bytes_before")


def _measured(rows: DataFrame, splitters: list[tuple[int, int]]) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """Rows with their range, and the exact rows and size of each range."""
    placed = rows.withColumn("range", _place(splitters)("_key", "_tie"))
    totals = placed.groupBy("range").agg(F.count("*").alias("n"), F.sum("_size").alias("size"))
    return placed, {r["range"]: (r["n"], r["size"]) for r in totals.collect()}


def _splitters(rows: DataFrame, total: int, pieces: int, sample: int) -> list[tuple[int, int]]:
    """Boundaries at the quantiles of a sample in which a record's chance follows its size.

    The draw is a hash of the record, so it repeats; about ``sample`` records, and never over four times as many, reach the driver.
    """
    weight = F.col("_size") * F.lit(sample / total)
    draw = F.shiftrightunsigned(F.xxhash64("_key", "_tie", F.lit(17)), 11) / F.lit(float(1 << 53))
    drawn = rows.filter(draw < weight).select("_key", "_tie", F.greatest(weight, F.lit(1.0)).alias("w"))
    got = drawn.limit(4 * sample).toPandas().sort_values(["_key", "_tie"])
    if got.empty:
        return []
    share = got["w"].cumsum() / got["w"].sum()
    at = np.searchsorted(share.to_numpy(), np.arange(1, pieces) / pieces)
    at = np.unique(np.minimum(at, len(got) - 1))
    return sorted({(int(k), int(t)) for k, t in got[["_key", "_tie"]].to_numpy()[at]})


def _place(splitters: list[tuple[int, int]]):
    keys, ties = (np.array([s[i] for s in splitters], np.int64) for i in range(2))

    @pandas_udf("int")
    def place(key: pd.Series, tie: pd.Series) -> pd.Series:
        k, t = key.to_numpy(np.int64), tie.to_numpy(np.int64)
        low, high = np.searchsorted(keys, k, side="left"), np.searchsorted(keys, k, side="right")
        for i in np.flatnonzero(high > low):  # the key itself is a boundary, so the tie decides
            low[i] += np.searchsorted(ties[low[i]:high[i]], t[i], side="right")
        return pd.Series(low.astype(np.int32))

    return place
