"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywire.session import materialize, scratch_root

SLICE_BYTES = 4 << 20


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release() -> None:
    """Give freed memory back to the system. Workers live on between tasks and stages, so what they keep adds up."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each slice holds about ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    release()


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column as Python strings; NULL becomes the empty string."""
    return [x or "" for x in batch.column(column).to_pylist()]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def link_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: bigint) -> (node, component): every node that has a link, with the smallest node it reaches.

    Alternates large-star and small-star steps until the links are stars. Each step is
    a map-side combined minimum and a join; a round's links replace those before it in
    the checkpoint folder, so a lost executor costs one round.
    """
    links = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = _mark(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        links_new = (
            large.join(small, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(small.select("a", F.col("m").alias("b"))).distinct()
        )
        links = materialize(links_new)
        after = _mark(links)
        if after == mark:
            break
        mark = after
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("bigint"))).first())


def scratch_table(spark: SparkSession, name: str) -> str:
    """A table name nobody else uses."""
    scratch_root(spark)
    return f"tallywire_{name}_{uuid.uuid4().hex}"


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of each row in them; NULL is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]
