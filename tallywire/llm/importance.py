"""Importance resampling of documents towards a target distribution of hashed features.

Features are runs of consecutive words, hashed by CRC-32 into ``BUCKETS`` counters. One pass over the documents and
one over the target texts count the buckets; a bucket's gain is the floored log ratio of its smoothed shares, a
document's weight the floored mean gain of its features. The draw takes the highest sums of weight and a
Gumbel noise fixed by the id, which is sampling without replacement with chances in proportion to exp(weight/1000).

The hashes are computed in matrices: the distinct feature bytes of a slice are grouped by length into two-dimensional
arrays of bytes, all checksums of a matrix are updated column by column, and the buckets are scattered
back to the features.

NULL and empty texts have no features: weight 0, and never drawn, as they have too few words. A NULL id reads as the
empty text in the noise. Rows are judged one by one, so repeated rows are drawn one by one; among equal scores and
ids fewer features come first, then the smaller weight, and rows equal in all of these are interchangeable. Empty tables give empty
results, an empty target gives gains that favour rare features. Other columns of the documents are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallywire.functions.ranking import ordered
from tallywire.llm.common import slices, utf8
from tallywire.session import materialize

BUCKETS = 10_000
MAX_RUN = 1
MIN_WORDS = 20
SEED = 2024
#: Rows that one task may rank; more are ranked in ranges.
RANK_ROWS = 200_000
_SLICE = 1 << 20


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased byte (A to Z alone), and whether it then belongs to a word: 0 to 9, a to z, all beyond ASCII."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    inside = np.zeros(256, bool)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        inside[low:high + 1] = True
    return lower, inside[lower]


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_LOWER, _INSIDE = _byte_classes()
_CRC = _crc_table()


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, row) of every word; words end where their row ends."""
    flag = _INSIDE[data]
    if not len(flag):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = offsets[(offsets > 0) & (offsets < len(flag))]
    before = np.concatenate([[False], flag[:-1]])
    before[edges] = False
    after = np.concatenate([flag[1:], [False]])
    after[edges - 1] = False
    begins = np.flatnonzero(flag & ~before)
    return begins, np.flatnonzero(flag & ~after) + 1, np.searchsorted(offsets, begins, side="right") - 1


def features(batch: pa.RecordBatch, column: str, max_run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, begin, length, row of every feature, words of every row): runs of 1 to ``max_run`` words joined by a space."""
    data, offsets = utf8(batch.column(column))
    data = _LOWER[data]
    begins, ends, rows = words(data, offsets)
    n_words = np.bincount(rows, minlength=batch.num_rows)
    if max_run == 1:
        return data, begins, ends - begins, rows, n_words
    sizes = ends - begins + 1
    places = np.concatenate([[0], np.cumsum(sizes)])
    joined = np.full(int(places[-1]), 0x20, np.uint8)
    inner = np.arange(len(joined)) - np.repeat(places[:-1], sizes)
    letters = inner < np.repeat(sizes - 1, sizes)
    joined[letters] = data[(np.repeat(begins, sizes) + inner)[letters]]
    first, length, owner = [], [], []
    for run in range(1, max_run + 1):
        count = max(0, len(rows) - run + 1)
        whole = np.flatnonzero(rows[:count] == rows[run - 1:run - 1 + count])
        first.append(places[whole])
        length.append(places[whole + run] - 1 - places[whole])
        owner.append(rows[whole])
    return joined, np.concatenate(first), np.concatenate(length), np.concatenate(owner), n_words


def crc_buckets(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of each feature ``data[begin : begin + length]``; no feature holds a zero byte."""
    out = np.zeros(len(begins), np.int64)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for at in np.split(order, cuts) if len(order) else []:
        length = int(lengths[at[0]])
        matrix = data[begins[at][:, None] + np.arange(length)]
        _, first, back = np.unique(_keys(matrix), return_index=True, return_inverse=True)
        distinct = np.ascontiguousarray(matrix[first].T)
        crc = np.full(len(first), 0xFFFFFFFF, np.uint32)
        for column in distinct:
            crc = _CRC[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
        out[at] = ((crc ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets))[back]
    return out


def _keys(matrix: np.ndarray) -> np.ndarray:
    """One sortable value per row: a number up to eight bytes, the bytes themselves beyond."""
    if matrix.shape[1] > 8:
        return matrix.view(f"S{matrix.shape[1]}")[:, 0]
    key = np.zeros(len(matrix), np.uint64)
    for column in matrix.T:
        key = (key << np.uint64(8)) | column
    return key


def bucket_counts(texts: DataFrame, text_column: str, max_run: int = MAX_RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts; a task hands on its counters, and one row per bucket is collected."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, "text", _SLICE):
            data, begins, lengths, _, _ = features(part, "text", max_run)
            total += np.bincount(crc_buckets(data, begins, lengths, buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    rows = texts.select(F.col(text_column).alias("text")).mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    table, counts = rows.toPandas(), np.zeros(buckets, np.int64)
    counts[table["bucket"].to_numpy(np.int64)] = table["n"]
    return counts


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket in thousandths of a nat, rounded down."""
    ratio = (target + 1.0) * (float(raw.sum()) + len(raw)) / ((raw + 1.0) * (float(target.sum()) + len(raw)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, id_column: str, text_column: str, max_run: int = MAX_RUN) -> DataFrame:
    """(id, n_words, n_features, weight) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", _SLICE):
            data, begins, lengths, rows, n_words = features(part, "text", max_run)
            found = gains[crc_buckets(data, begins, lengths, len(gains))]
            n = np.bincount(rows, minlength=part.num_rows)
            total = np.zeros(part.num_rows, np.int64)
            np.add.at(total, rows, found)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n_words), pa.array(n), pa.array(np.floor_divide(total, np.maximum(n, 1)))],
                names=["id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(id_column: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from the first 32 bits of SHA-256 over seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 32))
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("bigint")


def drawn(
    docs: DataFrame, target: DataFrame, percent: int, id_column: str = "doc_id", text_column: str = "text",
    target_column: str = "text", min_words: int = MIN_WORDS, max_run: int = MAX_RUN, buckets: int = BUCKETS, seed: int = SEED,
    rank_rows: int = RANK_ROWS,
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document; rank is NULL where it is not drawn.

    Of the documents of at least ``min_words`` words, ``percent`` of a hundred are drawn, rounded down.
    """
    gains = bucket_gains(bucket_counts(docs, text_column, max_run, buckets), bucket_counts(target, target_column, max_run, buckets))
    rows = weighed(docs, gains, id_column, text_column, max_run)
    rows = materialize(rows.withColumn("score", F.col("weight") + noise(F.col("id"), seed)))
    able, fit = F.col("n_words") >= min_words, rows.filter(F.col("n_words") >= min_words)
    take = math.floor(percent * fit.count() / 100) if isinstance(percent, float) else percent * fit.count() // 100
    order = [F.desc("score"), F.asc_nulls_last("id"), F.col("n_features"), F.col("weight")]
    ranked = ordered(fit, [], order, "rank", limit=rank_rows)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))
    return ranked.unionByName(rows.filter(~able).withColumn("rank", F.lit(None).cast("bigint")))


def resampled(docs: DataFrame, target: DataFrame, percent: int, id_column: str = "doc_id", **settings) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; of an id that repeats, all rows as soon as one is drawn."""
    ids = drawn(docs, target, percent, id_column, **settings).filter("rank IS NOT NULL").select(F.col("id").alias("_drawn_id")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("_own_id"))
    return rows.join(ids, F.col("_own_id").eqNullSafe(F.col("_drawn_id")), "left_semi").select("row.*")
