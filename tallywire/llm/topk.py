"""Exact top-k search by inner product: tiles, partial selection, tree merge.

Queries and candidates are dealt into tiles; each pair of tiles is one matrix product of bounded
size, from which at most k candidates per query survive, and lists are merged
in rounds of ``FAN`` until each query has one. Every query meets every candidate, in blocks.

Components are scaled to floor(1024 * x), so scores are exact integers and ties are real; they
go to the smaller id. Vectors that are NULL, hold NULL or a component that is not finite,
or have a NULL id take no part. Vectors of different lengths are not compared. Of rows that repeat an id the
smallest vector counts. A score beyond 64 bits is reported as the nearest 64-bit
number, ranked by its exact value inside a tile. A table without queries gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

SCALE = 1024
QUERY_TILE = 1024
SHARD_TILE = 8192
FAN = 8
_EXACT = float(1 << 53)
_LISTS = "query_id bigint, shard int, vec_id bigint, score bigint"


def top_k(
    vectors: DataFrame, is_query: Column, k: int, id_column: str = "vec_id", vector_column: str = "embedding",
    query_tile: int = QUERY_TILE, shard_tile: int = SHARD_TILE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates with the highest scores for each query row."""
    value = F.col(vector_column).cast("array<double>")
    usable = F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.filter(F.coalesce(usable, F.lit(False))).select(
        F.col(id_column).cast("bigint").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"), value.alias("v"))
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards, tiles = max(1, -(-n // shard_tile)), max(1, -(-asked // query_tile))
    spot = lambda seed, parts: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(parts)).cast("int")
    candidates = rows.select(spot(1, shards).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"),
                             F.col("id").alias("cid"), F.col("v").alias("cv"))
    queries = rows.filter("asks").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), spot(2, tiles).alias("tile"),
        F.col("id").alias("qid"), F.col("v").alias("qv"))

    def product(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_pandas(_product(key[0].as_py(), left, right, k), pa.schema(
            [("query_id", pa.int64()), ("shard", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())]), preserve_index=False)

    lists = queries.groupBy("shard", "tile").cogroup(candidates.groupBy("shard", "tile")).applyInArrow(product, _LISTS)
    best = lambda by: Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    while shards > FAN:
        shards = -(-shards // FAN)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / FAN).cast("int"))
        lists = lists.withColumn("r", F.row_number().over(best(["query_id", "shard"]))).filter(F.col("r") <= k).drop("r")
    return lists.withColumn("rank", F.row_number().over(best(["query_id"]))).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def _columns(table: pa.Table, id_column: str, vector_column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of each vector length; scaled, sorted by id, each id once."""
    vectors = table.column(vector_column).combine_chunks()
    ids, lengths = table.column(id_column).to_numpy(), np.diff(vectors.offsets.to_numpy())
    flat, begins = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()[:-1]
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        matrix = np.floor(SCALE * flat[begins[at][:, None] + np.arange(length)])
        order = np.lexsort([*matrix.T[::-1], ids[at]])
        once = order[np.concatenate([[True], np.diff(ids[at][order]) != 0])]
        yield ids[at][once], matrix[once]


def _product(shard: int, left: pa.Table, right: pa.Table, k: int) -> pd.DataFrame:
    found = [pd.DataFrame({"query_id": [], "shard": [], "vec_id": [], "score": []}, dtype=np.int64)]
    if left.num_rows and right.num_rows:
        candidates = {m.shape[1]: (ids, m) for ids, m in _columns(right, "cid", "cv")}
        for qids, q in _columns(left, "qid", "qv"):
            if q.shape[1] in candidates:
                found.append(_select(shard, qids, q, *candidates[q.shape[1]], k))
    return pd.concat(found).astype({"query_id": np.int64, "shard": np.int32, "vec_id": np.int64, "score": np.int64})


def _select(shard, qids, q, cids, c, k) -> pd.DataFrame:
    limit = (np.abs(q).max(initial=0.0) * np.abs(c).max(initial=0.0)) * max(1, q.shape[1])
    if limit < _EXACT:  # every partial sum is a whole number that a double holds
        scores = (q @ c.T).astype(np.int64)
    else:
        whole = lambda m: np.array([[int(x) for x in row] for row in m.tolist()], object).reshape(m.shape)
        scores = whole(q) @ whole(c).T
    out = []
    exact = scores.dtype == np.int64
    for i, qid in enumerate(qids.tolist()):
        row, ids = scores[i], cids
        at = np.searchsorted(cids, qid)
        if at < len(cids) and cids[at] == qid:
            row, ids = np.delete(row, at), np.delete(cids, at)
        if exact and len(row) > k:
            bar = np.partition(row, len(row) - k)[len(row) - k]
            some = np.flatnonzero(row >= bar)
            row, ids = row[some], ids[some]
        order = np.lexsort([ids, -row])[:k] if exact else sorted(range(len(row)), key=lambda j: (-row[j], ids[j]))[:k]
        low, high = -(1 << 63), (1 << 63) - 1
        out += [(qid, shard, int(ids[j]), min(max(int(row[j]), low), high)) for j in order]
    return pd.DataFrame(out, columns=["query_id", "shard", "vec_id", "score"])
