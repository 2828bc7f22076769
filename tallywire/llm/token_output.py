"""Packed token-id matrices.

Each task packs the documents it reads, a bounded buffer of tokens at a time: best-fit decreasing, with
a segment tree over the room left in open sequences that finds the fullest one a piece still
fits. A document longer than a sequence is cut into whole sequences and a rest, so no token is lost. No shuffle is needed.

A row of the result is a row of the matrix: ids padded to the sequence length, the cumulative lengths of
its segments, and positions that start anew at every segment. Nulls and empty texts consist of the end id alone; repeated
rows are packed each time; extra columns are left out; an empty table gives no sequences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallywire.llm.common import slices, strings
from tallywire.llm.units import encoder

LENGTH = 2048
BUFFER_TOKENS = 1 << 20


class RoomTree:
    """Counts of open sequences by room left, as a segment tree: the smallest room of at least n in O(log length)."""

    def __init__(self, largest: int):
        self._leaves = 1 << largest.bit_length()
        self._sums = [0] * (2 * self._leaves)

    def add(self, room: int, change: int) -> None:
        at = self._leaves + room
        while at:
            self._sums[at] += change
            at >>= 1

    def smallest(self, least: int) -> int | None:
        at = self._leaves + least
        while not self._sums[at]:
            while at & 1:  # a right child: what lies beyond it hangs on an ancestor
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self._leaves:
            at = 2 * at if self._sums[2 * at] else 2 * at + 1
        return at - self._leaves


def best_fit_rows(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indices of the pieces of each sequence; longest first, each into the fullest sequence that takes it."""
    tree, open_rows, rows = RoomTree(capacity), [[] for _ in range(capacity + 1)], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        room = tree.smallest(lengths[i])
        if room is None:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row = open_rows[room].pop()
            tree.add(room, -1)
        rows[row].append(i)
        room -= lengths[i]
        if room:
            open_rows[room].append(row)
            tree.add(room, 1)
    return rows


def packed_matrix(
    docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text",
    buffer_tokens: int = BUFFER_TOKENS,
) -> DataFrame:
    """One row per sequence: sequence_id, n_tokens, ids, position_ids, cu_seqlens, doc_ids and doc_starts.

    ids and position_ids are ``length`` little-endian unsigned 16-bit numbers, padded with the end id and position 0
    behind n_tokens; segment j is ids[cu_seqlens[j]:cu_seqlens[j + 1]], the tokens of doc_ids[j] from doc_starts[j] on.
    An id beyond 16 bits is an error.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count = TaskContext.get().partitionId() << 40, 0
        waiting, tokens = [], 0
        for part in slices(batches, "text"):
            enc = encoder(tokenizer)
            for doc, ids in zip(part.column("id").to_pylist(), enc.encode(strings(part, "text"))):
                ids = np.frombuffer(ids + end, "<u4")
                if ids.max() > 0xFFFF:
                    raise ValueError("an id does not fit into 16 bits")
                ids = ids.astype("<u2")
                waiting += [(doc, at, ids[at:at + length]) for at in range(0, len(ids), length)]
                tokens += len(ids)
            if tokens >= buffer_tokens:
                out = _rows(waiting, length, end_id, base + count)
                count += out.num_rows
                yield out
                waiting, tokens = [], 0
        if waiting:
            yield _rows(waiting, length, end_id, base + count)

    return rows.mapInArrow(run, "sequence_id bigint, n_tokens int, ids binary, position_ids binary, "
                                "cu_seqlens array<int>, doc_ids array<bigint>, doc_starts array<int>")


def _rows(pieces: list[tuple], length: int, end_id: int, first: int) -> pa.RecordBatch:
    packed = best_fit_rows([len(p[2]) for p in pieces], length)
    steps = np.arange(length, dtype="<u2")
    ids, positions, bounds = [], [], []
    for row in packed:
        sizes = [len(pieces[i][2]) for i in row]
        line, place = np.full(length, end_id, "<u2"), np.zeros(length, "<u2")
        line[:sum(sizes)] = np.concatenate([pieces[i][2] for i in row])
        place[:sum(sizes)] = np.concatenate([steps[:n] for n in sizes])
        ids.append(line.tobytes())
        positions.append(place.tobytes())
        bounds.append(np.cumsum([0, *sizes]).tolist())
    return pa.RecordBatch.from_arrays([
        pa.array(np.arange(first, first + len(packed))), pa.array([b[-1] for b in bounds], pa.int32()),
        pa.array(ids, pa.binary()), pa.array(positions, pa.binary()), pa.array(bounds, pa.list_(pa.int32())),
        pa.array([[pieces[i][0] for i in row] for row in packed], pa.list_(pa.int64())),
        pa.array([[pieces[i][1] for i in row] for row in packed], pa.list_(pa.int32())),
    ], names=["sequence_id", "n_tokens", "ids", "position_ids", "cu_seqlens", "doc_ids", "doc_starts"])


def unpack(packed: DataFrame) -> DataFrame:
    """(doc_id, start, ids): the segments of all sequences again; ids are binary as in the matrix."""
    j = F.col("at").cast("int")
    begin = F.get("cu_seqlens", j)
    return packed.select("ids", "cu_seqlens", "doc_ids", "doc_starts", F.explode(F.sequence(F.lit(0), F.size("doc_ids") - 1)).alias("at")) \
        .select(F.get("doc_ids", j).alias("doc_id"), F.get("doc_starts", j).alias("start"),
                F.expr("substring(ids, 2 * cu_seqlens[at] + 1, 2 * (cu_seqlens[at + 1] - cu_seqlens[at]))").alias("ids"),
                begin.alias("begin"))
