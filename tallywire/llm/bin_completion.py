"""Best-fit packing of a whole corpus into as few sequences as possible.

Only lengths matter to the packing, and there are at most ``capacity`` of them, so the problem is
solved on the histogram of lengths: how often each filling of a sequence is used. Best-fit decreasing gives the
first incumbent; if it is above the lower bound, bin completion looks for a better one, first among the sequences with room: around
the largest document left, undominated fillings are tried in order of waste, each as often as
the histogram allows, and a branch ends when its waste exceeds what a better packing may have.
Fillings are listed lazily, so none is passed over; the search ends after ``nodes`` of them and then keeps the incumbent, which packs everything.

A plan has at most a few fillings per length, whatever the size of the corpus, so it is the only
thing that reaches the driver. Documents are matched with its places by their number among those of equal length, counted
in salted groups, so that one length may hold most rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallywire.llm.common import slices, strings
from tallywire.llm.units import encoder
from tallywire.session import materialize

CAPACITY = 4096
NODES = 20_000
#: Best fit is tried at every node with fewer lengths, at every second one with twice as many, and so on.
_BEST_FIT_LENGTHS = 64
_SALT_ROWS = 200_000

Filling = tuple[tuple[int, int], ...]  # (length, how many), longest first


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(id, piece, start, length, ids, ids_crc32): each document's ids and the end id, cut only where longer than ``capacity``.

    NULL and empty texts have the end id alone. ``ids`` are little-endian unsigned 32-bit numbers. Repeated rows have pieces of their own.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows, piece, blob = [], [], []
            for row, ids in enumerate(encoder(tokenizer).encode(strings(part, "text"))):
                ids += end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    rows.append(row)
                    piece.append(n)
                    blob.append(ids[at:at + 4 * capacity])
            yield pa.RecordBatch.from_arrays([
                part.column("id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                pa.array([capacity * p for p in piece], pa.int64()), pa.array([len(b) // 4 for b in blob], pa.int64()),
                pa.array(blob, pa.binary()), pa.array([zlib.crc32(b) for b in blob], pa.int64()),
            ], names=["id", "piece", "start", "length", "ids", "ids_crc32"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, piece int, start bigint, length bigint, ids binary, ids_crc32 bigint") \
        .withColumnRenamed("id", id_column)


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` from 1 to ``capacity``.

    The rows are written to the checkpoint folder first, without any ids they carry. Equal rows are given different places.
    """
    own = [c for c in pieces.columns if c != "ids"]
    rows = materialize(pieces.select(own))
    counts = {int(r["length"]): r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(not 1 <= x <= capacity for x in counts):
        raise ValueError("lengths must be between 1 and the capacity")
    plan = solve(counts, capacity, nodes)
    key, first, offset = _places(plan)

    salts = max(1, -(-sum(counts.values()) // _SALT_ROWS))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*own), F.lit(salts)))
    groups = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*own))
    ranked = salted.withColumn("_rank", inside).join(starts, ["length", "_salt"]) \
        .select(*own, (F.col("_before") + F.col("_rank") - 1).alias("_rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wanted = (b.column("length").to_numpy().astype(np.int64) << 44) + b.column("_rank").to_numpy()
            at = np.searchsorted(key, wanted, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in own], pa.array(first[at] + wanted - key[at]), pa.array(offset[at])],
                names=[*own, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return ranked.mapInArrow(run, f"{kinds}, sequence_id bigint, offset bigint")


def _places(plan: list[tuple[Filling, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For runs of documents of one length: the key of the first, its sequence and the offset there."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for filling, times in plan:
        at = 0
        for length, copies in filling:
            for _ in range(copies):
                rows.append(((length << 44) + taken.get(length, 0), sequence, at))
                taken[length] = taken.get(length, 0) + times
                at += length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def solve(counts: dict[int, int], capacity: int, nodes: int = NODES) -> list[tuple[Filling, int]]:
    """Fillings and how often each is used; together they hold every document once.

    Sequences that best fit leaves with most room are emptied and searched first; where that finds nothing better, twice as many
    are emptied, up to all of them. The last search, over all documents, is exact unless the ``nodes`` end before it.
    """
    counts = {n: c for n, c in counts.items() if c}
    best = best_fit(counts, capacity)
    bound = lower_bound(counts, capacity)
    emptied = 0
    while sum(t for _, t in best) > bound and nodes > 0 and emptied < len(best):
        best.sort(key=lambda x: (-_spare(x[0], capacity), x))
        wasteful = sum(_spare(f, capacity) > 0 for f, _ in best)
        emptied = min(len(best), max(wasteful, 2 * emptied))
        part, kept = best[:emptied], best[emptied:]
        share = nodes if emptied == len(best) else nodes // 2
        found, tried = _complete(part, capacity, bound - sum(t for _, t in kept), share)
        nodes -= tried
        if found is not None:
            best, emptied = found + kept, 0
    return best


def _spare(filling: Filling, capacity: int) -> int:
    return capacity - sum(n * c for n, c in filling)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The best of the volume bounds that set aside what cannot share a sequence with pieces of k and more."""
    n = np.zeros(capacity + 1, np.int64)
    n[list(counts)] = list(counts.values())
    return _bound(n, capacity)


def _bound(n: np.ndarray, capacity: int) -> int:
    many, volume = np.cumsum(n), np.cumsum(n * np.arange(capacity + 1))
    half = capacity // 2
    k = np.arange(half + 1)
    alone = many[capacity] - many[capacity - k]
    wide = many[capacity - k] - many[half]
    free = wide * capacity - (volume[capacity - k] - volume[half])
    rest = volume[half] - volume[np.maximum(k - 1, 0)]
    return int((alone + wide + np.maximum(0, -((free - rest) // capacity))).max())


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing over runs of equal documents and equal sequences."""
    rooms: list[int] = []  # rooms left that occur, ascending
    groups: dict[int, list[list]] = {}  # room -> [filling, how many]

    def put(room: int, filling: Filling, times: int) -> None:
        if room not in groups:
            insort(rooms, room)
            groups[room] = []
        groups[room].append([filling, times])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                room, filling, times = capacity, (), left
            else:
                room = rooms[i]
                filling, times = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(i)
            each = room // length
            full = min(times, left // each)
            if full:
                put(room - each * length, (*filling, (length, each)), full)
                left -= full * each
            if left and full < times:
                rest = min(left, each)
                put(room - rest * length, (*filling, (length, rest)), 1)
                left -= rest
                full += 1
            if filling and full < times:
                put(room, filling, times - full)
    return [(f, t) for room in sorted(groups) for f, t in groups[room]]


def _complete(part: list[tuple[Filling, int]], capacity: int, bound: int, nodes: int) -> tuple[list | None, int]:
    """A packing of the documents in ``part`` with fewer sequences, or None; and how many fillings were looked at.

    Depth first: around the largest document left, undominated fillings in order of waste, each as often as it goes or once. A branch
    ends when its waste, or the bound on what is left, allows no better packing. What is left is also packed by best fit, which may better the incumbent.
    """
    left = np.zeros(capacity + 1, np.int64)
    for filling, times in part:
        for n, c in filling:
            left[n] += c * times
    total, most = int(left @ np.arange(capacity + 1)), sum(t for _, t in part)
    bound = max(bound, _bound(left, capacity))
    best, tried, used, waste = None, 0, 0, 0
    chosen: list[tuple[Filling, int, int]] = []

    def branches() -> Iterator:
        for filling in _fillings(left.copy(), capacity, lambda: (most - 1) * capacity - total - waste):
            if filling is None:
                yield None
                continue
            times = min(int(left[n]) // c for n, c in filling)
            for t in sorted({times, 1}, reverse=True):
                yield filling, t, t * _spare(filling, capacity)

    stack = [branches()]
    while stack and tried < nodes and most > bound:
        step = next(stack[-1], ())
        if step == ():
            stack.pop()
            if chosen:
                filling, times, spare = chosen.pop()
                used, waste = used - times, waste - spare
                for n, c in filling:
                    left[n] += c * times
            continue
        tried += 1
        if step is None or waste + step[2] > (most - 1) * capacity - total:
            continue
        filling, times, spare = step
        chosen.append(step)
        used, waste = used + times, waste + spare
        for n, c in filling:
            left[n] -= c * times
        lengths = np.flatnonzero(left).tolist()
        if not lengths or tried % (1 + len(lengths) // _BEST_FIT_LENGTHS) == 0:
            rest = best_fit({n: int(left[n]) for n in lengths}, capacity)
            if used + sum(t for _, t in rest) < most:
                best = [(f, t) for f, t, _ in chosen] + rest
                most = used + sum(t for _, t in rest)
        open_ = lengths and used + _bound(left, capacity) < most
        stack.append(branches() if open_ else iter(()))
    return best, tried


def _fillings(left: np.ndarray, capacity: int, allowed: Callable[[], int]) -> Iterator[Filling | None]:
    """Undominated fillings that hold the largest document, least waste first, up to the waste then allowed; None for each dominated one.

    A set of bits tells for each length which sums the shorter ones can make, so no dead end is entered and nothing is listed ahead.
    """
    largest = int(np.flatnonzero(left)[-1])
    room = capacity - largest
    left[largest] -= 1
    lengths = np.flatnonzero(left[:room + 1])[::-1].tolist()
    many = left[lengths].tolist()
    all_sums = (1 << (room + 1)) - 1
    sums = [1] * (len(lengths) + 1)  # what lengths[i:] can make
    for i in range(len(lengths) - 1, -1, -1):
        bits, n, more, step = sums[i + 1], lengths[i], min(many[i], room // lengths[i]), 1
        while more and bits != all_sums:
            step = min(step, more)
            bits = (bits | bits << (step * n)) & all_sums
            more, step = more - step, 2 * step
        sums[i] = bits

    def exact(i: int, wanted: int) -> Iterator[list[tuple[int, int]]]:
        if not wanted:
            yield []
            return
        for j in range(i, len(lengths)):
            if not sums[j] >> wanted & 1:
                return
            n = lengths[j]
            for c in range(min(many[j], wanted // n), 0, -1):
                if sums[j + 1] >> (wanted - c * n) & 1:
                    for rest in exact(j + 1, wanted - c * n):
                        yield [(n, c), *rest]

    available = sum(1 << n for n in lengths)
    spare = 0
    while spare <= min(room, allowed()):
        if sums[0] >> (room - spare) & 1:
            for items in exact(0, room - spare):
                if _dominated(items, spare, available, left):
                    yield None
                elif items and items[0][0] == largest:
                    yield ((largest, items[0][1] + 1), *items[1:])
                else:
                    yield ((largest, 1), *items)
        spare += 1


def _dominated(items: list[tuple[int, int]], spare: int, available: int, left: np.ndarray) -> bool:
    """Whether some items, or none, can give way to one longer document that is left and fits, or several to one of their sum.

    If a filling can be put inside the places of another, matching equal items first leaves such an exchange, so this test misses none.
    """
    single, several, seen = 0, 0, 1  # sums of one item, of two and more, of any number
    for n, c in items:
        if left[n] == c:
            available &= ~(1 << n)
        single |= 1 << n
        for _ in range(c):
            several |= (seen & ~1) << n
            seen |= seen << n
    if several & available:
        return True
    reach, width = (1 | single | several) << 1, 1  # from one more than each sum to ``spare`` more
    if not spare:
        return False
    while width < spare:
        step = min(width, spare - width)
        reach |= reach << step
        width += step
    return bool(reach & available)
