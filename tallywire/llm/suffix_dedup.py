"""Removal of byte strings that an earlier document already holds.

Every byte is removed that lies in a string of ``LENGTH`` bytes which also starts in a document with a smaller
id; strings are judged on the input, inside one document each. The work is a suffix sort of the
window starts that can have a partner, found in steps that never shuffle a text:

1. Texts are written once, compressed, in batches of bounded size, into a table bucketed by batch.
2. Exact copies are settled by digest: all but those with the smallest id go whole.
3. Each window of ``LENGTH`` bytes has an anchor, its k-gram of the smallest hash. Equal windows have equal
   anchors, so only windows whose anchor occurs in two documents matter. Batches send their anchor hashes
   once each, sorted and as differences, and get back which of them are repeated.
4. Batches send the text around repeated anchors, once for each different text. Within an anchor (and the place of the
   window relative to it) the suffixes are merge-sorted; two suffixes are compared by binary search for
   their common extension over prefix polynomial hashes. Neighbours that hash alike over
   ``LENGTH`` bytes are verified byte by byte, and each run's smallest id decides. Anchors that very many documents hold are
   sent window by window instead, so they spread over all tasks.
5. Batches mark their documents' bytes and give out what is left.

What a task holds is a batch or a share of the anchors, both bounded; a hot copy, passage or
anchor is one entry per batch.

A NULL text is empty; a NULL id ranks behind all ids and is never a source for rows with ids. Rows with equal ids are one
document and no source for each other. Other columns pass through whatever their names; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from hashlib import blake2b
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallywire.llm.common import release, scratch_table, utf8
from tallywire.session import materialize

LENGTH = 50
KGRAM = 20
BATCH_BYTES = 6 << 20
HOT = 2000
_BLOCK = 1 << 18
_CHUNK = 1 << 20
_BITS = 46
_LAST = (1 << 63) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_U = np.uint64


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    up, down = np.full(n, _BASE, _U), np.full(n, _U(pow(int(_BASE), -1, 1 << 64)), _U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


_UP, _DOWN = _powers(_BLOCK + 256)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(29))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(32))


def _prefix(values: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes: out[j] - out[i] is the hash of values[i:j], times the power at i."""
    out = np.zeros(len(values) + 1, _U)
    np.cumsum(values * powers, out=out[1:])
    return out


class Records:
    """Runs of windows that share an anchor: where they start and stop, the anchor's hash and place, and a hash of the text they span."""

    def __init__(self, start: np.ndarray, stop: np.ndarray, anchor: np.ndarray, lead: np.ndarray, whole: np.ndarray):
        self.start, self.stop, self.anchor, self.lead, self.whole = start, stop, anchor, lead, whole

    def take(self, at) -> Records:
        return Records(*(x[at] for x in (self.start, self.stop, self.anchor, self.lead, self.whole)))


def anchored(data: np.ndarray, ends: np.ndarray) -> Records:
    """All windows inside the documents that end at ``ends``, grouped by anchor."""
    width = LENGTH - KGRAM + 1
    out = []
    for a in range(0, max(0, len(data) - LENGTH + 1), _BLOCK):
        count = min(_BLOCK, len(data) - LENGTH + 1 - a)
        text = _BYTES[data[a:a + count + LENGTH - 1]]
        prefix = _prefix(text, _UP[:len(text)])
        grams = len(text) - KGRAM + 1
        gram = _mix((prefix[KGRAM:] - prefix[:-KGRAM]) * _DOWN[:grams])
        least = (gram & _U(0xFFFFFFFFFF000000)) | np.arange(grams, dtype=_U)
        span = 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
        place = (least[:count] & _U(0xFFFFFF)).astype(np.int64)
        closed = np.zeros(count + 1, np.int64)  # windows that reach over the end of a document
        near = ends[(ends > a) & (ends < a + count + LENGTH)] - a
        np.add.at(closed, np.maximum(near - LENGTH + 1, 0), 1)
        np.add.at(closed, np.minimum(near, count), -1)
        inside = np.cumsum(closed[:-1]) == 0
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (place[1:] != place[:-1])
        start = np.flatnonzero(new)
        if not len(start):
            continue
        done = np.flatnonzero(inside & np.append(~inside[1:] | new[1:], True)) + 1
        at = place[start]
        whole = (prefix[done + LENGTH - 1] - prefix[start]) * _DOWN[start]
        out.append(Records(start + a, done + a, _mix(gram[at] ^ _BASE) >> _U(64 - _BITS), at - start, whole))
    if not out:
        none = np.zeros(0, np.int64)
        return Records(none, none, none.astype(_U), none, none.astype(_U))
    return Records(*(np.concatenate([getattr(r, n) for r in out]) for n in ("start", "stop", "anchor", "lead", "whole")))


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of each range, one after another."""
    upto = np.cumsum(size)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(start - upto + size, size)


# --- texts in batches -------------------------------------------------------------------------------------------------

def _write_batches(docs: DataFrame, id_column: str, text_column: str, batch_bytes: int) -> tuple[DataFrame, str, int]:
    """The bucketed table of batches, the type of a document's other columns, and how many shares the anchors are dealt to."""
    spark = docs.sparkSession
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column])
    rows = docs.select(rest.alias("rest"), F.coalesce(F.col(id_column).cast("bigint"), F.lit(_LAST)).alias("id"),
                       F.col(text_column).alias("text"))
    kind = rows.schema["rest"].dataType.simpleString()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count = TaskContext.get().partitionId() << 32, 0
        waiting, size = [], 0
        for b in batches:
            data, offsets = utf8(b.column("text"))
            start = 0
            while start < b.num_rows:
                room = offsets[start] + batch_bytes - size
                stop = max(start + 1, int(np.searchsorted(offsets[1:], room, side="right")))
                waiting.append((b.slice(start, stop - start), data[offsets[start]:offsets[stop]], np.diff(offsets[start:stop + 1])))
                size += int(offsets[stop] - offsets[start])
                start = stop
                if size >= batch_bytes or start < b.num_rows:
                    yield _batch_row(base + count, waiting)
                    count, waiting, size = count + 1, [], 0
        if waiting:
            yield _batch_row(base + count, waiting)

    name = scratch_table(spark, "texts")
    buckets = min(100_000, max(1, -(-total // (4 * batch_bytes))))
    rows.mapInArrow(run, f"batch bigint, texts binary, sizes array<int>, ids array<bigint>, digests array<binary>, rest array<{kind}>") \
        .write.format("parquet").bucketBy(buckets, "batch").option("compression", "none").saveAsTable(name)
    return spark.table(name), kind, max(1, -(-total // batch_bytes))


def _batch_row(batch: int, parts: list) -> pa.RecordBatch:
    data = np.concatenate([p[1] for p in parts])
    sizes = np.concatenate([p[2] for p in parts])
    ends = np.cumsum(sizes)
    digests = [blake2b(data[e - n:e], digest_size=16).digest() for e, n in zip(ends.tolist(), sizes.tolist())]
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    column = lambda c: pa.concat_arrays([p[0].column(c) for p in parts])
    return pa.RecordBatch.from_arrays([
        pa.array([batch], pa.int64()), pa.array([zstandard.compress(data.tobytes(), 3)], pa.binary()),
        one(pa.array(sizes.astype(np.int32))), one(column("id")), one(pa.array(digests, pa.binary())), one(column("rest")),
    ], names=["batch", "texts", "sizes", "ids", "digests", "rest"])


class Batch:
    """A batch as a task sees it, with what it has been told so far."""

    def __init__(self, row: pa.RecordBatch, i: int):
        get = lambda c: row.column(c)[i]
        self.number = get("batch").as_py()
        self.sizes = np.array(get("sizes").values.to_numpy(), np.int64)
        self.ids = get("ids").values.to_numpy()
        self.ends = np.cumsum(self.sizes)
        self.data = np.frombuffer(zstandard.decompress(get("texts").as_py()), np.uint8)
        told = {d["digest"]: d["least"] for d in (get("copies").as_py() or [])}
        least: dict[bytes, int] = {}
        digests = get("digests").as_py()
        for d, n in zip(digests, self.ids.tolist()):
            least[d] = min(n, least.get(d, told.get(d, _LAST)))
        self.copy = self.ids > np.array([least[d] for d in digests], np.int64)
        self._row, self._i = row, i

    def records(self) -> tuple[Records, np.ndarray]:
        """Records of all documents but copies, and the document of each."""
        found = anchored(self.data, self.ends)
        doc = np.searchsorted(self.ends, found.start, side="right")
        keep = ~self.copy[doc]
        return found.take(keep), doc[keep]

    def anchors(self, shares: int, records: Records, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted anchors, in how many documents each is (at most 255), the first of each share, and the number of each record's."""
        order = np.lexsort([self.ids[doc], records.anchor])
        sorted_anchor, sorted_id = records.anchor[order], self.ids[doc][order]
        new = np.append(True, sorted_anchor[1:] != sorted_anchor[:-1])[:len(order)]
        other = new | np.append(True, sorted_id[1:] != sorted_id[:-1])[:len(order)]
        at = np.flatnonzero(new)
        held = np.minimum(np.add.reduceat(other.astype(np.int64), at), 255) if len(at) else at
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        anchors = sorted_anchor[at]
        bounds = np.searchsorted(anchors, [_share_start(s, shares) for s in range(shares + 1)])
        return anchors, held.astype(np.uint8), bounds, number

    def told(self, column: str, bounds: np.ndarray, kind) -> np.ndarray:
        """Answers of all shares in the order in which the questions were sent."""
        out = np.zeros(bounds[-1], kind)
        for answer in self._row.column(column)[self._i].as_py() or []:
            low, high = bounds[answer["share"]], bounds[answer["share"] + 1]
            out[low:high] = np.frombuffer(zstandard.decompress(answer["said"]), kind)
        return out

    def questions(self, shares: int) -> tuple[Records, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Records that can have a partner, sorted by share; their documents, the first of each kind, which of them speak for the others, and the bounds of shares among those."""
        records, doc = self.records()
        anchors, _, bounds, number = self.anchors(shares, records, doc)
        state = self.told("repeated", bounds, np.uint8)[number]
        hot = state == 2
        single = records.take(hot)
        size = single.stop - single.start
        start = _ranges(single.start, size)
        hashes = self._window_hashes(start)
        each = Records(start, start + 1, _mix(hashes) >> _U(64 - _BITS), np.zeros(len(start), np.int64), hashes)
        plain = records.take(state == 1)
        both = Records(*(np.concatenate([getattr(plain, n), getattr(each, n)]) for n in ("start", "stop", "anchor", "lead", "whole")))
        doc = np.concatenate([doc[state == 1], np.repeat(doc[hot], size)])
        # Records of equal text: the one with the smallest id asks for all.
        order = np.lexsort([both.start, self.ids[doc], both.whole, both.stop - both.start, both.anchor])
        both, doc = both.take(order), doc[order]
        same = np.ones(len(order), bool)
        if len(order):
            same[0] = False
            for x in (both.anchor, both.whole, both.stop - both.start):
                same[1:] &= x[1:] == x[:-1]
            same = self._verified(both, same)
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order)))) if len(order) else order
        speaks = np.flatnonzero(~same)
        bounds = np.searchsorted(both.anchor[speaks], [_share_start(s, shares) for s in range(shares + 1)])
        return both, doc, first, speaks, bounds

    def _window_hashes(self, start: np.ndarray) -> np.ndarray:
        out = np.zeros(len(start), _U)
        for i in range(LENGTH):
            out += _BYTES[self.data[start + i]] * _UP[i]
        return out

    def _verified(self, records: Records, same: np.ndarray) -> np.ndarray:
        """``same`` only where the bytes agree with the record before."""
        at = np.flatnonzero(same)
        for low in range(0, len(at), 1 << 15):
            some = at[low:low + (1 << 15)]
            size = records.stop[some] - records.start[some] + LENGTH - 1
            equal = self.data[_ranges(records.start[some], size)] == self.data[_ranges(records.start[some - 1], size)]
            same[some] = np.add.reduceat(equal, np.cumsum(size) - size) == size
        return same

    def removed(self, shares: int) -> np.ndarray:
        """Whether each byte of the batch is removed."""
        both, doc, first, speaks, bounds = self.questions(shares)
        mask = np.zeros(len(both.start), np.uint32)
        mask[speaks] = self.told("masks", bounds, np.uint32)
        # Another record of the same text: removed whole if it belongs to a later document.
        mask = np.where(self.ids[doc] > self.ids[doc[first]], _U(0xFFFFFFFF), mask[first]).astype(np.uint32)
        cover = np.zeros(len(self.data) + 1, np.int32)
        size = both.stop - both.start
        for w in range(LENGTH - KGRAM + 1):
            at = both.start[(size > w) & (mask >> np.uint32(w) & np.uint32(1)).astype(bool)] + w
            np.add.at(cover, at, 1)
            np.subtract.at(cover, at + LENGTH, 1)
        gone = np.cumsum(cover[:-1], dtype=np.int32) > 0
        for i in np.flatnonzero(self.copy & (self.sizes >= LENGTH)):
            gone[self.ends[i] - self.sizes[i]:self.ends[i]] = True
        return gone


def _share_start(share: int, shares: int) -> int:
    return (share << _BITS) // shares


# --- answers by share -------------------------------------------------------------------------------------------------

def _pack(hashes: np.ndarray) -> bytes:
    """Sorted hashes as differences."""
    steps = np.diff(hashes, prepend=_U(0))
    small = not len(steps) or int(steps.max()) >> 32 == 0
    return bytes([small]) + steps.astype("<u4" if small else "<u8").tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(blob, "<u4" if blob[0] else "<u8", offset=1).astype(_U), dtype=_U)


def _repeated(rows: pa.Table, hot: int) -> pa.Table:
    """For each batch's anchors of one share: 0 only in one document, 1 repeated, 2 in very many documents."""
    hashes = [_unpack(b) for b in rows.column("hashes").to_pylist()]
    held = np.concatenate([np.frombuffer(zstandard.decompress(b), np.uint8) for b in rows.column("held").to_pylist()])
    every = np.concatenate(hashes)
    order = np.argsort(every, kind="stable")
    new = np.append(True, every[order][1:] != every[order][:-1])
    total = np.add.reduceat(held[order].astype(np.int64), np.flatnonzero(new))
    said = np.empty(len(every), np.uint8)
    said[order] = np.where(total >= hot, 2, total > 1)[np.cumsum(new) - 1]
    stops = np.cumsum([len(h) for h in hashes])
    answers = [zstandard.compress(said[e - len(h):e].tobytes()) for e, h in zip(stops, hashes)]
    return pa.table({"batch": rows.column("batch"), "share": rows.column("share"), "said": pa.array(answers, pa.binary())})


def _masked(rows: pa.Table) -> pa.Table:
    """For each record of one share: which of its windows an earlier document holds."""
    load = lambda c, kind: [np.frombuffer(zstandard.decompress(b), kind) for b in rows.column(c).to_pylist()]
    anchors, windows = load("anchors", "<u8"), load("windows", np.uint8)
    ids, leads, texts = (np.concatenate(x) for x in (load("ids", "<i8"), load("leads", np.uint8), load("texts", np.uint8)))
    stops = np.cumsum([len(a) for a in anchors])
    anchor, count = np.concatenate(anchors), np.concatenate(windows).astype(np.int64)
    size = count + LENGTH - 1
    begin = np.cumsum(size) - size
    mask = np.zeros(len(anchor), np.uint32)
    order = np.argsort(anchor, kind="stable")
    new = np.append(True, anchor[order][1:] != anchor[order][:-1])
    group = np.cumsum(new) - 1
    upto = np.cumsum(size[order])
    low = 0
    while low < len(order):  # as many whole anchors as fit
        high = int(np.searchsorted(upto, (upto[low - 1] if low else 0) + _CHUNK))
        high = len(order) if high >= len(order) else max(int(np.searchsorted(group, group[high])), low + 1)
        high = int(np.searchsorted(group, group[high - 1], side="right"))
        some = order[low:high]
        mask[some] = _sorted_windows(texts, begin[some], count[some], anchor[some], leads[some].astype(np.int64), ids[some])
        low = high
    answers = [zstandard.compress(mask[e - len(a):e].tobytes()) for e, a in zip(stops, anchors)]
    release()
    return pa.table({"batch": rows.column("batch"), "share": rows.column("share"), "said": pa.array(answers, pa.binary())})


def _sorted_windows(texts, begin, count, anchor, lead, ids) -> np.ndarray:
    """Masks of records by a suffix sort of their windows inside each (anchor, place of the anchor in the window)."""
    size = count + LENGTH - 1
    data = texts[_ranges(begin, size)]
    start = np.cumsum(size) - size
    record = np.repeat(np.arange(len(count)), count)
    number = _ranges(np.zeros(len(count), np.int64), count)
    key = (anchor[record].astype(np.int64) << 6) + (lead[record] - number)
    order = np.lexsort([ids[record], key])
    key = key[order]
    new = np.append(True, key[1:] != key[:-1])
    sizes = np.diff(np.append(np.flatnonzero(new), len(key)))
    several = np.repeat(sizes > 1, sizes)  # a window alone in its group has no partner
    order, sizes = order[several], sizes[sizes > 1]
    mask = np.zeros(len(count), np.uint32)
    if not len(order):
        return mask
    record, number = record[order], number[order]
    at = start[record] + number
    suffixes = Suffixes(data, np.repeat(start, size), at)
    rank = suffixes.merge_sort(sizes, ids[record])
    equal = suffixes.equal_to_next(rank, sizes)
    new = np.append(True, ~equal)
    first = np.maximum.accumulate(np.where(new, np.arange(len(rank)), 0))
    own = ids[record[rank]]
    gone = rank[own > own[first]]
    np.bitwise_or.at(mask, record[gone], (np.uint32(1) << number[gone].astype(np.uint32)))
    return mask


class Suffixes:
    """Suffixes of records, compared over their first ``LENGTH`` bytes."""

    def __init__(self, data: np.ndarray, origin: np.ndarray, at: np.ndarray):
        self.data, self.at = data, at
        self._prefix = _prefix(_BYTES[data], _UP[np.arange(len(data)) - origin])
        self._down = _DOWN[at - origin[at]]
        self._whole = (self._prefix[at + LENGTH] - self._prefix[at]) * self._down

    def _extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bytes that suffixes x and y have in common, below ``LENGTH``, by binary search over hashes."""
        a, b = self.at[x], self.at[y]
        pa_, pb, da, db = self._prefix[a], self._prefix[b], self._down[x], self._down[y]
        low, high = np.zeros(len(x), np.int64), np.full(len(x), LENGTH - 1)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = (self._prefix[a + middle] - pa_) * da == (self._prefix[b + middle] - pb) * db
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, x: np.ndarray, y: np.ndarray, ids: np.ndarray, or_equal: bool) -> np.ndarray:
        """Whether suffix x sorts before y; equal suffixes sort by id, and remaining ties count as ``or_equal``."""
        out = ids[x] <= ids[y] if or_equal else ids[x] < ids[y]
        differ = np.flatnonzero(self._whole[x] != self._whole[y])
        if len(differ):
            x, y = x[differ], y[differ]
            common = self._extension(x, y)
            out[differ] = self.data[self.at[x] + common] < self.data[self.at[y] + common]
        return out

    def merge_sort(self, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The order of the suffixes inside consecutive groups of ``sizes``, merging runs of doubling width."""
        start = np.repeat(np.cumsum(sizes) - sizes, sizes)
        stop = start + np.repeat(sizes, sizes)
        rank = np.arange(len(self.at))
        width, widest = 1, int(sizes.max())
        while width < widest:
            moving = np.flatnonzero(stop - start > width)
            place, group = moving - start[moving], start[moving]
            run = place // width
            left = run % 2 == 0
            low = group + np.where(left, run + 1, run - 1) * width  # the run it is merged with
            low = np.minimum(low, stop[moving])
            high = np.minimum(low + width, stop[moving])
            other = low.copy()
            me = rank[moving]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                # From the right run, equal ones of the left go first.
                ahead = np.empty(len(open_), bool)
                for side in (True, False):
                    s = left[open_] == side
                    ahead[s] = self.before(rank[middle[s]], me[open_[s]], ids, or_equal=not side)
                low[open_] = np.where(ahead, middle + 1, low[open_])
                high[open_] = np.where(ahead, high[open_], middle)
            to = group + (run - run % 2) * width + place % width + (low - other)
            merged = rank.copy()
            merged[to] = me
            rank = merged
            width *= 2
        return rank

    def equal_to_next(self, rank: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether each sorted suffix equals the next one, verified byte by byte."""
        equal = self._whole[rank[1:]] == self._whole[rank[:-1]]
        equal[np.cumsum(sizes)[:-1] - 1] = False
        at = np.flatnonzero(equal)
        for low in range(0, len(at), 1 << 15):
            some = at[low:low + (1 << 15)]
            a, b = self.at[rank[some]], self.at[rank[some + 1]]
            bytes_ = np.arange(LENGTH)
            equal[some] = (self.data[a[:, None] + bytes_] == self.data[b[:, None] + bytes_]).all(axis=1)
        return equal


# --- the operator -----------------------------------------------------------------------------------------------------

def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", batch_bytes: int = BATCH_BYTES, hot: int = HOT,
    as_text: bool = False,
) -> DataFrame:
    """(row, n_bytes, begins, ends, kept): the removed spans of each document's bytes and the bytes left, joined.

    ``as_text`` gives them as a string, without what is left of characters cut at an edge.
    ``row`` holds all columns but the text. Anchors in ``hot`` documents or more are treated window by window.
    """
    table, kind, shares = _write_batches(docs, id_column, text_column, batch_bytes)
    digests = table.select("batch", F.explode(F.arrays_zip(F.col("digests").alias("digest"), F.col("ids").alias("id"))).alias("d")) \
        .groupBy("batch", "d.digest").agg(F.min("d.id").alias("own"))
    least = digests.groupBy("digest").agg(F.min("own").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    copies = materialize(digests.join(least, "digest").filter("own > least").groupBy("batch").agg(
        F.collect_list(F.struct("digest", "least")).alias("copies")))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            anchors, held, bounds, _ = batch.anchors(shares, *batch.records())
            used = [s for s in range(shares) if bounds[s] < bounds[s + 1]]
            yield pa.RecordBatch.from_arrays([
                pa.array([batch.number] * len(used), pa.int64()), pa.array(used, pa.int32()),
                pa.array([_pack(anchors[bounds[s]:bounds[s + 1]]) for s in used], pa.binary()),
                pa.array([zstandard.compress(held[bounds[s]:bounds[s + 1]].tobytes()) for s in used], pa.binary()),
            ], names=["batch", "share", "hashes", "held"])

    said = "batch bigint, share int, said binary"
    gather = lambda answers, name: answers.groupBy("batch").agg(F.collect_list(F.struct("share", "said")).alias(name))
    def answer(rows: pa.Table) -> pa.Table:
        return _repeated(rows, hot)

    asked = _with(table, [copies]).mapInArrow(ask, "batch bigint, share int, hashes binary, held binary")
    repeated = materialize(gather(asked.groupBy("share").applyInArrow(answer, said), "repeated"))
    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            both, doc, _, speaks, bounds = batch.questions(shares)
            for s in range(shares):
                at = speaks[bounds[s]:bounds[s + 1]]
                if len(at):
                    r = both.take(at)
                    size = r.stop - r.start
                    columns = [r.anchor.astype("<u8"), batch.ids[doc[at]].astype("<i8"), r.lead.astype(np.uint8), size.astype(np.uint8),
                               batch.data[_ranges(r.start, size + LENGTH - 1)]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.number], pa.int64()), pa.array([s], pa.int32()),
                         *[pa.array([zstandard.compress(c.tobytes())], pa.binary()) for c in columns]],
                        names=["batch", "share", "anchors", "ids", "leads", "windows", "texts"])

    shown = _with(table, [copies, repeated]).mapInArrow(
        show, "batch bigint, share int, anchors binary, ids binary, leads binary, windows binary, texts binary")
    masks = materialize(gather(shown.groupBy("share").applyInArrow(_masked, said), "masks"))
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield from _kept(Batch(b, i), b.column("rest")[i].values, shares, as_text)
                release()

    return _with(table, [copies, repeated, masks], "rest").mapInArrow(
        finish, f"row {kind}, n_bytes bigint, begins array<bigint>, ends array<bigint>, kept {'string' if as_text else 'binary'}")


def _with(table: DataFrame, told: list[DataFrame], *more: str) -> DataFrame:
    """Batches with what they have been told. Each answer is shuffled to the table's buckets, so the texts stay where they are."""
    out = table.select("batch", "texts", "sizes", "ids", "digests", *more)
    for answer in told:
        out = out.join(answer, "batch", "left")
    return out


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    for b in batches:
        for i in range(b.num_rows):
            yield Batch(b, i)
            release()


def _kept(batch: Batch, rest: pa.Array, shares: int, as_text: bool) -> Iterator[pa.RecordBatch]:
    gone = batch.removed(shares)
    for low in range(0, len(batch.sizes), 2000):
        begins, ends, kept = [], [], []
        for e, n in zip(batch.ends[low:low + 2000].tolist(), batch.sizes[low:low + 2000].tolist()):
            edges = np.flatnonzero(np.diff(gone[e - n:e].astype(np.int8), prepend=0, append=0))
            begins.append(edges[::2])
            ends.append(edges[1::2])
            left = batch.data[e - n:e][~gone[e - n:e]].tobytes()
            kept.append(left.decode(errors="ignore") if as_text else left)
        yield pa.RecordBatch.from_arrays([
            rest.slice(low, len(kept)), pa.array(batch.sizes[low:low + 2000]), pa.array(begins, pa.list_(pa.int64())),
            pa.array(ends, pa.list_(pa.int64())), pa.array(kept, pa.string() if as_text else pa.binary()),
        ], names=["row", "n_bytes", "begins", "ends", "kept"])
