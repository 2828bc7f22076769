"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints within ``radius`` bits of each other are linked. The 64 bits are cut into
``blocks`` blocks; two fingerprints that differ in at most ``radius`` bits agree in ``blocks - radius`` of them, so they meet in at
least one of the tables keyed by that many blocks (three of six: twenty tables). Inside a bucket of equal keys every pair is compared, 64
candidates to a machine word: bit planes are stored vertically, the differing bits of all
planes are added up in carry-save counters, preset so that they overflow just beyond the radius, and words
in which all candidates have overflowed are abandoned.

A wide radius finds edited copies but also strangers. ``Confirm`` then asks for a second, longer fingerprint over
other shingles, whose share of differing bits estimates similarity far more closely.

Only distinct fingerprints are compared, so copies cost nothing. A bucket above ``TILE`` rows is cut
into tiles, and each pair of tiles is a cell of its own, so no task holds a large bucket. A task
returns links that span what it found linked (not all pairs); connected components join them.

Nulls and texts without words have fingerprint zero and are linked like any other. Rows are never
merged: a repeated row gets the same result each time. A NULL id never becomes a
component id unless the component has no other. Extra columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tallywire.llm.common import link_components, partitions, release, slices, strings
from tallywire.session import materialize

SHINGLE = 3
SEED = 42
BLOCKS = 6
RADIUS = 3
TILE = 4096
_ENTRIES = 1 << 18
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_WORD = re.compile(rb"[^ \t-\r]+")
_BITS = np.array([[v >> b & 1 for b in range(8)] for v in range(256)], np.int64)


@dataclass(frozen=True)
class Confirm:
    """A longer fingerprint over shingles of ``words`` words: ``parts`` x 64 bits, of which at most ``radius`` may differ.

    The defaults stand for a Jaccard similarity of about 0.8 of five-word shingles: such texts
    differ in some 14 % of the bits, give or take 2.5 %.
    """

    words: int = 5
    parts: int = 3
    radius: int = 34


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every shingle of ``words`` lower-cased words, repeats included; of all words if there are fewer."""
    found = _WORD.findall(text.encode().lower())  # bytes: only A-Z change
    line, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) < words:
        return np.array([digest(line, SEED)] if found else [], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = [0, *ends[:len(found) - words].tolist()]
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts, (ends[words - 1:] - 1).tolist())], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; zero for none."""
    octets, out = hashes.view(np.uint8).reshape(-1, 8), 0
    for i in range(8):
        votes = np.bincount(octets[:, i], minlength=256) @ _BITS
        for b in np.flatnonzero(2 * votes > len(hashes)).tolist():
            out |= 1 << (8 * i + b)
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _long_fingerprint(text: str, confirm: Confirm) -> list[int]:
    hashes, out = shingle_hashes(text, confirm.words), []
    for _ in range(confirm.parts):
        out.append(_signed(fingerprint(hashes)))
        hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(29)
    return out


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = SHINGLE, confirm: Confirm | None = None,
) -> DataFrame:
    """(id, fp bigint, more array<bigint>) of every row; the bits of fp are those of the unsigned fingerprint."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = strings(part, "text")
            fps = [_signed(fingerprint(shingle_hashes(t, words))) for t in texts]
            more = [_long_fingerprint(t, confirm) if confirm else [] for t in texts]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(fps, pa.int64()), pa.array(more, pa.list_(pa.int64()))],
                                             names=["id", "fp", "more"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp bigint, more array<bigint>")


def near_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = SHINGLE, radius: int = RADIUS,
    blocks: int = BLOCKS, confirm: Confirm | None = None, tile: int = TILE,
) -> DataFrame:
    """(id, fp, component_id) of every row: the smallest id reachable over links."""
    node = F.xxhash64("fp", "more") if confirm else F.col("fp")
    found = materialize(fingerprints(docs, id_column, text_column, words, confirm).withColumn("node", node))
    own = found.groupBy("node", "fp", "more").agg(F.min("id").alias("least"))
    links = link_fingerprints(own.select("node", "fp", "more"), radius, blocks, confirm, tile)
    parts = link_components(links).withColumnRenamed("component", "root")
    # Only fingerprints that have links differ from their own smallest id.
    linked = own.select("node", "least").join(parts, "node")
    roots = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    table = own.select("node", "least").join(linked.select("node", "root").join(roots, "root").select("node", "component_id"), "node", "left") \
        .select("node", F.coalesce("component_id", "least").alias("component_id"))
    return found.select("id", "fp", "node").join(table, "node").select(F.col("id").alias(id_column), "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def link_fingerprints(
    fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, confirm: Confirm | None = None, tile: int = TILE,
) -> DataFrame:
    """Links (a, b) of nodes that span all groups of distinct (node, fp, more) within the radius."""
    tables = list(combinations(range(blocks), blocks - radius))
    keys = F.explode(F.array(*[
        F.struct(F.lit(i).alias("tab"), F.col("fp").bitwiseAND(F.lit(_mask(t, blocks))).alias("bits")) for i, t in enumerate(tables)
    ])).alias("k")
    rows = fps.select("node", "fp", "more", keys).select("node", "fp", "more", "k.*")
    # Buckets that need tiles; there are at most (tables x rows / tile) of them.
    large = materialize(rows.groupBy("tab", "bits").agg(F.count("*").alias("n")).filter(F.col("n") > tile)
                        .select("tab", "bits", F.ceil(F.col("n") / tile).cast("int").alias("tiles")))
    tiled = rows.join(large, ["tab", "bits"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    mine = F.pmod(F.xxhash64("node", F.lit(7)), F.col("tiles")).cast("int")
    cells = tiled.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        F.col("tab").cast("int"), "bits", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).alias("second"), "node", "fp", *([F.col("more")] if confirm else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if got:
            a, b = _link_cells(pa.Table.from_batches(got), radius, confirm)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            release()

    # A cell is bounded by two tiles; a partition by its share of all cells.
    dealt = cells.repartition(partitions(fps.sparkSession), "tab", "bits", "i", "j")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def _mask(chosen: tuple[int, ...], blocks: int) -> int:
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    return _signed(sum(((1 << edges[b + 1]) - (1 << edges[b])) for b in chosen))


def _link_cells(cells: pa.Table, radius: int, confirm: Confirm | None) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of all cells in one partition."""
    column = {c: cells.column(c).to_numpy() for c in ("tab", "bits", "i", "j", "second", "node", "fp")}
    order = np.lexsort([column[c] for c in ("node", "second", "j", "i", "bits", "tab")])
    column = {c: x[order] for c, x in column.items()}
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in ("tab", "bits", "i", "j"):
        new[1:] |= column[c][1:] != column[c][:-1]
    sizes = np.diff(np.append(np.flatnonzero(new), len(order)))
    several = np.repeat(sizes > 1, sizes)  # a row alone in its cell has no candidates
    if not several.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new, column = new[several], {c: x[several] for c, x in column.items()}
    more = None
    if confirm:
        more = cells.column("more").combine_chunks()
        more = more.values.to_numpy().reshape(-1, confirm.parts)[order[several]].view(np.uint64)
    fp, second = column["fp"].view(np.uint64), column["second"]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(fp)))
    stop = np.repeat(starts + sizes, sizes)
    cell = np.repeat(np.arange(len(starts)), sizes)
    # In a cell of two tiles the first asks and the second is asked; in a single tile each row asks the rows behind it.
    diagonal = column["i"] == column["j"]
    second_from = starts + np.add.reduceat((~second).astype(np.int64), starts)
    first_asked = np.where(diagonal, np.arange(len(fp)) + 1, second_from[cell])
    asks = np.flatnonzero((first_asked < stop) & (diagonal | ~second))
    values, node = np.unique(column["node"], return_inverse=True)
    label = np.arange(len(values))
    for a, b in _close_pairs(fp, asks, first_asked, stop, radius):
        apart = label[node[a]] != label[node[b]]
        a, b = a[apart], b[apart]
        if more is not None:
            true = np.bitwise_count(more[a] ^ more[b]).sum(axis=1, dtype=np.int64) <= confirm.radius
            a, b = a[true], b[true]
        _merge(label, node[a], node[b])
    moved = np.flatnonzero(label != np.arange(len(label)))
    return values[moved], values[label[moved]]


def bit_planes(fp: np.ndarray) -> np.ndarray:
    """planes[b][w]: bit b of the 64 fingerprints from 64 w on."""
    padded = np.zeros(-(-len(fp) // 64) * 64, np.uint64)
    padded[:len(fp)] = fp
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits.T, axis=1, bitorder="little").copy().view(np.uint64)


def close_words(
    planes: np.ndarray, asked: np.ndarray, word: np.ndarray, valid: np.ndarray, radius: int,
) -> tuple[np.ndarray, np.ndarray]:
    """For query ``asked[e]`` and word ``word[e]`` of 64 candidates: entries with any hit and the bits that hit.

    Counters hold one bit of 64 counts in a word; they start at a value from which ``radius`` steps are left before they overflow.
    """
    entry, over = np.arange(len(asked)), ~valid
    start = (1 << radius.bit_length()) - 1 - radius
    counters = [np.full(len(asked), _ALL if start >> i & 1 else 0, np.uint64) for i in range(radius.bit_length())]
    for b in range(64):
        carry = planes[b][word] ^ (np.uint64(0) - (asked >> np.uint64(b) & np.uint64(1)))
        for i, count in enumerate(counters):
            counters[i], carry = count ^ carry, count & carry
        over |= carry
        if b % 8 == 7:
            alive = over != _ALL
            if 2 * np.count_nonzero(alive) < len(alive):
                entry, asked, word, over = (x[alive] for x in (entry, asked, word, over))
                counters = [x[alive] for x in counters]
    hit = over != _ALL
    return entry[hit], ~over[hit]


def _close_pairs(fp, rows, first, stop, radius) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows within the radius, a bounded number of words at a time."""
    planes = bit_planes(fp)
    low, high = first[rows] // 64, (stop[rows] - 1) // 64 + 1
    upto = np.cumsum(high - low)
    begin = 0
    while begin < len(rows):
        done = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, done + _ENTRIES, side="right")))
        count = (high - low)[begin:end]
        row = np.repeat(rows[begin:end], count)
        word = np.repeat(low[begin:end] - np.cumsum(count) + count, count) + np.arange(count.sum())
        head, tail = first[row] - 64 * word, stop[row] - 64 * word
        valid = np.where(head > 0, _ALL << np.clip(head, 0, 63).astype(np.uint64), _ALL)
        valid &= np.where(tail < 64, (np.uint64(1) << np.clip(tail, 0, 63).astype(np.uint64)) - np.uint64(1), _ALL)
        entry, hits = close_words(planes, fp[row], word, valid, radius)
        for at in range(0, len(entry), 1 << 14):
            bits = np.unpackbits(hits[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            e, b = np.nonzero(bits)
            e = entry[at:at + (1 << 14)][e]
            yield row[e], 64 * word[e] + b
        begin = end


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union by smallest label; every pair ends with equal labels."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        low, high = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
        np.minimum.at(label, high, low)
        while True:
            next_label = label[label]
            if np.array_equal(next_label, label):
                break
            label[:] = next_label
