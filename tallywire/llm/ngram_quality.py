"""Quality rules: plain counts, and a log-likelihood ratio of hashed n-grams.

Byte n-grams are hashed into ``BUCKETS`` counters, once over the trusted documents and once over the whole
corpus; the smoothed multinomials give each bucket a log ratio. A document's score is
the mean ratio over its n-grams, so length does not matter, and it is kept at ``THRESHOLD`` or more: a fixed
comparison, no draw. Ratios are whole numbers (2**-16 of a nat), so sums do not depend on
the order of rows or tasks. Counts cover every document and every trusted one; what leaves a task is its
counters, and only one row per bucket reaches the driver.

Nulls count as empty texts; texts shorter than an n-gram score 0. Without trusted documents every ratio is 0.
Rows are judged one by one, repeated or not; extra columns pass through ``judged``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallywire.llm.common import slices, strings, utf8

NGRAM = 4
BUCKETS = 1 << 16
SMOOTHING = 1.0
THRESHOLD = -0.7
_UNIT = 1 << 16
_SLICE = 1 << 20
_WORD = re.compile("[^ \t-\r]+")
_SYMBOLS = "#*$%&|<>"
_MIN_WORDS = 10
_MAX_REPEAT_PERCENT = 20
_WINDOW = 5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines, and words inside repeated windows of five words."""
    words = _WORD.findall(text)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)),
            _repeated(words))


def _repeated(words: list[str]) -> int:
    if len(words) <= _WINDOW:
        return 0
    number = dict.fromkeys(words)
    number = dict(zip(number, range(len(number))))
    at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    key, kinds = at[:len(at) - _WINDOW + 1], len(number)
    for i in range(1, _WINDOW):
        if int(key.max()) >= (1 << 62) // kinds:  # number the prefixes anew, so that keys stay exact
            key = np.unique(key, return_inverse=True)[1]
        key = key * kinds + at[i:len(at) - _WINDOW + 1 + i]
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(key, twice))
    cover = np.zeros(len(at) + 1, np.int64)
    cover[starts] += 1
    np.subtract.at(cover, starts + _WINDOW, 1)
    return int(np.count_nonzero(np.cumsum(cover)))


def _codes(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every n-gram of the batch, and how many each row has; n-grams stay inside their row."""
    data, offsets = utf8(batch.column(column))
    sizes = np.maximum(np.diff(offsets) - NGRAM + 1, 0)
    if len(data) < NGRAM:
        return np.zeros(0, np.int64), sizes
    code = data[:len(data) - NGRAM + 1].astype(np.uint32)
    for i in range(1, NGRAM):
        code |= data[i:len(data) - NGRAM + 1 + i].astype(np.uint32) << np.uint32(8 * i)
    code *= np.uint32(0x9E3779B1)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x85EBCA77)
    inside = np.ones(len(code), bool)
    for i in range(1, NGRAM):
        cut = offsets[1:-1] - i
        inside[cut[(cut >= 0) & (cut < len(inside))]] = False
    return (code >> np.uint32(16)).astype(np.int64)[inside], sizes


def corpus_counts(docs: DataFrame, trusted: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(bucket, raw, target): n-grams of all documents and of those whose id is in ``trusted`` (one column)."""
    known = trusted.select(F.col(trusted.columns[0]).alias("t")).filter("t IS NOT NULL").distinct()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # Always a shuffle on the id: the labels grow with the corpus, so they are never broadcast.
    flagged = rows.join(known.hint("merge"), rows["id"] == known["t"], "left").select("text", F.col("t").isNotNull().alias("good"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for part in slices(batches, "text", _SLICE):
            codes, sizes = _codes(part, "text")
            good = np.repeat(part.column("good").to_numpy(zero_copy_only=False), sizes)
            raw += np.bincount(codes, minlength=BUCKETS)
            target += np.bincount(codes[good], minlength=BUCKETS)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])],
                                         names=["bucket", "raw", "target"])

    return flagged.mapInArrow(run, "bucket int, raw bigint, target bigint").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """The ratio of each bucket in units of 2**-16; at most ``BUCKETS`` rows are collected."""
    table = counts.toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[table["bucket"]], target[table["bucket"]] = table["raw"], table["target"]
    if not target.sum():
        return np.zeros(BUCKETS, np.int64)
    chance = lambda c: (c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS)
    return np.rint(_UNIT * (np.log(chance(target)) - np.log(chance(raw)))).astype(np.int64)


def judged(
    docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD,
) -> DataFrame:
    """(row: all columns of ``docs`` as a struct, the base counts, base_failed, score, kept) of every document."""
    ratios = log_ratios(corpus_counts(docs, trusted, id_column, text_column))
    bar = round(threshold * _UNIT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_text = (pa.RecordBatch.from_arrays([b.column(0), b.column(0).field(place)], names=["row", "text"]) for b in batches)
        for part in slices(with_text, "text", _SLICE):
            counts = np.array([base_counts(t) for t in strings(part, "text")], np.int64).reshape(-1, len(COUNTS))
            codes, sizes = _codes(part, "text")
            upto = np.concatenate([[0], np.cumsum(ratios[codes])])
            ends = np.cumsum(sizes)
            total = upto[ends] - upto[ends - sizes]
            failed = (counts[:, 0] < _MIN_WORDS) | (100 * counts[:, 4] > _MAX_REPEAT_PERCENT * counts[:, 0])
            yield pa.RecordBatch.from_arrays([
                part.column("row"), *[pa.array(counts[:, i]) for i in range(len(COUNTS))],
                pa.array(failed), pa.array(total / np.maximum(sizes, 1) / _UNIT), pa.array(~failed & (total >= bar * sizes)),
            ], names=["row", *COUNTS, "base_failed", "score", "kept"])

    rows, place = docs.select(F.struct("*").alias("row")), docs.columns.index(text_column)
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS)
                           + ", base_failed boolean, score double, kept boolean")
