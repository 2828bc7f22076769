"""Token counts by overlap resynchronisation.

A text longer than a chunk is encoded as overlapping chunks with offsets. Neighbouring
chunks are spliced at a *stable* boundary inside their overlap: a place that both encodings
give as the end of a token and where a visible character is followed by a blank or a
line feed. No merge and no look-ahead of the pre-tokenizers here reaches over such a place, so the tokens before it
do not depend on what follows, nor those after it on what came before. If an overlap holds
none, it is widened until it does, at worst to the end of the text.

Nulls count as empty texts (0 tokens). Any other column is left out; repeated rows are
counted each by itself; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallywire.llm.common import slices, strings
from tallywire.llm.units import UnitEncoder, encoder

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 512


def count_tokens(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text",
    chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """(id, n_bytes, n_tokens, n_chunks, n_widened) for every row; ``tokenizer`` is a file of the tokenizers library."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for part in slices(batches, "text"):
            texts = strings(part, "text")
            found = count_texts(enc, texts, chunk_chars, overlap_chars)
            yield pa.RecordBatch.from_arrays([
                part.column("id"), pa.array([len(t.encode()) for t in texts], pa.int64()),
                *[pa.array([f[i] for f in found], pa.int64()) for i in range(3)],
            ], names=["id", "n_bytes", "n_tokens", "n_chunks", "n_widened"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint, n_chunks bigint, n_widened bigint")
    return out.withColumnRenamed("id", id_column)


def count_texts(enc: UnitEncoder, texts: list[str], chunk: int, overlap: int) -> list[tuple[int, int, int]]:
    """(tokens, chunks, widened overlaps) of each text."""
    enc.trim()
    cut = [enc.units(t) if len(t) <= chunk else None for t in texts]
    known = enc.learn(cut)
    out = []
    for text, units in zip(texts, cut):
        if units is not None:
            out.append((sum(map(len, map(known.__getitem__, units))) // 4, 1, 0))
        elif len(text) <= chunk:
            out.append((len(enc.library.encode(text, add_special_tokens=False).ids), 1, 0))
        else:
            out.append(_spliced(enc, text, chunk, overlap))
    return out


def token_ends(enc: UnitEncoder, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Ends of tokens (or of units of tokens) as character offsets, and the tokens up to each."""
    units = None if enc._lower else enc.units(text)
    if units is None:
        ends = np.array([b for _, b in enc.library.encode(text, add_special_tokens=False).offsets], np.int64)
        return ends, np.arange(1, len(ends) + 1)
    known = enc.learn([units])
    return (np.fromiter(accumulate(map(len, units)), np.int64, len(units)),
            np.cumsum(np.fromiter((len(known[u]) for u in units), np.int64, len(units))) // 4)


def _up_to(encoded: tuple[np.ndarray, np.ndarray], place: int) -> int:
    i = int(np.searchsorted(encoded[0], place, side="right"))
    return int(encoded[1][i - 1]) if i else 0


def _spliced(enc: UnitEncoder, text: str, chunk: int, overlap: int) -> tuple[int, int, int]:
    total, chunks, widened = 0, 1, 0
    start, begin = 0, 0  # of the current chunk; of its part that is not yet counted
    stop = min(len(text), chunk + overlap)
    current = token_ends(enc, text[:stop])
    while stop < len(text):
        after = stop - overlap
        reach = overlap
        while True:
            after_stop = min(len(text), after + chunk + reach)
            following = token_ends(enc, text[after:after_stop])
            place = _common(text, current[0] + start, following[0] + after, after, stop)
            if place is not None or stop == len(text):
                break
            reach *= 2
            widened += 1
            stop = min(len(text), stop + reach)
            current = token_ends(enc, text[start:stop])
        if place is None:
            break
        total += _up_to(current, place - start) - _up_to(current, begin - start)
        start, begin, stop, current = after, place, after_stop, following
        chunks += 1
    return total + _up_to(current, stop - start) - _up_to(current, begin - start), chunks, widened


def _common(text: str, left: np.ndarray, right: np.ndarray, low: int, high: int) -> int | None:
    """The first stable boundary that both encodings have strictly inside (low, high)."""
    both = np.intersect1d(left[(left > low) & (left < high)], right[(right > low) & (right < high)])
    for p in both.tolist():
        if text[p] in " \n" and text[p - 1] > " " and not text[p - 1].isspace():
            return p
    return None
