"""SentencePiece encoding with byte spans in the original text, and decoding.

The text is normalised here, by the longest prefix found in the model's compiled character
map, and every normalised byte remembers where its source began. The library segments the normalised text; each piece then has a span of bytes of the
original. Segmentation is remembered per word: where no piece of the vocabulary holds
a blank mark behind another character, no merge crosses the start of a blank run,
so words are segmented independently of each other. A model that has such pieces is segmented whole.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallywire.llm.common import slices, strings

_BLANK = "▁"
_REMEMBERED = 300_000
_SLICE = 2 << 20
_OUT = "id {kind}, n_bytes bigint, ids array<int>, begins array<int>, ends array<int>, decoded string"


class CharMap:
    """Longest-prefix replacement by a compiled map: a double-array trie and its replacement strings."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self._trie = np.frombuffer(blob[4:4 + size], "<u4").tolist() if blob else []
        self._strings = blob[4 + size:]
        self._starts = {b for b in range(256) if self._trie and self._step(self._root(), b) is not None}

    def _root(self) -> int:
        return self._offset(self._trie[0])

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _step(self, at: int, byte: int) -> int | None:
        at ^= byte
        return at if at < len(self._trie) and self._trie[at] & 0x800000FF == byte else None

    def longest(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix at ``start`` and what replaces it."""
        at, best = self._root(), None
        for i in range(start, len(text)):
            found = self._step(at, text[i])
            if found is None:
                break
            unit = self._trie[found]
            at = found ^ self._offset(unit)
            if unit >> 8 & 1:
                value = self._trie[at] & 0x7FFFFFFF
                best = (i + 1 - start, self._strings[value:self._strings.index(b"\0", value)])
        return best

    def apply(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The mapped text, and for each of its bytes the offset at which its source begins."""
        source = np.frombuffer(text, np.uint8)
        heads = np.maximum.accumulate(np.where((source & 0xC0) != 0x80, np.arange(len(source)), 0)) if len(source) else np.zeros(0, np.int64)
        if not self._starts:
            return text, heads
        out, where, i, plain = [], [], 0, 0
        for i in np.flatnonzero(np.isin(source, list(self._starts)) & ((source & 0xC0) != 0x80)).tolist():
            if i < plain:
                continue
            found = self.longest(text, i)
            if found is None:
                continue
            out += [text[plain:i], found[1]]
            where += [heads[plain:i], np.full(len(found[1]), i)]
            plain = i + found[0]
        return b"".join([*out, text[plain:]]), np.concatenate([*where, heads[plain:]]).astype(np.int64)


class PieceCodec:
    """Ids and spans exactly as the library's own encoding of whole texts, without begin or end ids."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = pb.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        self.map = CharMap(spec.normalizer_spec.precompiled_charsmap)
        norm, train = spec.normalizer_spec, spec.trainer_spec
        self._prefix, self._trim = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        normal = [p.piece for p in spec.pieces if p.type in (p.NORMAL, p.USER_DEFINED, p.UNUSED)]
        if any(p.type == p.USER_DEFINED for p in spec.pieces) or not norm.escape_whitespaces or train.treat_whitespace_as_suffix:
            raise ValueError("models with user-defined pieces, plain blanks or blank suffixes are not supported")
        by_word = train.model_type == train.BPE and not any(re.search(f"[^{_BLANK}]{_BLANK}", p) for p in normal)
        line = "\n" if not any("\n" in p for p in normal) else ""  # in no piece: nothing merges over it
        self._words = re.compile(rf"{_BLANK}*[^{_BLANK}{line}]+|{_BLANK}+" + ("|\n+" if line else "")) if by_word else None
        # What is left to the library is segmentation: the text it gets is normalised already.
        norm.name, norm.precompiled_charsmap = "identity", b""
        norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
        self._segment = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        self._length = np.array([1 if p.type == p.BYTE else len(p.piece.encode()) for p in spec.pieces], np.int64)
        self._unknown = {i for i, p in enumerate(spec.pieces) if p.type == p.UNKNOWN}
        self._ids: dict[str, bytes] = {}

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and the source offset of each of its bytes, with the end of the source behind them."""
        raw = text.encode()
        if not raw:
            return "", np.zeros(1, np.int64)
        mapped, where = self.map.apply(raw)
        end = len(raw)
        if self._trim:
            mapped, where, end = _trimmed(mapped, where, end)
        widths = 1 + 2 * (np.frombuffer(mapped, np.uint8) == 32)
        lead = [0, 0, 0] if self._prefix and mapped else []
        first = where[0] if len(where) else 0
        where = np.concatenate([np.array(lead, np.int64) + first, np.repeat(where, widths), [end]])
        return (_BLANK if lead else "") + mapped.decode().replace(" ", _BLANK), where

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, begins, ends) of each text; spans are byte offsets in the original."""
        normal = [self.normalise(t) for t in texts]
        ids = self._ids_of([n for n, _ in normal])
        return [self._spans(i, n, w) for i, (n, w) in zip(ids, normal)]

    def _ids_of(self, normal: list[str]) -> list[np.ndarray]:
        if self._words is None:
            return [np.array(i, np.int32) for i in self._segment.encode(normal, num_threads=1)]
        cut = [self._words.findall(n) for n in normal]
        if len(self._ids) > _REMEMBERED:
            self._ids = {}
        new = list(set().union(*cut).difference(self._ids))
        for start in range(0, len(new), 4096):
            part = new[start:start + 4096]
            for word, i in zip(part, self._segment.encode(part, num_threads=1)):
                self._ids[word] = np.array(i, np.int32).tobytes()
        get = self._ids.__getitem__
        return [np.frombuffer(b"".join(map(get, c)), np.int32) for c in cut]

    def _spans(self, ids: np.ndarray, normal: str, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = self._length[ids]
        if self._unknown and lengths.sum() != len(where) - 1:
            # An unknown piece stands for as many characters as are left over between known ones.
            shown = self._segment.encode(normal, return_type="proto").pieces
            lengths = np.array([len(p.surface.encode()) for p in shown], np.int64)
        stops = np.cumsum(lengths)
        return ids, where[stops - lengths], where[stops]

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


def _trimmed(text: bytes, where: np.ndarray, end: int) -> tuple[bytes, np.ndarray, int]:
    """Blanks at the ends go, and of each inner run one stays."""
    blank = np.frombuffer(text, np.uint8) == 32
    keep = ~blank | np.concatenate([[False], ~blank[:-1]])
    if blank.any() and not blank.all():
        last = int(np.flatnonzero(~blank)[-1])
        keep[last + 1:] = False
        end = int(where[last + 1]) if last + 1 < len(where) else end
    elif blank.all():
        keep[:] = False
    return np.frombuffer(text, np.uint8)[keep].tobytes(), where[keep], end


_LOADED: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    if path not in _LOADED:
        _LOADED[path] = PieceCodec(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, ids, begins, ends, decoded): pieces with their source spans and the text decoded from the ids.

    NULL and empty texts have no pieces and decode to the empty text. Rows keep their own
    result however often they repeat; other columns are left out.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(os.fspath(model))
        for part in slices(batches, "text", _SLICE):
            texts = strings(part, "text")
            found = c.encode(texts)
            offsets = pa.array(np.cumsum([0] + [len(f[0]) for f in found]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([f[i] for f in found]).astype(np.int32)))
                     for i in range(3)]
            yield pa.RecordBatch.from_arrays([
                part.column("id"), pa.array([len(t.encode()) for t in texts], pa.int64()), *lists,
                pa.array([c.decode(f[0]) for f in found], pa.string()),
            ], names=["id", "n_bytes", "ids", "begins", "ends", "decoded"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, _OUT.format(kind=kind)).withColumnRenamed("id", id_column)
