"""Exact BPE encoding with a memory of units.

A pre-tokenizer cuts a text into units that the merges never cross, so a unit has the
same ids wherever it stands. Units are found here by a pattern and each new one is given to the
library's model once; texts are then put together from remembered units. The pattern is
used only on texts over an alphabet where it provably equals the library's own (white space,
ASCII and the letters of Latin-1); any other text goes to the library whole.
"""

from __future__ import annotations

import json
import os
import re
import struct

_REMEMBERED = 250_000


def pack(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


#: Outside of this, letters, digits, white space, case or composition need the library's tables.
_UNUSUAL = re.compile("[^\t\n\r -~À-ÖØ-öø-ÿ]")
_UPPER_LATIN = "A-ZÀ-ÖØ-Þ"
_LOWER_LATIN = "a-zß-öø-ÿ"
_PUNCTUATION = r"!-/:-@\[-`{-~"

#: Leading space belongs to the unit; white space is kept.
_SPACED = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{_UPPER_LATIN}{_LOWER_LATIN}]+| ?[0-9]+| ?[{_PUNCTUATION}]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+"
)
#: Lower-cased words, single digits; white space is dropped.
_WORDS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LOWER_LATIN}]+|[0-9]|[{_PUNCTUATION}]+")


class UnitEncoder:
    """Ids and counts of texts exactly as ``tokenizers`` gives them, without added special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self._model = self.library.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._special = [t["content"] for t in spec["added_tokens"]]
        self._pattern, self._lower = _pattern_of(spec)
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def units(self, text: str) -> list[str] | None:
        """The units of ``text``, or None where only the library may cut it."""
        if self._pattern is None or any(s in text for s in self._special):
            return None
        if not text.isascii() and _UNUSUAL.search(text) or text.isascii() and _CONTROL.search(text):
            return None
        return self._pattern.findall(text.lower() if self._lower else text)

    def trim(self) -> None:
        """Start a new memory if it has got too large; to be called between batches of texts.

        The one before it is kept, and units found there move over, so frequent ones are never encoded again.
        """
        if len(self._known) > _REMEMBERED:
            self._known, self._older = {}, self._known

    def learn(self, cut: list[list[str] | None]) -> dict[str, bytes]:
        """Remember the ids of all given units."""
        new = set().union(*[u for u in cut if u is not None]).difference(self._known)
        again = {u for u in new if u in self._older}  # an intersection would walk the whole memory
        self._known.update((u, self._older[u]) for u in again)
        merge = self._model.tokenize  # a unit is what the library's own steps hand to its model, after the byte alphabet
        for unit in new - again:
            self._known[unit] = pack([t.id for t in merge(unit.translate(_BYTES))])
        return self._known

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        self.trim()
        cut = [self.units(t) for t in texts]
        known = self.learn(cut).__getitem__
        return [self._whole(t) if u is None else b"".join(map(known, u)) for t, u in zip(texts, cut)]

    def _whole(self, text: str) -> bytes:
        return pack(self.library.encode(text, add_special_tokens=False).ids)


_CONTROL = re.compile("[^\t\n\r -~]")


def _byte_alphabet() -> dict[int, str]:
    """Characters up to U+00FF as the visible characters that byte-level models use for their UTF-8 bytes.

    Visible Latin-1 characters stand for their own byte; the other bytes have U+0100 and following, in order.
    """
    hidden = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD)]
    sign = {b: chr(0x100 + hidden.index(b)) if b in hidden else chr(b) for b in range(256)}
    return {c: "".join(sign[b] for b in chr(c).encode()) for c in range(256)}


_BYTES = _byte_alphabet()


def _pattern_of(spec: dict) -> tuple[re.Pattern | None, bool]:
    """The fast pattern for the two kinds of pre-tokenizer it is proven for."""
    model, pre, norm = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    if model["type"] != "BPE" or model.get("dropout"):
        return None, False
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
        return _SPACED, False
    steps = [n["type"] for n in norm.get("normalizers", [])]
    parts = [p["type"] for p in pre.get("pretokenizers", [])]
    if steps == ["NFC", "Replace", "Lowercase"] and parts == ["Split", "ByteLevel"] and model.get("end_of_word_suffix"):
        return _WORDS, True
    return None, False


_LOADED: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """One encoder per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = UnitEncoder(path)
    return _LOADED[path]
