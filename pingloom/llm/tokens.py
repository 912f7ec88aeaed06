"""Exact encoding of many texts by a tokenizer file, with each distinct piece of text encoded once.

The byte-level tokenizer first cuts a text by a fixed pattern and then merges bytes inside each cut.  Some of the
pattern's cuts can be seen from two neighbouring bytes: before the last white space ahead of other text, after it if it
isn't a space, and between an ASCII letter or digit and ASCII punctuation.  Texts are first split at the file's added
tokens (each has its own id), what lies between them is cut at those places, distinct units are encoded once a slice,
and ids are gathered by index; the ids equal those of the whole text.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import text_bytes

_BYTE = np.arange(256)
_SPACE = np.isin(_BYTE, [9, 10, 11, 12, 13, 32])
_ALNUM = ((_BYTE >= 48) & (_BYTE <= 57)) | ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122))
_PUNCT = (_BYTE > 32) & (_BYTE < 127) & ~_ALNUM
#: First bytes of characters that are surely no white space (C2, E1, E2 and E3 begin some that are).
_INK = ((_BYTE > 32) & (_BYTE < 127)) | ((_BYTE >= 0xC3) & (_BYTE < 0xF8) & ~np.isin(_BYTE, [0xE1, 0xE2, 0xE3]))
#: Units that the tokenizer's pattern keeps whole: letters, digits or other marks, after one space at most.
_WHOLE = r"^ ?(\p{L}+|\p{N}+|[!-/:-@\[-`{-~]+)$"
#: Distinct units whose ids a Python worker remembers from one task to the next (about 300 bytes each).
_REMEMBERED = 100_000


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + k for k, b in enumerate(rest)}


def _memory(json: str) -> dict:
    """A dict that lives as long as the Python worker, one for each tokenizer file."""
    import sys
    import types

    home = sys.modules.setdefault("_pingloom_worker", types.ModuleType("_pingloom_worker"))
    return home.__dict__.setdefault("ids", {}).setdefault(hash(json), {})


class Encoder:
    """texts -> ids, as encode(text, add_special_tokens=False) of the given tokenizer file gives them."""

    def __init__(self, json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = {t.content.encode() for t in added}
        #: At one place the longest added token counts.
        self.split = re.compile(b"|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        plain = not any(t.lstrip or t.rstrip or t.single_word for t in added)
        self.byte_level = plain and '"ByteLevel"' in json and '"normalizer":null' in json.replace(" ", "")
        self.letters = _byte_letters()
        self.known = _memory(json)

    def _fresh(self, units: list[bytes]) -> list[bytes]:
        """Ids of units that aren't remembered, as 32-bit integers in bytes.

        A unit that the pattern keeps whole goes straight to the tokenizer's merge model.
        """
        out: list[bytes] = [b""] * len(units)
        whole = pc.match_substring_regex(pa.array(units, pa.binary()).cast(pa.string()), _WHOLE).to_numpy(zero_copy_only=False) if self.byte_level else np.zeros(len(units), bool)
        whole = whole & ~np.fromiter((u in self.added for u in units), bool, len(units))
        at = np.nonzero(whole)[0].tolist()
        if at:
            feed, merge = chr(self.letters[10]), self.tokenizer.model.tokenize
            spelt = b"\n".join([units[k] for k in at]).decode("latin-1").translate(self.letters).split(feed)
            for k, unit in zip(at, spelt, strict=True):
                out[k] = array("I", [t.id for t in merge(unit)]).tobytes()
        at = np.nonzero(~whole)[0].tolist()
        for k in range(0, len(at), 10_000):
            here = at[k : k + 10_000]
            for j, found in zip(here, self.tokenizer.encode_batch_fast([units[j].decode() for j in here], add_special_tokens=False), strict=True):
                out[j] = array("I", found.ids).tobytes()
        return out

    def _added_places(self, text: pa.StringArray, data: np.ndarray, borders: np.ndarray) -> list[tuple[int, int]]:
        """Start and end of each added token that stands in a row."""
        if self.split is None:
            return []
        some = np.zeros(len(text), bool)
        for token in self.added:
            some |= pc.match_substring(text, token.decode()).to_numpy(zero_copy_only=False)
        out = []
        for k in np.nonzero(some)[0].tolist():
            a, b = int(borders[k]), int(borders[k + 1])
            out += [(a + m.start(), a + m.end()) for m in self.split.finditer(data[a:b].tobytes())]
        return out

    def _units(self, text: pa.StringArray) -> tuple[np.ndarray, np.ndarray, pa.BinaryArray]:
        """Starts of units in each row (as counts), each unit's index, and the distinct units."""
        data, borders = text_bytes(text)
        n = len(data)
        cut = np.zeros(n + 1, bool)
        if n > 1 and self.byte_level:
            before, after = data[:-1], data[1:]
            gap = _SPACE[before] & _INK[after]
            marks = self._added_places(text, data, borders)
            together = np.ones(n - 1, bool)  # pairs of bytes in one row and on the same side of every added token
            together[borders[(borders > 0) & (borders < n)] - 1] = False
            for start, end in marks:
                together[max(0, start - 1) : end] = False
            gap &= together
            cut[:-2] |= gap
            letter = _ALNUM[before]
            letter[1:] |= (data[:-2] >= 0xC3) & (data[:-2] <= 0xC9) & (before[1:] >= 0x80) & ~((data[:-2] == 0xC3) & ((before[1:] == 0x97) | (before[1:] == 0xB7)))
            cut[1:-1] |= (gap & (before != 32)) | (letter & _PUNCT[after] & together)
            cut[[x for mark in marks for x in mark]] = True
        cut[borders] = True
        starts = np.nonzero(cut)[0]
        count = np.diff(np.searchsorted(starts, borders))
        if n == 0:
            return count, np.zeros(0, np.int64), pa.array([], pa.binary())
        units = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = units.dictionary_encode()
        return count, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary

    def _distinct(self, units: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all distinct units in a row, and how many each has."""
        data, borders = text_bytes(units)
        data, borders = data.tobytes(), borders.tolist()
        units = [data[a:b] for a, b in zip(borders, borders[1:])]  # noqa: B905
        found = [*map(self.known.get, units)]
        missing = [k for k, x in enumerate(found) if x is None]
        fresh = self._fresh([units[k] for k in missing])
        for k, x in zip(missing, fresh, strict=True):
            found[k] = x
        room = _REMEMBERED - len(self.known)
        if room > 0:
            self.known.update(((units[k], x) for k, x in zip(missing[:room], fresh, strict=False) if len(units[k]) < 40))
        return np.frombuffer(b"".join(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found)) // 4

    def encode(self, text: pa.StringArray, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another (each with `end`, if given), and the n + 1 borders between rows."""
        count, index, units = self._units(text)
        flat, sizes = self._distinct(units) if len(units) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        size = sizes[index]
        upto = np.concatenate([[0], np.cumsum(size)])
        kind = np.int32 if upto[-1] + len(flat) < 1 << 31 else np.int64
        at = np.repeat(((np.cumsum(sizes) - sizes)[index] - upto[:-1]).astype(kind), size)
        at += np.arange(upto[-1], dtype=kind)
        ids = flat[at].astype(np.uint32, copy=False)
        borders = upto[np.concatenate([[0], np.cumsum(count)])]
        if end is not None:
            ids = np.insert(ids, borders[1:], end)
            borders = borders + np.arange(len(borders))
        return ids, borders


def tokenizer_json(path: str) -> str:
    """The tokenizer file's text, read by the driver: a fixed file of a few MB that travels with the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()
