"""Token ids of whole texts, by a public tokenizer, many texts at once.

Words repeat, and encoding one does not depend on its neighbours, so a task encodes each distinct
piece of text once and looks up the others. A text may be cut before any run of white space that
follows a character which is no white space: neither vocabulary's splitting rule has a match that
crosses such a place, and no special token holds white space. A full stop or comma between an ASCII
letter and white space is a match of its own as well. The pieces' ids in a row are then exactly the
ids of the whole text; tests compare them. Pieces are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from lossledger.llm import arrays as a

# Pieces that a task remembers, some 30 bytes each.
MEMORY = 1_500_000
# Longer pieces are encoded each time, so that memory stays bounded.
LONG = 256

_OPEN: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The encoder of a vocabulary file, one per Python worker."""
    if path not in _OPEN:
        _OPEN[path] = Encoder(path)
    return _OPEN[path]


class Encoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        """``keys`` are the hashes of the known pieces in order; the others tell their ids."""
        self.keys = np.zeros(0, np.uint64)
        self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        """Encodes new pieces together; ``keys`` are in order."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.starts = np.insert(self.starts, at, starts)
        self.sizes = np.insert(self.sizes, at, sizes)
        new = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        self.ids = np.append(self.ids, new)

    def _known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, bounds of each text in them) of consecutive texts; null is empty."""
        for row, data, offsets in a.text_slices(column):
            starts, ends, first = _pieces(data, offsets)
            keys, index, inverse = np.unique(a.hash_spans(data, starts, ends),
                                             return_index=True, return_inverse=True)
            new = ~self._known(keys)
            if new.any() and len(self.keys) + int(new.sum()) > MEMORY:
                self._forget()
                new[:] = True
            if new.any():
                raw, at = data.tobytes(), index[new]
                self._learn(keys[new], [raw[x:y].decode() for x, y in
                                        zip(starts[at].tolist(), ends[at].tolist())])
            place = np.searchsorted(self.keys, keys)
            size = self.sizes[place][inverse]
            ids = self.ids[a.ranges(self.starts[place][inverse], size)]
            yield row, ids, np.append(0, np.cumsum(size))[first]
            if (ends - starts).max(initial=0) > LONG:
                self._forget()


def _pieces(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, first piece of each text and one past the last) that cover every byte."""
    gap = a.SPACES[data]
    cut = np.zeros(len(data), bool)
    if len(data) > 1:
        cut[1:] = gap[1:] & ~gap[:-1]
        # A character of several bytes may itself be white space: U+0085 and U+00A0 begin with C2,
        # the others with E1, E2 or E3. Control characters 1C to 1F count as white space for some.
        cut[2:] &= data[:-2] != 0xC2
        cut[3:] &= ~((data[:-3] >= 0xE1) & (data[:-3] <= 0xE3))
        cut[1:] &= ~((data[:-1] >= 0x1C) & (data[:-1] <= 0x1F))
    if len(data) > 1:
        # A full stop or comma between an ASCII letter and white space is a piece of its own.
        mark = (data == 44) | (data == 46)
        mark[:-1] &= gap[1:]
        ends = offsets[1:][np.diff(offsets) > 0] - 1
        mark[-1] = mark[ends] = False
        letter = ((data | 32) >= 97) & ((data | 32) <= 122)
        cut[1:] |= mark[1:] & letter[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    cut[begins] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets)
