"""Token ids of whole texts by the tokenizers library, with a memory for pieces seen before.

Texts are cut only where the tokenizer's own splitting pattern cuts whatever stands beside it, every
distinct piece is encoded once by the library, and ids are put together by indexing. Texts with
characters for which the cuts aren't certain go to the library whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from llm.text import LOWER, SPACE, binary_array, buffers, bytes_list

#: Pieces kept in a worker's memory, and the bytes of the longest one that is kept.
MEMORY, LONGEST = 800_000, 48
_LETTER, _DIGIT, _BLANK, _OTHER = 0, 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[SPACE] = _BLANK
_CLASS[128:] = _LETTER
_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaces: bool) -> Encoder:
    """The worker's encoder for this file. spaces: white space is part of the tokens."""
    if (path, spaces) not in _ENCODERS:
        _ENCODERS[path, spaces] = Encoder(path, spaces)
    return _ENCODERS[path, spaces]


def forget() -> None:
    """Free the worker's memory of pieces, for tasks of operators that come after."""
    _ENCODERS.clear()


def _unsure(data: np.ndarray) -> np.ndarray:
    """Bytes of characters other than ASCII and the letters U+00C0 to U+00FF."""
    high = data >= 0x80
    if not high.any():
        return high
    lead = data == 0xC3
    follow = np.zeros_like(lead)
    follow[1:] = lead[:-1]
    return high & ~(lead | (follow & (data != 0x97) & (data != 0xB7)))


class Encoder:
    def __init__(self, path: str, spaces: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.spaces = spaces
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [self.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]

    def _learn(self, pieces: list[bytes]) -> None:
        new = self._library([p.decode("utf-8") for p in pieces])
        lengths = np.fromiter(map(len, new), np.int64, len(new))
        ends = len(self.ids) + np.cumsum(lengths)
        self.starts = np.concatenate([self.starts, ends - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        flat = np.fromiter((i for ids in new for i in ids), np.uint32, int(lengths.sum()))
        self.ids = np.concatenate([self.ids, flat])
        for p in pieces:
            self.known[p] = len(self.known)

    def _cuts(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where to cut, and for each row whether it must go to the library whole."""
        n = len(data)
        kind = _CLASS[data]
        odd = _unsure(data)
        row = np.searchsorted(off, np.flatnonzero(odd), "right") - 1
        whole = np.zeros(len(off) - 1, bool)
        whole[row] = True
        cut = np.zeros(n + 1, bool)
        cut[1:n] = kind[1:] != kind[:-1]
        blank = kind == _BLANK
        edge = np.zeros(n + 1, bool)  # edges of runs without white space
        edge[1:n] = blank[1:] != blank[:-1]
        edge[off] = True
        quotes = np.flatnonzero(data == 0x27)
        if len(quotes):  # contractions: keep the run in one piece
            run = np.cumsum(edge[:n])
            held = np.zeros(run[-1] + 1, bool)
            held[run[quotes]] = True
            cut[:n] &= ~held[run]
        cut |= edge
        if self.spaces:
            # A space directly before a run belongs to it; the rest of the white space stands alone.
            starts = np.flatnonzero(edge[:n] & ~blank)
            inside = np.zeros(n + 1, bool)
            inside[off] = True
            lead = starts[(starts > 0) & ~inside[starts]]
            lead = lead[data[lead - 1] == 0x20]
            cut[lead] = False
            cut[lead - 1] = True
            inside[lead] = True
            alone = starts[(starts > 0) & ~inside[starts]]  # a run after other white space: its last byte is cut off
            cut[alone - 1] = True
        cut[off] = True
        return np.flatnonzero(cut), whole

    @staticmethod
    def _lowered(data: np.ndarray, off: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Lower case for A-Z and U+00C0 to U+00DE, as the tokenizer does itself, so that fewer pieces differ."""
        out = LOWER[data]
        second = np.flatnonzero(data[:-1] == 0xC3) + 1
        second = second[(data[second] <= 0x9E) & (data[second] != 0x97)]
        out[second] += 32
        for row in np.flatnonzero(whole).tolist():
            out[off[row] : off[row + 1]] = data[off[row] : off[row + 1]]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the offset of every text in them, one more at the end."""
        data, off = buffers(texts)
        rows = len(off) - 1
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(rows + 1, np.int64)
        data = np.ascontiguousarray(data)
        cuts, whole = self._cuts(data, off)
        if not self.spaces:
            data = self._lowered(data, off, whole)
        if whole.any():  # one piece for the row
            inner = np.searchsorted(off, cuts, "right") - 1
            at_edge = np.isin(cuts, off)
            cuts = cuts[at_edge | ~whole[np.minimum(inner, rows - 1)]]
        if not self.spaces:
            blank = SPACE[data[cuts[:-1]]]
            blank[np.searchsorted(cuts, off[:-1][whole])] = False  # such a row is the one piece that starts with it
        pieces = binary_array(data, cuts)
        starts = cuts[:-1]
        if not self.spaces:
            pieces, starts = pieces.filter(pa.array(~blank)), starts[~blank]
        coded = pieces.dictionary_encode()
        distinct = bytes_list(coded.dictionary)
        if len(self.known) > MEMORY:
            self._forget()
        new = [p for p in distinct if p not in self.known]
        self._learn([p for p in new if len(p) <= LONGEST])
        kept = len(self.starts), len(self.ids)
        once = [p for p in new if len(p) > LONGEST]
        self._learn(once)
        place = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        piece = place[coded.indices.to_numpy(zero_copy_only=False)]
        lengths = self.lengths[piece]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[piece] - (ends - lengths), lengths) + np.arange(total)
        ids = self.ids[at]
        bounds = np.concatenate([[0], ends])[np.searchsorted(starts, off)]
        for p in once:  # long pieces hardly come again
            del self.known[p]
        self.starts, self.lengths, self.ids = self.starts[: kept[0]], self.lengths[: kept[0]], self.ids[: kept[1]]
        return ids, bounds
