"""Values of distinct pieces of text, each worked out once per worker and spread over the positions again."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .arrays import binary_array, gathered

# A worker keeps two generations of pieces, each of so many or so many bytes of pieces and values. When the young one is
# full it becomes the old one, and what was in neither again is forgotten; a piece met again is worked out again.
PIECES = 150_000
BYTES = 16 << 20


class Known:
    """``work`` turns distinct pieces into one value of bytes each."""

    def __init__(self, work: Callable[[list[bytes]], list[bytes]], pieces: int = PIECES, size: int = BYTES):
        self.work, self.pieces, self.size = work, pieces, size
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0

    def look_up(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bytes], list[bytes]]:
        """Number of the piece at each start, the distinct pieces, and their values."""
        coded = binary_array(data, np.append(starts, len(data))).dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        values = list(map(self.young.get, pieces))
        missing = [i for i, value in enumerate(values) if value is None]
        for i in missing:
            values[i] = self.old.get(pieces[i])
        new = [i for i in missing if values[i] is None]
        for i, value in zip(new, self.work([pieces[i] for i in new]) if new else ()):
            values[i] = value
        for i in missing:
            self.young[pieces[i]] = values[i]
            self.held += len(pieces[i]) + len(values[i])
        if len(self.young) > self.pieces or self.held > self.size:
            self.young, self.old, self.held = {}, self.young, 0
        return coded.indices.to_numpy(zero_copy_only=False), pieces, values

    def numbers(self, data: np.ndarray, starts: np.ndarray, kind: str = "<u4") -> tuple[np.ndarray, np.ndarray]:
        """Values read as numbers, joined in the order of the pieces, and how many each piece has."""
        codes, _, values = self.look_up(data, starts)
        flat = np.frombuffer(b"".join(values), kind)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // np.dtype(kind).itemsize
        return gathered(flat, (np.cumsum(sizes) - sizes)[codes], sizes[codes]), sizes[codes]


def with_space(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts as one array of bytes and bounds, each text that is not empty behind one space."""
    filled = np.diff(bounds) > 0
    return np.insert(data, bounds[:-1][filled], np.uint8(32)), bounds + np.concatenate([[0], np.cumsum(filled)])


def cuts(data: np.ndarray, bounds: np.ndarray, alone: np.ndarray | None = None) -> np.ndarray:
    """Starts of pieces: at each text, at a space behind a sign that is no white space, around bytes that stand ``alone``.

    Behind bytes above 127 there is a cut only where a letter of the ranges U+00C0 to U+07FF ends.
    """
    start = np.zeros(len(data) + 1, bool)
    start[bounds] = True
    if len(data) > 1:
        # Two-byte signs up to U+00BF include white space, those above hold none.
        ends = np.zeros(len(data), bool)
        ends[1:] = (data[1:] >= 128) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
        solid = ends | ((data > 32) & (data < 127))
        start[1:-1] |= (data[1:] == 32) & solid[:-1]
        if alone is not None:
            single = alone[data]
            start[:-1] |= single
            start[1:] |= single
    return np.flatnonzero(start[:-1])
