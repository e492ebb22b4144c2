"""Text columns as flat byte arrays: the vectorised helpers that the tasks of several operators share.

A null text counts as empty everywhere. Tasks work on slices of a few megabytes of text, whatever the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
# ASCII upper case to lower case, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the offset of each text (one more at the end)."""
    binary = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = binary.buffers()
    bounds = np.frombuffer(offsets, np.int64)[binary.offset : binary.offset + len(binary) + 1]
    if data is None or len(binary) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(binary) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a part has at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_binary())), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False)) if len(batch) else np.zeros(0, np.int64)
        start = 0
        while start < len(batch):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows in as few parts of at most ``limit`` bytes of text as their order allows."""
    held, size = [], 0
    for part in slices(batches, column, limit):
        own = part.column(column).nbytes
        if held and size + own > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(part)
        size += own
    if held:
        yield pa.concat_batches(held)


def give_back() -> None:
    """Hands unused memory of this worker to the system, as it outlives its task: Arrow's, then what numpy and Python freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow array whose values are ``data`` cut at ``offsets``; no copy."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    )


class Words:
    """Words of some texts: maximal runs of bytes for which ``is_word`` holds.

    ``data`` holds the words without what is between them, ``offsets`` their bounds in it, ``starts`` and
    ``ends`` their bounds in the texts, ``docs`` the number of the first word of each text (one more at the end).
    """

    def __init__(self, data: np.ndarray, doc_offsets: np.ndarray, is_word: np.ndarray):
        mask = is_word[data]
        padded = np.zeros(len(data) + 1, bool)
        padded[:-1] = mask
        first = mask.copy()
        first[1:] &= ~mask[:-1]
        inner = doc_offsets[1:-1]
        inner = inner[inner < len(data)]
        first[inner] |= mask[inner]
        self.starts = np.flatnonzero(first)
        stop = padded[1:].copy()
        stop[self.starts[self.starts > 0] - 1] = False
        self.ends = np.flatnonzero(mask & ~stop) + 1
        self.data = data[mask]
        self.offsets = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=self.offsets[1:])
        self.docs = np.searchsorted(self.starts, doc_offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """Number of each word in the list of distinct words, and that list."""
        encoded = binary_array(self.data, self.offsets).dictionary_encode()
        return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary


def gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``data[s : s + n]`` for every pair of a start and a length, joined."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return data[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread unsigned 64-bit hash of unsigned 64-bit numbers (finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
