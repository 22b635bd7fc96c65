"""Runs of bytes of whole texts as Arrow arrays, a bounded piece of the texts at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes worked on at a time; a text that cannot be cut within them is worked on up to its next cut.
PIECE = 1 << 22


def pieces(at: np.ndarray, cuts: Callable[[int, int], np.ndarray], size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Byte ranges that cover the texts, whose offsets are ``at``: whole texts where they fit, else parts of one text.

    ``cuts``: places between two bytes of a text, exclusive of both, where it may be cut."""
    low, end = int(at[0]), int(at[-1])
    while low < end:
        high = min(low + size, end)
        text_end = int(at[np.searchsorted(at, high, "right") - 1])
        if text_end > low:
            high = text_end
        else:
            stop = int(at[np.searchsorted(at, low, "right")])
            seen = low
            while len(found := cuts(seen, high)) == 0 and high < stop:
                seen, high = max(low, high - 4), min(high + size, stop)
            if len(found):
                high = int(found[-1])
        yield low, high
        low = high


def spans(inside: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every run of True; no run goes on over a border."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Bytes cut at n + 1 offsets, as n binary values."""
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def dictionary(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(code of each value, the distinct values)."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def letter_table(separators: np.ndarray) -> np.ndarray:
    """For every byte what it counts as: itself, A-Z in lower case, 0 for separators."""
    counts_as = np.arange(256, dtype=np.uint8)
    counts_as[ord("A") : ord("Z") + 1] += 32
    counts_as[separators] = 0
    return counts_as
