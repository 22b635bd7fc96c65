"""Words of whole texts as numpy arrays, read straight from Arrow buffers.

A word is a run of bytes outside a set of ASCII separators; A-Z count as a-z.
Every word becomes a 64-bit number: a polynomial over its bytes, taken from one
running sum over a piece of text, then mixed. Equal words have equal numbers;
different words share one with a chance of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes worked on at a time. Longer texts are cut between two words.
PIECE = 1 << 20

#: The multipliers of the splitmix64 finaliser, and an odd base.
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
BASE = np.uint64(0x9E3779B97F4A7C15)

WHITESPACE = (0x20, *range(0x09, 0x0E))
#: All ASCII but letters and digits.
NOT_ALPHANUMERIC = (*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_1
    x = x ^ (x >> np.uint64(27))
    x = x * MIX_2
    return x ^ (x >> np.uint64(31))


def byte_values(separators: Iterable[int]) -> np.ndarray:
    """A number for every byte, 0 for separators, the same for both cases of A-Z."""
    values = mixed(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    values[list(separators)] = 0
    return values


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and its inverse modulo 2^64, for i below n."""
    if len(_powers[0]) < n:
        size = max(n, PIECE + 1)
        for k, base in enumerate((int(BASE), pow(int(BASE), -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 offsets into them; null is empty."""
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), at


def _pieces(values: np.ndarray, data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges that cover the texts and cut none of their words."""
    low, end = int(at[0]), int(at[-1])
    while low < end:
        high = min(low + PIECE, end)
        if high < end:
            text_end = int(at[np.searchsorted(at, high, "right") - 1])
            if text_end > low:
                high = text_end
            else:
                gaps = np.flatnonzero(values[data[low:high]] == 0)
                while not len(gaps) and high < end:
                    seen, high = high, min(high + PIECE, int(at[np.searchsorted(at, high, "right")]))
                    gaps = np.flatnonzero(values[data[seen:high]] == 0) + (seen - low)
                    if not len(gaps) and high in at:
                        break
                if len(gaps):
                    high = low + int(gaps[-1]) + 1
        yield low, high
        low = high


def words(texts: pa.Array, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of every word in order, how many words each text has)."""
    data, at = text_buffers(texts)
    found, owners = [], []
    for low, high in _pieces(values, data, at):
        key = values[data[low:high]]
        inside = key != 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        borders = at[(at > low) & (at < high)] - low
        first[borders] = inside[borders]
        last[borders - 1] = inside[borders - 1]
        start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        if len(start):
            power, inverse = powers(high - low)
            key *= power
            total = np.empty(high - low + 1, np.uint64)
            total[0] = 0
            np.cumsum(key, out=total[1:])
            found.append(mixed((total[stop] - total[start]) * inverse[start]))
            owners.append(np.searchsorted(at, start + low, "right") - 1)
    n = len(texts)
    if not found:
        return np.empty(0, np.uint64), np.zeros(n, np.int64)
    return np.concatenate(found), np.bincount(np.concatenate(owners), minlength=n)


def slices(counts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts holding at most ``most`` words together, or one longer text."""
    ends = np.cumsum(counts)
    low = 0
    while low < len(counts):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + most, "right")))
        yield low, high
        low = high


def shingles(numbers: np.ndarray, size: int) -> np.ndarray:
    """The distinct runs of ``size`` words, sorted; a shorter text is one run."""
    n = len(numbers)
    if not n:
        return numbers
    width = min(size, n)
    run = numbers[: n - width + 1].copy()
    for k in range(1, width):
        run = mixed(run * BASE + numbers[k : n - width + 1 + k])
    return np.unique(mixed(run + np.uint64(width)))
