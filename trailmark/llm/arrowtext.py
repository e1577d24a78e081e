"""Words, spans and hashes of whole Arrow string columns at once.

A batch is handled as one byte array with document offsets, so there is no Python loop over
words. White space is the ASCII set ``[\\x20\\x09-\\x0D]``; every other byte belongs to a word,
which makes the work on UTF-8 bytes the same as on characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
STEP = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: A 64-bit code for each byte, and the same with A-Z as a-z.
CODE = mix((np.arange(1, 257, dtype=U64)) * U64(STEP))
FOLD = CODE.copy()
FOLD[65:91] = CODE[97:123]

_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    if _powers[0].size < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((STEP, pow(STEP, -1, 1 << 64))):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=U64)
    return _powers


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = CODE) -> np.ndarray:
    """A 64-bit hash of each byte span, from one prefix sum over the whole array."""
    power, inverse = _power_tables(data.size + 1)
    sums = np.zeros(data.size + 1, U64)
    np.cumsum(codes[data] * power[: data.size], dtype=U64, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def text_slices(column: pa.Array, most: int = 2_000_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column (nulls as empty) into runs of rows of about ``most`` bytes.

    Yields first row, row behind the last, the bytes and the row offsets into them.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    whole = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1)
        high = min(high, n)
        yield low, high, whole[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def words(data: np.ndarray, offsets: np.ndarray, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each document the index of its first word (one more at the end).

    Where ``cut`` is true, a word is parted before that byte.
    """
    n = data.size
    solid = ~SPACE[data]
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(offsets.size, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:n]
    last[:-1] &= ~solid[1:] | edge[1:n]
    if cut is not None:
        first |= cut
        last[:-1] |= cut[1:]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def window_hashes(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k``-word windows; a document of fewer words (but one) gives its whole sequence as one.

    Returns the hashes and, as ``bounds``, where each document's windows begin.
    """
    counts = np.diff(bounds)
    windows = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    starts = np.concatenate([[0], np.cumsum(windows)])
    if not starts[-1]:
        return np.zeros(0, U64), starts
    at = np.arange(starts[-1]) - np.repeat(starts[:-1] - bounds[:-1], windows)
    end = np.repeat(bounds[1:], windows)
    padded = np.concatenate([hashes, np.zeros(k, U64)])
    total = np.zeros(at.size, U64)
    for i in range(k):
        total = total * U64(0xC2B2AE3D27D4EB4F) + np.where(at + i < end, padded[at + i], U64(0)) + U64(i)
    return mix(total), starts


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each run, one run behind the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return np.arange(total) + shift
