"""Word hashes of whole texts, worked out on Arrow buffers with numpy inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from layerloom.llm.common import travels

travels(__name__)

# Bytes of text worked on at once; a longer text is cut between words.
PIECE = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, dtype=bool)
    word[48:58] = word[65:91] = word[97:123] = word[128:] = True
    return lower, word


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the hash base and of its inverse, kept for pieces of the usual size."""
    if "up" not in _POWERS or len(_POWERS["up"]) <= n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            powers = np.full(max(n, PIECE) + 1, base)
            powers[0] = 1
            _POWERS[name] = np.multiply.accumulate(powers)
    return _POWERS["up"][: n + 1], _POWERS["down"][: n + 1]


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of A to Z and of the accented Latin-1 letters in UTF-8."""
    lower, _ = _tables()
    out = lower[data]
    accent = np.flatnonzero(data[:-1] == 0xC3) + 1
    high = accent[(data[accent] >= 0x80) & (data[accent] <= 0x9E) & (data[accent] != 0x97)]
    out[high] += 0x20
    return out


def rows_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(data: np.ndarray, at: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The rows in runs of about ``size`` bytes: first row, bytes and offsets of each run.

    A run may begin and end inside a row, always next to a space.
    """
    row, start = 0, 0
    while row < len(at) - 1:
        stop = min(start + size, int(at[-1] if start == at[row] else at[row + 1]))
        last = int(np.searchsorted(at, stop, side="right")) - 1
        if last > row:
            stop, nxt = int(at[last]), last
        else:
            spaces = np.flatnonzero(data[start:stop] <= 0x20)
            stop = start + int(spaces[-1]) + 1 if len(spaces) and stop < at[row + 1] else int(at[row + 1])
            nxt = row + (stop == at[row + 1])
        inner = at[row + 1 : nxt + 1] if nxt > row else at[:0]
        offsets = np.concatenate([[start], inner[inner < stop], [stop]]) - start
        yield row, data[start:stop], offsets.astype(np.int64)
        row, start = nxt, stop


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (letters and digits, lower-cased) and the row it is in."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = lowered(data)
    word = _tables()[1][low]
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    edges = at[(at > 0) & (at < n)]
    starts[edges] |= word[edges]
    ends[edges - 1] |= word[edges - 1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    h = (sums[e] - sums[s]) * down[s]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h, np.searchsorted(at, s, side="right") - 1


def row_words(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows: first row, row count, word hashes and the row of each (from 0 in the run)."""
    data, at = rows_of(column)
    held: list[np.ndarray] = []
    open_row = None
    for row, part, offsets in pieces(data, at, size):
        h, r = word_hashes(part, offsets)
        whole = row + len(offsets) - 1
        goes_on = offsets[-1] + (part.ctypes.data - data.ctypes.data) < at[whole] if len(data) else False
        if goes_on or open_row is not None:
            # A text of several pieces is put together from its words.
            held.append(h)
            open_row = row
            if not goes_on:
                joined = np.concatenate(held)
                yield row, 1, joined, np.zeros(len(joined), np.int64)
                held, open_row = [], None
            continue
        yield row, len(offsets) - 1, h, r
