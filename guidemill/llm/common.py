"""Shared pieces: the word kernel, and from the library written intermediate tables and connected components."""

from __future__ import annotations

import numpy as np

from guidemill.operators.components import components
from guidemill.sources.tables import remove, shared_dir, written

__all__ = ["combined", "components", "remove", "run_hashes", "shared_dir", "shingle_sets", "utf8_slices", "word_hashes", "written"]
MASK = (1 << 64) - 1


# ---------------------------------------------------------------- word kernel
def _splitmix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256)
_FOLD[0x41:0x5B] += 0x20
_BYTE = _splitmix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
_LOWER_BYTE = _BYTE[_FOLD]
_BASE = 0x9E3779B97F4A7C55
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    """Powers of the base, at least n of them."""
    global _powers
    if len(_powers) < n:
        size = max(256, 1 << int(n - 1).bit_length())
        with np.errstate(over="ignore"):
            _powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE, np.uint64)]))
    return _powers


def utf8_slices(column, budget: int = 1 << 18):
    """(first row, bytes, offsets of rows) for runs of rows of an Arrow string column, each of about `budget` bytes or one row.

    Null counts as empty. The word kernel takes some 60 bytes for each byte of a slice, which a worker then keeps."""
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + budget, "right")) - 1)
        to = min(to, len(column))
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def run_hashes(data: np.ndarray, first: np.ndarray, starts: np.ndarray, skip: np.ndarray | None = None, table: np.ndarray = _BYTE) -> np.ndarray:
    """64-bit hashes of the runs of bytes that begin at `starts` (where `first` is set); bytes of `skip` don't count."""
    place = np.arange(len(data)) - starts[np.maximum(np.cumsum(first) - 1, 0)]
    if skip is not None:
        place[skip] = 0
    np.maximum(place, 0, out=place)
    with np.errstate(over="ignore"):
        value = table[data] * _power(int(place.max()) + 1)[place]
        if skip is not None:
            value[skip] = 0
        return _splitmix(np.add.reduceat(value, starts))


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ of each row, the first word's index for each row and one more, and word starts.

    fold: A-Z count as a-z."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
    space = _SPACE[data]
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = space[:-1]
    inner = offsets[1:-1]
    first[inner[inner < n]] = True
    first &= ~space
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), starts
    hashes = run_hashes(data, first, starts, space, _LOWER_BYTE if fold else _BYTE)
    return hashes, np.searchsorted(starts, offsets), starts


def combined(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` neighbouring words; the i-th starts at word i."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, 0x632BE59BD9B4E019 + width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = _splitmix(out * np.uint64(0xD1342543DE82EF95) + hashes[k : k + n])
    return out


def shingle_sets(column, width: int):
    """For each row of an Arrow string column, the sorted distinct uint64 hashes of its word shingles (shorter texts: all words as one)."""
    for _, data, offsets in utf8_slices(column):
        hashes, first, _ = word_hashes(data, offsets)
        runs = combined(hashes, width)
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= width:
                yield np.unique(runs[a : b - width + 1])
            elif b > a:
                yield combined(hashes[a:b], int(b - a))
            else:
                yield np.zeros(0, np.uint64)

