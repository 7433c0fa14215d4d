"""Words and word shingles of texts as arrays of 64-bit keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from govmill.llm import ragged

#: White space between words (fixed values: blank and \x09 to \x0D).
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Letters, digits and every byte of a longer code point.
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null rows are empty."""
    column = pa.compute.fill_null(column, "").cast(pa.large_binary())
    data = column.buffers()[2]
    offset = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offset[0]: offset[-1]], offset - offset[0]


def word_keys(flat: np.ndarray, offset: np.ndarray, letters_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the lower-cased (A-Z) words of every row, and bounds: row i has those from bound[i] to bound[i + 1].

    Words lie between white space; with `letters_only` they are runs of letters, digits and non-ASCII.
    """
    inside = np.zeros(len(flat) + 2, bool)
    inside[1:-1] = _WORD[flat] if letters_only else ~_BLANK[flat]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    first = offset[:-1][offset[1:] > offset[:-1]]
    begins[first] = inside[1:-1][first]
    ends[first[first > 0] - 1] = inside[1:-1][first[first > 0] - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    keys = ragged.piece_keys(_LOWER[flat], start, end)
    return keys, np.searchsorted(start, offset)


def shingle_keys(keys: np.ndarray, bound: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, first word) of all shingles; a row with fewer words has one: its whole sequence."""
    count = np.diff(bound)
    at = np.arange(len(keys))
    row = np.repeat(np.arange(len(count)), count)
    room = bound[1:][row] - at
    full = np.flatnonzero(room >= size)
    total = np.zeros(len(full), np.uint64)
    for j in range(size):
        total = ragged.mixed(total * np.uint64(31) + keys[full + j])
    short = np.flatnonzero((count > 0) & (count < size))
    rest = np.zeros(len(short), np.uint64)
    for j in range(size - 1):
        has = count[short] > j
        step = ragged.mixed(rest * np.uint64(31) + keys[np.minimum(bound[short] + j, len(keys) - 1)]) if len(keys) else rest
        rest = np.where(has, step, rest)
    # Tells the one shingle of a short text from the first words of others.
    rest = ragged.mixed(rest + count[short].astype(np.uint64))
    return np.concatenate([total, rest]), np.concatenate([row[full], short]), np.concatenate([full, bound[short]])


def shingle_sets(column: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles of each row, sorted by key, one row after another, and the bounds of the rows."""
    flat, offset = column_bytes(column)
    keys, bound = word_keys(flat, offset)
    key, row, _ = shingle_keys(keys, bound, size)
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    keep = np.ones(len(key), bool)
    keep[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    key, row = key[keep], row[keep]
    return key, np.searchsorted(row, np.arange(len(column) + 1))


def slices(batch: pa.RecordBatch, text: str, limit: int = ragged.CHUNK) -> list[pa.RecordBatch]:
    """Parts of a batch with about `limit` bytes of text each."""
    size = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    cuts = [0, *(np.flatnonzero(np.diff(size // limit)) + 1).tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]


def windows(flat: np.ndarray, offset: np.ndarray, letters_only: bool = False, limit: int = ragged.CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of about `limit` bytes that take no word apart, also within one row."""
    at, n = 0, len(flat)
    while at < n:
        end = min(at + limit, n)
        while end < n:
            row_end = int(offset[np.searchsorted(offset, end)])
            look = flat[end: min(row_end, end + 4096)]
            gap = np.flatnonzero(~_WORD[look] if letters_only else _BLANK[look])
            if len(gap) or row_end <= end + 4096:
                end = end + int(gap[0]) if len(gap) else row_end
                break
            end += 4096
        yield at, end
        at = end
