"""Words, hashes and shingles of Arrow text columns, vectorised over the column's own bytes.

A column's UTF-8 buffer is used as it is; a null text counts as empty. Separators are ASCII bytes,
so cutting bytes cuts code points alike. Work goes in slices of a megabyte (one text at least),
which bounds memory whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from medallion.llm.workers import forgets

SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_POWERS: dict[str, np.ndarray] = {}
forgets(_POWERS.clear)


def byte_table(*, lower: bool = True, separators: bytes = SPACES) -> np.ndarray:
    """Value of each byte in a hash; 0 marks a separator."""
    table = np.arange(1, 257, dtype=np.uint64)
    if lower:
        table[65:91] = table[97:123]
    table[np.frombuffer(separators, np.uint8)] = 0
    return table


WORD_TABLE = byte_table()
RAW_TABLE = byte_table(lower=False, separators=b"")
#: Words without ASCII punctuation, for classifiers.
LETTER_TABLE = byte_table(separators=bytes(b for b in range(128) if not chr(b).isalnum()))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets between them."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with at most ``limit`` bytes, or one row."""
    if not len(column):
        return
    data, offsets = text_buffer(column)
    first, rows = 0, len(column)
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = np.asarray(values, np.uint64)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < size:
        size = max(size, SLICE_BYTES + 1)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each ascending span, independent of where it stands."""
    out = np.empty(len(start), np.uint64)
    first = 0
    while first < len(start):
        base = start[first]
        last = max(int(np.searchsorted(end, base + SLICE_BYTES, side="right")), first + 1)
        low, high = start[first:last] - base, end[first:last] - base
        up, down = _powers(int(high[-1]) + 1)
        sums = np.zeros(int(high[-1]) + 1, np.uint64)
        np.cumsum(table[data[base : base + high[-1]]] * up[: high[-1]], out=sums[1:])
        out[first:last] = mix((sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64))
        first = last
    return out


def word_spans(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray, cuts: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of each text's first word (one more than texts).

    ``cuts`` marks bytes, one flag each, before which a word is cut as well.
    """
    inside = (table != 0)[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    if cuts is not None:
        begins |= cuts
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets)


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words within a text, and the index of each text's first one.

    A text with fewer words has one shingle, its whole sequence; a text without words has none.
    """
    count = np.diff(first)
    shingles = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    begin = np.concatenate([[0], np.cumsum(shingles)])
    at = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], shingles)
    have = np.repeat(np.minimum(count, size), shingles)
    total = have.astype(np.uint64) * np.uint64(BASE)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    for k in range(size):
        factor = np.uint64(pow(BASE, k + 2, 1 << 64))
        total += np.where(k < have, padded[at + k], np.uint64(0)) * factor
    return mix(total), begin
