"""Arrow text columns as flat byte arrays: word spans, word hashes and shingle hashes without a Python object per word.

Words are runs of bytes other than space and 0x09-0x0D, so spans found in UTF-8 bytes are word boundaries in code points too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # text handled at once; temporaries are about 100 bytes per byte of text
_U = np.uint64
_RNG = np.random.default_rng(20240607)
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
PLACE_CODE = _RNG.integers(1, 2**63, 16, dtype=np.uint64) | _U(1)
BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
LETTER = np.zeros(256, bool)
LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; one to one."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            inverse = pow(BASE, -1, 2**64)
            self.up = np.cumprod(np.r_[_U(1), np.full(2 * n, BASE, np.uint64)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[_U(1), np.full(2 * n, inverse, np.uint64)], dtype=np.uint64)
        return self.up, self.down


_POWERS = _Powers()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the row offsets into them; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of text; a longer text stands alone, whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(size) - size) // most
        cuts = np.r_[0, np.flatnonzero(np.diff(group)) + 1, batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(a, b - a)


def span_hasher(data: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function from starts and ends to 64-bit hashes of those byte spans."""
    up, down = _POWERS.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * up[:len(data)], out=total[1:])
    return lambda starts, ends: mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hasher(data)(starts, ends)


@dataclass
class Words:
    data: np.ndarray  # bytes, lower-cased if asked
    offsets: np.ndarray  # of rows
    starts: np.ndarray  # of words
    ends: np.ndarray
    row: np.ndarray  # row of each word
    bounds: np.ndarray  # first word of each row, and the number of words

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.ends)


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of True that do not cross row boundaries."""
    before = np.r_[False, inside[:-1]] if len(inside) else inside.copy()
    before[offsets[:-1][offsets[:-1] < len(inside)]] = False
    after = np.r_[inside[1:], False] if len(inside) else inside.copy()
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def split_words(column: pa.Array, lower: bool = True, space: np.ndarray = SPACE) -> Words:
    data, offsets = flat(column)
    if lower:
        data = LOWER[data]
    starts, ends = spans(~space[data], offsets)
    row = np.searchsorted(offsets, starts, side="right") - 1
    return Words(data, offsets, starts, ends, row, np.searchsorted(row, np.arange(len(offsets))))


def split_letters(column: pa.Array) -> Words:
    """Words of letters, digits and bytes beyond ASCII in lower case, so that punctuation, spacing and case make no difference.

    Capitals of the Latin-1 block are lowered too (second byte 0x80-0x9E after 0xC3, but the multiplication sign).
    """
    data, offsets = flat(column)
    data = LOWER[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    data[after[(data[after] <= 0x9E) & (data[after] != 0x97) & (data[after] >= 0x80)]] += 0x20
    starts, ends = spans(LETTER[data], offsets)
    row = np.searchsorted(offsets, starts, side="right") - 1
    return Words(data, offsets, starts, ends, row, np.searchsorted(row, np.arange(len(offsets))))


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word shingles in text order and the first shingle of each row.

    A row with fewer words has one shingle, its whole sequence; a row without words has none.
    """
    code, n = words.hashes(), len(words.starts)
    count = np.diff(words.bounds)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(count) + 1, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(min(width, n)):
        total[:n - k] += code[k:] * PLACE_CODE[k]
    last = words.row
    whole = np.zeros(n, bool)
    if n >= width:
        whole[:n - width + 1] = last[width - 1:] == last[:n - width + 1]
    short = np.flatnonzero((count > 0) & (count < width))
    for r in short:  # fewer words than a shingle: at most width - 1 additions each
        a, b = words.bounds[r], words.bounds[r + 1]
        total[a] = (np.r_[code[a:b], _U(b - a)] * np.r_[PLACE_CODE[:b - a], PLACE_CODE[width]]).sum(dtype=np.uint64)
    keep = whole
    keep[words.bounds[short]] = True
    at = np.flatnonzero(keep)
    return mix(total[at]), np.searchsorted(words.row[at], np.arange(words.rows + 1))


def list_column(flat_values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """array<bigint> column from concatenated values and row bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat_values.view(np.int64) if flat_values.dtype == np.uint64 else flat_values.astype(np.int64)))
