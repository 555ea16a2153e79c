"""Words, lines and their hashes of an Arrow text column, as NumPy arrays.

The helpers look at the UTF-8 bytes of many rows at once and never at a row's
characters one by one. Hashes are polynomial over a table of random 64-bit numbers
(all sums modulo 2^64) and mixed at the end, so that equal content has equal hashes
wherever it stands.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 512 << 10

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(values):
    """Spread 64-bit values over all bits; a bijection."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


class Family:
    """One hash function for byte ranges and for runs of hashes, chosen by its seed."""

    def __init__(self, seed):
        start = np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1234567) % 2**64)
        numbers = mix(np.arange(1, 259, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03) + start)
        self.table = numbers[:256]
        self.base = numbers[256] | np.uint64(1)
        self.inverse = np.uint64(pow(int(self.base), -1, 2**64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, size):
        if len(self.powers) < size:
            size = max(size, 1 << 16)
            for name, factor in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def _ranges(self, values, starts, ends):
        self._grow(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=sums[1:])
        found = (sums[ends] - sums[starts]) * self.inverses[starts]
        return mix(found + (ends - starts).astype(np.uint64) * self.table[0])

    def of_bytes(self, data, starts, ends):
        return self._ranges(self.table[data], starts, ends)

    def of_runs(self, hashes, starts, ends):
        """Hash of each run of hashes from start to end."""
        return self._ranges(hashes, starts, ends)


FIRST, SECOND = Family(1), Family(2)


class Chunk(NamedTuple):
    """Some consecutive rows: their bytes, and where each row begins in them."""

    first_row: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self):
        return len(self.offsets) - 1


def chunks(column, limit=CHUNK_BYTES):
    """Cut a string column into chunks of about the limit; a longer row stands alone."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(max(stop, row + 1), len(column))
        part = offsets[row : stop + 1]
        yield Chunk(row, data[part[0] : part[-1]], part - part[0])
        row = stop


class Words(NamedTuple):
    """Byte range and row of each word; `first` has each row's first word and the end."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray


def words(chunk):
    """Maximal runs of bytes other than space, tab, line feed to carriage return."""
    inside = ~SPACE[chunk.data]
    size = len(inside)
    edge = np.zeros(size + 1, bool)
    edge[chunk.offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:size]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:size]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(closes) + 1
    first = np.searchsorted(starts, chunk.offsets)
    row = np.repeat(np.arange(chunk.rows), np.diff(first))
    return Words(starts, ends, row, first)


def runs(found, length):
    """First word of every run of `length` words that stays within its row."""
    size = len(found.starts)
    if size < length:
        return np.zeros(0, np.int64)
    index = np.arange(size - length + 1)
    return index[found.row[index] == found.row[index + length - 1]]


class Lines(NamedTuple):
    """Byte range, row and number within the row of each line."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    number: np.ndarray


def lines(chunk):
    """Rows split at line feeds; an empty row is one empty line."""
    breaks = np.flatnonzero(chunk.data == 10)
    starts = np.sort(np.concatenate([chunk.offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, chunk.offsets[1:]]))
    each = np.diff(np.searchsorted(breaks, chunk.offsets)) + 1
    row = np.repeat(np.arange(chunk.rows), each)
    number = np.arange(len(starts)) - np.repeat(np.cumsum(each) - each, each)
    return Lines(starts, ends, row, number)


def stripped(chunk, starts, ends):
    """The ranges without white space at either end."""
    solid = np.flatnonzero(~SPACE[chunk.data])
    if not len(solid):
        return starts, starts
    low = np.searchsorted(solid, starts)
    high = np.searchsorted(solid, ends) - 1
    some = high >= low
    new_starts = np.where(some, solid[np.minimum(low, len(solid) - 1)], starts)
    new_ends = np.where(some, solid[high] + 1, starts)
    return new_starts, new_ends


def signed(values):
    return values.view(np.int64)


def rows_of(frame, schema):
    """An Arrow batch from a dictionary of columns."""
    return pa.RecordBatch.from_arrays(
        [value if isinstance(value, pa.Array) else pa.array(value, field.type) for value, field in zip(frame, schema)],
        schema=schema,
    )
