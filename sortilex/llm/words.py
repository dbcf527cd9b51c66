"""Words and shingles of an Arrow column of texts, as numpy arrays.

Words are runs of bytes other than space and 0x09 to 0x0D; no multi-byte
character of UTF-8 holds such a byte, so bytes and code points agree. Work goes
chunk by chunk, so memory follows the chunk (or the longest text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
SHINGLE_WORDS = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's last step)."""
    x = x + _U((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        inverse = pow(_BASE, -1, 2**64)
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * _U(pow(_BASE, k, 2**64))])
            self.down = np.concatenate([self.down, self.down * _U(pow(inverse, k, 2**64))])
        return self.up[:n], self.down[:n]


_powers = _Powers()


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums from which ``range_hashes`` takes the hash of any byte range."""
    up, _ = _powers.get(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * up, out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes in each range; equal bytes hash alike wherever they stand."""
    _, down = _powers.get(len(sums))
    value = (sums[ends] - sums[starts]) * down[starts]
    return mix(value ^ (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count or pa.types.is_null(column.type):
        column = pc.fill_null(column.cast(pa.large_string()), "")
    column = column.cast(pa.large_string()).cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_chunks(
    column: pa.Array, limit: int = CHUNK_BYTES
) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``limit`` bytes together: rows, bytes and offsets."""
    data, offsets = as_bytes(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(last, first + 1))
        yield (
            slice(first, last),
            data[offsets[first] : offsets[last]],
            offsets[first : last + 1] - offsets[first],
        )
        first = last


def small_batches(
    batches: Iterator[pa.RecordBatch], limit: int = 4 * CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes, so that what a task makes of them is small."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * limit / max(batch.nbytes, limit)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


@dataclass
class Words:
    """Words of several texts: byte ranges, and where each text's words begin."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return range_hashes(prefix_hashes(self.data), self.starts, self.ends)


def find_words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    """Words of the texts, A to Z in lower case if wanted; none crosses a text's end."""
    if lower:
        data = _LOWER[data]
    n = len(data)
    space = _SPACE[data]
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    before[edges] = True
    after[edges - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


_PLACE = [_U(2 * int(v) + 1) for v in mix(np.arange(64, dtype=np.uint64), 7) >> _U(1)]


def shingle_hashes(
    hashes: np.ndarray, first: np.ndarray, size: int = SHINGLE_WORDS
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words and where each text's runs begin.

    A text of fewer words gives its whole sequence as one; a text without words
    gives none. Runs stand in the order of their first word.
    """
    counts = np.diff(first)
    n_runs = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    run_first = np.concatenate([[0], np.cumsum(n_runs)])
    total = int(run_first[-1])
    at = np.arange(total) + np.repeat(first[:-1] - run_first[:-1], n_runs)
    end = np.repeat(first[1:], n_runs)
    value = np.zeros(total, np.uint64)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    for j in range(size):
        value += np.where(at + j < end, padded[at + j] * _PLACE[j], _U(0))
    return mix(value, 3), run_first


def per_batch(schema_names: list[str], types: list[pa.DataType]):
    """Builds a record batch from columns in the given order."""
    schema = pa.schema(list(zip(schema_names, types, strict=True)))

    def build(*columns) -> pa.RecordBatch:
        arrays = [
            c if isinstance(c, pa.Array) else pa.array(c, t)
            for c, t in zip(columns, types, strict=True)
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    return build
