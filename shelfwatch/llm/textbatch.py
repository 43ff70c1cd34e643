"""Text columns of Arrow batches as numpy bytes, and the words in them.

Work goes through small runs of rows, so that a task holds a few megabytes
besides its Arrow batch however long the table is; a text longer than a run is a
run of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

#: A-Z to a-z, every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words: digits, letters and everything beyond ASCII.
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[48:58] = WORD_BYTE[65:91] = WORD_BYTE[97:123] = True
WORD_BYTE[128:] = True


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row starts; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), at


def runs(column: pa.Array, size: int = RUN_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of about *size* bytes: first row, bytes, row starts from 0."""
    if not len(column):
        return
    data, at = utf8(column)
    first, rows = 0, len(at) - 1
    while first < rows:
        last = int(np.searchsorted(at, at[first] + size, "right")) - 1
        last = min(rows, max(first + 1, last))
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> None:
        if len(cls.up) < n:
            n = max(n, 2 * RUN_BYTES)
            cls.up, cls.down = (
                np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n - 1, b))])
                for b in (_BASE, _BASE_INVERSE)
            )


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all 64 bits of a polynomial hash."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which :func:`span_hash` takes the hash of any span."""
    _Powers.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _Powers.up[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, the same wherever they stand."""
    return mix((sums[end] - sums[start]) * _Powers.down[start])


def spans(member: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest stretches of *member* bytes that do not cross rows: start, end, row."""
    if not len(member):
        none = np.zeros(0, np.int64)
        return none, none, none
    opens, closes = member.copy(), member.copy()
    opens[1:] &= ~member[:-1]
    closes[:-1] &= ~member[1:]
    inner = at[(at > 0) & (at < len(member))]
    opens[inner] |= member[inner]
    closes[inner - 1] |= member[inner - 1]
    start = np.flatnonzero(opens)
    return start, np.flatnonzero(closes) + 1, np.searchsorted(at, start, "right") - 1
