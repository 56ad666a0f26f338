"""Words of whole Arrow batches, without a Python object per word.

A batch's text is one byte buffer. Words are found in it by a table of the
separating bytes, hashed to 64 bits from prefix sums, and looked up in an
open-addressing table of numpy arrays; only words not met before are handled
one by one. Words are told apart by their hash and length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from .repeats import mixed

_STEP = 1 << 18
#: Longer words are hashed by themselves.
_LONGEST = 1 << 12
_K = 0xD6E8FEB86659FD93
#: A 64-bit symbol per byte, and the powers that weight them by place.
_SYMBOLS = mixed(np.arange(1, 257, dtype=np.uint64))


def _powers(k: int) -> np.ndarray:
    p = np.full(_STEP + _LONGEST, k, np.uint64)
    p[0] = 1
    return np.cumprod(p)


_UP, _DOWN = _powers(_K), _powers(pow(_K, -1, 1 << 64))


def byte_set(values) -> np.ndarray:
    """Membership table of byte values."""
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


#: The six ASCII white-space characters.
WHITE = byte_set([9, 10, 11, 12, 13, 32])


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string or binary column; null rows are empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind, width = pa.large_binary(), np.int64
    else:
        kind, width = pa.binary(), np.int32
    column = column.cast(kind).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def runs(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of other bytes, none across rows."""
    inside = ~separators[data]
    opens, ends = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = np.flatnonzero(np.diff(offsets) > 0)
    first, last = offsets[filled], offsets[filled + 1] - 1
    opens[first], ends[last] = inside[first], inside[last]
    return np.flatnonzero(opens), np.flatnonzero(ends) + 1


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many starts each row has."""
    return np.diff(np.searchsorted(starts, offsets))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run, never 0."""
    out = np.zeros(len(starts), np.uint64)
    cuts = np.flatnonzero(np.diff(starts // _STEP)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(starts)]):
        if a == b:
            continue
        low = int(starts[a])
        high = min(int(ends[b - 1]), low + len(_UP))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_SYMBOLS[data[low:high]] * _UP[:high - low], out=sums[1:])
        s, e = starts[a:b] - low, np.minimum(ends[a:b] - low, high - low)
        out[a:b] = mixed((sums[e] - sums[s]) * _DOWN[s] + (e - s).astype(np.uint64))
    for k in np.flatnonzero(ends - starts > _LONGEST):
        digest = hashlib.blake2b(data[starts[k]:ends[k]], digest_size=8).digest()
        out[k] = int.from_bytes(digest, "little")
    out[out == 0] = 1
    return out


class Table:
    """64-bit key -> row number, counted from 0 in the order of arrival."""

    def __init__(self, size: int = 1 << 16):
        self.rows = 0
        self._make(size)

    def _make(self, size: int):
        self.mask = size - 1
        self.keys, self.row = np.zeros(size, np.uint64), np.zeros(size, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The rows of the keys, -1 for unknown ones."""
        at = (keys & np.uint64(self.mask)).astype(np.int64)
        there = self.keys[at]
        out = np.where(there == keys, self.row[at], -1)
        open_ = np.flatnonzero((there != keys) & (there != 0))
        at = at[open_]
        while len(open_):
            at = (at + 1) & self.mask
            there = self.keys[at]
            hit = there == keys[open_]
            out[open_[hit]] = self.row[at[hit]]
            more = ~hit & (there != 0)
            open_, at = open_[more], at[more]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Give new, distinct keys the next rows."""
        rows = np.arange(self.rows, self.rows + len(keys), dtype=np.int32)
        self.rows += len(keys)
        if 2 * self.rows > self.mask:
            used = self.keys != 0
            old = self.keys[used], self.row[used]
            size = self.mask + 1
            while 2 * self.rows > size - 1:
                size *= 2
            self._make(size)
            self._put(*old)
        self._put(keys, rows)

    def _put(self, keys: np.ndarray, rows: np.ndarray) -> None:
        at = (keys & np.uint64(self.mask)).astype(np.int64)
        while len(keys):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[free]  # of several for one place the last one stays
            done = self.keys[at] == keys
            self.row[at[done]] = rows[done]
            keys, rows, at = keys[~done], rows[~done], (at[~done] + 1) & self.mask


class Memo:
    """Values of words, each computed once while it's remembered.

    ``learn`` gets the bytes of new words and returns an array of their values.
    After ``limit`` words all are forgotten, so a worker's memory is bounded.
    """

    def __init__(self, learn, limit: int = 1_000_000):
        self.learn, self.limit = learn, limit
        self.clear()

    def clear(self):
        self.table, self.values = Table(), None

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self.table.rows > self.limit:
            self.clear()
        keys = hashes(data, starts, ends)
        at = self.table.find(keys)
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            new, first = np.unique(keys[unknown], return_index=True)
            first = unknown[first]
            raw = data.tobytes()
            got = np.asarray(self.learn([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]))
            self.values = got if self.values is None else np.concatenate([self.values, got])
            self.table.add(new)
            at[unknown] = self.table.find(keys[unknown])
        return self.values[at] if len(at) else np.zeros(0, np.int64)
