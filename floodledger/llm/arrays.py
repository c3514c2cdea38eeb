"""Whole texts of an Arrow batch as flat numpy arrays: bytes, words, hashed shingles.

A batch is cut between rows into slices of about ``SLICE`` bytes, so temporary arrays stay small
whatever the batch holds; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; a null row is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows ``lo:hi`` with their bytes and offsets, of ``limit`` bytes or one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def powers(n: int, base=BASE) -> np.ndarray:
    out = np.full(n, base, U64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """Hash, row, start and end byte of every word (a run of bytes other than white space)."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n == 0:
        return np.zeros(0, U64), none, none, none
    solid = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:n]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:] | edge[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    if len(starts) == 0:
        return np.zeros(0, U64), none, none, none
    lengths = ends - starts
    kept = data[solid]
    if lower:
        kept = LOWER[kept]
    first = np.zeros(len(starts), np.int64)
    np.cumsum(lengths[:-1], out=first[1:])
    place = np.arange(len(kept)) - np.repeat(first, lengths)
    value = (kept.astype(U64) + U64(1)) * powers(int(lengths.max()))[place]
    hashes = mix(np.add.reduceat(value, first) + lengths.astype(U64) * BASE)
    return hashes, np.searchsorted(offsets, starts, side="right") - 1, starts, ends


def grams(hashes: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``width`` words of one row; shorter rows give none."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    total = np.full(n, U64(width * 0x9E3779B97F4A7C15 % 2**64))
    for j in range(width):
        total = (total ^ hashes[j : j + n]) * U64(0xD6E8FEB86659FD93)
        total ^= total >> U64(32)
    same = rows[:n] == rows[width - 1 :]
    return mix(total[same]), rows[:n][same]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every row, one row after the other, and the rows' offsets.

    A row of fewer than ``width`` words has its whole sequence as its one shingle, a row without
    words an empty set.
    """
    n = len(offsets) - 1
    hashes, rows, _, _ = words(data, offsets)
    values, owner = grams(hashes, rows, width)
    count = np.bincount(rows, minlength=n)
    short = count[(count > 0) & (count < width)]
    if len(short):
        parts, owners = [values], [owner]
        for k in np.unique(short):
            whole = np.isin(rows, np.flatnonzero(count == k))
            v, o = grams(hashes[whole], rows[whole], int(k))
            parts.append(v)
            owners.append(o)
        values, owner = np.concatenate(parts), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        values, owner = values[order], owner[order]
    bounds = np.searchsorted(owner, np.arange(n + 1))
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        values[lo:hi].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    sizes = np.bincount(owner[keep], minlength=n)
    out = np.zeros(n + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return values[keep], out


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of equal neighbours."""
    if len(keys) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return starts, np.append(starts[1:], len(keys))


def by_key(batches, key: str) -> Iterator[tuple[object, pa.Table]]:
    """The groups of a partition that is sorted by ``key``, one at a time."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = np.asarray(batch.column(key).to_numpy(zero_copy_only=False))
        for lo, hi in zip(*runs(values)):
            if held and values[lo] != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = values[lo]
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield current, pa.Table.from_batches(held)
