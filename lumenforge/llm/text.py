"""Vectorised words, shingles and hashes over Arrow batches of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words are runs of bytes other than space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Two bases of polynomial hashes, and a table of byte values for the second, so that the two are independent.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_powers = [[np.ones(1, np.uint64), np.ones(1, np.uint64)] for _ in _BASES]

#: Text bytes worked on at once; just below a power of two, which the tables of powers are rounded up to.
SLICE_BYTES = (1 << 20) - 64


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a hash base and of its inverse, modulo 2^64."""
    if len(_powers[which][0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASES[which], pow(_BASES[which], -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[which][k] = np.multiply.accumulate(steps)
    return _powers[which][0][:n], _powers[which][1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads each bit of 64 over all of them."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SECOND = mix(np.arange(1, 257, dtype=np.uint64))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets by row) of a string column; null is empty. Offsets start at 0."""
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    buffers = array.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1)
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, name: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most `limit` text bytes (a longer text is a run of its own)."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(column(batch, name))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def gathered(parts: Iterator[tuple[np.ndarray, ...]], limit: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of several slices put together, as soon as they have `limit` rows or more: what a worker holds does not follow the batch."""
    held: list[tuple[np.ndarray, ...]] = []
    for part in parts:
        held.append(part)
        if sum(len(x[0]) for x in held) >= limit:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held = []
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row): words never cross rows."""
    inside = ~SPACE[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after[:-1] = inside[1:]
    full = offsets[1:] > offsets[:-1]
    before[offsets[:-1][full]] = False
    after[offsets[1:][full] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


#: Hashes of (place, byte) for the first 64 places; those of later ones are worked out.
_PLACED = mix(np.arange(64 << 8, dtype=np.uint64) + np.uint64(1 << 40))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: the sum of a hash of every (place in the span, byte). Spans are in order and apart.

    Sums of powers of a base modulo 2^64 would make some long spans of two letters equal whatever the base.
    """
    lengths = ends - starts
    begin = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(begin, lengths)
    at = (place << 8) + data[place + np.repeat(starts, lengths)]
    values = _PLACED[np.minimum(at, len(_PLACED) - 1)]
    far = np.flatnonzero(at >= len(_PLACED))
    values[far] = mix(at[far].astype(np.uint64) + np.uint64(1 << 40))
    return mix((np.add.reduceat(values, begin) if len(begin) else np.zeros(0, np.uint64)) + lengths.astype(np.uint64))


def prefix_sums(data: np.ndarray, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(sums, inverse): (sums[b] - sums[a]) * inverse[a] is a hash of the bytes from a to b; the two kinds are independent."""
    power, inverse = powers(len(data) + 1, which)
    values = _SECOND[data] if which else data.astype(np.uint64) + np.uint64(1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values * power[: len(data)], out=total[1:])
    return total, inverse


def word_hashes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every lower-cased word, first word of each row)."""
    data, offsets = text_bytes(array)
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    return span_hashes(data, starts, ends), first


def rolled(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words, by its first word; runs across rows are the caller's to mask."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, k):
        out *= np.uint64(0xD1342543DE82EF95)
        out += words[j : n + j]
    return mix(out)


def shingles(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct k-word hashes of each row, one row after another; offsets by row).

    A row with fewer words than k has its whole sequence as its one shingle; a row without words has none.
    """
    counts = np.diff(first)
    every = rolled(words, k)
    n = np.where(counts >= k, counts - k + 1, 0)
    rows = np.repeat(np.arange(len(counts)), n)
    starts = np.repeat(first[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    values = every[starts] if len(starts) else np.zeros(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        more = np.array([rolled(words[first[r] : first[r + 1]], int(counts[r]))[0] ^ np.uint64(counts[r]) for r in short], np.uint64)
        rows, values = np.concatenate([rows, short]), np.concatenate([values, more])
    order = np.lexsort((values, rows)) if len(rows) else np.zeros(0, np.int64)
    rows, values = rows[order], values[order]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    rows, values = rows[keep], values[keep]
    return values, np.searchsorted(rows, np.arange(len(counts) + 1))


def tallied(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each occurs (or the sum of its weights)."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    if weights is None:
        values = np.sort(values)
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        return values[first], np.diff(np.append(first, len(values)))
    order = np.argsort(values)
    values, weights = values[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[first], np.add.reduceat(weights, first)


def binaries(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
