"""Words and shingles of whole texts as 64-bit hashes, computed on Arrow buffers with numpy.

A word is a run of bytes other than space and 0x09-0x0D of the UTF-8 text, A-Z in lower case. A word's hash is a
polynomial over its bytes modulo 2**64, read off running sums, so a batch costs a handful of passes over its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACES = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                    0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], dtype=np.uint64)
_powers: list[np.ndarray] = []


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit moves every output bit."""
    x = values ^ (values >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SEGMENT_BYTES + 1)
        tables = []
        for base in (_ODD, pow(_ODD, -1, 2**64)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            np.multiply.accumulate(table, out=table)
            tables.append(table)
        _powers[:] = tables
    return _powers


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    everything = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return everything[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 2 * SEGMENT_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts hold at most ``most_bytes``, or a single row."""
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64()))
        ends, first = np.cumsum(lengths), 0
        while first < len(lengths):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
            yield batch.slice(first, last - first)
            first = last


def _segment(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word; ``breaks`` are places where a word must end."""
    space = _SPACE[data]
    before = np.empty(len(data) + 1, bool)
    before[0] = True
    before[1:] = space
    before[breaks] = True
    starts = np.flatnonzero(before[:-1] & ~space)
    after = np.empty(len(data), bool)
    after[-1] = True
    after[:-1] = before[1:-1] | space[1:]
    ends = np.flatnonzero(after & ~space) + 1
    power, inverse = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * power[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts]), starts


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in order, and for each row where its words begin (one entry more than rows)."""
    hashes, starts, at, n = [], [], 0, len(data)
    while at < n:
        end = min(n, at + SEGMENT_BYTES)
        if end < n:
            gaps = np.flatnonzero(_SPACE[data[at:end]])
            inner = offsets[(offsets > at) & (offsets <= end)]
            end = max(at + int(gaps[-1]) + 1 if len(gaps) else 0, int(inner[-1]) if len(inner) else 0)
            if end <= at:  # one word longer than a segment
                rest = np.flatnonzero(_SPACE[data[at:]])
                later = offsets[offsets > at]
                end = min(at + int(rest[0]) + 1 if len(rest) else n, int(later[0]) if len(later) else n)
        breaks = offsets[(offsets >= at) & (offsets <= end)] - at
        found, places = _segment(data[at:end], breaks)
        hashes.append(found)
        starts.append(places + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = 5) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its ``n``-word shingles.

    A row with fewer words has its whole sequence as its one shingle; a row without words has none.
    """
    words, bounds = word_hashes(data, offsets)
    places = _PLACES[:n]
    if len(words) >= n:
        runs = words[:len(words) - n + 1] * places[0]
        for k in range(1, n):
            runs = runs + words[k:len(words) - n + 1 + k] * places[k]
        runs = mix(runs)
    sets = []
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        count = last - first
        if count >= n:
            found = np.sort(runs[first:last - n + 1])
            keep = np.empty(len(found), bool)
            keep[0] = True
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            sets.append(found[keep])
        elif count:
            short = words[first:last] * places[:count]
            sets.append(mix(np.array([short.sum(dtype=np.uint64) + np.uint64(count)], np.uint64)))
        else:
            sets.append(words[:0])
    return sets
