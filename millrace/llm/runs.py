"""Groups of a partition that arrives sorted by group, one after another, with bounded memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each stretch with equal ``keys``, which hold integers without nulls. Only one group is held."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [np.asarray(batch.column(k)) for k in keys]
        changed = np.zeros(len(batch), bool)
        for column in columns:
            changed[1:] |= column[1:] != column[:-1]
        first = tuple(int(c[0]) for c in columns)
        cuts = [0, *np.flatnonzero(changed).tolist(), len(batch)]
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        for k, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if k and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
        last = tuple(int(c[-1]) for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def matrix(column: pa.ChunkedArray, width: int, dtype: str) -> np.ndarray:
    """Rows of a binary column, each ``width`` numbers, as a matrix."""
    whole = column.combine_chunks()
    offsets = np.frombuffer(whole.buffers()[1], np.int32)[whole.offset:whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data.view(dtype).reshape(len(whole), width)
