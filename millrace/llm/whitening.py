"""Whitening of vectors: principal components of their covariance, each scaled to variance one.

Entries become whole numbers, so sums over all rows are exact. The passes over the rows each leave one small table of the
width of a vector, combined by Spark; the eigenvectors of that table are found by contour integration (``feast``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.llm.feast import largest_eigenpairs

SCALE, SHIFT = 1024, 100_000   # fixed values: x = floor(1024 * c) + 100000
LARGEST = float(1 << 30)       # entries from here on have no exact place in the sums
BATCH_ROWS = 4096


@dataclass(frozen=True)
class Whitening:
    n: int
    dims: int
    sums: tuple[int, ...]        # of x, exact
    values: np.ndarray           # eigenvalues, falling
    vectors: np.ndarray          # unit eigenvectors, as rows
    trace: float
    identity_error: float

    @property
    def centre(self) -> np.ndarray:
        """A whole number near each mean."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> tuple[int, ...]:
        """``sums`` of the entries less ``centre``: below ``n``."""
        return tuple(s % self.n for s in self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) - np.array([r / self.n for r in self.rest])

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Per row the sum of ``(n * x - sums) ** 2``, exact."""
        near = x - self.centre
        largest = int(np.abs(near).max(initial=0)) * self.n + self.n
        kind = pa.decimal128(38, 0)
        if largest * largest * self.dims < 2**63:
            gaps = near * self.n - np.array(self.rest, np.int64)
            return pa.array((gaps * gaps).sum(axis=1)).cast(kind)
        gaps = near.astype(object) * self.n - np.array(self.rest, object)
        totals = (gaps * gaps).sum(axis=1)
        return pa.array([Decimal(t) if t < 10**38 else None for t in totals.tolist()], kind)


def whole_vectors(vectors: DataFrame, embedding: str, dims: int | None = None) -> Column:
    """Whether a vector takes part: without null, NaN, infinite or huge entries, and of ``dims`` entries if that is given."""
    odd = F.exists(embedding, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    sized = F.size(embedding) > 0 if dims is None else F.size(embedding) == dims
    return F.coalesce(sized & ~odd, F.lit(False))


def usual_length(vectors: DataFrame, embedding: str) -> int:
    """The number of entries that most vectors have, the larger one of equally frequent ones; 0 if none takes part."""
    lengths = vectors.filter(whole_vectors(vectors, embedding)).groupBy(F.size(embedding).alias("size")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def _wholes(column: pa.Array, dims: int) -> np.ndarray:
    entries = np.asarray(column.flatten(), np.float64).reshape(len(column), dims)
    return np.floor(entries * SCALE).astype(np.int64) + SHIFT


def _entries(vectors: DataFrame, embedding: str, dims: int) -> DataFrame:
    return vectors.filter(whole_vectors(vectors, embedding, dims)).select(F.col(embedding).cast("array<double>").alias("v"))


def _exact_sums(vectors: DataFrame, embedding: str, dims: int) -> tuple[int, tuple[int, ...]]:
    """The number of rows and the exact sum of every entry; a task sends ``dims + 1`` numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dims, object), 0
        for batch in batches:
            total = total + _wholes(batch.column(0), dims).sum(axis=0).astype(object)
            n += len(batch)
        sums = pa.array([Decimal(int(t)) for t in [*total, n]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(dims + 1), pa.int32()), sums], names=["i", "s"])

    parts = _entries(vectors, embedding, dims).mapInArrow(run, "i int, s decimal(38,0)")
    rows = {r["i"]: int(r["s"]) for r in parts.groupBy("i").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()}
    return rows.get(dims, 0), tuple(rows.get(i, 0) for i in range(dims))


def _products(vectors: DataFrame, embedding: str, dims: int, width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``of(x)' of(x)`` over all rows, ``width`` by ``width``; a task sends one such table, its rows are added up by key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, len(batch), BATCH_ROWS):
                y = of(_wholes(batch.column(0).slice(at, BATCH_ROWS), dims))
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "r"])

    def add(rows: pa.Table) -> pa.Table:
        total = np.sort(np.stack(rows.column("r").to_numpy()), axis=0).sum(axis=0)  # sorted: whatever order the tasks end in
        return pa.table({"i": rows.column("i").slice(0, 1), "r": pa.array([total], pa.list_(pa.float64()))})

    parts = _entries(vectors, embedding, dims).mapInArrow(run, "i int, r array<double>")
    rows = {r["i"]: r["r"] for r in parts.groupBy("i").applyInArrow(add, "i int, r array<double>").collect()}
    return np.array([rows[i] for i in range(width)])


def fit_whitening(vectors: DataFrame, components: int = 8, embedding: str = "embedding") -> Whitening | None:
    """Fitted on all vectors that take part, in four passes; None if none does.

    Most vectors decide how many entries a vector has; others, and those with null, non-finite or huge entries (from 2**30
    on), take no part. What reaches the driver is a table as wide as a vector. There are fewer ``components`` if the
    covariance has a lower rank: none for a single vector or copies of one.
    """
    dims = usual_length(vectors, embedding)
    if not dims:
        return None
    n, sums = _exact_sums(vectors, embedding, dims)
    start = Whitening(n, dims, sums, np.zeros(0), np.zeros((0, dims)), 0.0, 0.0)
    covariance = _products(vectors, embedding, dims, dims, start.centred) / n
    values, directions = largest_eigenpairs(covariance, components)
    fitted = replace(start, values=values, vectors=directions, trace=float(np.trace(covariance)))
    if not len(values):
        return fitted
    found = _products(vectors, embedding, dims, len(values) + 1, lambda x: np.hstack([fitted.project(x), np.ones((len(x), 1))]))
    means = found[-1, :-1] / n
    error = np.abs(found[:-1, :-1] / n - np.outer(means, means) - np.eye(len(values))).max()
    return replace(fitted, identity_error=float(error))


def whiten(vectors: DataFrame, model: Whitening | None, embedding: str = "embedding", keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """One row for each vector that takes part and each component: ``keep, component, n, deviation, whitened, explained, identity_error``.

    ``deviation`` is exact up to 38 digits and null beyond. Rows are mapped one by one, so repeated rows and ids stay, and
    columns that are not in ``keep`` may have any name. Without a model, or one without components, there are no rows.
    """
    inner = vectors.select(F.struct(*keep).alias("kept"), F.col(embedding).cast("array<double>").alias("v"))
    inner = inner.filter(whole_vectors(inner, "v", model.dims) if model is not None else F.lit(False))
    fields = [("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.DecimalType(38, 0)), ("whitened", T.DoubleType()),
              ("explained", T.DoubleType()), ("identity_error", T.DoubleType())]
    schema = T.StructType([inner.schema["kept"], *[T.StructField(*f) for f in fields]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 0 if model is None else len(model.values)
        for batch in batches:
            if not width or not len(batch):
                continue
            x = _wholes(batch.column("v"), model.dims)
            rows, of = np.repeat(np.arange(len(x)), width), np.tile(np.arange(width), len(x))
            yield pa.RecordBatch.from_arrays([
                batch.column("kept").take(pa.array(rows)), pa.array(of + 1, pa.int32()), pa.array(np.full(len(rows), model.n), pa.int64()),
                model.deviations(x).take(pa.array(rows)), pa.array(model.project(x).ravel()), pa.array((model.values / model.trace)[of]),
                pa.array(np.full(len(rows), model.identity_error))], names=schema.names)

    return inner.mapInArrow(run, schema).select("kept.*", *schema.names[1:])
