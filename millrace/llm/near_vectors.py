"""Near-copies among vectors: binary codes of randomly rotated vectors find candidates and bound their cosine.

A vector's code is the signs of its rotation. Stored with it is the inner product of the rotated unit vector and its code's
unit vector; the code of one vector with the other vector itself, divided by that factor, estimates their cosine without
bias, and its error has a bound that falls with the dimension. Pairs whose upper bound reaches the threshold are computed
again in double precision, and that alone decides.

Vectors meet if a stretch of their codes is equal. The number of stretches follows from their length, so that a pair at
the threshold meets with the wanted probability at every size of the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.components import connected_components
from millrace.llm.runs import matrix, runs
from millrace.session import stored

LEAST_DIM = 64
SURE = 5.0              # bound of the estimate's error, in its standard deviations
TILE = 1024             # vectors of a bucket that are compared with each other at once


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not empty, all finite, and not zero."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(numbers, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(numbers, lambda x: x != 0), F.lit(False))


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix; its first ``dim`` rows rotate vectors that are padded with zeros."""
    full = max(dim, LEAST_DIM)
    q, r = np.linalg.qr(np.random.default_rng((seed, full)).standard_normal((full, full)))
    return (q * np.sign(np.diag(r)))[:dim]


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def stretch_bits(classes: int) -> int:
    """Bits of a stretch: a bucket of unrelated vectors then holds about sixteen."""
    return min(30, max(6, math.ceil(math.log2(max(classes, 2))) - 4))


def stretch_count(bits: int, threshold: float, recall: float) -> int:
    met = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(1 - recall) / math.log1p(-met))


def _codes(bits: int, stretches: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                own = np.asarray(rows.column("vector").flatten(), np.float64).reshape(len(rows), dim)
                units = unit(own)
                full = max(dim, LEAST_DIM)
                signs = np.concatenate([units @ rotation(dim, seed + k) >= 0 for k in range(-(-bits * stretches // full))], axis=1)
                places = (1 << np.arange(bits, dtype=np.int64))
                keys = signs[:, :bits * stretches].reshape(len(rows), stretches, bits) @ places
                yield pa.record_batch({"class": rows.column("class"), "copies": rows.column("copies"), "dim": rows.column("dim"),
                                       "vector": pa.array([x.tobytes() for x in own], pa.binary()),
                                       "keys": pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * stretches),
                                                                        pa.array(keys.ravel()))})
    return run


def estimates(units: np.ndarray, others: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Upper bounds of the cosines of all ``units`` with all ``others``, from the codes of the ``units``."""
    rotated = units @ turn
    full = rotated.shape[1]
    codes = np.where(rotated >= 0, 1.0, -1.0) / math.sqrt(full)
    factor = (rotated * codes).sum(axis=1)
    error = np.sqrt((1 - factor**2).clip(min=0)) / factor / math.sqrt(full - 1)
    return codes.astype(np.float32) @ (others @ turn).T.astype(np.float32) / factor[:, None].astype(np.float32) + (SURE * error)[:, None]


def _tile_links(threshold: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for group in runs(batches, ["dim", "stretch", "key", "left", "right"]):
            if len(group) < 2:
                continue
            dim, stretch = group.column("dim")[0].as_py(), group.column("stretch")[0].as_py()
            left, right = group.column("left")[0].as_py(), group.column("right")[0].as_py()
            turn = turns.setdefault(dim, rotation(dim, seed))
            names, copies = (np.asarray(group.column(x).combine_chunks()) for x in ("class", "copies"))
            block = np.asarray(group.column("block").combine_chunks())
            units = unit(matrix(group.column("vector"), dim, "<f8"))
            keys = np.asarray(group.column("keys").combine_chunks().flatten()).reshape(len(group), -1)
            rows = np.flatnonzero(block == left)
            cols = rows if left == right else np.flatnonzero(block == right)
            if not len(rows) or not len(cols):
                continue
            close = estimates(units[rows], units[cols], turn) >= threshold
            if left == right:
                close &= np.tri(len(rows), k=-1, dtype=bool)
            i, j = np.nonzero(close)
            i, j = rows[i], cols[j]
            keep = np.zeros(len(i), bool)
            for first in range(0, len(i), 1 << 15):  # in double precision, and only where the pair meets first
                part = slice(first, first + (1 << 15))
                keep[part] = np.einsum("nd,nd->n", units[i[part]], units[j[part]]) >= threshold
                if stretch:
                    keep[part] &= ~(keys[i[part], :stretch] == keys[j[part], :stretch]).any(axis=1)
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            links = np.bincount(i, copies[j], len(names)) + np.bincount(j, copies[i], len(names))
            root = np.arange(len(names))
            while True:  # the least row of each component of the tile
                low = np.minimum(root[i], root[j])
                before = root.copy()
                np.minimum.at(root, i, low)
                np.minimum.at(root, j, low)
                root = root[root]
                if (root == before).all():
                    break
            found = np.flatnonzero(links)
            out.append((names[found], links[found].astype(np.int64), names[root[found]]))
            if sum(len(x[0]) for x in out) > 1 << 16:
                yield _rows(out)
                out = []
        if out:
            yield _rows(out)
    return run


def _rows(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], ["class", "links", "root"])


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", threshold: float = 0.95,
                 recall: float = 0.999, seed: int = 20) -> DataFrame:
    """``id_column, n_links, component_id, kept`` per row, for links of cosine >= ``threshold`` in double precision.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id reachable, the own included,
    and ``kept`` says that this is the own id. A pair at the threshold is found with probability ``recall``, a closer one
    more surely; none below it is linked. Only vectors of one dimension are compared.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing: 0 links, a component of
    their own. Equal vectors are compared once and counted as often as they occur. A repeated id is a row each, with one
    component. A row without id counts as a link of others but has a null component if its component has no id, and
    ``kept`` is then false. An empty table gives an empty result. Other columns are ignored.

    A bucket of many vectors is cut into blocks of about ``TILE``, and each pair of blocks is a tile of its own. A pair
    counts in the first stretch in which it meets. A tile returns a count and a root per vector, never pairs.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"))
    rows = rows.withColumn("vector", F.when(usable(F.col("vector")), F.transform("vector", lambda x: x.cast("double"))))
    classes = rows.filter("vector IS NOT NULL").groupBy("vector").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    bits = stretch_bits(classes.count())
    stretches = stretch_count(bits, threshold, recall)
    coded = classes.select("class", "copies", F.size("vector").alias("dim"), "vector").mapInArrow(
        _codes(bits, stretches, seed), "class long, copies long, dim int, vector binary, keys array<long>")
    entries = stored(coded, "codes").select("*", F.posexplode("keys").alias("stretch", "key"))
    bucket = ["dim", "stretch", "key"]
    counts = entries.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / TILE).cast("int")
    met = entries.join(counts, bucket).withColumn("block", F.pmod(F.xxhash64("class"), blocks).cast("int"))
    tiles = met.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn(
        "left", F.greatest("block", "other")).withColumn("right", F.least("block", "other"))
    tile = [*bucket, "left", "right"]
    linked = tiles.select(*tile, "block", "class", "copies", "vector", "keys").repartition(*tile).sortWithinPartitions(*tile).mapInArrow(
        _tile_links(threshold, seed), "class long, links long, root long")
    linked = stored(linked, "tile-links")
    counted = linked.groupBy("class").agg(F.sum("links").alias("links"))
    grouped = connected_components(linked.select("class", "root").distinct(), "class", "root")
    named = classes.select("class", "vector", "least", "copies").join(counted, "class", "left").join(
        grouped, F.col("class") == F.col("node"), "left").withColumn("group", F.coalesce("component", "class"))
    least = named.groupBy("group").agg(F.min("least").alias("component_id"))
    told = named.join(least, "group").select("vector", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    own = F.when(F.col("vector").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.join(told, "vector", "left").select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
        F.coalesce(F.col("id") == own, F.lit(False)).alias("kept"))
