"""Exact top-k inner products by block-at-a-time pruning.

Documents are dealt into small blocks of similar vectors; a block keeps its vectors as a forward index and the greatest and
least value of every term. For a query, the greatest value of a term (the least, for a negative weight) times its weight,
summed over the terms, bounds every score in the block. A query first scores the blocks of highest bound, which gives a
score that its k-th best cannot fall below; after that only blocks whose bound reaches it are scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.runs import matrix, runs
from millrace.session import stored

BLOCK = 128             # vectors of a block
GROUP = 32              # blocks of a range, which a task scores together
QUERIES = 512           # queries of a query block
CENTRES = 64
EXACT = float(1 << 53)


def scaled(vector: str, scale: int) -> F.Column:
    """floor(scale * x) of every component as a double, or null for vectors that take no part."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(numbers, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.when((F.size(vector) > 0) & finite, F.transform(numbers, lambda x: F.floor(x * scale).cast("double")))


def _near(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                own = np.asarray(rows.column("vector").flatten(), np.float64).reshape(len(rows), dim)
                if len(centres) and centres.shape[1] == dim:
                    cell = ((centres**2).sum(axis=1) / 2 - own @ centres.T).argmin(axis=1).astype(np.int32)
                else:
                    cell = np.zeros(len(rows), np.int32)
                yield pa.record_batch([rows.column("id"), rows.column("dim"), pa.array(cell), pa.array([x.tobytes() for x in own], pa.binary())],
                                      ["id", "dim", "cell", "vector"])
    return run


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and range the greatest and least value of every term."""
    for group in runs(batches, ["dim", "range", "block"]):
        own = matrix(group.column("vector"), group.column("dim")[0].as_py(), "<f8")
        yield pa.record_batch({**{x: group.column(x).slice(0, 1).combine_chunks() for x in ("dim", "range", "block")},
                               "most": pa.array([own.max(axis=0).tobytes()], pa.binary()),
                               "least": pa.array([own.min(axis=0).tobytes()], pa.binary())})


def products(queries: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Integer inner products: exact in doubles where they are small enough, and else in 64-bit integers."""
    if len(queries) and len(others) and np.abs(queries).max() * np.abs(others).max() * queries.shape[1] >= EXACT:
        return queries.astype(np.int64) @ others.astype(np.int64).T
    return (queries @ others.T).astype(np.int64)


def upper_bounds(queries: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    return queries.clip(min=0) @ most.T + queries.clip(max=0) @ least.T


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _score(k: int):
    """Scores one query block against one range: blocks by falling bound, until the bounds are below the k-th score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["dim", "range", "part"]):
            dim = group.column("dim")[0].as_py()
            is_query = np.asarray(group.column("is_query").combine_chunks().cast(pa.int8())).astype(bool)
            ids = np.asarray(group.column("id").combine_chunks())
            own = matrix(group.column("vector"), dim, "<f8")
            block, floor = (np.asarray(group.column(x).combine_chunks()) for x in ("block", "floor"))
            if is_query.all() or not is_query.any():
                continue
            docs = np.flatnonzero(~is_query)
            docs = docs[np.argsort(block[docs], kind="stable")]
            starts = np.flatnonzero(np.r_[True, np.diff(block[docs]) != 0])
            pieces = np.split(docs, starts[1:])
            most = np.stack([own[x].max(axis=0) for x in pieces])
            least = np.stack([own[x].min(axis=0) for x in pieces])
            asked = np.flatnonzero(is_query)
            bounds = upper_bounds(own[asked], most, least)
            low = floor[asked].astype(np.float64)
            kept_ids = [np.zeros(0, np.int64)] * len(asked)
            kept_scores = [np.zeros(0, np.int64)] * len(asked)
            for place in range(len(pieces)):
                if place == 0:
                    order = np.argsort(-bounds, axis=1, kind="stable")
                turn = order[:, place]
                live = np.flatnonzero(bounds[np.arange(len(asked)), turn] >= low)
                if not len(live):
                    break
                for piece in np.unique(turn[live]).tolist():
                    who = live[turn[live] == piece]
                    scores = products(own[asked[who]], own[pieces[piece]])
                    names = ids[pieces[piece]]
                    for row, q in enumerate(who.tolist()):
                        fit = np.flatnonzero((scores[row] >= low[q]) & (names != ids[asked[q]]))
                        if len(fit):
                            kept_ids[q], kept_scores[q] = _best(np.concatenate([kept_ids[q], names[fit]]),
                                                                np.concatenate([kept_scores[q], scores[row][fit]]), k)
                            if len(kept_ids[q]) == k:
                                low[q] = max(low[q], kept_scores[q][-1])
            counts = [len(x) for x in kept_ids]
            yield pa.record_batch([pa.array(np.repeat(ids[asked], counts)), pa.array(np.concatenate(kept_ids)), pa.array(np.concatenate(kept_scores))],
                                  ["query_id", "vec_id", "score"])
    return run


def _pairs(first: int | None):
    """For a query block and the bounds of many ranges: the ranges to score, all whose bound reaches a query's floor.

    With ``first``, of those only the ``first`` of highest bound of each query.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["dim", "part", "tile"]):
            dim = group.column("dim")[0].as_py()
            is_query = np.asarray(group.column("is_query").combine_chunks().cast(pa.int8())).astype(bool)
            if is_query.all() or not is_query.any():
                continue
            asked, ranges = np.flatnonzero(is_query), np.flatnonzero(~is_query)
            own = matrix(group.column("vector"), dim, "<f8")
            least = matrix(group.filter(pa.array(~is_query)).column("least"), dim, "<f8")
            bounds = upper_bounds(own[asked], own[ranges], least)
            floor = np.asarray(group.column("floor").combine_chunks())[asked].astype(np.float64)
            reach = bounds >= floor[:, None]
            if first is not None and bounds.shape[1] > first:
                top = np.argpartition(-bounds, first - 1, axis=1)[:, :first]
                chosen = np.zeros_like(reach)
                np.put_along_axis(chosen, top, True, axis=1)
                reach &= chosen
            wanted = np.unique(np.asarray(group.column("range").combine_chunks())[ranges[reach.any(axis=0)]])
            if len(wanted):
                yield pa.record_batch([pa.array(np.full(len(wanted), group.column(x)[0].as_py(), np.int32)) for x in ("dim", "part")]
                                      + [pa.array(wanted)], ["dim", "part", "range"])
    return run


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
               scale: int = 256, centres: int = CENTRES, seed: int = 3) -> DataFrame:
    """``query_id, rank, id_column, score``: the ``k`` rows of the highest integer inner product per query.

    Components are turned into floor(``scale`` * x). A query is not its own candidate, by id; ties go to the smaller id,
    and a query with fewer than ``k`` candidates has all of them. Vectors that are null, empty, or hold null or non-finite
    components take no part, nor do rows without id, and vectors meet those of their own dimension only. Repeated rows
    are candidates each; a query id that is repeated is answered once, for its vector that sorts last. No queries or no
    candidates give an empty result. Other columns are ignored.

    Blocks follow the nearest of at most ``centres`` vectors, a bounded sample by hash that changes only the work. Queries
    and ranges of blocks meet in query blocks: tables of their bounds say which pairs are worth scoring.
    """
    spark = vectors.sparkSession

    def prepared(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector")).withColumn("vector", scaled("vector", scale))
        return rows.filter("id IS NOT NULL AND vector IS NOT NULL").withColumn("dim", F.size("vector"))

    rows = prepared(vectors)
    sample = rows.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(centres).select("vector").toPandas()["vector"].tolist()
    width = max((len(x) for x in sample), default=0)
    middle = np.array([x for x in sample if len(x) == width], np.float64)
    near, kind = _near(middle), "id long, dim int, cell int, vector binary"
    docs = stored(rows.mapInArrow(near, kind), "cells")
    sizes = docs.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("dim").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # a row per cell
    sizes = sizes.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    sizes = sizes.withColumn("first", F.coalesce(F.sum("blocks").over(before), F.lit(0)).cast("int"))
    placed = docs.join(F.broadcast(sizes), ["dim", "cell"]).withColumn(
        "block", (F.col("first") + F.pmod(F.xxhash64("id", "vector"), F.col("blocks"))).cast("int")).withColumn(
        "range", F.floor(F.col("block") / GROUP).cast("int")).select("id", "dim", "range", "block", "vector")
    placed = stored(placed, "blocks")
    order = ["dim", "range", "block"]
    bounds = placed.repartition("dim", "range").sortWithinPartitions(*order).mapInArrow(
        _bounds, "dim int, range int, block int, most binary, least binary")
    bounds = stored(bounds, "bounds")

    asked = prepared(queries).groupBy("id").agg(F.max("vector").alias("vector")).withColumn("dim", F.size("vector"))
    asked = stored(asked.mapInArrow(near, kind), "queries")
    parts = asked.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n")).withColumn("blocks", F.ceil(F.col("n") / QUERIES).cast("int"))
    parts = parts.withColumn("first", F.coalesce(F.sum("blocks").over(before), F.lit(0)).cast("int"))
    asked = stored(asked.join(F.broadcast(parts), ["dim", "cell"]).withColumn(
        "part", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("blocks"))).cast("int")).select("id", "dim", "part", "vector"), "query-blocks")

    nothing = F.lit(-(1 << 62)).cast("long")
    tiled = bounds.withColumn("tile", F.pmod(F.hash("range"), F.lit(TILES)))
    kinds = asked.select("dim", "part").distinct()

    def pairs(floors: DataFrame, first: int | None) -> DataFrame:
        left = floors.select("dim", "part", F.explode(F.sequence(F.lit(0), F.lit(TILES - 1))).alias("tile"), F.lit(True).alias("is_query"),
                             "vector", F.lit(None).cast("binary").alias("least"), F.lit(0).alias("range"), "floor")
        right = tiled.join(kinds, "dim").select("dim", "part", "tile", F.lit(False).alias("is_query"), F.col("most").alias("vector"),
                                                "least", "range", nothing.alias("floor"))
        key = ["dim", "part", "tile"]
        found = left.unionByName(right).repartition(*key).sortWithinPartitions(*key).mapInArrow(_pairs(first), "dim int, part int, range int")
        return stored(found.distinct(), "pairs")

    def scored(floors: DataFrame, wanted: DataFrame) -> DataFrame:
        left = floors.join(wanted, ["dim", "part"]).select("dim", "range", "part", F.lit(True).alias("is_query"), "id", "vector", F.lit(0).alias("block"), "floor")
        right = placed.join(wanted, ["dim", "range"]).select("dim", "range", "part", F.lit(False).alias("is_query"), "id", "vector", "block", nothing.alias("floor"))
        key = ["dim", "range", "part"]
        return left.unionByName(right).repartition(*key).sortWithinPartitions(*key).mapInArrow(_score(k), "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    open_queries = asked.withColumn("floor", nothing)
    tried = stored(scored(open_queries, pairs(open_queries, 1)), "first-scores")
    reached = tried.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    floors = stored(asked.join(reached, "id", "left").withColumn("floor", F.coalesce("least", nothing)).select("id", "dim", "part", "vector", "floor"), "floors")
    final = scored(floors, pairs(floors, None))
    return final.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("vec_id").alias(id_column), "score")


TILES = 8               # tables that the bounds of all blocks are dealt into for each query block
