"""A collection of documents with embeddings, and exact nearest neighbours in it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.operators.clean import first_per_key, top_per_key
from millrace.operators.pivots import MAX_PIVOTS, SAMPLE_PER_PIVOT, Cells, as_euclidean, choose_pivots
from millrace.session import stored

# How many numbers of the query side may be sent to every task (8 MB as doubles).
MAX_BROADCAST_NUMBERS = 1_000_000
# How many numbers one block of a grouped join may hold (32 MB as doubles).
BLOCK_NUMBERS = 4_000_000
# How many numbers a table of distances, or a batch that a task puts out, may hold (8 MB as doubles).
TABLE_NUMBERS = 1_000_000
# Of one block of the corpus, how many queries are searched together, and so many tasks it is cut into before they hold fewer.
QUERIES_AT_ONCE = 2048
TASKS_PER_BLOCK = 8


def collection(rows: DataFrame, id_column: str, embedding: str, document: Column | None = None,
               metadata: dict[str, Column] | None = None) -> DataFrame:
    """Rows in collection form: ``id, document, metadata, embedding``."""
    pairs = [part for name, value in (metadata or {}).items() for part in (F.lit(name), value.cast("string"))]
    tags = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return rows.select(
        F.col(id_column).cast("string").alias("id"),
        (F.lit(None) if document is None else document).cast("string").alias("document"),
        tags.alias("metadata"), F.col(embedding).cast("array<float>").alias("embedding"))


def add_documents(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """The incoming rows that may be appended: ids not stored yet, each id once.

    Known ids are looked up first, so a small batch is what travels and the stored
    rows are only scanned by id.
    """
    known = stored.select("id").join(incoming.select("id"), "id", "left_semi")
    fresh = incoming.join(known, "id", "left_anti")
    return first_per_key(fresh, ["id"], [F.col("document"), F.col("embedding")])


def get_documents(stored: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows with one of the given ids."""
    return stored.join(ids.select("id"), "id", "left_semi")


def search(stored: DataFrame, queries: DataFrame, k: int, metric: str = "l2") -> DataFrame:
    """The ``k`` nearest documents per query with their text: ``query_id, rank, id, distance, document``."""
    found = nearest(queries, stored, k, metric)
    return found.join(stored.select("id", "document"), "id").select("query_id", "rank", "id", "distance", "document")


def whole_vector(name: str, dims: int) -> Column:
    """Whether a vector has ``dims`` numbers and no NULL among them."""
    return F.coalesce((F.size(name) == dims) & ~F.exists(name, lambda x: x.isNull()), F.lit(False))


def nearest(queries: DataFrame, corpus: DataFrame, k: int, metric: str = "l2",
            max_broadcast_numbers: int = MAX_BROADCAST_NUMBERS, block_numbers: int = BLOCK_NUMBERS) -> DataFrame:
    """The ``k`` nearest corpus rows of every query, exactly.

    Both sides have a unique ``id`` and an ``embedding``. The result has ``query_id, id,
    distance, rank``, ties broken by id. Vectors that are NULL, hold a NULL, or have
    fewer numbers than the longest query (or more) take no part, on either side. ``metric`` is ``l2`` (squared distance) or
    ``cosine`` (1 - cosine).

    A small query side, whose size is counted first, is sent to the tasks and the
    corpus is scanned where it lies. For a larger one the corpus is parted into cells
    around pivots. A query first meets the cells around it, which bounds the distance
    of its ``k``-th neighbour, and then only those cells that may hold a nearer row by
    the triangle inequality. Cells are gathered into blocks for that, and a query is
    shuffled once to each block that holds a cell it needs, with a bit per cell: never
    more rows than blocks that all meet would take. Every group of the joins holds two
    blocks of bounded size, and a task keeps only its ``k`` best rows per query, so pairs
    are never emitted, and the last step ranks those few. Equal query vectors are searched
    once, and of equal corpus vectors only the ``k`` first are.
    """
    queries = queries.select(F.col("id").alias("query_id"), F.col("embedding").alias("query"))
    corpus = corpus.select("id", "embedding")
    dims = queries.agg(F.max(F.size("query"))).first()[0] or 0
    queries, corpus = queries.filter(whole_vector("query", dims)), corpus.filter(whole_vector("embedding", dims))
    kinds = (queries.schema["query_id"].dataType, corpus.schema["id"].dataType)
    found_schema = T.StructType([
        T.StructField("query_id", kinds[0]), T.StructField("id", kinds[1]), T.StructField("distance", T.DoubleType())])

    size = queries.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("query").cast("bigint")).alias("numbers")).first()
    if (size["numbers"] or 0) <= max_broadcast_numbers:
        found = _scan_corpus(queries, corpus, k, metric, found_schema)
    else:
        found = _join_pivots(queries, corpus, k, metric, found_schema, max(1, block_numbers // dims))
    return top_per_key(found, ["query_id"], [F.col("distance"), F.col("id")], k)


def _scan_corpus(queries: DataFrame, corpus: DataFrame, k: int, metric: str, schema: T.StructType) -> DataFrame:
    """Map-side search. The caller has checked the size of the query side."""
    table = queries.toArrow()
    ids = np.array(table.column("query_id").to_pylist(), dtype=object)
    shared = queries.sparkSession.sparkContext.broadcast((ids, _matrix(table.column("query"))))
    arrow_schema = _arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query_vectors = shared.value
        best = _Best(query_ids, query_vectors, k, metric)
        for batch in batches:
            best.offer(batch.column("id"), batch.column("embedding"))
        yield best.as_batch(arrow_schema)

    return corpus.mapInArrow(search, schema)


def _meet(left: DataFrame, right: DataFrame, keys: list[str], k: int, metric: str, schema: T.StructType) -> DataFrame:
    """The ``k`` best rows per query of each group: two blocks of bounded size."""
    arrow_schema = _arrow_schema(schema)

    def search(query_rows: pa.Table, corpus_rows: pa.Table) -> pa.Table:
        if not query_rows.num_rows or not corpus_rows.num_rows:
            return arrow_schema.empty_table()
        ids = np.array(query_rows.column("query_id").to_pylist(), dtype=object)
        best = _Best(ids, _matrix(query_rows.column("query")), k, metric)
        best.offer(corpus_rows.column("id"), corpus_rows.column("embedding"))
        return pa.Table.from_batches([best.as_batch(arrow_schema)])

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)


def _part(id_column: str, parts: Column | int) -> Column:
    return F.pmod(F.xxhash64(id_column), parts if isinstance(parts, Column) else F.lit(parts)).cast("int")


def _every(parts: Column | int) -> Column:
    return F.explode(F.sequence(F.lit(0), (parts if isinstance(parts, Column) else F.lit(parts)).cast("int") - 1))


def place_in_cells(corpus: DataFrame, dims: int, metric: str) -> tuple[DataFrame, Cells] | None:
    """The corpus with the ``cell`` of each row, and what is known of the cells; None if it is empty.

    Pivots come from a sample by a hash of the id, of at most ``MAX_PIVOTS * SAMPLE_PER_PIVOT`` rows and
    ``MAX_BROADCAST_NUMBERS`` numbers; all rows are placed.
    """
    spark = corpus.sparkSession
    n = corpus.count()
    if not n:
        return None
    wanted = max(1, min(MAX_PIVOTS, int(n ** 0.5), MAX_BROADCAST_NUMBERS // (dims * SAMPLE_PER_PIVOT)))
    sample = corpus.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PER_PIVOT * wanted).select("embedding").toArrow()
    pivots = choose_pivots(_matrix(sample.column("embedding")), wanted, metric)
    shared, pivots_at_once = spark.sparkContext.broadcast(pivots), pivots.cells

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, TABLE_NUMBERS // pivots_at_once)
        for whole in batches:
            for at in range(0, len(whole), step):
                batch = whole.slice(at, step)
                cell, distance, slack = shared.value.place(_matrix(batch.column("embedding")))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(distance), pa.array(np.full(len(cell), slack))],
                    [*batch.schema.names, "cell", "gap", "slack"])

    placed = stored(corpus.mapInArrow(place, T.StructType(
        [*corpus.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("gap", T.DoubleType()), T.StructField("slack", T.DoubleType())])), "cells")
    counts, least, most = np.zeros(pivots.cells, np.int64), np.zeros(pivots.cells), np.zeros(pivots.cells)
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("gap") - F.col("slack")).alias("least"),
                                        F.max(F.col("gap") + F.col("slack")).alias("most")).collect():   # a row per cell
        counts[r["cell"]], least[r["cell"]], most[r["cell"]] = r["n"], r["least"], r["most"]
    return placed.select("id", "embedding", "cell"), Cells(pivots, counts, least, most)


def routes(queries: DataFrame, cells: Cells, k: int) -> DataFrame:
    """``query_id, query, cell``: the cells to search for each query. Without a column ``bound`` the nearest ones, which hold
    ``k`` rows, and with it the others that may hold a row within it."""
    shared = queries.sparkSession.sparkContext.broadcast(cells)
    bounded = "bound" in queries.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Cells = shared.value
        step = max(1, TABLE_NUMBERS // known.pivots.cells)
        for whole in batches:
            for at in range(0, len(whole), step):
                batch = whole.slice(at, step)
                distances, slack = known.pivots.distances(_matrix(batch.column("query")))
                wanted = known.first(distances, k)
                if bounded:
                    limit = as_euclidean(np.asarray(batch.column("bound"), np.float64), known.pivots.metric)
                    wanted = known.possible(distances, slack, limit) & ~wanted
                row, cell = np.nonzero(wanted)
                for some in _few_numbers(row, batch.column("query")):
                    rows = batch.select(["query_id", "query"]).take(pa.array(row[some]))
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cell[some].astype(np.int32))], ["query_id", "query", "cell"])

    fields = [queries.schema[x] for x in ("query_id", "query")]
    return queries.mapInArrow(run, T.StructType([*fields, T.StructField("cell", T.IntegerType())]))


def _few_numbers(rows: np.ndarray, vectors) -> Iterator[slice]:
    """Stretches of ``rows`` whose vectors hold at most ``TABLE_NUMBERS`` numbers, so that a batch stays small however many rows there are."""
    step = max(1, TABLE_NUMBERS * len(vectors) // max(1, len(vectors.flatten())))
    return (slice(at, at + step) for at in range(0, len(rows), step))


def blocks_of_cells(cells: Cells, block_rows: int) -> list[tuple[np.ndarray, int]]:
    """Whole cells of together at most ``block_rows`` rows, and 1; or one larger cell, and into how many parts it is cut."""
    blocks, gathered, held = [], [], 0
    for cell in np.flatnonzero(cells.counts):
        n = int(cells.counts[cell])
        if gathered and held + n > block_rows:
            blocks.append((np.array(gathered), -(-held // block_rows)))
            gathered, held = [], 0
        gathered.append(cell)
        held += n
    return [*blocks, (np.array(gathered), -(-held // block_rows))] if gathered else blocks


def _search_blocks(asked: DataFrame, n_queries: int, corpus: DataFrame, cells: Cells, k: int, metric: str, schema: T.StructType,
                   block_rows: int) -> DataFrame:
    """Queries, each with a ``bound``, with all cells that may hold a row within it; a query goes once to each block of cells."""
    blocks = blocks_of_cells(cells, block_rows)
    q_parts = max(-(-n_queries // block_rows), min(TASKS_PER_BLOCK, -(-n_queries // QUERIES_AT_ONCE)))
    shared = asked.sparkSession.sparkContext.broadcast((cells, blocks))
    block_of, parts_of = np.full(len(cells.counts), -1, np.int32), np.array([n for _, n in blocks], np.int32)
    for b, (members, _) in enumerate(blocks):
        block_of[members] = b

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gathered = shared.value
        step = max(1, TABLE_NUMBERS // known.pivots.cells)
        for whole in batches:
            for at in range(0, len(whole), step):
                batch = whole.slice(at, step)
                distances, slack = known.pivots.distances(_matrix(batch.column("query")))
                limit = as_euclidean(np.asarray(batch.column("bound"), np.float64), known.pivots.metric)
                wanted = known.possible(distances, slack, limit)
                for b, (members, parts) in enumerate(gathered):
                    row = np.flatnonzero(wanted[:, members].any(axis=1))
                    bits = np.packbits(wanted[row][:, members], axis=1)
                    for some in _few_numbers(row, batch.column("query")):
                        rows = batch.select(["query_id", "query", "bound"]).take(pa.array(row[some]))
                        for part in range(parts):
                            here = [pa.array(np.full(rows.num_rows, x, np.int32)) for x in (b, part)]
                            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([x.tobytes() for x in bits[some]], pa.binary()), *here],
                                                             ["query_id", "query", "bound", "wanted", "block", "c_part"])

    numbered = asked.sparkSession.createDataFrame(      # a row per cell
        [(int(c), int(block_of[c]), int(parts_of[block_of[c]])) for c in np.flatnonzero(cells.counts)], "cell int, block int, c_parts int")
    fields = [asked.schema[x] for x in ("query_id", "query", "bound")]
    left = asked.select("query_id", "query", "bound").mapInArrow(route, T.StructType([
        *fields, T.StructField("wanted", T.BinaryType()), T.StructField("block", T.IntegerType()), T.StructField("c_part", T.IntegerType())]))
    left = left.withColumn("q_part", _part("query_id", q_parts))
    right = corpus.join(F.broadcast(numbered), "cell").withColumn("c_part", _part("id", F.col("c_parts"))).drop("c_parts").withColumn(
        "q_part", _every(q_parts))
    arrow_schema, keys = _arrow_schema(schema), ["block", "c_part", "q_part"]

    def search(key: tuple, query_rows: pa.Table, corpus_rows: pa.Table) -> pa.Table:
        found = []
        if query_rows.num_rows and corpus_rows.num_rows:
            members = shared.value[1][key[0].as_py()][0]
            cell = corpus_rows.column("cell").to_numpy()
            order = np.argsort(cell, kind="stable")
            starts, ends = (np.searchsorted(cell[order], members, side) for side in ("left", "right"))
            ids, rows = np.array(corpus_rows.column("id").to_pylist())[order], _matrix(corpus_rows.column("embedding"))[order]
            for at in range(0, query_rows.num_rows, QUERIES_AT_ONCE):
                some = query_rows.slice(at, QUERIES_AT_ONCE)
                best = _Best(np.array(some.column("query_id").to_pylist(), dtype=object), _matrix(some.column("query")), k, metric,
                             some.column("bound").to_numpy())
                bits = np.frombuffer(b"".join(some.column("wanted").to_pylist()), np.uint8).reshape(some.num_rows, -1)
                wanted = np.unpackbits(bits, axis=1, count=len(members)).astype(bool)
                for c in np.flatnonzero(ends > starts):
                    best.offer_to(np.flatnonzero(wanted[:, c]), ids[starts[c]:ends[c]], rows[starts[c]:ends[c]])
                found.append(best.as_batch(arrow_schema))
        return pa.Table.from_batches(found, arrow_schema)

    # little data may mean much work, so few rows do not share a task
    groups = min(2 * q_parts * int(parts_of.sum()), max(200, int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    left, right = left.repartition(groups, *keys), right.repartition(groups, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)


def _search_cells(routed: DataFrame, corpus: DataFrame, cells: Cells, k: int, metric: str, schema: T.StructType, block_rows: int) -> DataFrame:
    """Queries with the rows of the cells they were sent to. Large cells and crowded ones are cut into parts."""
    wanted = routed.groupBy("cell").agg(F.count(F.lit(1)).alias("asked"))
    sizes = corpus.sparkSession.createDataFrame([(c, int(n)) for c, n in enumerate(cells.counts) if n], "cell int, held long")
    parts = F.broadcast(stored(wanted.join(sizes, "cell").select(    # a row per cell
        "cell", F.ceil(F.col("asked") / block_rows).alias("q_parts"), F.ceil(F.col("held") / block_rows).alias("c_parts")), "parts"))
    left = routed.join(parts, "cell").withColumn("q_part", _part("query_id", F.col("q_parts"))).withColumn("c_part", _every(F.col("c_parts")))
    right = corpus.join(parts, "cell").withColumn("c_part", _part("id", F.col("c_parts"))).withColumn("q_part", _every(F.col("q_parts")))
    return _meet(left.drop("q_parts", "c_parts"), right.drop("q_parts", "c_parts"), ["cell", "q_part", "c_part"], k, metric, schema)


def pairs_to_meet(routed: DataFrame, cells: Cells) -> int:
    """How many pairs of a query and a corpus row a search of these routes computes."""
    return sum(r["n"] * int(cells.counts[r["cell"]]) for r in routed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect())


def _join_pivots(queries: DataFrame, corpus: DataFrame, k: int, metric: str, schema: T.StructType, block_rows: int) -> DataFrame:
    """Search by cells, for a query side of any size."""
    dims = queries.select(F.max(F.size("query"))).first()[0]
    asked = stored(queries.groupBy("query").agg(F.min("query_id").alias("query_id")), "queries")
    fewer = stored(top_per_key(corpus, ["embedding"], [F.col("id")], k).select("id", "embedding"), "corpus")
    placed = place_in_cells(fewer, dims, metric)
    if placed is None:
        return queries.sparkSession.createDataFrame([], schema)
    rows, cells = placed
    first = stored(routes(asked.select("query_id", "query"), cells, k), "routes")
    near = _search_cells(first, rows, cells, k, metric, schema, block_rows)
    ranked = top_per_key(near, ["query_id"], [F.col("distance"), F.col("id")], k)
    bounds = ranked.groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.max("distance")).otherwise(float("inf")).alias("bound"))
    bounded = stored(asked.join(bounds, "query_id"), "bounds")
    found = _search_blocks(bounded, bounded.count(), rows, cells, k, metric, schema, block_rows)
    best = top_per_key(found, ["query_id"], [F.col("distance"), F.col("id")], k).select(F.col("query_id").alias("asked_as"), "id", "distance")
    same = queries.join(asked.select(F.col("query_id").alias("asked_as"), "query"), "query").select("query_id", "asked_as")
    return same.join(best, "asked_as").select("query_id", "id", "distance")


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema])


def _matrix(vectors) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if len(vectors) == 0:
        return np.zeros((0, 0))
    return np.asarray(vectors.flatten(), dtype=np.float64).reshape(len(vectors), -1)


def _squares(rows: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", rows, rows)


def _distances(queries: np.ndarray, q_squares: np.ndarray, rows: np.ndarray, metric: str) -> tuple[np.ndarray, float]:
    """Fast distances by one matrix product, and how far off they may be."""
    products = queries @ rows.T
    q_squares, r_squares = q_squares[:, None], _squares(rows)[None, :]
    rounding = 8 * (queries.shape[1] + 1) * np.finfo(np.float64).eps
    if metric == "cosine":
        lengths = np.sqrt(q_squares) * np.sqrt(r_squares)
        return 1.0 - np.divide(products, lengths, out=np.zeros_like(products), where=lengths > 0), rounding
    return q_squares + r_squares - 2.0 * products, rounding * float(q_squares.max() + r_squares.max())


def _pair_distances(queries: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """The distances that are reported, row by row: equal vectors get equal ones, to the last bit."""
    def total(values: np.ndarray) -> np.ndarray:
        return np.cumsum(values, axis=1)[:, -1]   # left to right, whatever the number of rows

    if metric == "l2":
        return total((rows - queries) ** 2)
    lengths = np.sqrt(total(queries * queries)) * np.sqrt(total(rows * rows))
    dots = total(rows * queries)
    return 1.0 - np.divide(dots, lengths, out=np.zeros_like(dots), where=lengths > 0)


def _rank_in_group(groups: np.ndarray) -> np.ndarray:
    """The position of each entry among the equal ones of a sorted array."""
    return np.arange(len(groups)) - np.searchsorted(groups, groups, "left")


class _Best:
    """The ``k`` nearest rows seen so far for each query of a block."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, metric: str, bound: np.ndarray | None = None):
        """``bound``, if known: a distance within which each query has ``k`` rows of the corpus."""
        if metric not in ("l2", "cosine"):
            raise ValueError(f"unknown metric: {metric}")
        self.query_ids, self.queries, self.k, self.metric = query_ids, queries, k, metric
        self.squares = _squares(queries)
        self.position, self.distance, self.ids = np.zeros(0, dtype=np.int64), np.zeros(0), None
        self.bound = np.full(len(query_ids), np.inf) if bound is None else np.array(bound)

    def offer(self, ids, embeddings) -> None:
        if len(self.query_ids) and len(ids):
            self.offer_to(slice(None), *self._few_copies(np.array(ids.to_pylist()), _matrix(embeddings)))

    def offer_to(self, which: np.ndarray | slice, ids: np.ndarray, rows: np.ndarray) -> None:
        """Rows for some of the queries."""
        asked = np.arange(len(self.query_ids))[which]
        if len(asked):
            step = max(64, TABLE_NUMBERS // len(asked))
            for start in range(0, len(ids), step):
                self._offer(asked, which, ids[start:start + step], rows[start:start + step])

    def _few_copies(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of equal vectors only the first ``k`` ids can be among the nearest."""
        _, same = np.unique(rows, axis=0, return_inverse=True)
        order = np.lexsort((ids, same))
        kept = order[_rank_in_group(same[order]) < self.k]
        return ids[kept], rows[kept]

    def _offer(self, asked: np.ndarray, which: np.ndarray | slice, ids: np.ndarray, rows: np.ndarray) -> None:
        queries, known = self.queries[which], self.bound[which]
        rough, slack = _distances(queries, self.squares[which], rows, self.metric)
        within = rough <= (known + slack)[:, None]
        if np.count_nonzero(within) > 2 * self.k * len(asked):
            last = min(self.k, len(ids)) - 1
            within = rough <= (np.minimum(np.partition(rough, last, axis=1)[:, last], known) + slack)[:, None]
        query, row = np.nonzero(within)
        if len(query):
            step = max(1, TABLE_NUMBERS // rows.shape[1])
            exact = [_pair_distances(queries[query[i:i + step]], rows[row[i:i + step]], self.metric) for i in range(0, len(query), step)]
            self._merge(asked[query], np.concatenate(exact), ids[row])

    def _merge(self, position: np.ndarray, distance: np.ndarray, ids: np.ndarray) -> None:
        if self.ids is not None:
            position, distance = np.append(self.position, position), np.append(self.distance, distance)
            ids = np.append(self.ids, ids)
        order = np.lexsort((ids, distance, position))
        rank = _rank_in_group(position[order])
        order, rank = order[rank < self.k], rank[rank < self.k]
        self.position, self.distance, self.ids = position[order], distance[order], ids[order]
        full = rank == self.k - 1
        self.bound[self.position[full]] = np.minimum(self.bound[self.position[full]], self.distance[full])

    def as_batch(self, schema: pa.Schema) -> pa.RecordBatch:
        found = [] if self.ids is None else self.ids.tolist()
        columns = (self.query_ids[self.position].tolist(), found, self.distance.tolist())
        return pa.record_batch([pa.array(values, kind) for values, kind in zip(columns, schema.types)], schema=schema)
