"""Nearest neighbours against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.operators import vectors
from millrace.operators.pivots import Cells, choose_pivots
from millrace.operators.vectors import add_documents, collection, get_documents, nearest
from millrace.plans import vector_search
from millrace.session import stored


def brute_force(queries, corpus, k, metric):
    result = {}
    for q, query in queries.items():
        scored = []
        for i, row in corpus.items():
            a, b = np.array(query, dtype=np.float64), np.array(row, dtype=np.float64)
            gap = float(((a - b) ** 2).sum()) if metric == "l2" else float(1 - a @ b / np.sqrt((a @ a) * (b @ b)))
            scored.append((round(gap, 9), i))
        result[q] = [i for _, i in sorted(scored)[:k]]
    return result


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_nearest(spark, metric, limit):
    dice = np.random.default_rng(3)
    data = {i: [float(np.float32(x)) for x in dice.normal(size=8)] for i in range(300)}
    data.update({i: data[7] for i in range(300, 400)})   # a quarter of the rows are copies of one
    queries = {i: data[i] for i in (0, 7, 33, 350)}
    schema = "id bigint, embedding array<float>"
    corpus = spark.createDataFrame(list(data.items()), schema).repartition(5)
    asked = spark.createDataFrame(list(queries.items()), schema)
    found = nearest(asked, corpus, 3, metric, max_broadcast_numbers=limit, block_numbers=8 * 50).collect()
    got = {q: [r["id"] for r in sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])] for q in queries}
    assert got == brute_force(queries, data, 3, metric)
    assert all(r["distance"] >= -1e-12 for r in found)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_far_from_the_origin_and_empty_vectors(spark, limit):
    """Close neighbours far out, where a matrix product alone would lose them; zero vectors have cosine distance 1."""
    base = 1e6
    corpus = spark.createDataFrame([(i, [base + i * 0.125, base]) for i in range(50)], "id bigint, embedding array<double>")
    asked = spark.createDataFrame([(7, [base + 7 * 0.125, base])], "id bigint, embedding array<double>")
    found = nearest(asked, corpus, 3, max_broadcast_numbers=limit).orderBy("rank").collect()
    assert [(r["id"], r["distance"]) for r in found] == [(7, 0.0), (6, 0.015625), (8, 0.015625)]
    zero = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0])], "id bigint, embedding array<double>")
    found = nearest(zero, zero, 2, "cosine", max_broadcast_numbers=limit).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["id"], round(r["distance"], 9)) for r in found] == [(1, 1, 1.0), (1, 2, 1.0), (2, 2, 0.0), (2, 1, 1.0)]


def test_nearest_of_few_and_none(spark):
    schema = "id string, embedding array<float>"
    corpus = spark.createDataFrame([("a", [1.0, 0.0])], schema)
    asked = spark.createDataFrame([("q", [0.0, 0.0])], schema)
    assert [tuple(r) for r in nearest(asked, corpus, 2).collect()] == [("q", "a", 1.0, 1)]
    assert nearest(asked.limit(0), corpus, 2).count() == 0
    assert nearest(asked, corpus.limit(0), 2).count() == 0
    with pytest.raises(Exception, match="unknown metric"):
        nearest(asked, corpus, 2, metric="angle").collect()


def test_collection(spark):
    rows = spark.createDataFrame([(1, "payments", "fee", [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]), (2, "prices", "rise", [0.0] * 6)],
                                 "n int, category string, text string, v array<float>")
    stored = collection(rows, "n", "v", F.col("text"), {"category": F.col("category")})
    assert stored.columns == ["id", "document", "metadata", "embedding"]
    incoming = collection(rows.union(rows).withColumn("n", F.col("n") + 1), "n", "v", F.col("text"))
    assert sorted(r["id"] for r in add_documents(stored, incoming).collect()) == ["3"]
    wanted = spark.createDataFrame([("1",), ("9",)], "id string")
    got = get_documents(stored, wanted).select(F.size("embedding"), F.slice("embedding", 1, 5), "metadata").collect()
    assert [tuple(r) for r in got] == [(6, [1.0, 2.0, 3.0, 4.0, 5.0], {"category": "payments"})]
    assert nearest(stored.filter("metadata['category'] = 'prices'"), stored, 1).first()["id"] == "2"


def test_search_job(spark, folder):
    schema = "id string, document string, metadata map<string,string>, embedding array<float>"
    spark.createDataFrame([("id1", "fee", {"category": "payments"}, [1.0, 0.0])], schema).write.parquet(f"{folder}/stored")
    spark.createDataFrame([("id1", "again", {}, [9.0, 9.0]), ("id2", "rise", {"category": "prices"}, [0.0, 1.0]),
                           ("id3", "help", {}, [5.0, 5.0])], schema).write.parquet(f"{folder}/new")
    spark.createDataFrame([("q1", [0.9, 0.0])], "id string, embedding array<float>").write.parquet(f"{folder}/queries")
    vector_search.main(["--collection", f"{folder}/stored", "--add", f"{folder}/new", "--queries", f"{folder}/queries",
                        "--output", f"{folder}/out"])
    assert sorted(r[0] for r in spark.read.text(f"{folder}/out").collect()) == [
        "q1 | Result 1 (Distance: 0.01): fee", "q1 | Result 2 (Distance: 1.81): rise"]


def clustered(n, centres=40, dims=8, seed=1):
    dice = np.random.default_rng(seed)
    middle = dice.normal(size=(centres, dims)) * 10
    rows = (middle[dice.integers(centres, size=n)] + dice.normal(size=(n, dims)) * 0.3).astype(np.float32)
    return {i: [float(x) for x in row] for i, row in enumerate(rows)}


def met(queries, corpus, k, metric="l2"):
    """Pairs that a search by cells computes, in both of its passes, and all pairs."""
    asked = queries.select(F.col("id").alias("query_id"), F.col("embedding").alias("query"))
    rows, cells = vectors.place_in_cells(corpus.select("id", "embedding"), 8, metric)
    first = vectors.routes(asked, cells, k)
    bounds = nearest(queries, corpus, k, metric).groupBy("query_id").agg(F.max("distance").alias("bound"))
    more = vectors.routes(asked.join(bounds, "query_id"), cells, k)
    return vectors.pairs_to_meet(first, cells) + vectors.pairs_to_meet(more, cells), asked.count() * rows.count()


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_cells_that_hold_no_neighbour_are_not_met(spark, metric):
    found = spark.createDataFrame(list(clustered(3000).items()), "id bigint, embedding array<float>").repartition(4)
    some, every = met(found, found, 3, metric)
    assert some < every / 4      # under half of all pairs, by far
    by_cells = nearest(found, found, 3, metric, max_broadcast_numbers=0, block_numbers=8 * 100)
    whole = nearest(found, found, 3, metric)
    assert sorted(map(tuple, by_cells.collect())) == sorted(map(tuple, whole.collect()))


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_cells_with_copies_zeros_ties_and_no_structure(spark, metric):
    dice = np.random.default_rng(7)
    data = {i: [float(np.float32(x)) for x in dice.normal(size=8)] for i in range(400)}                # nothing to prune
    data |= {i: [0.0] * 8 for i in range(400, 450)} | {i: data[3] for i in range(450, 700)}              # hot copies, zeros
    data |= {i: [float(i % 3), 1.0] + [0.0] * 6 for i in range(700, 760)}                                # ties
    data |= {i: [2.0 * x for x in data[i - 760]] for i in range(760, 780)}                               # one direction, other lengths
    found = spark.createDataFrame(list(data.items()), "id bigint, embedding array<float>").repartition(5)
    for k in (1, 4):
        by_cells = nearest(found, found, k, metric, max_broadcast_numbers=0, block_numbers=8 * 64)
        whole = nearest(found, found, k, metric)
        assert sorted(map(tuple, by_cells.collect())) == sorted(map(tuple, whole.collect()))


def test_bounds_never_exceed_a_distance():
    """The cells left out hold no row within the bound, whatever the scale and the offset of the vectors."""
    dice = np.random.default_rng(9)
    for scale, offset in ((1.0, 0.0), (1e-6, 0.0), (1.0, 1e6), (1e8, -1e8)):
        rows = dice.normal(size=(600, 5)) * scale + offset
        pivots = choose_pivots(rows[:100], 20, "l2")
        cell, gap, slack = pivots.place(rows)
        counts = np.bincount(cell, minlength=pivots.cells)
        least, most = (np.array([f(gap[cell == c]) if counts[c] else 0.0 for c in range(pivots.cells)]) for f in (np.min, np.max))
        cells = Cells(pivots, counts, least - slack, most + slack)
        asked = rows[:50] + dice.normal(size=(50, 5)) * scale * 0.1
        exact = np.sqrt(((asked[:, None, :] - rows[None]) ** 2).sum(axis=2))
        bounds = np.sort(exact, axis=1)[:, 4]
        allowed = cells.possible(*pivots.distances(asked), bounds)
        for q in range(50):
            assert allowed[q][cell[exact[q] <= bounds[q]]].all()
        assert ((cells.first(pivots.distances(asked)[0], 7) * counts).sum(axis=1) >= 7).all()


def test_vectors_without_clusters_are_not_sent_to_each_cell(spark, monkeypatch):
    """Where every cell may hold a neighbour, a query is still written once, not once per cell, and batches stay small."""
    dice = np.random.default_rng(5)
    found = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(dice.normal(size=(600, 24)))], "id bigint, embedding array<double>")
    written = {}

    def counted(df, label):
        out = stored(df, label)
        written[label] = written.get(label, 0) + out.count()
        return out
    monkeypatch.setattr(vectors, "stored", counted)
    by_cells = nearest(found, found, 1, max_broadcast_numbers=0, block_numbers=24 * 250)
    assert sorted(map(tuple, by_cells.collect())) == [(i, i, 0.0, 1) for i in range(600)]
    assert written["routes"] <= 600
    many = pa.array([[0.0] * 1000] * 5)
    assert max(x.stop - x.start for x in vectors._few_numbers(np.zeros(10_000, np.int64), many)) * 1000 <= vectors.TABLE_NUMBERS


def test_blocks_hold_whole_cells_or_parts_of_one():
    pivots = choose_pivots(np.arange(10.0)[:, None], 5, "l2")
    cells = Cells(pivots, np.array([3, 0, 4, 25, 2, 2]), np.zeros(6), np.zeros(6))
    assert [(list(map(int, cell)), parts) for cell, parts in vectors.blocks_of_cells(cells, 10)] == [([0, 2], 1), ([3], 3), ([4, 5], 1)]
