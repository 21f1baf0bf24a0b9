"""Queries over the vector collection."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.vectors import add_documents, collection, get_documents, nearest, search
from millrace.queries.registry import query, table

L2 = "list_sum(list_transform(list_zip(q.embedding, c.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) ** 2))"

NEAREST_SQL = """
SELECT query_id, id, round(distance, 6) AS distance, r::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS r FROM (
    SELECT q.vec_id AS query_id, c.vec_id AS id, {distance} AS distance
    FROM embeddings q, (SELECT * FROM embeddings WHERE {keep}) c))
WHERE r <= 2
"""


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def _stored(spark, sf_dir):
    return collection(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", metadata={"label": F.col("label")})


@query("""
SELECT vec_id::VARCHAR AS id, label::VARCHAR AS label, len(embedding)::INTEGER AS dimensions
FROM embeddings WHERE label >= 5
""")
def vec_add(spark, sf_dir):
    """What may be appended: half of the incoming ids are stored already, and each comes twice."""
    everything = _stored(spark, sf_dir)
    stored = everything.filter("cast(metadata['label'] AS int) < 5")
    fresh = add_documents(stored, everything.unionByName(everything))
    return fresh.select("id", F.col("metadata")["label"].alias("label"), F.size("embedding").alias("dimensions"))


@query("""
SELECT vec_id::VARCHAR AS id, label::VARCHAR AS label, len(embedding)::INTEGER AS dimensions
FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels)
""")
def vec_get(spark, sf_dir):
    """Documents by id."""
    wanted = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return get_documents(_stored(spark, sf_dir), wanted).select(
        "id", F.col("metadata")["label"].alias("label"), F.size("embedding").alias("dimensions"))


@query(NEAREST_SQL.format(distance=L2, keep="true"))
def vec_topk(spark, sf_dir):
    """The two nearest vectors of every vector."""
    vectors = _vectors(spark, sf_dir)
    return nearest(vectors, vectors, 2).withColumn("distance", F.round("distance", 6))


@query(NEAREST_SQL.format(distance=L2, keep="label = 3"))
def vec_filtered(spark, sf_dir):
    """The same within one metadata value, filtered before any distance is computed."""
    vectors = _vectors(spark, sf_dir)
    return nearest(vectors, vectors.filter("label = 3"), 2).withColumn("distance", F.round("distance", 6))


@query(NEAREST_SQL.format(
    distance="1 - list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[])", keep="true"))
def vec_cosine(spark, sf_dir):
    """Two nearest by cosine."""
    vectors = _vectors(spark, sf_dir)
    return nearest(vectors, vectors, 2, metric="cosine").withColumn("distance", F.round("distance", 6))


@query("""
SELECT query_id, r::INTEGER AS rank, id, round(distance, 6) AS distance, text AS document FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS r FROM (
    SELECT q.vec_id::VARCHAR AS query_id, c.vec_id::VARCHAR AS id, c.text, """ + L2 + """ AS distance
    FROM embeddings q, (SELECT * FROM embeddings JOIN documents ON vec_id = doc_id) c))
WHERE r <= 2
""")
def vec_search(spark, sf_dir):
    """The two nearest documents of every vector, with their whole text."""
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    embedded = table(spark, sf_dir, "embeddings").join(documents, "vec_id")
    stored = collection(embedded, "vec_id", "embedding", F.col("text"))
    return search(stored, _stored(spark, sf_dir), 2).withColumn("distance", F.round("distance", 6))


@query(NEAREST_SQL.format(distance=L2, keep="true"))
def vec_topk_cells(spark, sf_dir):
    """The two nearest vectors of every vector, as for a query side too large to be sent to the tasks: by cells around pivots."""
    vectors = _vectors(spark, sf_dir)
    return nearest(vectors, vectors, 2, max_broadcast_numbers=0).withColumn("distance", F.round("distance", 6))
