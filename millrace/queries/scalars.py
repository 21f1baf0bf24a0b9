"""Queries over scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.numbers import comma_decimal, fixed_text, round_half_even
from millrace.functions.text import canonical_label, padded_id, without_prefix
from millrace.functions.times import clock, iso_day, parse_iso, plus_seconds
from millrace.queries.registry import query, table

SEGMENTS = ["Automobile", "Building", "Furniture", "HouseHold"]


@query("""
SELECT c_custkey, upper(lower(c_name)) AS shouted, 'HEL' || lpad(c_nationkey::VARCHAR, 3, '0') AS padded,
       c_acctbal AS balance, substr(c_name, 10) AS number,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Automobile' WHEN 'BUILDING' THEN 'Building'
         WHEN 'FURNITURE' THEN 'Furniture' WHEN 'HOUSEHOLD' THEN 'HouseHold' ELSE c_mktsegment END AS label
FROM customer
""")
def scalar_strings(spark, sf_dir):
    """Upper case, padded ids, comma decimals, prefix removal, repaired labels."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.upper(F.lower("c_name")).alias("shouted"), padded_id("HEL", F.col("c_nationkey")).alias("padded"),
        comma_decimal(F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(","))).alias("balance"),
        without_prefix(F.col("c_name"), "Customer#").alias("number"),
        canonical_label(F.col("c_mktsegment"), SEGMENTS).alias("label"))


@query("""
SELECT event_id, date_trunc('second', ts) + to_seconds(json_extract(props, '$.k')::INTEGER) AS later,
       strftime(ts, '%H:%M:%S') AS clock, strftime(ts, '%Y-%m-%d') AS day
FROM events
""")
def scalar_time(spark, sf_dir):
    """ISO text to a timestamp, plus seconds, and formatted parts."""
    moment = parse_iso(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    seconds = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id", plus_seconds(moment, seconds).cast("timestamp_ntz").alias("later"),
        clock(moment).alias("clock"), iso_day(moment).alias("day"))


@query("""
SELECT p_partkey, round_even(p_size / 8, 2) AS eighths, round_even(p_size / 2, 0) AS halves,
       printf('%.1f', p_size / 4) AS quarters
FROM part
""")
def scalar_numeric(spark, sf_dir):
    """Rounding with ties to even, on values that are exact in binary."""
    size = F.col("p_size").cast("double")
    return table(spark, sf_dir, "part").select(
        "p_partkey", round_half_even(size / 8, 2).alias("eighths"), round_half_even(size / 2, 0).alias("halves"),
        fixed_text(size / 4, 1).alias("quarters"))


@query("""
SELECT vec_id, len(embedding)::INTEGER AS dimensions, embedding[1]::DOUBLE AS v1, embedding[2]::DOUBLE AS v2,
       embedding[3]::DOUBLE AS v3, embedding[4]::DOUBLE AS v4, embedding[5]::DOUBLE AS v5
FROM embeddings
""")
def scalar_arrays(spark, sf_dir):
    """Length and first five values of every vector."""
    first = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.size("embedding").alias("dimensions"), F.slice("embedding", 1, 5).alias("five"))
    return first.select("vec_id", "dimensions",
                        *[F.get("five", F.lit(i)).cast("double").alias(f"v{i + 1}") for i in range(5)])
