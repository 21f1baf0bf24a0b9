"""Queries over projections and row maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.numbers import whole_part
from millrace.functions.records import default_key, map_lookup, struct_without
from millrace.functions.text import clean_name
from millrace.operators.aggregates import explode_words
from millrace.operators.clean import keep_present
from millrace.operators.joins import expand_keys, lookup_join
from millrace.operators.table_functions import Lines, Sessions, table_function
from millrace.plans.customer_etl import normalise
from millrace.plans.daily_mart import stage_meters, stage_readings
from millrace.queries.registry import query, table


@query("""
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')
       AS name, length(p_name) AS length
FROM part
""")
def map_clean_name(spark, sf_dir):
    padded = F.concat(F.lit("\t "), "p_name", F.lit("  "))
    return table(spark, sf_dir, "part").select("p_partkey", clean_name(padded).alias("name")).select(
        "p_partkey", "name", F.length("name").cast("bigint").alias("length"))


@query("""
SELECT 'Customer#' || lpad(c_custkey::VARCHAR, 9, '0') AS name, c_mktsegment AS country_city_code,
       c_custkey::INTEGER AS user_id, c_acctbal AS order_value, c_nationkey AS is_active_flag
FROM customer
""")
def map_normalize_row(spark, sf_dir):
    """Rename, clean and cast in one projection."""
    return normalise(table(spark, sf_dir, "customer").select(
        F.upper("c_name").alias("name_raw"), F.col("c_mktsegment").alias("location_code"),
        F.col("c_custkey").cast("string").alias("user_id"), F.col("c_acctbal").cast("string").alias("order_value"),
        F.col("c_nationkey").cast("string").alias("is_active_flag")))


@query("""
SELECT event_id::VARCHAR AS reading_id, user_id::VARCHAR AS meter_id, value AS voltage,
       json_extract(props, '$.k')::DOUBLE AS consumption, date_trunc('second', ts) AS registration_date
FROM events
""")
def map_stage_readings(spark, sf_dir):
    """The staging view of readings: casts from text."""
    staged = stage_readings(table(spark, sf_dir, "events").select(
        F.col("event_id").alias("reading_id"), F.col("user_id").alias("meter_id"),
        F.col("value").cast("string").alias("voltage"), F.get_json_object("props", "$.k").alias("kwh_consumption"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("recorded_at")))
    return staged.withColumn("registration_date", F.col("registration_date").cast("timestamp_ntz"))


@query("""
SELECT c_custkey::VARCHAR AS meter_id, c_name AS location_name, c_mktsegment AS customer_category,
       TIMESTAMP '2024-01-31 00:00:00' AS installation_date
FROM customer
""")
def map_stage_meters(spark, sf_dir):
    """The staging view of meters: trim and upper case."""
    staged = stage_meters(table(spark, sf_dir, "customer").select(
        F.concat(F.lit("  "), "c_custkey", F.lit(" ")).alias("id_meter"), F.col("c_name").alias("location"),
        F.lower("c_mktsegment").alias("customer_type"), F.lit("2024-01-31").alias("installation_date")))
    return staged.withColumn("installation_date", F.col("installation_date").cast("timestamp_ntz"))


PRIORITIES = {"1-URGENT": "now", "2-HIGH": "today", "3-MEDIUM": "this week"}


@query("""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'today'
       WHEN '3-MEDIUM' THEN 'this week' ELSE 'Unknown' END AS due, trunc(o_totalprice) > 100000 AS is_high_value
FROM orders
""")
def map_enrich_row(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", map_lookup(F.col("o_orderpriority"), PRIORITIES, "Unknown").alias("due"),
        (whole_part(F.col("o_totalprice")) > 100000).alias("is_high_value"))


@query("""
SELECT doc_id, count(*) AS n_words, max(length(w)) AS longest
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[a-zA-Z]+')) AS w FROM documents) GROUP BY doc_id
""")
def map_explode_words(spark, sf_dir):
    found = explode_words(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_words"), F.max(F.length("word").cast("bigint")).alias("longest"))


@query("""
SELECT n_name AS name, r_name AS region, c_name AS customer
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def map_struct_pop(spark, sf_dir):
    """A dimension row nested without its key, then read through the struct."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    nested = nation.select(F.col("n_nationkey").alias("c_nationkey"),
                           struct_without(nation.columns, ["n_nationkey"]).alias("info"))
    return lookup_join(table(spark, sf_dir, "customer"), nested, ["c_nationkey"], "inner").select(
        F.col("info.n_name").alias("name"), F.col("info.r_name").alias("region"), F.col("c_name").alias("customer"))


@query("""
SELECT DISTINCT coalesce(nullif(event_type, 'error'), 'unknown_race') AS race, user_id, c_name
FROM events JOIN customer ON user_id = c_custkey
""")
def map_composite_key(spark, sf_dir):
    """Distinct composite keys, joined to the dimension on one part of the key."""
    events = table(spark, sf_dir, "events").select(
        default_key(F.nullif("event_type", F.lit("error")), "unknown_race").alias("race"), "user_id")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    return expand_keys(events, customers, ["race", "user_id"], ["user_id"]).select("race", "user_id", "c_name")


@query("""
SELECT event_id, lower(event_type) AS event_type, coalesce(CASE WHEN value <= 100 THEN value END, 0) AS value
FROM events WHERE event_type <> 'error'
""")
def map_null_default(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.upper(F.nullif("event_type", F.lit("error"))).alias("event_type"),
        F.when(F.col("value") <= 100, F.col("value")).alias("value"))
    return keep_present(rows, "event_type").fillna({"value": 0.0}).withColumn("event_type", F.lower("event_type"))


CTES = """
WITH big AS (SELECT * FROM {orders} WHERE o_totalprice > 100000),
     people AS (SELECT * FROM {customer}),
     final AS (SELECT c_mktsegment, o_orderstatus, count(*) AS n
               FROM big JOIN people ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT * FROM final
"""


@query(CTES.format(orders="orders", customer="customer"))
def map_ctes(spark, sf_dir):
    """Named subqueries and grouping by position, in SQL."""
    return spark.sql(CTES, orders=table(spark, sf_dir, "orders"), customer=table(spark, sf_dir, "customer"))


@query("""
SELECT doc_id, line::INTEGER AS line, words::INTEGER AS words, length(x)::INTEGER AS chars FROM (
  SELECT doc_id, generate_subscripts(l, 1) AS line, unnest(l) AS x, len(list_filter(string_split(unnest(l), ' '), lambda w: w <> '')) AS words
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
WHERE words > 0
""")
def map_table_function(spark, sf_dir):
    """Any number of rows of each row: the lines of every text."""
    lines = table_function(lambda: Lines("text"), Lines.made, ["doc_id"])
    return table(spark, sf_dir, "documents").select("doc_id", "text").transform(lines)


@query("""
SELECT user_id, min(ts) AS first, max(ts) AS last, count(*)::INTEGER AS n FROM (
  SELECT *, sum(CASE WHEN gap > INTERVAL '6 hours' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s
  FROM (SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events))
GROUP BY user_id, s
""")
def map_table_sessions(spark, sf_dir):
    """A table function over the ordered rows of each key, with rows left to put out at the end."""
    sessions = table_function(lambda: Sessions("ts", 6 * 3600), Sessions.made, ["user_id"], ["user_id"], ["ts"])
    return table(spark, sf_dir, "events").select("user_id", "ts").transform(sessions)
