"""Queries over aggregations, running values, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.numbers import clamp, exact
from millrace.functions.text import WORD_WITH_APOSTROPHE, as_strings
from millrace.functions.times import lap_of
from millrace.operators.aggregates import count_words
from millrace.operators.clean import clean_people, concat_rows, first_per_key, top_per_key
from millrace.operators.combiners import Moments, combine_per_key
from millrace.operators.running import running_totals
from millrace.plans.daily_mart import (
    consumption_per_key, daily_monitoring, stability, stage_meters, stage_readings, widest)
from millrace.queries.registry import query, table


@query("""
SELECT word, count(*) AS count FROM (SELECT unnest(regexp_extract_all(text, '[a-zA-Z]+')) AS word FROM documents)
GROUP BY word
""")
def agg_word_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").transform(count_words("text"))


@query("""
SELECT word, count(*) AS count FROM (SELECT unnest(regexp_extract_all(text, '[a-zA-Z'']+')) AS word FROM documents)
GROUP BY word
""")
def agg_word_count_apostrophe(spark, sf_dir):
    return table(spark, sf_dir, "documents").transform(count_words("text", WORD_WITH_APOSTROPHE))


@query("""
SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey,
    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS r FROM lineitem)
WHERE r = 1
""")
def agg_dedup(spark, sf_dir):
    """One row per key by a total order."""
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
    return first_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col(c) for c in order])


@query("""
SELECT id::INTEGER AS id, name, age FROM (
  SELECT user_id AS id, lower(event_type) AS name, CASE WHEN value <= 100 THEN value::INTEGER ELSE 0 END AS age,
         row_number() OVER (PARTITION BY user_id
                            ORDER BY lower(event_type), CASE WHEN value <= 100 THEN value::INTEGER ELSE 0 END) AS r
  FROM (SELECT user_id, nullif(event_type, 'error') AS event_type, trunc(value) AS value FROM events)
  WHERE event_type IS NOT NULL)
WHERE r = 1
""")
def agg_clean_people(spark, sf_dir):
    """Drop missing names, default the age, lower-case, one row per id."""
    return clean_people(table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("id"), F.upper(F.nullif("event_type", F.lit("error"))).alias("name"),
        F.when(F.floor("value") <= 100, F.floor("value")).cast("int").alias("age")))


@query("""
SELECT c_mktsegment AS location_name, user_id::VARCHAR AS meter_id, date_trunc('day', ts) AS day,
       round(avg(value / 7), 9) AS voltage_average,
       sum(json_extract(props, '$.k')::INTEGER)::DOUBLE AS consumption_total,
       max(CASE WHEN value / 7 < 3 THEN 1 ELSE 0 END) AS there_was_a_voltage_drop
FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2, 3
""")
def agg_daily_mart(spark, sf_dir):
    """Average, total and low-value flag per place, meter and day."""
    readings = stage_readings(table(spark, sf_dir, "events").select(
        F.col("event_id").alias("reading_id"), F.col("user_id").alias("meter_id"), (F.col("value") / 7).alias("voltage"),
        F.get_json_object("props", "$.k").alias("kwh_consumption"), F.col("ts").alias("recorded_at")))
    meters = stage_meters(table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id_meter"), F.col("c_mktsegment").alias("location"),
        F.col("c_mktsegment").alias("customer_type"), F.lit(None).cast("string").alias("installation_date")))
    return daily_monitoring(readings, meters, low_voltage=3).withColumn("voltage_average", F.round("voltage_average", 9))


@query("SELECT user_id, round(sum(value / 7), 6) AS total FROM events GROUP BY user_id")
def agg_consumption(spark, sf_dir):
    """Accumulated consumption per customer."""
    totals = consumption_per_key(table(spark, sf_dir, "events"), "user_id", F.col("value") / 7)
    return totals.withColumn("total", F.round("total", 6))


@query("""
SELECT c_mktsegment, min(value / 7) AS lowest, max(value / 7) AS highest, max(value / 7) - min(value / 7) AS spread
FROM events JOIN customer ON user_id = c_custkey GROUP BY c_mktsegment
""")
def agg_business_goals(spark, sf_dir):
    """How stable the values are per place."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    per_user = stability(table(spark, sf_dir, "events"), "user_id", F.col("value") / 7)
    return widest(per_user.join(customers, "user_id"), "c_mktsegment")


@query("""
SELECT event_type, count(*) AS n, sum(length(event_id::VARCHAR) + length(user_id::VARCHAR))::BIGINT AS characters
FROM events GROUP BY event_type
""")
def agg_record_count(spark, sf_dir):
    """Record counts, and lists of numbers as lists of texts."""
    texts = as_strings(F.array("event_id", "user_id"))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length(F.array_join(texts, "")).cast("bigint")).alias("characters"))


@query("""
SELECT event_id, user_id,
       count(*) OVER w AS running_count, (sum(value::DECIMAL(18,2)) OVER w)::DOUBLE AS running_value,
       greatest(1, ceil((sum(value::DECIMAL(18,2)) OVER w) / 300))::INTEGER AS lap, greatest(10.0, least(100.0, value))::DOUBLE AS clamped
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""")
def win_running(spark, sf_dir):
    """Running count and sum per user, the lap they lead to, and a clamp."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", "value", exact(F.col("value")).alias("amount"))
    running = running_totals(events, ["user_id"], ["ts", "event_id"], sums={"running_value": "amount"})
    return running.select(
        "event_id", "user_id", "running_count", F.col("running_value").cast("double").alias("running_value"),
        lap_of(F.col("running_value")).alias("lap"), clamp(F.col("value"), 10.0, 100.0).alias("clamped"))


@query("""
SELECT o_custkey, o_orderkey, o_totalprice, r::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders)
WHERE r <= 2
""")
def topk_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top_per_key(orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 2)


@query("SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 100")
def limit_records(spark, sf_dir):
    """A read cut off after a number of records."""
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type").orderBy("event_id").limit(100)


@query("""
SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier
""")
def set_concat(spark, sf_dir):
    """Frames with different columns, one after the other."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return concat_rows(customers, suppliers)


@query("""
SELECT k AS key, count(value) AS n, round(avg(value), 6) AS mean, round(var_pop(value), 4) AS variance
FROM (SELECT CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE 'user ' || user_id END AS k, value / 7 AS value FROM events) GROUP BY k
""")
def agg_combiner(spark, sf_dir):
    """A combiner of one's own, with a third of the rows under one key."""
    key = F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("user "), "user_id"))
    found = combine_per_key(table(spark, sf_dir, "events").withColumn("key", key), ["key"], F.col("value") / 7, Moments(), "m")
    return found.select("key", "m.n", F.round("m.mean", 6).alias("mean"), F.round("m.variance", 4).alias("variance"))
