"""Queries over joins and nested histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.numbers import price_with_margin
from millrace.functions.text import as_strings
from millrace.operators.joins import co_group, join_first_left, lookup_join, lookup_struct
from millrace.plans.race_history import race_histories
from millrace.queries.registry import query, table


def _ids(lists, name):
    return F.array_join(as_strings(F.col(lists).getField(name)), ",")


@query("""
WITH u AS (
  SELECT c_custkey AS custkey, 0 AS side, c_name, NULL AS ts, NULL AS event_id FROM customer
  UNION ALL SELECT user_id * 2, 1, NULL, ts, event_id FROM events),
p AS (SELECT *, (row_number() OVER (PARTITION BY custkey ORDER BY side, c_name, ts, event_id) - 1) // 5 AS chunk FROM u)
SELECT custkey, chunk::BIGINT AS chunk, count(*) FILTER (side = 0)::INTEGER AS n_customers,
       count(*) FILTER (side = 1)::INTEGER AS n_events,
       coalesce(string_agg(event_id, ',' ORDER BY ts, event_id) FILTER (side = 1), '') AS event_ids
FROM p GROUP BY 1, 2
""")
def join_cogroup(spark, sf_dir):
    """Both sides as sorted lists of up to five rows per key; keys of one side only have an empty list on the other."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    events = table(spark, sf_dir, "events").select((F.col("user_id") * 2).alias("custkey"), "ts", "event_id")
    grouped = co_group({"customers": customers, "events": events}, ["custkey"],
                       {"customers": ["c_name"], "events": ["ts", "event_id"]}, chunk_rows=5)
    return grouped.select("custkey", "chunk", F.size("customers").alias("n_customers"),
                          F.size("events").alias("n_events"), _ids("events", "event_id").alias("event_ids"))


@query("""
SELECT user_id, event_id, o_orderkey, o_totalprice
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events)
JOIN orders ON user_id = o_custkey WHERE r = 1
""")
def join_inner_first(spark, sf_dir):
    """The first left row of each key with all right rows."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), "o_orderkey", "o_totalprice")
    joined = join_first_left(events, orders, ["user_id"], [F.col("ts"), F.col("event_id")])
    return joined.select("user_id", "event_id", "o_orderkey", "o_totalprice")


@query("""
SELECT p_brand, count(*) AS n,
       round(sum(p_retailprice / 7 * (1 + l_discount / 3)), 4) AS priced
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO') ON l_partkey = p_partkey GROUP BY p_brand
""")
def join_broadcast_left(spark, sf_dir):
    """A left lookup with misses, and a price from cost and margin."""
    parts = table(spark, sf_dir, "part").filter("p_type <> 'PROMO'").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", "p_retailprice")
    parts = parts.union(parts.withColumn("p_brand", F.concat(F.lit("~"), "p_brand")))  # a second row per key is not looked up
    joined = lookup_join(table(spark, sf_dir, "lineitem").select("l_partkey", "l_discount"), parts, ["l_partkey"])
    price = price_with_margin(F.col("p_retailprice") / 7, F.col("l_discount") / 3)
    return joined.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(price).cast("double"), 4).alias("priced"))


@query("""
SELECT p_brand, count(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
""")
def join_salted_lookup(spark, sf_dir):
    """The same kind of lookup with every key spread over eight salts."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber")
    return lookup_join(items, parts, ["l_partkey"], "inner", salts=8, salt_by=["l_orderkey", "l_linenumber"]).groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_id, coalesce(c_name, 'UNKNOWN') AS team, c_nationkey AS nation
FROM events LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON user_id = c_custkey
""")
def join_default_struct(spark, sf_dir):
    """A nested dimension row, with a default where there is none."""
    teams = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey")
    joined = lookup_struct(table(spark, sf_dir, "events").select("event_id", "user_id"), teams, "user_id", "TeamInfo",
                           {"c_name": "UNKNOWN"})
    return joined.select("event_id", F.col("TeamInfo.c_name").alias("team"),
                         F.col("TeamInfo.c_nationkey").alias("nation"))


RACES = {"P": "purchase", "O": "view", "F": "click"}

HISTORY_SQL = """
WITH u AS (
  SELECT coalesce(nullif(event_type, 'error'), 'unknown_race') AS race, user_id AS helicopter, 0 AS side,
         epoch_us(ts) / 1e6 AS moment, event_id AS id FROM events
  UNION ALL SELECT CASE o_orderstatus WHEN 'P' THEN 'purchase' WHEN 'O' THEN 'view' ELSE 'click' END, o_custkey, 1,
                   o_orderkey, o_orderkey FROM orders),
p AS (SELECT *, (row_number() OVER (PARTITION BY race, helicopter ORDER BY moment, side) - 1) // 4 AS chunk,
             bool_or(side = 0) OVER (PARTITION BY race, helicopter) AS flown FROM u),
g AS (SELECT race, helicopter, chunk::BIGINT AS chunk, any_value(flown) AS flown,
             count(*) FILTER (side = 0)::INTEGER AS n_telemetry, count(*) FILTER (side = 1)::INTEGER AS n_events,
             coalesce(string_agg(id, ',' ORDER BY moment) FILTER (side = 0), '') AS telemetry_ids,
             coalesce(string_agg(id, ',' ORDER BY moment) FILTER (side = 1), '') AS event_ids FROM p GROUP BY 1, 2, 3)
SELECT race, helicopter::VARCHAR AS helicopter, chunk, {team} AS team, n_telemetry, telemetry_ids, n_events, event_ids
FROM g LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON helicopter = c_custkey
"""


def _histories(spark, sf_dir, team_scope):
    """Events as telemetry, orders as race events, customers as teams."""
    telemetry = table(spark, sf_dir, "events").select(
        F.nullif("event_type", F.lit("error")).alias("RaceID"), F.col("user_id").cast("string").alias("HelicopterID"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("Time_s"), "event_id")
    status = F.create_map(*[F.lit(part) for pair in RACES.items() for part in pair])
    events = table(spark, sf_dir, "orders").select(
        F.try_element_at(status, F.col("o_orderstatus")).alias("RaceID"),
        F.col("o_custkey").cast("string").alias("HelicopterID"), F.col("o_orderkey").alias("Timestamp_s"))
    teams = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").cast("string").alias("HelicopterID"), F.col("c_name").alias("TeamName"), "c_nationkey")
    nested = race_histories(telemetry, events, teams, team_scope, chunk_rows=4)
    return nested.select(
        F.col("RaceID").alias("race"), F.col("HelicopterID").alias("helicopter"), "chunk",
        F.col("TeamInfo.TeamName").alias("team"), F.size("TelemetryHistory").alias("n_telemetry"),
        _ids("TelemetryHistory", "event_id").alias("telemetry_ids"), F.size("RaceEvents").alias("n_events"),
        _ids("RaceEvents", "Timestamp_s").alias("event_ids"))


@query(HISTORY_SQL.format(team="coalesce(c_name, 'UNKNOWN')"))
def join_three_way(spark, sf_dir):
    """Sorted histories of two sides per composite key, with the team of the key."""
    return _histories(spark, sf_dir, "all")


@query(HISTORY_SQL.format(team="CASE WHEN NOT flown THEN 'UNKNOWN' ELSE coalesce(c_name, 'UNKNOWN') END"))
def join_team_scope(spark, sf_dir):
    """The same, with teams only for keys that have telemetry."""
    return _histories(spark, sf_dir, "telemetry")
