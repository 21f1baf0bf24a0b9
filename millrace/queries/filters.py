"""Queries over filters and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.records import required_key
from millrace.operators.clean import fan_out, split_valid
from millrace.operators.quality import accepted_range, accepted_values, not_null, run_checks, unique, verdict
from millrace.operators.routing import level, score_route
from millrace.queries.registry import query, table


@query("""
SELECT CASE WHEN floor(value) > 100 THEN 'alert' WHEN floor(value) = 0 THEN 'zero' ELSE 'normal' END AS level,
       count(*) AS n
FROM events GROUP BY 1
""")
def filter_thresholds(spark, sf_dir):
    labelled = table(spark, sf_dir, "events").select(level(F.floor("value"), 100).alias("level"))
    return labelled.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_type, count(*) AS n FROM events GROUP BY event_type HAVING sum(value::DECIMAL(18,2)) / count(*) < 50
""")
def filter_having(spark, sf_dir):
    """A threshold after the aggregation."""
    means = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("value").cast("decimal(18,2)")).alias("mean"))
    return means.filter("mean < 50").select("event_type", "n")


@query("""
SELECT coalesce(nullif(event_type, 'error'), 'rejected') AS kind, count(*) AS n FROM events GROUP BY 1
""")
def filter_missing_key(spark, sf_dir):
    """Rows without a key are skipped, and counted."""
    rows = table(spark, sf_dir, "events").select(F.nullif("event_type", F.lit("error")).alias("kind"))
    kept, rejected = split_valid(rows, F.col("kind") != "")
    return kept.unionByName(rejected.select(F.lit("rejected").alias("kind"))).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"))


@query("""
SELECT 'alerts' AS branch, event_id, value FROM events WHERE value > 100
UNION ALL SELECT 'anomalies', event_id, value FROM events WHERE floor(value) = 0
UNION ALL SELECT 'history', event_id, value FROM events
""")
def fanout_three(spark, sf_dir):
    """One pass over the rows, three branches."""
    return fan_out(table(spark, sf_dir, "events").select("event_id", "value"), {
        "alerts": F.col("value") > 100, "anomalies": F.floor("value") == 0, "history": F.lit(True),
    }).select("branch", "event_id", "value")


@query("""
SELECT failures, CASE WHEN failures <= 0 THEN 'process_normal_flow' ELSE 'trigger_reprocess_alert' END AS route
FROM (SELECT (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1))
           + (SELECT count(*) FROM orders WHERE o_custkey IS NULL)
           + (SELECT count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('O', 'F'))
           + (SELECT count(*) FROM orders WHERE o_totalprice < 2000) AS failures)
""")
def route_quality(spark, sf_dir):
    return verdict(run_checks(table(spark, sf_dir, "orders"), [
        unique("o_orderkey"), not_null("o_custkey"), accepted_values("o_orderstatus", ["O", "F"]),
        accepted_range("o_totalprice", low=2000)]))


@query("""
SELECT p_partkey, CASE WHEN p_size > 5 THEN p_name || ' passed ' || p_type ELSE p_name || ' has to apply again' END
       AS message
FROM part
""")
def route_score(spark, sf_dir):
    """A message chosen by a score."""
    passed = F.concat("p_name", F.lit(" passed "), "p_type")
    failed = F.concat("p_name", F.lit(" has to apply again"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", score_route(F.col("p_size").cast("string"), passed, failed).alias("message"))


@query("""
SELECT event_id, 'user ' || user_id AS key FROM events
""")
def filter_required_key(spark, sf_dir):
    """A key that every row must have: a row without it would fail the job."""
    key = required_key(F.concat(F.lit("user "), "user_id"), "event without a user")
    return table(spark, sf_dir, "events").select("event_id", key.alias("key"))
