"""Queries over data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.quality import (
    accepted_range, accepted_values, no_rows_where, not_null, offending, run_checks, unique)
from millrace.queries.registry import query, table


@query("""
SELECT 'unique' AS "check", 'o_orderkey' AS "column",
       (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS failures
UNION ALL SELECT 'unique', 'o_custkey',
       (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'not_null', 'priority', count(*) FROM orders WHERE nullif(o_orderpriority, '5-LOW') IS NULL
UNION ALL SELECT 'accepted_values', 'o_orderstatus',
       (SELECT count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('O', 'F'))
UNION ALL SELECT 'accepted_range', 'o_totalprice', count(*) FROM orders WHERE o_totalprice < 2000 OR o_totalprice > 400000
UNION ALL SELECT 'old_open_order', 'o_orderdate', count(*) FROM orders
       WHERE o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1993-01-01'
""")
def dq_checks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("priority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return run_checks(orders, [
        unique("o_orderkey"), unique("o_custkey"), not_null("priority"),
        accepted_values("o_orderstatus", ["O", "F"]), accepted_range("o_totalprice", low=2000, high=400000),
        no_rows_where("old_open_order", "o_orderdate",
                      (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < F.lit("1993-01-01").cast("timestamp_ntz")))])


@query("SELECT l_orderkey, count(*) AS n_records FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def dq_offending(spark, sf_dir):
    """The values a check complains about."""
    return offending(table(spark, sf_dir, "lineitem"), unique("l_orderkey"))
