"""Running values and nested histories: the cut-up route must equal the plain one."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators.histories import collect_chunks
from millrace.operators.joins import co_group
from millrace.operators.running import running_totals


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, one is NULL, and some amounts and times are missing."""
    dice = random.Random(1)
    rows = []
    for i in range(600):
        key = "hot" if i % 3 else dice.choice(["a", "b", None])
        moment = dice.randrange(50) if dice.random() > 0.1 else None
        amount = Decimal(dice.randrange(1000)) / 100 if dice.random() > 0.2 else None
        rows.append((key, moment, i, amount))
    return rows, spark.createDataFrame(rows, "k string, t int, id int, amount decimal(18,2)").cache()


def by_hand(rows):
    expected = {}
    for key in {r[0] for r in rows}:
        count, total = 0, None
        for _, t, i, amount in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
            count += 1
            total = total if amount is None else (total or 0) + amount
            expected[i] = (count, total)
    return expected


def test_running_totals(skewed):
    rows, df = skewed
    result = running_totals(df, ["k"], ["t", "id"], "n", {"total": "amount"})
    assert result.columns == ["k", "t", "id", "amount", "n", "total"]
    assert {r["id"]: (r["n"], r["total"]) for r in result.collect()} == by_hand(rows)


def test_a_key_within_one_day_is_spread(spark):
    """A third of the rows under one key on one day: no partition of the stored table holds the key."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
        result = running_totals(df, ["k"], ["id"], "n")
        parts = result.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert {r["n"] for r in result.filter("k = 'hot'").select("n").collect()} == set(range(1, 3001))
        assert len(parts) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("chunk_rows", [7, 100, 10_000])
def test_chunks_keep_every_row(skewed, chunk_rows):
    rows, df = skewed
    lists = collect_chunks(df, ["k"], ["t", "id"], ["id"], "items", chunk_rows).collect()
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in lists if r["k"] == key), key=lambda r: r["chunk"])
        expected = [i for i, _ in sorted(
            ((i, (n)) for i, (n, _) in by_hand([r for r in rows if r[0] == key]).items()), key=lambda pair: pair[1])]
        assert [item["id"] for r in mine for item in r["items"]] == expected
        assert [r["chunk"] for r in mine] == list(range(len(mine)))
        assert all(len(r["items"]) == chunk_rows for r in mine[:-1])


def test_co_group_chunks_follow_one_sequence(skewed):
    _, df = skewed
    other = df.filter("k = 'a'").select("k", "id")
    grouped = co_group({"left": df, "right": other}, ["k"], {"left": ["t", "id"], "right": ["id"]}, chunk_rows=50)
    rows = grouped.select("k", "chunk", F.size("left").alias("l"), F.size("right").alias("r")).collect()
    assert sum(r["l"] for r in rows) == 600
    assert sum(r["r"] for r in rows) == other.count()
    for key in {r["k"] for r in rows}:
        mine = sorted((r for r in rows if r["k"] == key), key=lambda r: r["chunk"])
        assert [r["chunk"] for r in mine] == list(range(len(mine)))
        assert all(r["l"] + r["r"] == 50 for r in mine[:-1])
        assert [r["r"] > 0 for r in mine] == sorted(r["r"] > 0 for r in mine)   # the second side follows the first


def test_merged_sides_share_a_stretch_of_time(spark):
    left = spark.createDataFrame([("k", t, f"l{t}") for t in (1, 3, 5, 7)], "k string, t int, v string")
    right = spark.createDataFrame([("k", t, f"r{t}") for t in (2, 4)], "k string, t int, v string")
    grouped = co_group({"left": left, "right": right}, ["k"], {"left": ["t"], "right": ["t"]}, 3, {"left": ["v"], "right": ["v"]}, merged=True)
    got = {r["chunk"]: ([x["v"] for x in r["left"]], [x["v"] for x in r["right"]]) for r in grouped.collect()}
    assert got == {0: (["l1", "l3"], ["r2"]), 1: (["l5", "l7"], ["r4"])}
