"""Cleaning, joins and word counts on hand-worked examples."""

import pytest
from pyspark.sql import functions as F

from millrace.functions.text import WORD_WITH_APOSTROPHE
from millrace.operators.aggregates import count_words, latest_per_key
from millrace.operators.clean import clean_people, concat_rows, fan_out, first_per_key, keep_counting, top_per_key
from millrace.operators.joins import co_group, expand_keys, join_first_left, lookup_join, lookup_struct
from millrace.schemas import CUSTOMER_PEOPLE


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([("C1", "Per"), ("C2", "Ulla")], "customer_id string, name string")


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame([("C1", "O1", 36), ("C1", "O2", 91), ("C3", "O3", 8)],
                                 "customer_id string, order_no string, amount int")


def test_clean_people(spark):
    people = spark.createDataFrame([(1, "Ulla", 52), (2, None, 19), (3, "Per", None), (3, "Per", None)], CUSTOMER_PEOPLE)
    assert rows(clean_people(people)) == [(1, "ulla", 52), (3, "per", 0)]


def test_join_first_left(customers, orders):
    joined = join_first_left(customers, orders, ["customer_id"], [F.col("name")])
    assert rows(joined, "customer_id", "name", "order_no", "amount") == [
        ("C1", "Per", "O1", 36), ("C1", "Per", "O2", 91)]


def test_co_group_sizes_and_whole_rows(customers, orders):
    grouped = co_group({"customers": customers, "orders": orders}, ["customer_id"],
                       {"customers": ["name"], "orders": ["order_no"]})
    assert rows(grouped, "customer_id", F.size("customers"), F.size("orders")) == [
        ("C1", 1, 2), ("C2", 1, 0), ("C3", 0, 1)]
    first = grouped.filter("customer_id = 'C1'").first()
    assert [r.asDict() for r in first["orders"]] == [
        {"customer_id": "C1", "order_no": "O1", "amount": 36}, {"customer_id": "C1", "order_no": "O2", "amount": 91}]


@pytest.mark.parametrize("salts", [1, 4])
def test_lookup_adds_no_fields_on_a_miss(spark, salts):
    products = spark.createDataFrame([(41, "Kettle", "Kitchen"), (42, "Scarf", "Clothes")],
                                     "item int, label string, category string")
    sold = spark.createDataFrame([("S1", 41), ("S2", 42), ("S3", 41), ("S4", 88)],
                                 "sale string, item int")
    joined = lookup_join(sold, products, ["item"], salts=salts, salt_by=["sale"])
    lines = joined.orderBy("sale").select(F.to_json(F.struct("sale", "label", "category")))
    assert [r[0] for r in lines.collect()] == [
        '{"sale":"S1","label":"Kettle","category":"Kitchen"}',
        '{"sale":"S2","label":"Scarf","category":"Clothes"}',
        '{"sale":"S3","label":"Kettle","category":"Kitchen"}',
        '{"sale":"S4"}']


def test_a_second_dimension_row_adds_no_facts(spark):
    facts = spark.createDataFrame([(1, "A"), (2, "B")], "id int, key string")
    teams = spark.createDataFrame([("A", "Beta", 2), ("A", "Alpha", 3)], "key string, TeamName string, size int")
    assert rows(lookup_join(facts, teams, ["key"]), "id", "TeamName", "size") == [(1, "Alpha", 3), (2, None, None)]
    assert rows(lookup_join(facts, teams, ["key"], dim_order=["size"]), "id", "TeamName") == [(1, "Beta"), (2, None)]
    assert lookup_struct(facts, teams, "key", "TeamInfo", {}).count() == 2
    with pytest.raises(ValueError):
        lookup_join(facts, teams, ["key"], salts=2)


def test_lookup_struct_default(spark):
    events = spark.createDataFrame([(1, "A"), (2, "Z")], "id int, key string")
    teams = spark.createDataFrame([("A", "Alpha", 3)], "key string, TeamName string, size int")
    joined = lookup_struct(events, teams, "key", "TeamInfo", {"TeamName": "UNKNOWN"})
    lines = joined.orderBy("id").select(F.to_json("TeamInfo"))
    assert [r[0] for r in lines.collect()] == ['{"TeamName":"Alpha","size":3}', '{"TeamName":"UNKNOWN"}']


def test_expand_keys(spark):
    facts = spark.createDataFrame([("r1", "A"), ("r1", "A"), ("r2", "A"), ("r1", "Z")], "race string, key string")
    dim = spark.createDataFrame([("A", "Alpha"), ("B", "Beta")], "key string, name string")
    assert rows(expand_keys(facts, dim, ["race", "key"], ["key"]), "race", "key", "name") == [
        ("r1", "A", "Alpha"), ("r2", "A", "Alpha")]


def test_word_counts(spark):
    lines = spark.createDataFrame([("don't stop 2day",), ("stop Stop",), (None,), ("",)], "value string")
    assert dict(rows(lines.transform(count_words("value")))) == {"don": 1, "t": 1, "stop": 2, "Stop": 1, "day": 1}
    assert dict(rows(lines.transform(count_words("value", WORD_WITH_APOSTROPHE)))) == {
        "don't": 1, "stop": 2, "Stop": 1, "day": 1}


def test_fan_out_and_concat(spark):
    df = spark.createDataFrame([(1, 12.0), (2, 0.0), (3, None)], "id int, v double")
    branches = fan_out(df, {"high": F.col("v") > 10, "zero": F.col("v") == 0, "all": F.lit(True)})
    assert rows(branches, "branch", "id") == [("all", 1), ("all", 2), ("all", 3), ("high", 1), ("zero", 2)]
    merged = concat_rows(df, spark.createDataFrame([(9,)], "id int"))
    assert merged.filter("id = 9").first()["v"] is None and merged.count() == 4


def test_first_top_and_latest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 5, "w")], "k string, n int, t string")
    assert rows(first_per_key(df, ["k"], [F.col("n"), F.col("t")])) == [("a", 1, "x"), ("b", 5, "w")]
    assert rows(top_per_key(df, ["k"], [F.col("n").desc(), F.col("t")], 2), "k", "t", "rank") == [
        ("a", "y", 1), ("a", "z", 2), ("b", "w", 1)]
    assert rows(latest_per_key(df, ["k"], ["n", "t"])) == [("a", 2, "z"), ("b", 5, "w")]


def test_rejects_are_counted_in_the_same_pass(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "k string")
    kept, seen = keep_counting(df, F.col("k") != "")
    assert rows(kept) == [("a",)] and seen.get == {"rejected": 2}
