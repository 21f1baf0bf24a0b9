"""Readers, writers, Avro schemas, the keyed log and the relational writer."""

import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from millrace import schemas
from millrace.sinks import files, format_report, keyed_log, relational, tables
from millrace.sources import avro_schema, kafka, paths
from millrace.sources.files import (
    MissingConnector, has_format, inline_rows, read_csv, read_json_lines, read_lines, read_table)

USERS = [(1, "Ida", "ida@example.com", True), (2, "Olu", "olu@example.com", False),
         (3, "Wen, \"W\" ñ", "wen@example.com", True)]


@pytest.fixture(scope="module")
def users(spark):
    return inline_rows(spark, USERS, schemas.USERS)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("fmt, codec", [("csv", None), ("csv", "gzip"), ("json", None), ("parquet", "none"),
                                        ("parquet", "snappy"), ("parquet", "gzip"), ("orc", "zlib")])
def test_round_trip(spark, users, folder, fmt, codec):
    files.write_table(users, f"{folder}/t", fmt, codec)
    assert rows(read_table(spark, f"{folder}/t", fmt, schemas.USERS)) == USERS


def test_unknown_format_and_missing_schema(spark, users, folder):
    with pytest.raises(ValueError):
        files.write_table(users, f"{folder}/t", "xlsx")
    with pytest.raises(ValueError):
        read_table(spark, folder, "xlsx")
    with pytest.raises(ValueError):
        read_table(spark, folder, "csv")


def test_missing_connectors_are_named(spark, users, folder):
    if not has_format(spark, "avro"):
        with pytest.raises(MissingConnector, match="spark-avro"):
            files.write_table(users, f"{folder}/t", "avro")
    if not has_format(spark, "kafka"):
        with pytest.raises(MissingConnector, match="kafka"):
            kafka.read_topic(spark, "host:9092", "races")
    assert has_format(spark, "parquet")


def test_json_lines_keep_or_fail(spark, folder):
    with open(f"{folder}/x.json", "w") as out:
        out.write('{"id": 1, "age": 85.3}\n{broken\n')
    schema = T.StructType.fromDDL("id INT, age INT, missing STRING")
    kept = read_json_lines(spark, f"{folder}/x.json", schema, fail_on_bad=False)
    assert {(r["id"], r["age"], r["missing"], r["_corrupt_record"]) for r in kept.collect()} == {
        (1, 85, None, None), (None, None, None, "{broken")}
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_lines(spark, f"{folder}/x.json", schema).collect()


def test_text_csv_and_json_lines(spark, users, folder):
    files.write_lines(users, F.concat("name", F.lit("\n"), "id"), f"{folder}/text", one_file=True)
    assert read_lines(spark, f"{folder}/text").count() == 6
    assert len([f for f in os.listdir(f"{folder}/text") if f.startswith("part-")]) == 1
    files.write_csv(users, f"{folder}/csv")
    assert rows(read_csv(spark, f"{folder}/csv", schemas.USERS)) == USERS
    files.write_csv_lines(users.select("id", "email"), f"{folder}/bare")
    assert sorted(r[0] for r in read_lines(spark, f"{folder}/bare").collect())[0] == "1,ida@example.com"
    files.write_json_lines(users.withColumn("email", F.lit(None).cast("string")), f"{folder}/json")
    assert '{"id":3,"name":"Wen, \\"W\\" ñ","active":true}' in {
        r[0] for r in read_lines(spark, f"{folder}/json").collect()}


def test_lines_end_both_ways(spark, folder):
    with open(f"{folder}/x.txt", "wb") as out:
        out.write(b"a\r\n\nb\rc\nd\r\r\n")
    assert [r[0] for r in read_lines(spark, f"{folder}/x.txt").collect()] == ["a", "", "b\rc", "d\r"]


def test_avro_schema_types():
    parsed = avro_schema.struct_from_avro({"type": "record", "name": "All", "fields": [
        {"name": "a", "type": "int"}, {"name": "b", "type": ["string", "null"]}, {"name": "c", "type": ["null", "long"]},
        {"name": "d", "type": {"type": "long", "logicalType": "timestamp-micros"}}, {"name": "e", "type": "bytes"},
        {"name": "f", "type": {"type": "bytes", "logicalType": "decimal", "precision": 10, "scale": 3}},
        {"name": "g", "type": {"type": "array", "items": ["null", "float"]}},
        {"name": "h", "type": {"type": "map", "values": "boolean"}},
        {"name": "i", "type": {"type": "enum", "name": "E", "symbols": ["X"]}},
        {"name": "j", "type": {"type": "record", "name": "R", "fields": [{"name": "x", "type": "double"}]}},
        {"name": "k", "type": {"type": "int", "logicalType": "date"}}]})
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in parsed] == [
        ("a", "int", False), ("b", "string", True), ("c", "bigint", True), ("d", "timestamp", False),
        ("e", "binary", False), ("f", "decimal(10,3)", False), ("g", "array<float>", False),
        ("h", "map<string,boolean>", False), ("i", "string", False), ("j", "struct<x:double>", False), ("k", "date", False)]
    for bad in (["int", "string"], ["int", "string", "null"], ["null"], "uuid"):
        with pytest.raises(NotImplementedError):
            avro_schema.struct_from_avro({"fields": [{"name": "a", "type": bad}]})


def test_avro_schema_files(spark, folder):
    with open(f"{folder}/ok.avsc", "w") as out:
        json.dump({"type": "record", "fields": []}, out, indent=2)
    assert avro_schema.load_avro_schema(spark, f"{folder}/ok.avsc")["type"] == "record"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        avro_schema.load_avro_schema(spark, f"{folder}/absent.avsc")
    with pytest.raises(json.JSONDecodeError):
        avro_schema.parse_avro_schema("{not json")
    with pytest.raises(ValueError):
        avro_schema.parse_avro_schema("[1]")


def test_kafka_options_and_shape(spark, users):
    assert kafka.read_options("h:9092", "t", "earliest", 100) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "100"}
    assert kafka.read_options("h:9092", "t")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        kafka.read_options("h:9092", "t", "middle")
    records = kafka.encode_records(users)
    assert [f.dataType.simpleString() for f in records.schema] == ["binary", "binary"]
    stamped = records.withColumn("timestamp", F.lit(7))
    decoded = kafka.decode_records(stamped, schemas.USERS)
    assert decoded.columns == ["timestamp", *schemas.USERS.names] and rows(decoded.drop("timestamp")) == USERS


def test_paths(spark):
    assert paths.bucket_name("s3://lake/a/b") == "lake" and paths.bucket_name("lake") == "lake"
    assert paths.spark_path("s3://lake/a") == "s3a://lake/a" and paths.spark_path("/data") == "/data"
    got = spark.createDataFrame([("s3://lake/a/b",), ("lake",)], "p string").select(
        paths.bucket_column(F.col("p")), paths.key_column(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("lake", "a/b"), ("lake", "")]


def test_partitioned_writes_replace_only_their_day(spark, users, folder):
    files.write_ingestion(users, f"{folder}/t", "2026-01-01")
    files.write_ingestion(users, f"{folder}/t", "2026-01-02")
    files.write_ingestion(users.filter("id = 1"), f"{folder}/t", "2026-01-02")
    counts = spark.read.parquet(f"{folder}/t").groupBy(F.col("p_ingestion_date").cast("string")).count()
    assert rows(counts) == [("2026-01-01", 3), ("2026-01-02", 1)]


def test_conform(users):
    shaped = files.conform(users, T.StructType.fromDDL("name STRING, id BIGINT, extra DOUBLE"))
    assert shaped.dtypes == [("name", "string"), ("id", "bigint"), ("extra", "double")]


def test_models_see_earlier_ones(spark, folder):
    tables.build_models(spark, {
        "model_a": ("view", lambda s: s.range(3)), "model_b": ("table", lambda s: s.table("model_a").filter("id > 0"))}, folder)
    assert spark.table("model_b").count() == 2
    with pytest.raises(ValueError):
        tables.build_models(spark, {"model_c": ("snapshot", lambda s: s.range(1))})


def test_keyed_log_replay_and_compaction(spark, folder):
    def batch(*values):
        return spark.createDataFrame(list(values), "id string, v int")

    log = f"{folder}/log"
    keyed_log.upsert_batch(batch(("a", 1), ("b", 1)), log, 0)
    keyed_log.upsert_batch(batch(("b", 2), ("c", 2)), log, 1)
    once = rows(keyed_log.read_current(spark, log, ["id"]))
    keyed_log.upsert_batch(batch(("b", 2), ("c", 2)), log, 1)
    assert rows(keyed_log.read_current(spark, log, ["id"])) == once == [("a", 1), ("b", 2), ("c", 2)]
    keyed_log.compact(spark, log, f"{folder}/compacted", ["id"])
    keyed_log.upsert_batch(batch(("a", 3)), f"{folder}/compacted", 2)
    assert rows(keyed_log.read_current(spark, f"{folder}/compacted", ["id"])) == [("a", 3), ("b", 2), ("c", 2)]


def test_keyed_log_orders_late_batches(spark, folder):
    for batch_id, moment in enumerate((5, 3)):
        keyed_log.upsert_batch(spark.createDataFrame([("a", moment)], "id string, at int"), f"{folder}/log", batch_id)
    assert rows(keyed_log.read_current(spark, f"{folder}/log", ["id"])) == [("a", 3)]
    assert rows(keyed_log.read_current(spark, f"{folder}/log", ["id"], ["at", "batch_id"])) == [("a", 5)]


def test_telemetry_rows(spark):
    source = spark.createDataFrame(
        [("r", "h", 3, 1.5, 250.0, 85.3), ("r", None, 1, 1.0, 1.0, 1.0), ("r", "h2", 1, 1.0, 1e9, 1.0)],
        "RaceID string, HelicopterID string, LapNumber int, Time_s double, Speed_km_h double, FuelLevel_percentage double")
    for name in ("Altitude_m", "EngineTemp_c", "RotorRPM", "Latitude", "Longitude"):
        source = source.withColumn(name, F.lit(1.0))
    shaped = relational.telemetry_rows(source)
    assert shaped.columns == list(schemas.TELEMETRY_TABLE)
    got = {r["HelicopterID"]: r for r in shaped.collect()}
    assert set(got) == {"h"} and float(got["h"]["FuelLevel_percentage"]) == 85.3 and len(got["h"]["id"]) == 64
    faults = source.select("HelicopterID", relational.telemetry_fault(source).alias("why")).collect()
    assert {r["HelicopterID"]: r["why"] for r in faults} == {
        "h": None, None: "no helicopter, or no record", "h2": "a measure is out of range"}


class FakeConnection:
    """Remembers what a DB-API connection is asked to do."""

    def __init__(self, fail_on=None):
        self.log, self.fail_on = [], fail_on

    def cursor(self):
        return self

    def executemany(self, statement, batch):
        if self.fail_on in [row[0] for row in batch]:
            raise RuntimeError("constraint")
        self.log.append(("rows", len(batch)))

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def test_relational_statements_and_batches():
    assert relational.upsert_statement("t", ["id", "a", "b"], "id") == (
        "INSERT INTO t (id, a, b) VALUES (%s, %s, %s) ON CONFLICT (id) DO UPDATE SET a = EXCLUDED.a, b = EXCLUDED.b")
    assert relational.create_table_statement("t", {"id": "VARCHAR(255)", "a": "INTEGER"}, "id") == (
        "CREATE TABLE IF NOT EXISTS t (id VARCHAR(255) PRIMARY KEY, a INTEGER)")
    connection = FakeConnection()
    relational.upsert_rows(iter([(i,) for i in range(5)]), lambda: connection, "s", batch_size=2)
    assert connection.log == [("rows", 2), "commit", ("rows", 2), "commit", ("rows", 1), "commit", "close", "close"]
    failing = FakeConnection(fail_on=3)
    with pytest.raises(RuntimeError):
        relational.upsert_rows(iter([(i,) for i in range(5)]), lambda: failing, "s", batch_size=2)
    assert failing.log == [("rows", 2), "commit", "rollback", "close"]


def test_format_report(spark, folder):
    df = spark.range(2000).select(
        F.col("id").alias("transaction_id"), (F.col("id") % 97).cast("int").alias("user_id"), F.rand(1).alias("amount"),
        F.timestamp_seconds(F.col("id")).alias("timestamp"), F.lit("Food").alias("category"), F.lit(False).alias("is_fraud"),
        F.repeat(F.lit("A"), 50).alias("description"))
    report = {(r["format"], r["codec"]): r for r in format_report.compare_formats(df, folder, "amount").collect()}
    assert set(report) == set(format_report.available(spark))
    assert report[("csv", "none")]["size_mib"] > report[("parquet", "snappy")]["size_mib"] > 0
    assert all(r["write_s"] > 0 and r["read_all_s"] > 0 for r in report.values())


def test_a_source_that_wants_options_counts_as_present(spark):
    assert has_format(spark, "jdbc") and has_format(spark, "parquet") and not has_format(spark, "no_such_format")


def test_csv_values_that_do_not_fit(spark, folder):
    with open(f"{folder}/c.csv", "w") as out:
        out.write("id,kwh\n1,2.5\n2,abc\n")
    schema = T.StructType.fromDDL("id INT, kwh DOUBLE")
    with pytest.raises(Exception):
        read_csv(spark, f"{folder}/c.csv", schema).collect()
    assert rows(read_csv(spark, f"{folder}/c.csv", schema, fail_on_bad=False).fillna(0.0).fillna("")) == [(1, 2.5, ""), (2, 0.0, "2,abc")]
