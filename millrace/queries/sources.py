"""Queries over the sources."""

from __future__ import annotations

import json

from pyspark.sql import functions as F, types as T

from millrace.functions.records import row_json
from millrace.functions.text import csv_line, field
from millrace.operators.histories import collect_chunks
from millrace.operators.joins import lookup_join
from millrace.queries.registry import query, table
from millrace.schemas import FORECAST_RESPONSE
from millrace.session import scratch_path
from millrace.sinks.files import write_csv, write_json_lines, write_lines, write_table
from millrace.sources.avro_schema import parse_avro_schema, struct_from_avro
from millrace.sources.files import inline_rows, read_csv, read_json_lines, read_lines, read_table
from millrace.sources.kafka import decode_records, encode_records
from millrace.sources.meter_csv import parse_readings
from millrace.sources.paths import bucket_column, key_column
from millrace.sources.seeds import load_seed
from millrace.sources.weather import flatten_forecasts

EVENT_LIMITS = [("click", 50.0), ("error", 10.0), ("purchase", 100.0), ("signup", 25.0), ("view", 75.0)]


@query("""
WITH limits(event_type, high) AS (
  VALUES ('click', 50.0), ('error', 10.0), ('purchase', 100.0), ('signup', 25.0), ('view', 75.0))
SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > high) AS n_high
FROM events JOIN limits USING (event_type) GROUP BY event_type
""")
def src_inline_rows(spark, sf_dir):
    """Inline rows, as a small dimension of the events."""
    limits = inline_rows(spark, EVENT_LIMITS, T.StructType.fromDDL("event_type STRING, high DOUBLE"))
    joined = lookup_join(table(spark, sf_dir, "events"), limits, ["event_type"], "inner")
    return joined.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > F.col("high")).alias("n_high"))


@query("""
SELECT substr(line, 1, 1) AS first_letter, count(*) AS n
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1
""")
def src_text_lines(spark, sf_dir):
    path = scratch_path(spark, "text")
    write_lines(table(spark, sf_dir, "documents"), F.col("text"), path)
    lines = read_lines(spark, path)
    return lines.groupBy(F.substring("value", 1, 1).alias("first_letter")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT user_id, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY user_id")
def src_glob_union(spark, sf_dir):
    """Shards in several folders read as one collection."""
    path = scratch_path(spark, "shards")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    events.write.partitionBy("event_type").json(path)
    schema = T.StructType.fromDDL("event_id BIGINT, user_id BIGINT")
    shards = read_json_lines(spark, f"{path}/event_type=*/part-*.json", schema)
    return shards.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query("SELECT conv_id, turn, role, text FROM conversations")
def src_jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    rows = table(spark, sf_dir, "conversations")
    write_json_lines(rows, path)
    return read_json_lines(spark, path, rows.schema)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def src_csv_header(spark, sf_dir):
    path = scratch_path(spark, "csv")
    rows = table(spark, sf_dir, "orders")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


def _meter_lines(spark, sf_dir):
    """Events as hand-made CSV with a header: errors lack a time, sign-ups say NULL, small values are cut short."""
    events = table(spark, sf_dir, "events")
    meter = F.concat(F.lit(" M-"), F.col("user_id").cast("string"))
    when = F.when(F.col("event_type") == "error", F.lit("")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    used = F.when(F.col("event_type") == "signup", F.lit("NULL")).otherwise(F.col("value").cast("string"))
    whole = csv_line(meter, when, used, F.get_json_object("props", "$.k"), F.col("event_type"))
    lines = events.select(F.when(F.col("value") < 1, csv_line(meter, when)).otherwise(whole).alias("value"))
    header = inline_rows(spark, [("id_meter,timestamp,consumption_kwh,voltage,status",)],
                         T.StructType.fromDDL("value STRING"))
    path = scratch_path(spark, "meter-lines")
    write_lines(header.union(lines), F.col("value"), path)
    return read_lines(spark, path)


@query("""
SELECT 'm-' || user_id AS id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts, value AS kwh,
       json_extract(props, '$.k')::INTEGER AS v, event_type AS status
FROM events WHERE event_type NOT IN ('error', 'signup') AND value >= 1
""")
def src_csv_validate(spark, sf_dir):
    valid, _ = parse_readings(_meter_lines(spark, sf_dir))
    return valid


@query("""
SELECT CASE WHEN value >= 1 THEN event_type END AS status, count(*) AS n FROM events
WHERE event_type IN ('error', 'signup') OR value < 1 GROUP BY 1
""")
def src_csv_rejects(spark, sf_dir):
    _, rejected = parse_readings(_meter_lines(spark, sf_dir))
    return rejected.groupBy(field(F.col("value"), 4).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, user_id::INTEGER AS user_id, event_type, value FROM events")
def src_kafka_decode(spark, sf_dir):
    """Key and value bytes as a topic delivers them, decoded by the function the topic reader uses."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    schema = T.StructType.fromDDL("event_id BIGINT, user_id INT, event_type STRING, value DOUBLE")
    return decode_records(encode_records(events), schema)


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment")
def src_seed_tables(spark, sf_dir):
    """A seed loaded twice: a full refresh, so the counts do not change."""
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "seed")
    write_csv(customer, f"{path}/csv")
    for _ in range(2):
        seed = load_seed(spark, f"{path}/csv", customer.schema, "customer_seed", f"{path}/table")
    return seed.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


EVENT_AVSC = json.dumps({"type": "record", "name": "Event", "fields": [
    {"name": "event_id", "type": "long"},
    {"name": "user_id", "type": "int"},
    {"name": "event_type", "type": ["string", "null"]},
    {"name": "value", "type": "double"},
    {"name": "large", "type": "boolean"},
    {"name": "day", "type": {"type": "int", "logicalType": "date"}},
    {"name": "note", "type": ["null", "string"]},
]})


@query("""
SELECT event_id, user_id::INTEGER AS user_id, nullif(event_type, 'error') AS event_type, value, value > 100 AS large,
       ts::DATE AS day, NULL::VARCHAR AS note
FROM events
""")
def src_avsc_schema(spark, sf_dir):
    """JSON read by an Avro schema: an unknown field is ignored, a missing one is NULL."""
    schema = struct_from_avro(parse_avro_schema(EVENT_AVSC))
    path = scratch_path(spark, "avsc")
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.nullif("event_type", F.lit("error")).alias("event_type"), "value",
        (F.col("value") > 100).alias("large"), F.col("ts").cast("date").alias("day"), "props")
    write_json_lines(events, f"{path}/json")
    write_table(read_json_lines(spark, f"{path}/json", schema), f"{path}/parquet", "parquet", schema=schema)
    return read_table(spark, f"{path}/parquet", "parquet")


@query("""
SELECT fmt, count(*) AS n, sum(p_size)::BIGINT AS sizes
FROM part CROSS JOIN (VALUES ('csv'), ('json'), ('parquet'), ('orc')) AS f(fmt) GROUP BY fmt
""")
def src_full_read(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    path = scratch_path(spark, "full-read")
    results = []
    for fmt in ("csv", "json", "parquet", "orc"):
        write_table(part, f"{path}/{fmt}", fmt)
        rows = read_table(spark, f"{path}/{fmt}", fmt, part.schema)
        results.append(rows.agg(F.count("p_name").alias("n"), F.sum("p_size").alias("sizes"))
                       .select(F.lit(fmt).alias("fmt"), "n", "sizes"))
    return results[0].union(results[1]).union(results[2]).union(results[3])


@query("SELECT sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders")
def src_projected_read(spark, sf_dir):
    """One column is all the scan reads."""
    return table(spark, sf_dir, "orders").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


@query("""
SELECT page_id, split_part(rest, '/', 1) AS bucket,
       CASE WHEN contains(rest, '/') THEN substr(rest, strpos(rest, '/') + 1) ELSE '' END AS object_key
FROM (SELECT page_id, regexp_replace(url, '^https?://', '') AS rest FROM pages)
""")
def src_object_path(spark, sf_dir):
    path = F.regexp_replace("url", "^https?://", "s3://")
    return table(spark, sf_dir, "pages").select(
        "page_id", bucket_column(path).alias("bucket"), key_column(path).alias("object_key"))


@query("""
SELECT user_id AS city, c_nationkey AS country, strftime(ts, '%Y-%m-%d %H:%M:%S') AS forecast_time, value AS temp,
       json_extract(props, '$.k')::DOUBLE AS humidity, CASE WHEN event_type <> 'error' THEN event_type END AS weather_main,
       CASE WHEN event_type = 'view' THEN 0 ELSE value END AS precipitation_probability,
       TIMESTAMP '2024-02-01 06:00:00' AS ingestion_at, event_type <> 'error' AS complete
FROM events JOIN customer ON user_id = c_custkey
""")
def src_nested_json(spark, sf_dir):
    """Documents of up to 40 points each, written as nested JSON, read back and flattened."""
    kind = F.col("event_type")
    sky = F.struct(kind.alias("main"), kind.alias("description"))
    points = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("city"), "event_id", "ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("dt_txt"),
        F.struct(F.col("value").alias("temp"), F.col("value").alias("temp_min"), F.col("value").alias("temp_max"),
                 F.get_json_object("props", "$.k").cast("double").alias("humidity")).alias("main"),
        F.when(kind == "error", F.array().cast("array<struct<main:string,description:string>>"))
        .otherwise(F.array(sky)).alias("weather"),
        F.struct(F.col("value").alias("speed")).alias("wind"),
        F.when(kind != "view", F.col("value")).alias("pop"))
    documents = collect_chunks(points, ["city"], ["ts", "event_id"], ["dt_txt", "main", "weather", "wind", "pop"], "list",
                               chunk_rows=40)
    path = scratch_path(spark, "nested")
    write_lines(documents, row_json(["city", "list"]), path)
    schema = T.StructType([T.StructField("city", T.LongType()), *FORECAST_RESPONSE.fields])
    flat = flatten_forecasts(read_json_lines(spark, path, schema), F.lit("2024-02-01 06:00:00").cast("timestamp_ntz"))
    cities = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("city"), F.col("c_nationkey").alias("country"))
    return lookup_join(flat, cities, ["city"], "inner").select(
        "city", "country", "forecast_time", "temp", "humidity", "weather_main", "precipitation_probability",
        "ingestion_at", "complete")
